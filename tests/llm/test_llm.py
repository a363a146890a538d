"""Each operator against a brute-force version on a small fixture with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from allelon.llm import components, langid, lexicon, packing, quality, queries, rules, sharding, simhash, tokens, topk, warc

SF = "/root/testdata/sf0.001"
WORD, BYTE, PIECES = (P.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "\n", "a", "  two  blanks \n lines\t\n", "Ünïcödé ΣΑΣ İstanbul naïve é", "x<|endoftext|>y <|startoftext|> z", "it's we'll 12345 don'T",
    "a\x1cb\x1fc\x85d\xa0e　f", "!!!***$$$ | ||", "日本語 テキスト 🙂🙂", "long" * 5000, "word " * 3000, "<|ENDOFTEXT|> <|endoftext|>", "é́ é",
]


def docs_of(spark, texts, ids=None, extra=True):
    rows = [(i if ids is None else ids[i], t, random.Random(i).choice(["en", "de", None]), "s", 1, "clash") for i, t in enumerate(texts)]
    own = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    return own if extra else own.drop("score")


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def some_texts(sample):
    return [r["text"] for r in sample.orderBy("doc_id").collect()] + ODD


# WARC


def test_warc_round_trip(spark):
    same = "<p>" + "x" * 200
    rows = [(3, "http://a/\r\nb", same), (1, None, same), (2, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (7, "ü", "é" * 50),
        (None, "n", same), (8, "v", "y" * 100000), (1, None, same)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    got = sorted((tuple(r) for r in warc.warc_round_trip(pages).collect()), key=str)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = min(j for j, _, h in rows if h == html and j is not None) if len(data) >= 100 else None
        kind = "revisit" if first is not None and i != first else "response"
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), kind, first if kind == "revisit" else None))
    assert got == sorted(want, key=str)
    index = warc.write_archives(pages)
    one = warc.read_archives(index.where("url = 'v'")).collect()
    assert [r["payload"] for r in one] == [bytearray(b"y" * 100000)]
    assert warc.warc_round_trip(pages.where("1 = 0")).count() == 0


# Sharding


def test_matrix_sums_and_law():
    m = sharding.communication_matrix([5, 0, 7, 3], 4, 1)
    assert m.sum(1).tolist() == [5, 0, 7, 3] and sorted(m.sum(0).tolist()) == [3, 4, 4, 4]
    seen = Counter(int(sharding.communication_matrix([2, 2], 2, s)[0, 0]) for s in range(3000))
    assert abs(seen[1] / 3000 - 4 / 6) < 0.04 and abs(seen[0] / 3000 - 1 / 6) < 0.03
    rng = np.random.default_rng(0)
    big = [sharding._hypergeometric(rng, 3_000_000_000, 1_000_000_000, 1000) for _ in range(300)]
    assert abs(np.mean(big) - 750) < 4


def test_shuffle_is_whole_and_even(spark, some_texts, tmp_path):
    texts = some_texts + [some_texts[0]] * 5
    df = docs_of(spark, texts, [None if i % 17 == 0 else i for i in range(len(texts))]).withColumnRenamed("score", "slot").repartition(3)
    for own in (df, spark.read.parquet(_written(df, tmp_path))):
        got = sharding.shard_shuffle(own, 8, home_rows=16, block_bytes=4096).collect()
        assert Counter(r["text"] for r in got) == Counter(texts)
        slots = defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1 and len(slots) == 8
    assert sharding.shard_shuffle(spark.read.parquet(str(tmp_path / "t")).where("1 = 0")).count() == 0
    again = lambda: sorted(str(tuple(r)) for r in sharding.shard_shuffle(spark.read.parquet(str(tmp_path / "t"))).collect())
    assert again() == again()


def _written(df, tmp_path):
    df.write.parquet(str(tmp_path / "t"))
    return str(tmp_path / "t")


# BPE


def test_codec_equals_library(spark, some_texts):
    own = Tokenizer.from_file(WORD)
    got = {r["doc_id"]: r for r in lexicon.encode_documents(docs_of(spark, some_texts), WORD, lexicon_words=500).collect()}
    for i, t in enumerate(some_texts):
        ids = own.encode(t or "", add_special_tokens=False).ids
        assert bytes(got[i]["ids"]) == struct.pack(f"<{len(ids)}I", *ids), t
        assert got[i]["decoded"] == own.decode(ids, skip_special_tokens=False)
    assert lexicon.encode_documents(docs_of(spark, some_texts).where("1 = 0"), WORD).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.sets(st.text(min_size=1, max_size=6), max_size=40), st.text(max_size=6))
def test_lexicon_holds_its_words_only(tmp_path_factory, words, other):
    words = {w for w in words if w.isprintable()}
    path = tmp_path_factory.mktemp("fst") / "x"
    path.write_bytes(lexicon.compile_lexicon(words, lambda w: [len(w), *w.encode()]))
    own = lexicon.Lexicon(str(path))
    for w in words:
        assert own.ids(w) == struct.pack(f"<{1 + len(w.encode())}I", len(w), *w.encode())
    assert (own.ids(other) is None) == (other not in words)


def test_lexicon_shares_suffixes(tmp_path):
    (tmp_path / "x").write_bytes(lexicon.compile_lexicon([a + "ation" for a in "bcdf"], lambda w: [1]))
    assert struct.unpack_from("<8I", (tmp_path / "x").read_bytes())[1] == 7


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_merges_equal_library(text):
    own = Tokenizer.from_file(WORD) if not hasattr(test_merges_equal_library, "t") else test_merges_equal_library.t
    test_merges_equal_library.t = own
    if not hasattr(test_merges_equal_library, "c"):
        test_merges_equal_library.c = lexicon.Codec(None, lexicon.WordBpe(WORD))
    known = [c for c in text if ord(c) < 0x3000 and c.isprintable()]
    text = "".join(known)
    assert list(memoryview(test_merges_equal_library.c.encode(text)).cast("I")) == own.encode(text, add_special_tokens=False).ids


def test_token_counts_equal_library(spark, some_texts):
    own = Tokenizer.from_file(WORD)
    got = {r["doc_id"]: r for r in tokens.token_counts(docs_of(spark, some_texts), WORD).collect()}
    for i, t in enumerate(some_texts):
        assert got[i]["n_tokens"] == len(own.encode(t or "", add_special_tokens=False).ids), t
        assert got[i]["n_bytes"] == len((t or "").encode())
    assert tokens.token_counts(docs_of(spark, some_texts).where("1 = 0"), WORD).count() == 0


# Packing


def test_packing_is_exact_and_full(spark, some_texts):
    own = Tokenizer.from_file(BYTE)
    df = docs_of(spark, some_texts).coalesce(1)
    pieces, full = defaultdict(list), defaultdict(list)
    for r in packing.pack_documents(df, BYTE).collect():
        pieces[r["doc_id"]].append(r)
        full[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t in enumerate(some_texts):
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(pieces[i], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in parts) == struct.pack(f"<{len(ids)}I", *ids), t
        assert all(r["doc_tokens"] == len(ids) and r["length"] == len(r["ids"]) // 4 > 0 for r in parts)
        assert [r["start"] for r in parts] == np.cumsum([0, *(r["length"] for r in parts)])[:-1].tolist()
    for spans in full.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    used = sum(n for s in full.values() for _, n in s)
    assert len(full) * 1024 - used < 1024
    assert packing.pack_documents(df.where("1 = 0"), BYTE).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([16, 100]))
def test_pack_law(lengths, capacity):
    found = packing.pack(lengths, capacity)
    got = Counter()
    for d, _, n, _, _ in found:
        got[d] += n
    assert dict(got) == dict(enumerate(lengths))
    assert len({p[3] for p in found}) == -(-sum(n % capacity for n in lengths) // capacity) + sum(n // capacity for n in lengths)


# Language


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "ab", "b", "▁ab"]
    p = np.arange(1, 13, dtype=float).reshape(6, 2) / 100
    own = langid.Unigrams(pieces, p, ["x", "y"])

    def brute(s, k):
        return 1.0 if not s else sum(p[pieces.index(s[:n]), k] * brute(s[n:], k) for n in range(1, len(s) + 1) if s[:n] in pieces)

    for w in ("a", "ab", "abab", "bba"):
        assert np.allclose(np.exp(own.log_likelihoods([w])[0]), [brute("▁" + w, 0), brute("▁" + w, 1)])
    uses = own.expected(["ab"], np.array([2.0]), np.array([1]))
    length = sum(uses[i, 1] * len(q) for i, q in enumerate(pieces))
    assert np.isclose(length, 2 * 3)


def test_language_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, PIECES, max_docs=400)
    found = langid.predict(docs, model).where("crc32(cast(doc_id as string)) % 3 = 1").select("lang", "lang_pred", "score").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.95 and all(0 <= r["score"] <= 1 for r in found)
    odd = {r["text"]: (r["lang_pred"], r["score"]) for r in langid.predict(docs_of(spark, ODD), model).collect()}
    assert odd[None] == odd[""] == odd["!!!***$$$ | ||"] == ("und", 0.0)
    none = langid.fit(docs.where("1 = 0"), PIECES)
    assert {r["lang_pred"] for r in langid.predict(docs_of(spark, ODD), none).collect()} == {"und"}
    assert langid.keep_identified(docs_of(spark, ODD), PIECES).columns == docs_of(spark, ODD).columns
    assert langid.predict(docs.where("1 = 0"), model).count() == 0


# Quality


def test_quality_ranks_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.predict(docs, quality.fit(docs, labels)).join(labels, "doc_id").where("crc32(cast(doc_id as string)) % 4 = 2").collect()
    good, bad = ([r["score"] for r in found if r["quality"] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    model = quality.fit(docs, labels.where("1 = 0"))
    assert {round(r["score"], 6) for r in quality.predict(docs_of(spark, ODD), model).collect()} == {0.7}
    assert quality.predict(docs.where("1 = 0"), model).count() == 0


def test_pairs_follow_a_planted_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    good = x @ np.array([2.0, -1.0, 0.0]) + rng.normal(size=400) * 0.3 > 0
    model = quality.fit_pairs(x, good)
    assert np.mean((model.score(x) >= 0.7) == good) > 0.9


# Top-k


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    codes = rng.integers(-(2**63), 2**63, 300)
    codes[100:150] = codes[0]
    codes[150:200] ^= 1
    df = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes)] + [(7, int(codes[7]))], "id long, code long")
    rows = [(i, int(c)) for i, c in enumerate(codes)] + [(7, int(codes[7]))]
    got = defaultdict(list)
    for r in topk.top_k(df, df.where("id % 50 = 0"), 10, block_rows=64).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["distance"], r["id"]))
    for q in range(0, 300, 50):
        assert got[q] == sorted((((int(codes[q]) ^ c) & (2**64 - 1)).bit_count(), i) for i, c in rows)[:10]
    assert topk.top_k(df, df.where("1 = 0")).count() == topk.top_k(df.where("1 = 0"), df).count() == 0
    assert topk.top_k(df.limit(3), df.limit(1), 10).count() == 3


def test_sign_codes(spark):
    rows = [(1, [1.0, -1.0, float("nan"), None] + [0.5] * 60), (2, None), (3, []), (None, [1.0]), (4, [-1.0] * 63 + [2.0] * 5)]
    got = {r["id"]: r["code"] for r in topk.sign_codes(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (((1 << 64) - 1) ^ 0b1110) - (1 << 64), 3: 0, 4: -(1 << 63)}


# Rules


def brute_rules(t):
    sep = "\x20\x09\x0a\x0b\x0c\x0d"
    words = [w for w in "".join(" " if c in sep else c for c in t).split(" ") if w]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    cover = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines, dup = set(), 0
    for x in t.split("\n"):
        if x.strip(sep):
            dup += x in lines
            lines.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(cover)


def test_rules_equal_brute_force(spark, some_texts):
    got = {r["doc_id"]: r for r in rules.quality_rules(docs_of(spark, some_texts)).collect()}
    for i, t in enumerate(some_texts):
        n, *_, r = want = brute_rules(t or "")
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == want, t
        assert got[i]["base_failed"] == (n < 20 or 100 * r > 30 * n)
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert rules.quality_rules(docs_of(spark, some_texts).where("1 = 0")).count() == 0
    kept = rules.keep_by_rules(docs_of(spark, some_texts).withColumnRenamed("score", "kept"))
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]} and "kept" in kept.columns


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_repeated_words(ids):
    n = len(ids)
    windows = Counter(tuple(ids[i : i + 8]) for i in range(n - 7))
    want = {i + k for i in range(n - 7) if windows[tuple(ids[i : i + 8])] > 1 for k in range(8)}
    assert rules.repeated_words(np.array(ids, np.int64)) == len(want)


def test_js_distance():
    assert rules.js_distance(np.array([1.0, 0]), np.array([0, 3.0])) == pytest.approx(1) and rules.js_distance(np.array([1.0, 2]), np.array([2.0, 4])) == 0


# SimHash


def brute_fingerprint(t):
    sep = "\x20\x09\x0a\x0b\x0c\x0d"
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if c in sep else c for c in t)
    words = [w for w in low.split(" ") if w]
    if not words:
        return 0
    parts = [words[i : i + 4] for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64(" ".join(p).encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_near_groups_equal_brute_force(spark, some_texts):
    texts = some_texts + [t + " end" for t in some_texts if t] + [some_texts[3]] * 3
    fps = [brute_fingerprint(t or "") for t in texts]
    want = brute_groups(fps)
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: r for r in simhash.near_groups(docs).collect()}
    for i in range(len(texts)):
        assert got[i]["fp"] & (2**64 - 1) == fps[i], texts[i]
        assert got[i]["component_id"] == want[i]
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))
    assert simhash.near_groups(docs.where("1 = 0")).count() == simhash.drop_near_duplicates(docs.where("1 = 0")).count() == 0
    nulls = docs_of(spark, ["same words in both of these"] * 3 + ["quite other words stand here now"] * 2, [None, 5, 4, None, None])
    assert sorted(str(r["doc_id"]) for r in simhash.drop_near_duplicates(nulls).collect()) == ["4", "None"]


def test_large_groups_are_dealt_into_tiles(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    codes = {base}
    while len(codes) < 400:  # one dense group, chains, and noise that shares a segment
        x = rng.choice(sorted(codes))
        for _ in range(rng.randint(1, 6)):
            x ^= 1 << rng.randrange(64)
        codes.add(x)
    codes |= {(base & 0xFFFFFFFF) | rng.getrandbits(32) << 32 for _ in range(300)}
    codes = sorted(codes)
    want = brute_groups(codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "fp long")
    for size in (8192, 32):
        links = simhash.near_links(df, 4, group_rows=size)
        assert all(((r["u"] ^ r["v"]) & (2**64 - 1)).bit_count() for r in links.collect())
        roots = {r["node"]: r["root"] for r in components.components(links).collect()}
        groups = defaultdict(set)
        for c, w in zip(signed, want, strict=True):
            groups[w].add(roots.get(c, c))
        assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1300)}}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# Queries and pipeline


def test_queries_are_whole(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op2_sharding", "op3_bpe_codec", "op4_language_id", "op5_quality_classifier", "op6_token_counts", "op9_quality_rules", "op10_simhash"):
        assert queries.QUERIES[name](spark, SF).count() == n, name


def test_pipeline_equals_its_stages(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = corpus_pipeline.language_id(spark, docs, SF)
    assert {r["doc_id"] for r in docs.join(known, "doc_id", "left_anti").collect()} <= {r["doc_id"] for r in docs.collect() if not langid.letter_runs(r["text"] or "")} | {
        r["doc_id"] for r in langid.predict(docs, langid.fit(docs, PIECES)).where("score < 0.5").collect()
    }
    ruled = corpus_pipeline.quality_rules(spark, known, SF)
    for r in known.join(ruled, "doc_id", "left_semi").collect():
        n, *_, rep = brute_rules(r["text"])
        assert n >= 20 and 100 * rep <= 30 * n
    once = corpus_pipeline.near_duplicates(spark, ruled, SF)
    rows = sorted(ruled.collect(), key=lambda r: r["doc_id"])
    root = brute_groups([brute_fingerprint(r["text"]) for r in rows])
    want = sorted(rows[i]["doc_id"] for i in set(root))
    assert sorted(r["doc_id"] for r in once.collect()) == want and once.columns == docs.columns
    out = corpus_pipeline.run(spark, SF).collect()
    assert sorted({r["doc_id"] for r in out}) == want
    own = Tokenizer.from_file(BYTE)
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in out:
        ids = [*own.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
