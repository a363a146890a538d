"""Models, verdicts and placings against plain versions; clashing columns, very long texts, empty tables, all of Unicode."""

import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from allelon.llm import common, langid, lexicon, packing, quality, rules, sharding, simhash, tokens, topk

SF = "/root/testdata/sf0.001"
WORD, BYTE, PIECES = (P.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# Batches


def test_parts_and_bytes():
    texts = ["é" * 10, None, "", "x" * 500, "ab", "ü"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "text"])
    found = list(common.parts(iter([batch, batch.slice(2)]), most=21))
    assert [b.column(0).to_pylist() for b in found] == [[0, 1, 2], [3], [4, 5], [2], [3], [4, 5]]
    assert list(common.by_bytes(["é" * 3, "a", "b" * 6, "c"], 6)) == [["ééé"], ["a", "bbbbbb"], ["c"]]


# Language


def plain_log(word, pieces, p, unknown=langid.UNKNOWN):
    """Log of the sum over all segmentations, in logs throughout."""
    logs = [0.0] + [-math.inf] * len(word)
    for j in range(1, len(word) + 1):
        own = []
        for i in range(max(0, j - 20), j):
            q = p.get(word[i:j], unknown if j == i + 1 else 0)
            if q:
                own.append(logs[i] + math.log(q))
        top = max(own)
        logs[j] = top + math.log(sum(math.exp(x - top) for x in own))
    return logs[-1]


def some_model():
    pieces = ["▁", "▁a", "a", "ab", "b", "▁ab", "aba", "é"]
    return langid.Unigrams(pieces, np.arange(1, 17, dtype=float).reshape(8, 2) / 100, ["x", "y"])


def test_long_runs_are_summed_whole(monkeypatch):
    own, rng = some_model(), random.Random(1)
    words = ["".join(rng.choices("abcé", k=n)) for n in (1, 3, 24, 25, 26, 70, 500)] + ["c" * 200]
    p = [{q: own.p[i, k] for i, q in enumerate(own.pieces)} for k in range(2)]
    want = [[plain_log("▁" + w, own.pieces, p[k]) for k in range(2)] for w in words]
    assert np.allclose(own.log_likelihoods(words), want, rtol=1e-10)
    uses = own.expected(words, np.ones(len(words)), np.zeros(len(words), int))
    assert np.isclose(sum(uses[i, 0] * len(q) for i, q in enumerate(own.pieces)), sum(len(w) + 1 - w.count("c") for w in words)) and not uses[:, 1].any()
    monkeypatch.setattr(langid, "TOGETHER", 1 << 10)
    word = "".join(rng.choices("abcé", k=5000))
    assert np.allclose(own.log_likelihoods([word, "ab"])[0], [plain_log("▁" + word, own.pieces, p[k]) for k in range(2)], rtol=1e-10)


def test_fit_equals_plain_expectation_maximisation(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat sat", "en"), ("die katze", "de"), ("the the dog", "en"), (None, "en"), ("la casa", None),
        ("der hund der", "de"), ("cat", "en"), ("katze hund", "de"), ("a", "de")] * 2)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES, rounds=2)
    import zlib

    counts = {g: Counter(w for i, t, h in rows if t and h == g and zlib.crc32(str(i).encode()) % 3 != 1 for w in t.split()) for g in ("de", "en")}
    pieces = langid.vocabulary(PIECES)
    known = set(pieces)
    assert model.languages == ["de", "en"] and model.pieces == pieces

    def ways(w):
        if not w:
            yield ()
        for n in range(1, len(w) + 1):
            if w[:n] in known or n == 1:
                yield from ((w[:n], *rest) for rest in ways(w[n:]))

    for k, g in enumerate(("de", "en")):
        p = dict.fromkeys(pieces, 1 / len(pieces))
        for _ in range(2):
            uses = Counter()
            for w, n in counts[g].items():
                all_ways = list(ways("▁" + w))
                odds = [math.prod(p.get(q, langid.UNKNOWN) for q in way) for way in all_ways]
                for way, o in zip(all_ways, odds, strict=True):
                    for q in way:
                        uses[q] += n * o / sum(odds)
            total = sum(0.01 + uses[q] for q in pieces)
            p = {q: (0.01 + uses[q]) / total for q in pieces}
        assert np.allclose(model.p[:-2, k], [p[q] for q in pieces], rtol=1e-9)


def test_prediction_equals_plain_scores(spark, docs):
    model = langid.fit(docs, PIECES, max_docs=60)
    p = [{q: float(np.float32(model.p[i, k])) for i, q in enumerate(model.pieces)} for k in range(len(model.languages))]
    short = docs.where(F.length("text") < 600).limit(25)
    for r in langid.predict(short, model).collect():
        runs = ["".join(c if c.isalpha() else " " for c in w).split() for w in r["text"].lower().split()]
        runs = [x for own in runs for x in own]
        logs = [sum(plain_log("▁" + x, model.pieces, q) for x in runs) for q in p]
        if not runs:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        best = max(range(len(logs)), key=lambda k: logs[k])
        score = 1 / sum(math.exp(max(-700, (x - logs[best]) * min(1, 20 / len(runs)))) for x in logs)
        assert r["lang_pred"] == model.languages[best] and r["score"] == pytest.approx(score, rel=1e-6)


def test_sample_at_any_size(spark, docs):
    for n in (4001, 10**6, 5 * 10**10, 10**15):
        bound = langid.sample_bound(n, 4000)
        assert 0 < bound < 1 << 62 and abs(bound / (1 << 62) * n - 4000) < 1
    assert langid.sample_bound(4000, 4000) == langid.sample_bound(0, 4000) == 1 << 62
    assert langid.fit(docs, PIECES, max_docs=1, rounds=1).languages
    assert len(langid.fit(docs, PIECES, max_languages=2, rounds=1).languages) == 2


def test_only_letters_count(spark, docs):
    odd = ["½ ½", "①", "Ⅷ", "² ³", "٣", "_", "a½b", "日本語", "́", "ª"]
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    got = {r["text"]: r["lang_pred"] for r in langid.predict(rows, langid.fit(docs, PIECES, max_docs=60, rounds=1)).collect()}
    assert {t for t, g in got.items() if g == "und"} == {t for t in odd if not any(c.isalpha() for c in t)}
    assert langid.letter_runs("A½b ①x_y2z É") == ["a", "b", "x", "y", "z", "é"]


# Packing


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 150), max_size=80), st.sampled_from([7, 16, 100]))
def test_packing_takes_the_cheapest_with_room(lengths, capacity):
    full = sum(n // capacity for n in lengths)
    rest = sorted(((n % capacity, d, n - n % capacity) for d, n in enumerate(lengths) if n % capacity), key=lambda x: (-x[0], x[1]))
    room = [capacity] * -(-sum(x[0] for x in rest) // capacity)
    costs, want = [0.0] * len(room), []
    for n, d, at in rest:
        while n:
            able = [s for s in range(len(room)) if room[s] >= n] or [s for s in range(len(room)) if room[s]]
            s = min(able, key=lambda s: (costs[s], s))
            take = min(n, room[s])
            want.append((d, at, take, full + s, capacity - room[s]))
            costs[s] += packing.cost(take, 1.0, 1 / 512)
            room[s] -= take
            at, n = at + take, n - take
    assert packing.pack(lengths, capacity)[full:] == want


# Tokens

LETTER = "".join(random.Random(4).choices("abcdefgh", k=10_000))
LONG = [
    "word " * 260_000, "日本語、テキスト。" * 150_000, "a.b1,c" * 200_000, "x<|endoftext|> y " * 70_000, LETTER * 3 + " " + LETTER, "it's'll don't.1'd\t\n " * 60_000,
]


def test_long_texts_equal_libraries(spark):
    assert all(len(t) > tokens.LONG for t in LONG if t[0] != LETTER[0])
    rows = spark.createDataFrame(list(enumerate(LONG)), "doc_id long, text string").repartition(3)
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    counts = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in tokens.token_counts(rows, WORD).collect()}
    coded = {r["doc_id"]: r for r in lexicon.encode_documents(rows, WORD, lexicon_words=100).collect()}
    pieces = defaultdict(list)
    for r in packing.pack_documents(rows, BYTE).collect():
        pieces[r["doc_id"]].append(r)
    for i, t in enumerate(LONG):
        ids = word.encode(t, add_special_tokens=False).ids
        assert counts[i] == (len(t.encode()), len(ids))
        assert bytes(coded[i]["ids"]) == struct.pack(f"<{len(ids)}I", *ids) and coded[i]["decoded"] == word.decode(ids, skip_special_tokens=False)
        ids = [*byte.encode(t, add_special_tokens=False).ids, 0]
        assert b"".join(bytes(r["ids"]) for r in sorted(pieces[i], key=lambda r: r["start"])) == struct.pack(f"<{len(ids)}I", *ids)


def test_tables_hold_no_long_words():
    table = tokens.length_table(WORD, most=10)
    codec = lexicon.Codec(None, lexicon.WordBpe(WORD), most=10)
    for k in range(5):
        words = {f"w{k}", LETTER + str(k), *(f"v{k}{i}" for i in range(8))}
        assert table.fill(words).keys() >= words and codec.fill(words).keys() >= words
        for own in (table, codec.table):
            assert sum(len(w) > tokens.KEPT_LETTERS for w in own.held) == 1 and len(own.held) + len(own.old) <= 24
            assert not any(len(w) > tokens.KEPT_LETTERS for w in own.old)


_WORD = {}


@settings(max_examples=1500, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_merges_equal_library_over_all_of_unicode(text):
    own = _WORD.setdefault("t", None) or _WORD.update(t=Tokenizer.from_file(WORD), c=lexicon.Codec(None, lexicon.WordBpe(WORD))) or _WORD["t"]
    assert list(memoryview(_WORD["c"].encode(text)).cast("I")) == own.encode(text, add_special_tokens=False).ids


def test_marks_in_the_librarys_order():
    own, codec = Tokenizer.from_file(WORD), lexicon.Codec(None, lexicon.WordBpe(WORD))
    rng = random.Random(2)
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    texts = ["഻҃", "഼࡙", "຺࣓", "߽۫", "࢚࢘"] + ["".join(rng.choices(chars, k=6)) for _ in range(20_000)] + chars[::11]
    assert [x for x, ids in zip(texts, codec.encode_all(texts), strict=True) if list(memoryview(ids).cast("I")) != own.encode(x, add_special_tokens=False).ids] == []


# Quality


def test_weights_equal_plain_ascent():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3)) * [1, 5, 0.1] + [0, 2, 9]
    good = x @ np.array([1.0, -0.3, 2.0]) + rng.normal(size=60) > np.median(x @ np.array([1.0, -0.3, 2.0]))
    model = quality.fit_pairs(x, good)
    z = np.clip((x - x.mean(0)) / x.std(0), -8, 8)
    pairs = [(a, b) for a in np.flatnonzero(good) for b in np.flatnonzero(~good)]
    w = np.zeros(3)
    for _ in range(20_000):
        step = -1e-3 * w
        d = np.array([z[a] - z[b] for a, b in pairs]) if not _ else d
        step = step + (d * (1 / (1 + np.exp(d @ w)))[:, None]).mean(0)
        w = w + 0.5 * step
        if np.abs(step).max() < 1e-9:
            break
    assert np.allclose(model.weights, w, atol=1e-4)
    raw = sorted(z @ w)
    assert model.cut == pytest.approx(np.quantile(raw, (~good).mean()), abs=1e-3)
    assert ((model.score(x) >= quality.CUT) == (z @ w >= model.cut - 1e-9)).all()


def test_fit_uses_all_rows_and_pairs(spark, monkeypatch):
    """12,000 labelled rows, more than a draw of 10,000 took, of which 1,500 alone show what a feature is worth."""
    rng = np.random.default_rng(8)
    n, k = 12_000, 4
    monkeypatch.setattr(quality, "N_FEATURES", k)
    x = rng.normal(size=(n, k))
    good = x @ np.array([1.0, -0.5, 0.2, 0.0]) + rng.normal(size=n) > 0.3
    x[:, 3] = np.where(np.arange(n) >= n - 1500, np.where(good, 1.0, -1.0), 0.0)
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<double>")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality int")
    used = np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i in range(n)])
    pairs = int(good[used].sum()) * int((~good[used]).sum())
    own, whole = quality.fit_rows(rows, labels), quality.fit_pairs(x[used][::5], good[used][::5], pairs=pairs)
    assert np.allclose(own.mean, x[used].mean(0)) and np.allclose(own.spread, x[used].std(0))
    z = np.clip((x[used] - own.mean) / own.spread, -8, 8)
    a, b = z[good[used]], z[~good[used]]
    left = np.zeros(k)
    for part in np.array_split(a, 40):  # the gradient over all pairs
        p = 1 / (1 + np.exp(-((part @ own.weights)[:, None] - (b @ own.weights)[None, :])))
        left += (part * (1 - p).sum(1)[:, None]).sum(0) - (1 - p).sum(0) @ b
    assert np.abs(left / pairs - 1e-3 * own.weights).max() < 1e-4
    assert np.allclose(own.weights, whole.weights, atol=0.6)
    assert own.cut == pytest.approx(np.quantile(z @ own.weights, (~good[used]).mean()), abs=1e-9) and own.scale == pytest.approx((z @ own.weights).std() / 2)


def test_fit_ends_where_bins_are_dealt_anew(spark, monkeypatch):
    """Features that nearly repeat each other and few bad rows: bins that are dealt anew move the weights for ever, but no longer the loss."""
    rng = np.random.default_rng(5)
    n, k = 4_000, 8
    monkeypatch.setattr(quality, "N_FEATURES", k)
    x = rng.normal(size=(n, k))
    x[:, 4:] = x[:, :4] + rng.normal(size=(n, 4)) * 0.01
    good = x[:, 0] + 0.1 * rng.normal(size=n) > -1.2
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<double>")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality int")
    used, passes, sums = np.array([zlib.crc32(str(i).encode()) % 4 != 2 for i in range(n)]), [], quality._sums
    monkeypatch.setattr(quality, "_sums", lambda *a: passes.append(1) or sums(*a))
    own = quality.fit_rows(rows, labels)
    z = np.clip((x[used] - own.mean) / own.spread, -8, 8)
    a, b = z[good[used]], z[~good[used]]
    p = 1 / (1 + np.exp(-((a @ own.weights)[:, None] - (b @ own.weights)[None, :])))
    left = (a.T @ (1 - p).sum(1) - b.T @ (1 - p).sum(0)) / p.size - 1e-3 * own.weights
    assert np.abs(left).max() < 1e-4 and len(passes) <= 17


def test_sums_meet_in_few_tasks(spark):
    """A Newton step starts no Python for each partition of the session's shuffles."""
    rows = spark.createDataFrame([(i % 2, [float(i)] * quality.N_FEATURES) for i in range(40)], "label int, x array<double>")
    model = quality.Ranking(*(np.full(quality.N_FEATURES, v) for v in (0.0, 1.0, 0.1)))
    held = {"spark.sql.shuffle.partitions": "67", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, sc = {k: spark.conf.get(k) for k in held}, spark.sparkContext
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        sc.setJobGroup("sums-of-few-tasks", "")
        label, count, total, square = quality._sums(rows, model, 1 / 16)
    finally:
        sc._jsc.clearJobGroup()
        for name, value in before.items():
            spark.conf.set(name, value)
    jobs = sc.statusTracker().getJobIdsForGroup("sums-of-few-tasks")
    stages = {s for j in jobs for s in sc.statusTracker().getJobInfo(j).stageIds}
    tasks = [i.numTasks for i in map(sc.statusTracker().getStageInfo, stages) if i]
    assert tasks and max(tasks) <= max(sc.defaultParallelism, rows.rdd.getNumPartitions())
    assert count.sum() == 40 and list(label) == sorted(label) and total[:, 0].sum() == pytest.approx(sum(min(i, 8) for i in range(40)))
    assert square.shape[1:] == (quality.N_FEATURES, quality.N_FEATURES)


def test_scores_equal_plain_features(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)

    def plain(t):
        words = [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in t).split(" ") if w]
        n, size = max(1, len(words)), max(1, len(t.encode()))
        kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\x0b\x0c", ".,;:?'\"()-"]
        classes = [sum(c in k for c in t) for k in kinds]
        classes += [sum(ord(c) < 128 for c in t) - sum(classes), sum(ord(c) > 127 for c in t)]
        lines = [x for x in t.split("\n") if x.strip(" \t\r\x0b\x0c")]
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        cover = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
        sizes = [len(w.encode()) for w in words]
        share = lambda f: sum(map(f, sizes)) / len(sizes) if sizes else 0.0
        return [math.log1p(len(words)), math.log1p(len(lines)), *(c / size for c in classes),
            *(min(1.0, math.sqrt(t.count(chr(c)) / n)) for c in quality.MARKS), len(set(words)) / n,
                1 - len(set(lines)) / max(1, len(lines)), len(cover) / n, share(lambda k: k), share(lambda k: k <= 3), share(lambda k: k > 15)]

    rows = docs.orderBy("doc_id").limit(60).collect()
    got = {r["doc_id"]: r["score"] for r in quality.predict(docs, model).collect()}
    for r in rows:
        raw = float(np.clip((np.array(plain(r["text"] or "")) - model.mean) / model.spread, -8, 8) @ model.weights)
        z = (raw - model.cut) / model.scale + math.log(0.7 / 0.3)
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-max(-500, min(500, z)))), rel=1e-9, abs=1e-12)


# Rules


def plain_distance(p, q):
    p, q = ({k: v / sum(x.values()) for k, v in x.items() if v} for x in (p, q))
    if not p or not q:
        return 1.0
    m = {k: (p.get(k, 0) + q.get(k, 0)) / 2 for k in {*p, *q}}
    part = lambda x: sum(v * math.log2(v / m[k]) for k, v in x.items())
    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def test_verdicts_equal_plain_divergences(spark, docs):
    rows = docs.collect()
    kinds = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r\x0b\x0c", ".,;:?'\"()-"]
    split = lambda t: [w for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in t).split(" ") if w]
    kind = lambda c: next((k for k, own in enumerate(kinds) if c in own), 6 if ord(c) < 128 else 7)
    words, classes = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        if r["lang"] is not None and r["text"] is not None:
            words[r["lang"]].update(split(r["text"]))
            classes[r["lang"]].update(map(kind, r["text"]))
    common_words = {g: dict(sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:50]) for g, c in words.items()}
    reference = {g: {**w, "": sum(words[g].values()) - sum(w.values())} for g, w in common_words.items()}
    got = {r["doc_id"]: r for r in rules.quality_rules(docs).collect()}
    assert len(got) == len(rows)
    for r in rows:
        own, t = split(r["text"] or ""), Counter(map(kind, r["text"] or ""))
        found = []
        for g in words:
            w = Counter(x if x in common_words[g] else "" for x in own)
            found.append((plain_distance(w, reference[g]), plain_distance(t, classes[g])))
        odd, far = min(found)
        v = got[r["doc_id"]]
        assert (v["word_distance"], v["class_distance"]) == (pytest.approx(odd, abs=1e-9), pytest.approx(far, abs=1e-9))
        bad = (len(own) >= 30 and far > rules.LIMITS["class_limit"]) or (len(own) >= 60 and odd > rules.LIMITS["word_limit"])
        assert v["kept"] == (not v["base_failed"] and not bad)


def test_references_are_exact_however_they_are_counted(docs):
    own = docs.repartition(5)
    want = rules.language_references(own)
    for more in ({"top": 60, "most": 1500}, {"top": 20, "most": 300}, {"top": 60, "most": 1500, "most_candidates": 1}):
        got = rules.language_references(own, **more)
        assert got.keys() == want.keys() and all((got[g][0] == want[g][0]).all() and got[g][1] == want[g][1] and (got[g][2] == want[g][2]).all() for g in want)
    assert len(rules.language_references(own, max_languages=2)) == 2


# Sharding


def test_placing_equals_plain_arrays(spark, tmp_path):
    n, seed = 500, 7
    spark.range(n).coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = {r["id"]: (r["shard"], r["slot"]) for r in sharding.shard_shuffle(df, 5, seed, home_rows=64, block_bytes=200).collect()}
    sizes = [min(64, n - at) for at in range(0, n, 64)]
    matrix = sharding.communication_matrix(sizes, 5, seed)
    shard = np.empty(n, int)
    for home, size in enumerate(sizes):
        labels = np.repeat(np.arange(5, dtype=np.int32), matrix[home])
        np.random.Generator(np.random.Philox(key=[seed, home + 1])).shuffle(labels)
        shard[home * 64 : home * 64 + size] = labels
    assert [got[i][0] for i in range(n)] == shard.tolist() and Counter(shard.tolist()) == {k: 100 for k in range(5)}
    order = {r["id"]: r["r"] & (2**64 - 1) for r in df.select("id", F.xxhash64(F.lit(seed), F.expr("id div 64"), F.expr("id % 64")).alias("r")).collect()}
    blocks = max(r[1] for r in got.values())
    assert blocks == 99
    for k in range(5):
        own = sorted((i for i in range(n) if shard[i] == k), key=lambda i: got[i][1])
        top = [order[i] >> 33 for i in own]  # blocks are ranges of the upper bits
        assert all(a * 1 // (1 << 31) <= b for a, b in zip(top, top[1:], strict=False)) and [got[i][1] for i in own] == list(range(100))


def test_shuffle_is_uniform_over_seeds():
    """Each row is in each shard equally often, and so is each pair of rows in the same shard."""
    seen, pair = np.zeros((10, 3)), 0
    for seed in range(3000):
        matrix = sharding.communication_matrix([4, 6], 3, seed)
        shard = np.concatenate([sharding._labels.__wrapped__(seed, h, tuple(matrix[h].tolist())) for h in range(2)])
        seen[np.arange(10), shard] += 1
        pair += shard[0] == shard[9]
    # shards of 4, 3 and 3 rows: any two rows share one with probability (4 * 3 + 3 * 2 + 3 * 2) / (10 * 9)
    assert np.abs(seen / 3000 - [0.4, 0.3, 0.3]).max() < 0.04 and abs(pair / 3000 - 24 / 90) < 0.04


# Columns of any name, empty tables

CLASHES = ["__file", "__row", "__run", "__home", "__at", "__r", "__block", "__task", "__h", "__own", "__often", "score", "lang_pred", "kept", "n_words", "root", "fp", "_metadata"]


@pytest.fixture(scope="module")
def clashing(docs):
    return docs.where("doc_id < 60").select("*", *(F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in CLASHES))


def test_clashing_columns_keep_their_values(spark, docs, clashing):
    rows = {r["doc_id"]: r for r in clashing.collect()}
    kept = {
        "language": langid.keep_identified(clashing, PIECES, max_docs=60, rounds=1),
        "rules": rules.keep_by_rules(clashing),
        "copies": simhash.drop_near_duplicates(clashing),
    }
    for name, found in kept.items():
        assert found.columns == clashing.columns, name
        own = found.collect()
        assert own and all(r == rows[r["doc_id"]] for r in own), name
    dealt = sharding.shard_shuffle(clashing, 3)
    assert dealt.columns == [*clashing.columns, "shard", "slot"]
    assert {r["doc_id"]: r[: len(clashing.columns)] for r in dealt.collect()} == {i: tuple(r) for i, r in rows.items()}


def test_empty_table_through_the_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    docs.where("1 = 0").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    none = docs.where("1 = 0")
    assert rules.keep_by_rules(none).columns == langid.keep_identified(none, PIECES).columns == none.columns


def test_repeated_rows_and_null_ids_keep_one(spark):
    rows = [(1, "one two three four five six", "a"), (1, "one two three four five six", "b"), (None, "other words stand in this text", "c"),
        (None, "other words stand in this text", "d"), (2, None, "e"), (3, "", "f")]
    found = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, more string")).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "2", "None"] and all(tuple(r) in rows for r in found)


# SimHash and search


def test_segments_follow_the_count():
    assert [simhash.segment_count(n, 4) for n in (1, 10**6, 10**7, 10**9, 10**10, 10**12)] == [5, 5, 6, 6, 7, 8]


@pytest.mark.parametrize("segments", [5, 6, 7, 8])
def test_links_are_whole_for_any_segments(spark, monkeypatch, segments):
    monkeypatch.setattr(simhash, "segment_count", lambda *_: segments)
    rng = random.Random(segments)
    base = [rng.getrandbits(64) for _ in range(20)]
    codes = sorted({*base, *(b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 5))) for b in base for _ in range(4))})
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    links = simhash.near_links(spark.createDataFrame([(c,) for c in signed], "fp long"), 4).collect()
    root = {c: c for c in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        root[find(r["u"])] = find(r["v"])
    for i, a in enumerate(signed):
        for b in signed[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 4:
                assert find(a) == find(b)


def test_top_k_in_blocks_and_parts(spark):
    rng = np.random.default_rng(5)
    codes = rng.integers(-(2**63), 2**63, 400)
    codes[50:200] = codes[0]
    df = spark.createDataFrame([(i, int(c)) for i, c in enumerate(codes)] + [(None, 1), (7000, None)], "id long, code long")
    found = topk.top_k(df, df.where("id % 20 = 0"), 7, block_rows=90, query_rows=6).collect()
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["distance"], r["id"]))
    assert len(got) == 20
    for q, near in got.items():
        assert near == sorted((((int(codes[q]) ^ int(c)) & (2**64 - 1)).bit_count(), i) for i, c in enumerate(codes))[:7]


def test_digest_is_of_whole_text(spark):
    """A very long text's fingerprint is of all its shingles."""
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdef", k=4)) for _ in range(200_000))
    fps = {r["id"]: r["fp"] for r in simhash.fingerprints(spark.createDataFrame([(1, text), (2, text.rsplit(" ", 60_000)[0])], "doc_id long, text string")).collect()}
    assert fps[1] != fps[2]
