"""Line deduplication, the conversation trie and whitening against brute force on small fixtures with odd rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from allelon.llm import linededup, queries, trie, whitening

SF = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Lines


def plain_lines(rows, min_chars=20, min_docs=3):
    key = lambda line: line.strip(BLANKS).translate(UPPER)
    docs, owner = Counter(), {}
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            docs[k] += 1
            if i is not None and (owner.get(k) is None or i > owner[k]):
                owner[k] = i
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and docs[key(x)] >= min_docs and i != owner.get(key(x)))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    common, other, rng = "This line is in very many documents", "ÜBER Straße naïve Ωmega İ line", random.Random(3)
    pool = [common, other, "  " + common.upper() + "\t\r", "short", "x" * 19, "y" * 20, "é" * 20, "", " ", other + "\x0b", "\x85" + "z" * 25, "unique "]
    rows = [(i, "\n".join(rng.choice(pool) + (str(i) if rng.random() < 0.2 else "") for _ in range(rng.randint(0, 12)))) for i in range(60)]
    rows += [(None, common + "\n" + other), (None, None), (70, None), (71, ""), (72, "\n\n"), (5, rows[5][1]), (5, common), (80, "\n".join([common, "y" * 20] * 30_000)), (-4, other)]
    return rows


def test_lines_equal_brute_force(spark):
    rows = line_rows()
    docs = spark.createDataFrame([(i, t, k, "clash", "x") for k, (i, t) in enumerate(rows)], "doc_id long, text string, lost int, kept_text string, `a.b` string").repartition(3)
    for batches, fanout in ((4, 2), (1, 2), (7, 3)):
        found = linededup.drop_lines(docs, batches=batches, fanout=fanout)
        assert found.columns == ["doc_id", "text", "lost", "a.b", "n_lines", "n_dropped", "kept_text"]
        assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in found.collect()), key=str) == plain_lines(rows)


def test_no_lines(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert linededup.drop_lines(empty).collect() == []
    nulls = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    assert [tuple(r) for r in linededup.drop_lines(nulls).collect()] == [(None, None, 1, 0, "")] * 2


def test_runs_by_levels(spark):
    runs = linededup.LineRuns(spark, fanout=2, buckets=3)
    for b, keys in enumerate([[1, 2], [2, 3], [3, 1, 4], [1]]):
        batch = spark.createDataFrame([(k, k, 1, 100 - b) for k in keys], "h1 long, h2 long, docs long, owner long")
        assert {r["h1"] for r in runs.unseen(batch).collect()} == set(keys) - {k for own in [[1, 2], [2, 3], [3, 1, 4], [1]][:b] for k in own}
        runs.add(batch)
        assert [len(level) for level in runs.levels] == [[1], [0, 1], [1, 1], [0, 0, 1]][b]
    assert {(r["h1"], r["docs"], r["owner"]) for r in runs.found().collect()} == {(1, 3, 100), (2, 2, 100), (3, 2, 99), (4, 1, 98)}
    assert {r["h1"] for r in runs.found(3).collect()} == {1}
    runs.close()
    assert runs.runs() == [] and not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


# Conversations


def plain_trie(rows, family=20, spans=4):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % spans
        built[c] = tuple(own.get(c - c % family, [])[:h] + v[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, p in built.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
        ends[p].append(c)
    kids = Counter(p[:-1] for p in members if p)
    words = lambda t: len([w for w in "".join(" " if x in BLANKS else x for x in t).split(" ") if w])
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * words(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
        hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def rows_of_trie(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def conversation_rows(seed, n=150):
    rng, out = random.Random(seed), []
    texts = ["a b", "a  b\tc", "", None, "x", "long " * 300, "ü ö"]
    for c in range(n):
        if c % 20 == 0 and rng.random() < 0.3:
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            out.append((c, None if turn == 0 and rng.random() < 0.1 else turn, rng.choice(["user", None]) if turn % 2 == 0 else "assistant", rng.choice(texts[: 2 + turn % 6])))
    # One conversation that very many repeat, one that is long.
    out += [(1000 + k, turn, "user", "same words here") for k in range(200) for turn in range(4)]
    out += [(5000, turn, "user", str(turn % 3)) for turn in range(700)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("shard_turns", [40, 100_000])
def test_trie_equals_brute_force(spark, shard_turns):
    rows = conversation_rows(shard_turns)
    turns = spark.createDataFrame([(*r, "clash", 1) for r in [*rows, (None, 0, "user", "no id")]], "conv_id long, turn long, role string, text string, depth string, id int").repartition(4)
    assert rows_of_trie(trie.prefix_trie(turns, shard_turns=shard_turns)) == plain_trie(rows)


def test_small_tries(spark):
    kind = "conv_id long, turn long, role string, text string"
    assert trie.prefix_trie(spark.createDataFrame([], kind)).collect() == []
    # Conversation 7 has no base, so what it would take from it is missing; all its turns may be left out.
    for rows in ([(7, 0, "user", "a")], [(20, 0, "u", "a b"), (20, 1, "u", "c"), (21, 0, "u", "z")], [(3, None, None, None)]):
        assert rows_of_trie(trie.prefix_trie(spark.createDataFrame(rows, kind))) == plain_trie(rows)
    # Repeated rows and turns of one number are turns of their own, in one order for all conversations.
    tied = [(c, 0, "u", t) for c in (40, 60) for t in ("one", "two", "two")]
    found = {r["depth"]: r for r in trie.prefix_trie(spark.createDataFrame(tied, kind), shard_turns=1).collect() if r["n_convs"] == 2}
    assert set(found) >= {0, 1} and max(r[1] for r in rows_of_trie(trie.prefix_trie(spark.createDataFrame(tied, kind)))) == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=0, max_size=900))
def test_parentheses(rises):
    depth = [0]
    for r in rises:
        depth.append(max(1, depth[-1] + 1 - r))
    piece, n = trie.Piece(np.array(depth)), len(depth)
    ends = [next((j for j in range(i + 1, n) if depth[j] <= depth[i]), n) for i in range(n)]
    assert piece.end.tolist() == ends
    values = np.arange(n) + 1
    assert piece.sums(values).tolist() == [values[i : ends[i]].sum() for i in range(n)]
    assert piece.least(-values).tolist() == [(-values)[i : ends[i]].min() for i in range(n)]
    leaf = [i + 1 == e for i, e in enumerate(ends)]
    assert piece.leaves().tolist() == [sum(leaf[i : ends[i]]) for i in range(n)]
    assert piece.children().tolist() == [sum(depth[j] == depth[i] + 1 for j in range(i + 1, ends[i])) for i in range(n)]


# Embeddings


def plain_whitening(rows, k=16):
    kept = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(0)
    y = (n * fit - total) / n
    e, w = np.linalg.eigh(y.T @ y / n)
    e, w = e[::-1], w[:, ::-1]
    k = min(k, int((e > 1e-12 * e.sum()).sum()))
    return kept, n, ((n * x - total) ** 2).sum(1), ((n * x - total) / n) @ (w[:, :k] / np.sqrt(e[:k])), e[:k] / e.sum()


def check_whitening(found, rows):
    kept, n, deviation, white, explained = plain_whitening(rows)
    k = white.shape[1]
    got = found.orderBy("row", "component").collect()
    assert len(got) == len(kept) * k and {r["n"] for r in got} == {n}
    values = np.array([r["whitened"] for r in got]).reshape(-1, k)
    signs = np.sign((values * white).sum(0))
    assert np.allclose(values * signs, white, atol=1e-8)
    assert [r["deviation"] for r in got] == np.repeat(deviation, k).tolist() and [r["component"] for r in got] == [*range(1, k + 1)] * len(kept)
    assert np.allclose([r["explained"] for r in got], np.tile(explained, len(kept)), rtol=1e-9) and max(r["identity_error"] for r in got) < 1e-9
    assert len({r["identity_error"] for r in got}) == 1


@pytest.mark.parametrize(("d", "size"), [(5, 400), (24, 900), (24, 10)])
def test_whitening_equals_numpy(spark, d, size):
    rng = np.random.default_rng(d + size)
    scale = np.linspace(0.2, 3, d)
    rows = [(i, (rng.normal(size=d) * scale).tolist()) for i in range(size)]
    rows += [(None, rows[3][1]), (3, rows[3][1]), *((1000 + i, rows[7][1]) for i in range(size // 2))]
    odd = [(-1, None), (-2, [float("nan")] + [0.0] * (d - 1)), (-3, [float("inf")] + [0.0] * (d - 1)), (-4, [None] + [0.0] * (d - 1)), (-5, []), (-6, [1e300] + [0.0] * (d - 1))]
    table = [(i, v, k, "clash", "x") for k, (i, v) in enumerate(rows + odd)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>, row int, whitened string, `x.y` string").repartition(5)
    found = whitening.whiten(df)
    assert found.columns == ["vec_id", "embedding", "row", "x.y", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(found, rows)


def test_little_to_whiten(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        found = whitening.whiten(spark.createDataFrame(rows, kind))
        assert found.collect() == [] and found.columns[2:] == ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    # Vectors of another length than most are left out.
    some = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [4.0, 3.0]), (3, [1.0])], kind)).collect()
    assert sorted((r["vec_id"], r["component"]) for r in some) == [(1, 1), (2, 1)]
    with pytest.raises(OverflowError):
        whitening.whiten(spark.createDataFrame([(k, [float(k) * 1e12, 0.0]) for k in range(4)], "vec_id long, embedding array<double>"))


def test_rank_one_updates():
    rng = np.random.default_rng(1)
    for d, lanes, size in ((1, 2, 9), (6, 3, 100), (40, 4, 200)):
        x = np.floor(rng.normal(size=(size, d)) * 4)
        x[:, d // 2] = x[:, 0]  # equal eigenvalues (of 0) to the end
        x[: size // 3] = x[0]
        own = whitening.Spectra(lanes, d)
        for i in range(0, size - lanes + 1, lanes):
            own.take(x[i : i + lanes])
        used = size - size % lanes
        for lane in range(lanes):
            y = x[lane:used:lanes]
            want = (y - y.mean(0)).T @ (y - y.mean(0))
            assert np.allclose(own.q[lane] * own.lam[lane] @ own.q[lane].T, want, atol=1e-9 * max(1, want.max()))
            assert np.allclose(own.q[lane].T @ own.q[lane], np.eye(d), atol=1e-12)
        one, y = own.combined(), x[:used] - x[:used].mean(0)
        assert np.allclose(one.q[0] * one.lam[0] @ one.q[0].T, y.T @ y, atol=1e-9 * max(1, (y.T @ y).max())) and one.n[0] == used


def test_queries_on_tables(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()]
    check_whitening(queries.op13_whitening(spark, SF).withColumn("row", F.col("vec_id")), rows)
    turns = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of_trie(queries.op12_prefix_trie(spark, SF)) == plain_trie(turns)
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, n, m, hashlib.sha256(t.encode()).hexdigest()) for i, n, m, t in plain_lines(docs))
    assert sorted(tuple(r) for r in queries.op11_line_dedup(spark, SF).collect()) == want


# Words of the lexicon


def test_frequent_words_are_short_and_fill_the_lexicon(spark):
    from allelon.llm import lexicon

    long = "w" * 1_000_000
    docs = spark.createDataFrame([(" ".join(["aa"] * 50 + ["bb"] * 3 + ["cc", "dd", "ee"]) + f" {long} {long}",), (None,), ("",)], "text string")
    every = lexicon.frequent_words(docs)
    assert {"aa", "bb", "cc", "dd", "ee"} <= {w.strip("▁</w> ") for w in every} and max(map(len, every)) <= 64
    # Words of one level beyond the bound: those that sort first.
    ordered = [lexicon.frequent_words(docs, most=k) for k in range(1, len(every) + 1)]
    assert [len(w) for w in ordered] == [*range(1, len(every) + 1)] and all(set(a) < set(b) for a, b in zip(ordered, ordered[1:], strict=False))


# Large draws


def test_logs_of_large_binomials():
    import math
    from decimal import Decimal

    from allelon.llm import sharding

    for n, k in ((10, 3), (63, 1), (64, 32), (200, 77), (5000, 1234), (20_000, 10_000)):
        want = Decimal(math.comb(n, k)).ln()
        assert abs(sharding.log_choose(n, k) - want) < Decimal("1e-17")
    assert sharding.log_choose(10**12, 0) == 0
    # The share of even splits of 2 x 10^12 rows, from the same series in closed form: about 1 / sqrt(pi n / 4) for draws of half.
    n = 10**12
    peak = float((sharding.log_choose(n, n // 2) * 2 - sharding.log_choose(2 * n, n)).exp())
    assert abs(peak * math.sqrt(math.pi * n / 4) - 1) < 1e-9
    rng = np.random.default_rng(1)
    draws = [sharding._hypergeometric(rng, n, n, 10**6) for _ in range(200)]
    assert abs(np.mean(draws) - 5e5) < 5 * 500 / 200**0.5 and 350 < np.std(draws) < 650
