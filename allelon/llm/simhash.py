"""SimHash fingerprints of word shingles and their exact near-duplicate groups."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.llm.common import hidden, parts, shown, texts_of
from allelon.llm.components import components
from allelon.storage import discard, store


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of the text's word shingles, repeats included; a bit is 1 if over half of the hashes have it."""
    words = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    whole, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(whole, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n = len(words) - shingle + 1
    hashes = np.fromiter((digest(whole[i:j], seed) for i, j in zip((ends - sizes).tolist(), ends[shingle - 1 :].tolist(), strict=False)), np.uint64, n)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        votes += np.unpackbits(hashes[at : at + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id, text_hash, fp) for each row, fp as a signed long; null texts are empty and have fingerprint zero."""
    schema = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            found = np.array([fingerprint(t, shingle, seed) for t in texts_of(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], schema=schema)

    own = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("text_hash"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "id long, text_hash long, fp long")


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after linking each i with its j; a label is a member of the same group, and roots label themselves."""
    while True:
        a, b = label[i], label[j]
        if not (apart := a != b).any():
            return label
        label[np.maximum(a, b)[apart]] = np.minimum(a, b)[apart]
        while not np.array_equal(nxt := label[label], label):
            label = nxt


def tiled_links(codes: np.ndarray, side: np.ndarray | None, radius: int, tile: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (from, to) of all pairs of ``codes`` within ``radius`` bits; with ``side``, of pairs across sides only.

    Codes are put in order of their bit counts and compared tile by tile; a pair of tiles whose bit counts lie more
    than the radius apart is skipped. What is returned links the same groups as all the close pairs would.
    """
    n = len(codes)
    if n <= 24 and side is None:
        close = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= radius
        if np.count_nonzero(close) == n:
            return codes[:0], codes[:0]
        label = _merge(np.arange(n), *np.nonzero(close))
    else:
        bits = np.bitwise_count(codes)
        order = np.argsort(bits, kind="stable")
        codes, bits = codes[order], bits[order].astype(np.int64)
        side = side[order] if side is not None else None
        label = np.arange(n)
        for a in range(0, n, tile):
            x, top = codes[a : a + tile], bits[min(a + tile, n) - 1]
            for b in range(a, n, tile):
                if bits[b] - top > radius:
                    break
                close = np.bitwise_count(x[:, None] ^ codes[None, b : b + tile]) <= radius
                if side is not None:
                    close &= side[a : a + tile, None] != side[None, b : b + tile]
                if np.count_nonzero(close) > (len(x) if a == b and side is None else 0):
                    i, j = np.nonzero(close)
                    label = _merge(label, i + a, j + b)
    off = np.flatnonzero(label != np.arange(n))
    return codes[off], codes[label[off]]


def segment_count(count: int, radius: int, value_rows: int = 1024, most_keys: int = 500) -> int:
    """Segments of which all but ``radius`` make a key: the fewest with which ``count`` random fingerprints leave ``value_rows`` to a key's value."""
    segments = radius + 1
    while count / 2 ** (64 * (segments - radius) / segments) > value_rows and comb(segments + 1, radius) <= most_keys:
        segments += 1
    return segments


def near_links(fps: DataFrame, radius: int = 4, group_rows: int = 8192) -> DataFrame:
    """Spanning links (u, v) of the distinct fingerprints ``fps`` (fp) that differ in at most ``radius`` bits. Exact.

    Two such fingerprints agree on all but ``radius`` of any number of segments, so only those that share the value of such a
    choice of segments meet; more fingerprints are cut into more segments. The values deal the work over tasks. A value with more than ``group_rows`` fingerprints is dealt
    further, into pairs of tiles by bit count, leaving out pairs that lie beyond the radius, so that no
    task ever holds more than two tiles.
    """
    spark = fps.sparkSession
    count = fps.count()
    segments = segment_count(count, radius)
    edges = [round(64 * i / segments) for i in range(segments + 1)]
    cut = lambda i: F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))
    keys = [F.struct(F.lit(k).alias("seg"), F.concat_ws(",", *(cut(i).cast("string") for i in own)).alias("val")) for k,
        own in enumerate(combinations(range(segments), segments - radius))]
    keyed = fps.select("fp", F.bit_count("fp").alias("pop"), F.explode(F.array(*keys)).alias("key")).select("key.seg", "key.val", "pop", "fp")
    sizes = keyed.groupBy("seg", "val", "pop").agg(F.count("*").alias("n"))
    large = (
        sizes.groupBy("seg", "val")
        .agg(F.sum("n").alias("all"), F.collect_list(F.struct("pop", F.ceil(F.col("n") * 2 / group_rows).cast("int").alias("salts"))).alias("tiles"))
        .where(F.col("all") > group_rows)
        .drop("all")
    )  # at most 65 entries a list
    marked = keyed.join(large, ["seg", "val"], "left")
    small = marked.where("tiles IS NULL").select("seg", "val", F.lit("").alias("pair"), F.lit(False).alias("second"), "fp")
    salted = marked.where("tiles IS NOT NULL").withColumn("salts", F.expr("filter(tiles, t -> t.pop = pop)[0].salts")).withColumn("own",
        F.expr("struct(pop AS pop, cast(pmod(xxhash64(fp), salts) AS int) AS salt)"))
    other = F.expr(
        f"flatten(transform(filter(tiles, t -> abs(t.pop - pop) <= {radius}), t -> transform(sequence(0, t.salts - 1), s -> struct(t.pop AS pop, s AS salt))))"
    )
    dealt = (
        salted.select("seg", "val", "fp", "own", F.explode(other).alias("other"))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .select("seg", "val", F.concat_ws(",", *(F.col(c).cast("string") for c in ("low.pop", "low.salt", "high.pop", "high.salt"))).alias("pair"),
            (F.col("own") > F.col("other")).alias("second"), F.col("fp"), (F.col("own") == F.col("other")).alias("self"))
        .select("seg", "val", F.when(F.col("self"), F.concat(F.lit("s"), "pair")).otherwise(F.col("pair")).alias("pair"), "second", "fp")
    )
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None

        def groups(table: pa.Table) -> Iterator[tuple[int, int]]:
            names = [f"{a}|{b}|{c}" for a, b, c in zip(*(table.column(i).to_pylist() for i in range(3)), strict=True)]
            start = 0
            for i in range(1, len(names) + 1):
                if i == len(names) or names[i] != names[start]:
                    yield start, i
                    start = i

        def out(table: pa.Table, spans: list[tuple[int, int]]) -> pa.RecordBatch:
            fp = table.column("fp").to_numpy().view(np.uint64)
            second, pair = table.column("second").to_numpy(), table.column("pair")
            u, v = [], []
            for a, b in spans:
                if b - a > 1:
                    name = pair[a].as_py()
                    x, y = tiled_links(fp[a:b], second[a:b] if name and name[0] != "s" else None, radius)
                    u.append(x)
                    v.append(y)
            join = lambda parts: pa.array(np.concatenate([*parts, np.empty(0, np.uint64)]).view(np.int64))
            return pa.RecordBatch.from_arrays([join(u), join(v)], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            last = tuple(batch.column(i)[batch.num_rows - 1].as_py() for i in range(3))
            if last != key or sum(x.num_rows for x in held) > 1 << 20:  # a group has ended somewhere in this batch
                table = pa.Table.from_batches(held)
                spans = list(groups(table))
                if len(spans) > 1:
                    yield out(table, spans[:-1])
                    held = table.slice(spans[-1][0]).combine_chunks().to_batches()
                key = last
        if held:
            table = pa.Table.from_batches(held)
            yield out(table, list(groups(table)))

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), count * len(keys) // 2_000_000)
    together = small.unionByName(dealt).repartition(tasks, "seg", "val", "pair").sortWithinPartitions("seg", "val", "pair")
    return together.mapInArrow(compare, "u long, v long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4) -> DataFrame:
    """(id, text_hash, fp, component_id, root) for each row of ``docs``.

    component_id is the smallest id that can be reached over links of at most ``radius`` bits, root the fingerprint
    that names the group. Copies share a fingerprint and are compared once. Null ids never are the smallest: a group
    without any id has a null component_id. Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows give repeated results. Texts of any length count whole; an empty table gives an empty result.
    """
    own = store(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = store(own.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    linked = store(components(near_links(distinct.select("fp"), radius)).withColumnRenamed("node", "fp"), "roots")
    # Tables in between are stored, so that both sides of each join are plain shuffles, whose hot keys adaptive execution splits.
    least = store(linked.join(distinct, "fp").groupBy("root").agg(F.min("least").alias("component_id")), "least-ids")
    groups = store(linked.join(least, "root"), "groups")
    names = distinct.join(groups, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    names = store(names, "fingerprint-groups")
    for table in (distinct, linked, least, groups):
        discard(table)
    return own.join(names, "fp").select(F.col("id").alias(id_col), "text_hash", "fp", "component_id", "root")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest id's, of repeated ids the least text hash's, of repeated rows any.

    Only (id, text hash) pairs of the kept rows are joined with the texts, which are moved once; rows whose pair repeats are moved once more.
    All columns stay as they are. Null and empty texts are one group; an empty table stays empty.
    """
    groups = near_groups(docs, id_col, text_col, radius, shingle).select(F.col(id_col).alias("__id"), F.col("text_hash").alias("__hash"), "root")
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("__id").isNull().alias("none"), "__id", "__hash")).alias("k")).select("k.__id", "k.__hash")
    often = groups.groupBy("__id", "__hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("__id").alias("__i"), F.col("__hash").alias("__g"))
    kept = first.join(often, first["__id"].eqNullSafe(often["__i"]) & (first["__hash"] == often["__g"]), "left")
    kept = store(kept.select("__id", "__hash", F.col("__g").isNotNull().alias("__often")), "kept")
    named = hidden(docs)
    own, text = F.col(f"`__in_{id_col}`").cast("long"), F.col(f"`__in_{text_col}`")
    named = named.withColumns({"__own": own, "__h": F.xxhash64(F.coalesce(text, F.lit("")))})
    found = named.join(kept, named["__own"].eqNullSafe(kept["__id"]) & (named["__h"] == kept["__hash"]))
    once = found.where("NOT __often").unionByName(found.where("__often").dropDuplicates(["__own", "__h"]))
    return shown(once)
