"""Exact top-k search over 64-bit binary codes by incremental multi-index hashing."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelon.storage import store

BITS = 64


def sign_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, code): bit i is 1 if component i is above 0, over the first 64 components; missing, null and NaN ones are 0.

    Rows with a null id or a null vector have no code and are left out.
    """
    bit = lambda i: F.when(F.coalesce(F.get(vector_col, F.lit(i)) > 0, F.lit(False)) & ~F.coalesce(F.isnan(F.get(vector_col, F.lit(i))),
        F.lit(False)), F.lit(1 << i if i < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("long")
    code = bit(0)
    for i in range(1, BITS):
        code = code.bitwiseOR(bit(i))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), code.alias("code"))


class SegmentIndex:
    """Codes of a block by the value of each of ``segments`` equal segments."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, segments: int = 4):
        self.ids, self.codes, self.segments = ids, codes, segments
        self.width = BITS // segments
        self.order, self.start = [], []
        for s in range(segments):
            values = self.values(codes, s)
            self.order.append(np.argsort(values, kind="stable"))
            self.start.append(np.concatenate([[0], np.cumsum(np.bincount(values, minlength=1 << self.width))]))
        self.seen = np.zeros(len(codes), bool)  # all false between searches
        self.masks = [np.array([sum(1 << b for b in c) for c in combinations(range(self.width), r)], np.int64) for r in range(self.width + 1)]

    def values(self, codes, s: int):
        return ((codes >> np.uint64(s * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def search(self, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest codes, ties to the smaller id.

        Segment radius r is searched in one segment after the other. Once s of the segments are searched to radius r and the
        rest to r - 1, every code within segments * r + s - 1 bits has been seen, so the search ends as soon as the kth
        verified distance is no larger than that.
        """
        seen, hits, distances = self.seen, [], []
        enough = min(k, len(self.codes))
        own = [int(self.values(code, s)) for s in range(self.segments)]
        within = np.zeros(BITS + 2, np.int64)
        for r in range(self.width + 1):
            for s in range(self.segments):
                at = own[s] ^ self.masks[r]
                a, size = self.start[s][at], self.start[s][at + 1] - self.start[s][at]
                if total := int(size.sum()):
                    hit = size > 0
                    a, size = a[hit], size[hit]
                    spots = np.arange(total) + np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
                    new = self.order[s][spots]
                    new = new[~seen[new]]
                    seen[new] = True
                    far = np.bitwise_count(self.codes[new] ^ code).astype(np.int64)
                    hits.append(new)
                    distances.append(far)
                    within += np.bincount(far, minlength=BITS + 2)
                if within[: self.segments * r + s + 1].sum() >= enough:
                    break
            else:
                continue
            break
        found, far = np.concatenate(hits), np.concatenate(distances)
        seen[found] = False
        best = np.lexsort((self.ids[found], far))[:k]
        return self.ids[found[best]], far[best]


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, block_rows: int = 1 << 18, query_rows: int = 1 << 20) -> DataFrame:
    """(query_id, rank, id, distance): the k codes nearest to each query, ties to the smaller id. Exact.

    ``codes`` and ``queries`` have columns (id, code). Codes are dealt into blocks of about ``block_rows`` and queries into parts of
    about ``query_rows``; a task indexes a block and searches it for a part of the queries, so that it holds no more than
    one of each. The best k of all blocks are merged, cut to k in each task before the shuffle. Ids that repeat
    count once for each row; rows with a null id or code are left out; empty tables give empty results.
    """
    whole = "id IS NOT NULL AND code IS NOT NULL"
    codes, queries = store(codes.select("id", "code").where(whole), "codes"), store(queries.select("id", "code").where(whole), "queries")
    blocks = max(1, math.ceil(codes.count() / block_rows))
    parts = max(1, math.ceil(queries.count() / query_rows))
    schema = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("distance", pa.int32())])

    def dealt(rows: DataFrame, own: int, others: int) -> DataFrame:
        """Each row in its own block (or part), once for each of the others."""
        return rows.withColumns({"own": F.pmod(F.xxhash64("id", "code"), F.lit(own)), "other": F.explode(F.sequence(F.lit(0), F.lit(others - 1)))})

    def search(block: pa.Table, wanted: pa.Table) -> pa.Table:
        if not block.num_rows or not wanted.num_rows:
            return schema.empty_table()
        order = np.argsort(block.column("id").to_numpy(), kind="stable")
        index = SegmentIndex(block.column("id").to_numpy()[order], block.column("code").to_numpy()[order].view(np.uint64))
        names, found = wanted.column("id").to_numpy(), [index.search(c, k) for c in wanted.column("code").to_numpy().view(np.uint64)]
        ids, far = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        return pa.table([np.repeat(names, [len(f[0]) for f in found]), ids, far.astype(np.int32)], schema=schema)

    left = dealt(codes, blocks, parts).select(F.col("own").alias("block"), F.col("other").cast("long").alias("part"), "id", "code")
    right = dealt(queries, parts, blocks).select(F.col("other").cast("long").alias("block"), F.col("own").alias("part"), "id", "code")
    near = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(search, "query_id long, id long, distance int")
    best = Window.partitionBy("query_id").orderBy("distance", "id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "distance")
