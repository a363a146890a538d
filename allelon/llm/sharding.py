"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

import math
from decimal import Decimal, localcontext
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from allelon.llm.common import hidden, shown
from allelon.storage import store

PI = Decimal("3.14159265358979323846264338327950288419716939937510")


def _log_factorial(n: int) -> Decimal:
    """Natural log of n! to some 40 digits, by Stirling's series; small ones exactly."""
    if n < 64:
        return Decimal(math.factorial(n)).ln()
    x = Decimal(n)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7) + 1 / (1188 * x**9)
    return x * x.ln() - x + (2 * PI * x).ln() / 2 + series


def log_choose(n: int, k: int) -> Decimal:
    """Log of the binomial coefficient. In floats the difference of such large logs would keep few digits."""
    with localcontext() as c:
        c.prec = 50
        return _log_factorial(n) - _log_factorial(k) - _log_factorial(n - k)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws without replacement are good; numpy's own where its limits allow, else inversion from the mode."""
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, n))
    low, high = max(0, n - bad), min(n, good)
    mode = min(high, max(low, (n + 1) * (good + 1) // (good + bad + 2)))
    peak = float((log_choose(good, mode) + log_choose(bad, n - mode) - log_choose(good + bad, n)).exp())
    left = rng.random() - peak
    up = down = mode
    p_up = p_down = peak
    while left > 0 and (up < high or down > low):
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(sizes: list[int], n_shards: int, seed: int) -> np.ndarray:
    """Rows of partition i that go to shard j, drawn so that every arrangement of all rows is equally likely.

    Row sums are ``sizes``; column sums differ by one at most.
    """
    rng = np.random.Generator(np.random.Philox(seed))
    total = sum(sizes)
    left = [total // n_shards + (j < total % n_shards) for j in range(n_shards)]
    out = np.zeros((len(sizes), n_shards), np.int64)
    for i, size in enumerate(sizes):
        need, pool = size, sum(left)
        for j in range(n_shards):
            pool -= left[j]
            take = _hypergeometric(rng, left[j], pool, need) if need and left[j] else 0
            out[i, j] = take
            left[j] -= take
            need -= take
    return out


@lru_cache(maxsize=2)
def _labels(seed: int, home: int, counts: tuple[int, ...]) -> np.ndarray:
    """The shard of each row of a home partition, in a random order that (seed, home) fix."""
    labels = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    np.random.Generator(np.random.Philox(key=[seed, home + 1])).shuffle(labels)
    return labels


def _task_keys(spark: SparkSession, tasks: int) -> list[int]:
    """A number for each task that Spark's hash partitioning into ``tasks`` sends there."""
    draws = spark.range(math.ceil(tasks * (math.log(tasks) + 10))).select("id", F.pmod(F.hash("id"), F.lit(tasks)).alias("task"))
    found = {r["task"]: r["id"] for r in draws.groupBy("task").agg(F.min("id").alias("id")).collect()}  # a row for each task
    return [found.get(t, t) for t in range(tasks)]


#: Cells of the matrix (home, shard) and blocks (shard, part of it) that the driver holds and sends out: 32 MB and some 20 MB at most.
MOST_CELLS, MOST_HOMES, MOST_BLOCKS, MOST_SHARDS = 4_000_000, 500_000, 100_000, 4096


def shard_shuffle(df: DataFrame, n_shards: int = 8, seed: int = 42, home_rows: int = 1 << 17, block_bytes: int = 1 << 23) -> DataFrame:
    """All rows and columns of ``df`` plus shard (int) and slot (long, gapless from 0 in each shard).

    Home partitions are runs of ``home_rows`` rows of a file, named by Parquet's own row positions, so a
    task that is run again gives every row the same place. A table that isn't read straight from Parquet
    is stored first, and so is one of very many files. Three passes: row counts of the homes (no data columns), row counts of the
    blocks of each shard (no data columns), then one exchange of the whole rows, in which a task gets one block of about
    ``block_bytes`` of the files' bytes.

    The driver holds a count for each (home, shard), MOST_CELLS and MOST_HOMES at most (homes have more rows in larger tables), and for
    each (shard, block), MOST_BLOCKS at most, or one for each shard (blocks have more bytes in larger tables). From 1 to MOST_SHARDS shards.

    Repeated rows, nulls and long texts are rows like any other; an empty table gives an empty result.
    Columns named shard or slot are replaced; all others keep their names and values.
    """
    if not 1 <= n_shards <= MOST_SHARDS:
        raise ValueError(f"n_shards must be from 1 to {MOST_SHARDS}")
    spark, df = df.sparkSession, df.drop("shard", "slot")
    most_homes = min(MOST_HOMES, MOST_CELLS // n_shards)
    place = {"__file": F.xxhash64("_metadata.file_path"), "__row": F.col("_metadata.row_index")}
    for attempt in range(2):
        whole, total = False, 0
        try:
            if attempt or "_metadata" not in df.columns:
                own = ["*"] if attempt else [F.col(f"`{c}`").alias(f"__in_{c}") for c in df.columns]
                placed = df.select(*own, *(c.alias(n) for n, c in place.items()))
                files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), *(c.alias(n) for n, c in place.items()))
                files = files.groupBy("path", "__file").agg(F.count("*").alias("n"), F.max("__row").alias("last"), F.min("__row").alias("first"), F.max("bytes").alias("bytes"))
                straight = F.coalesce(F.every((F.col("n") == F.col("last") + 1) & (F.col("first") == 0)), F.lit(True)) & (F.count_distinct("__file") == F.count("*"))
                total, size, whole, n_files = files.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0)), straight, F.count("*")).first()
                whole = whole and n_files <= most_homes // 2
        except AnalysisException:  # not a table of files
            whole = False
        if whole:
            break
        if attempt:
            raise ValueError("the stored table's rows can't be placed")
        df = store(hidden(df).coalesce(most_homes // 2), "shard-input")
    home_rows = max(home_rows, math.ceil(total / (most_homes - most_homes // 2)))
    placed = placed.withColumn("__run", F.expr(f"__row div {home_rows}"))
    homes = placed.groupBy("__file", "__run").count().orderBy("__file", "__run").collect()
    matrix = communication_matrix([h["count"] for h in homes], n_shards, seed)
    shipped = spark.sparkContext.broadcast(matrix)
    home_df = spark.createDataFrame([(h["__file"], h["__run"], i) for i, h in enumerate(homes)], "__file long, __run long, __home long")

    @F.pandas_udf(IntegerType())
    def shard_of(home: pd.Series, at: pd.Series) -> pd.Series:
        out = np.empty(len(home), np.int32)
        h, a = home.to_numpy(), at.to_numpy()
        for one in np.unique(h):
            here = np.flatnonzero(h == one)
            out[here] = _labels(seed, int(one), tuple(shipped.value[one].tolist()))[a[here]]
        return pd.Series(out)

    blocks = max(1, min(math.ceil(size / block_bytes / n_shards), MOST_BLOCKS // n_shards))
    dealt = (
        placed.join(F.broadcast(home_df), ["__file", "__run"])  # at most MOST_HOMES rows of three numbers
        .withColumn("__at", F.col("__row") % home_rows)
        .withColumn("shard", shard_of("__home", "__at"))
        .withColumn("__r", F.xxhash64(F.lit(seed), "__home", "__at"))
        .withColumn("__block", F.shiftright(F.shiftrightunsigned("__r", 33) * F.lit(blocks), 31).cast("int"))
    )
    starts, at = [], {}
    tasks = blocks * n_shards
    keys = _task_keys(spark, tasks)
    for r in dealt.groupBy("shard", "__block").count().orderBy("shard", "__block").collect():
        starts.append((r["shard"], r["__block"], at.get(r["shard"], 0), keys[r["shard"] * blocks + r["__block"]]))
        at[r["shard"]] = at.get(r["shard"], 0) + r["count"]
    start_df = F.broadcast(spark.createDataFrame(starts, "shard int, __block int, __start long, __task long"))  # a row for each task
    within = Window.partitionBy("__task", "shard", "__block").orderBy("__r", "__home", "__at")
    found = dealt.join(start_df, ["shard", "__block"]).repartition(tasks, "__task").withColumn("__rank", F.row_number().over(within))
    return shown(found.withColumn("slot", F.col("__start") + F.col("__rank") - 1), "shard", "slot")
