"""Line deduplication over a corpus, by levelled sorted runs of line hashes. DataFrame functions only.

A run is a table of distinct line keys (two 64-bit hashes), bucketed and sorted by key, with how many documents hold the key and the
largest of their ids. Runs stand on levels: each new batch is a run of level 0, and as soon as a level has ``fanout`` runs they are merged
into one of the next level, so that a key is rewritten once for each level. A batch meets the runs in merge joins that need no
exchange of the runs: what they lack is new (the anti-join), what they hold is a repeat.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelon.llm.common import hidden, shown
from allelon.storage import discard_path, new_path, store

#: ASCII white space, a fixed value, and the letters whose case is ignored.
BLANKS, UPPER, LOWER = " \t\n\x0b\x0c\r", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HASHES = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """A line without ASCII white space at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20) -> DataFrame:
    """(id, th, pos, h1, h2, first) of each line whose key has ``min_chars`` code points or more.

    th: hash of the text; pos: the line's place, from 0; first: no line above it in its text has its key, which the sorted hashes of a
    text tell, so that no text is gathered or compared line by line with itself.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    hashed = lambda x, i: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit(1), x).alias("h2"), i.alias("pos"), F.length(x).alias("n"))
    lines = F.sort_array(F.filter(F.transform(F.transform(F.split(text, "\n"), line_key), hashed), lambda s: s["n"] >= min_chars))
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("th"), lines.alias("lines"))
    before = F.concat(F.array(F.lit(None).cast("struct<h1:bigint,h2:bigint,pos:int,n:int>")), "lines")
    # The array of those before is longer by one, so the last entry has no line.
    pairs = F.zip_with("lines", before, lambda a, b: F.struct(a["pos"].alias("pos"), a["h1"].alias("h1"), a["h2"].alias("h2"),
        (~F.coalesce((a["h1"] == b["h1"]) & (a["h2"] == b["h2"]), F.lit(False))).alias("first")))
    rows = own.select("id", "th", F.explode(pairs).alias("p"))
    return rows.select("id", "th", "p.*").where("pos IS NOT NULL")


class LineRuns:
    """Levelled sorted runs in the shared folder.

    ``add`` takes the next batch, ``found`` gives what the runs know of each key. A run's table is written whole
    before it counts, so a lost executor only repeats tasks; runs that were merged are deleted.
    """

    def __init__(self, spark: SparkSession, fanout: int = 2, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = new_path(self.spark, name)
        keys.write.bucketBy(self.buckets, *HASHES).sortBy(*HASHES).option("path", self.paths[name]).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        discard_path(self.spark, self.paths.pop(name))

    def runs(self) -> list[str]:
        return [r for level in self.levels for r in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (h1, h2, ...) that no run holds: one merge anti-join for each run."""
        return reduce(lambda left, run: left.join(self.spark.table(run).hint("merge"), HASHES, "left_anti"), self.runs(), keys)

    def add(self, keys: DataFrame) -> None:
        """A batch of (h1, h2, docs, owner), a row for each key, with the ids above those of all later batches.

        The owner is kept only where no run holds the key, so each key has one owner: that of its first batch.
        """
        known = reduce(
            lambda left, run: left.join(self.spark.table(run).hint("merge").select(*HASHES, F.lit(True).alias("__is")), HASHES, "left")
            .withColumn("__seen", F.col("__seen") | F.coalesce("__is", F.lit(False))).drop("__is"),
            self.runs(), keys.withColumn("__seen", F.lit(False)),
        )
        new = known.select(*HASHES, "docs", F.when(~F.col("__seen"), F.col("owner")).alias("owner"), (~F.col("__seen")).alias("owned"))
        self._put(self._write(new), 0)

    def _put(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self._write(self._merged(old))
            for name in old:
                self._drop(name)
            self._put(merged, level + 1)

    def _merged(self, runs: list[str]) -> DataFrame:
        # Read as plain files: Spark 4.1 takes a union of bucketed tables as bucketed, but then may read them without their buckets.
        rows = self.spark.read.schema(self.spark.table(runs[0]).schema).parquet(*(self.paths[r] for r in runs))
        return rows.groupBy(*HASHES).agg(F.sum("docs").alias("docs"), F.max("owner").alias("owner"), F.max("owned").alias("owned"))

    def found(self, min_docs: int = 1) -> DataFrame:
        """(h1, h2, docs, owner) of the keys that ``min_docs`` documents hold."""
        return self._merged(self.runs()).where(F.col("docs") >= min_docs).drop("owned")

    def close(self) -> None:
        """Delete all runs."""
        for name in self.runs():
            self._drop(name)
        self.levels = []


def batch_of(id_col: str, cuts: list[int]) -> Column:
    """Number of the batch, falling with the id: 0 above the last cut; null ids are in the last."""
    own = sum((F.when(F.col(id_col) > c, 0).otherwise(1) for c in cuts), F.lit(0))
    return F.coalesce(F.when(F.col(id_col).isNotNull(), own), F.lit(len(cuts))).cast("int")


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with n_lines, n_dropped (long) and kept_text: the text without its common lines.

    A line's key is the line without ASCII white space at both ends, A-Z in lower case. Keys of ``min_chars`` code points or
    more that ``min_docs`` documents hold lose all their lines but those of the document with the largest id.

    Documents are dealt into ``batches`` of about equal rows by falling id, and each batch of line keys is added to the runs, so the batch
    that a key is new to has its largest id. Every row counts as a document, repeated rows as several; those with the largest id all keep
    the line, and null ids are below all others. A null or empty text is one empty line. All columns stay (new ones
    replace columns of their names, at the end); an empty table gives an empty result. Texts of any length count whole.
    """
    spark = docs.sparkSession
    own = F.col(f"`{id_col}`").cast("long")
    cuts = docs.select(own.alias("id")).agg(F.percentile_approx("id", [i / batches for i in range(1, batches)], 1000).alias("c")).first()["c"] if batches > 1 else None
    cuts = sorted(set(cuts or []))
    hashed = line_hashes(docs, id_col, text_col, min_chars).withColumn("batch", batch_of("id", cuts))
    path = new_path(spark, "line-hashes")
    hashed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(hashed.schema).parquet(path)
    runs = LineRuns(spark, fanout)
    for k in range(len(cuts) + 1):
        batch = lines.where(F.col("batch") == k)
        runs.add(batch.groupBy(*HASHES).agg(F.count_if("first").alias("docs"), F.max("id").alias("owner")))
    common = store(runs.found(min_docs), "common-lines")
    runs.close()
    lost = lines.join(common, HASHES).where(~F.col("id").eqNullSafe(F.col("owner"))).select("id", "th", "pos")
    # Rows that repeat an id and a text lose the same places: a set, as long as the text has lines.
    lost = store(lost.groupBy("id", "th").agg(F.collect_set("pos").alias("__lost")), "lost-lines")
    named = hidden(docs)
    text = F.coalesce(F.col(f"`__in_{text_col}`").cast("string"), F.lit(""))
    # The lines are cut below the join, so that the expressions above walk one array.
    named = named.withColumns({"__id": F.col(f"`__in_{id_col}`").cast("long"), "__th": F.xxhash64(text), "__lines": F.split(text, "\n")})
    both = named.join(lost, named["__id"].eqNullSafe(lost["id"]) & (named["__th"] == lost["th"]), "left")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__lost"), lambda p: F.get("__lines", p))
    out = both.withColumns({
        "n_lines": F.size("__lines").cast("long"), "n_dropped": F.coalesce(F.size("__lost"), F.lit(0)).cast("long"),
        "kept_text": F.array_join(F.when(F.col("__lost").isNull(), F.col("__lines")).otherwise(kept), "\n"),
    })
    more = ["n_lines", "n_dropped", "kept_text"]
    return shown(out.drop(*(f"__in_{c}" for c in more)), *more)
