"""Assembly quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Default thresholds for genomes of 4 to 6.5 million bases; fixed values.
THRESHOLDS = {
    "min_bp": 4_000_000, "max_bp": 6_500_000, "moderate_fragmentation": 200, "high_fragmentation": 500, "low_n50": 20_000, "moderate_n50": 50_000,
    "moderate_n_fraction": 0.001, "high_n_fraction": 0.01, "ready_max_contigs": 300, "ready_min_n50": 50_000, "ready_max_n_fraction": 0.01,
}


def n50(df: DataFrame, group: list[str], length: str) -> DataFrame:
    """N50 of each group: the longest length at which lengths from the top add up to half of all.

    Lengths are counted first, so a group is as many rows as it has different lengths, not contigs.
    """
    counted = df.groupBy(*group, F.col(length).alias("__len")).agg(F.count("*").alias("__n"))
    down = Window.partitionBy(*group).orderBy(F.desc("__len"))
    run = counted.withColumns({"__run": F.sum(F.col("__len") * F.col("__n")).over(down), "__all": F.sum(F.col("__len") * F.col("__n")).over(Window.partitionBy(*group))})
    return run.groupBy(*group).agg(F.max(F.when(F.col("__run") * 2 >= F.col("__all"), F.col("__len"))).alias("n50"))


def assembly_qc(contigs: DataFrame, group: tuple[str, ...] = ("genome_id", "file_name"), seq: str = "seq", **limits: float) -> DataFrame:
    """Length, contigs, N50, share of N, flags, quality and readiness of each assembly. Empty contigs don't count."""
    t = THRESHOLDS | limits
    keys = list(group)
    slim = contigs.select(*keys, F.length(seq).cast("long").alias("len"), (F.length(seq) - F.length(F.replace(F.upper(seq), F.lit("N"), F.lit("")))).cast("long").alias("n"))
    # One scan, combined by length before the shuffle, so sequences never move and a group is as many rows as it has different lengths.
    counted = slim.groupBy(*keys, "len").agg(F.count("*").alias("times"), F.sum("n").alias("n"))
    part = Window.partitionBy(*keys)
    size = F.col("len") * F.col("times")
    run = counted.withColumns({"run": F.sum(size).over(part.orderBy(F.desc("len"))), "all": F.sum(size).over(part)})
    base = run.groupBy(*keys).agg(
        F.sum(size).alias("total_bp"), F.sum(F.when(F.col("len") > 0, F.col("times")).otherwise(0)).alias("contigs"), F.sum("n").alias("n_count"),
        F.coalesce(F.max(F.when(F.col("run") * 2 >= F.col("all"), F.col("len"))), F.lit(0).cast("long")).alias("n50"),
    )
    rows = base.withColumn("frac", F.when(F.col("total_bp") > 0, F.col("n_count") / F.col("total_bp")).otherwise(F.lit(1.0)))
    bp, c, n, f = (F.col(x) for x in ("total_bp", "contigs", "n50", "frac"))
    flags = [
        F.when(bp < t["min_bp"], "small_assembly"),
        F.when(bp > t["max_bp"], "large_assembly"),
        F.when(c > t["high_fragmentation"], "high_fragmentation").when(c > t["moderate_fragmentation"], "moderate_fragmentation"),
        F.when(n < t["low_n50"], "low_n50").when(n < t["moderate_n50"], "moderate_n50"),
        F.when(f > t["high_n_fraction"], "high_ambiguous_bases").when(f > t["moderate_n_fraction"], "moderate_ambiguous_bases"),
    ]
    severe = (bp < t["min_bp"]) | (c > t["high_fragmentation"]) | (n < t["low_n50"]) | (f > t["high_n_fraction"])
    text = F.concat_ws(";", *flags)
    ready = bp.between(t["min_bp"], t["max_bp"]) & (c <= t["ready_max_contigs"]) & (n >= t["ready_min_n50"]) & (f <= t["ready_max_n_fraction"])
    return rows.select(
        *keys, "total_bp", "contigs", "n50", F.round("frac", 6).alias("n_fraction"),
        F.when(severe, "poor").when(text != "", "moderate").otherwise("good").alias("quality"),
        ready.cast("int").alias("extraction_ready"), F.when(text == "", "none").otherwise(text).alias("flags"),
    )


def qc_levels(qc: DataFrame) -> DataFrame:
    return qc.groupBy("quality").agg(F.count("*").alias("genomes"), F.sum("extraction_ready").alias("ready"))


def contig_histogram(qc: DataFrame) -> DataFrame:
    return qc.groupBy("contigs").agg(F.count("*").alias("genomes"))


def ready_subset(contigs: DataFrame, qc: DataFrame, key: str = "genome_id") -> DataFrame:
    return contigs.join(qc.where("extraction_ready = 1").select(key), key, "left_semi")


def genome_validate(contigs: DataFrame, key: str = "genome_id", length: str = "seq_len", header: str = "header", min_length: int = 1_000_000,
    reference_length: int | None = None) -> DataFrame:
    """Validity, status text and coverage of each genome; only sequence below a header counts."""
    total = F.coalesce(F.sum(F.when(F.col(header).isNotNull(), F.col(length))), F.lit(0))
    rows = contigs.groupBy(key).agg(F.max(F.col(header).isNotNull()).alias("fasta"), total.alias("length"))
    status = (
        F.when(~F.col("fasta"), "Not a valid FASTA file (no header found)")
        .when(F.col("length") < min_length, F.format_string("Sequence too short: %sbp < %sbp", F.col("length"), F.lit(min_length)))
        .otherwise(F.format_string("Valid FASTA: %sbp", F.col("length")))
    )
    cover = F.lit(100.0) if not reference_length else F.col("length") * 100.0 / reference_length
    return rows.select(key, "length", (F.col("fasta") & (F.col("length") >= min_length)).alias("is_valid"), status.alias("status"), cover.alias("coverage"))


def genome_metadata(contigs: DataFrame, key: str = "genome_id", header: str = "header", order: str = "contig_ord") -> DataFrame:
    return contigs.groupBy(key).agg(F.max("file_name").alias("file_name"), F.max("file_size").alias("file_size"), F.count(header).alias("records"),
        F.min_by(header, order).alias("first_header"))
