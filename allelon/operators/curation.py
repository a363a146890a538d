"""Ids and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.functions.text import strip


def normalize_ids(df: DataFrame, id_col: str, order: str) -> DataFrame:
    """Distinct ids without white space around them, in the order of their first rows; blank ones and nan are dropped."""
    rows = df.select(strip(F.col(id_col)).alias("id"), F.col(order).alias("first_ord")).where("id <> '' AND lower(id) <> 'nan'")
    return rows.groupBy("id").agg(F.min("first_ord").alias("first_ord"))


def missing_ids(wanted: DataFrame, present: DataFrame, id_col: str = "id", size_col: str = "size", min_bytes: float = 0) -> DataFrame:
    """Wanted ids that aren't present with more than ``min_bytes``."""
    return wanted.join(present.where(F.col(size_col) > min_bytes).select(id_col), id_col, "left_anti")


def missing_references(targets: DataFrame, refs: DataFrame) -> DataFrame:
    """Target genes without a non-empty reference."""
    return targets.join(refs.where("seq <> ''").select(F.lower("gene").alias("gene")), "gene", "left_anti")


def require_references(targets: DataFrame, refs: DataFrame, most: int = 20) -> None:
    """An error that names the first missing references."""
    if missing := [r["gene"] for r in missing_references(targets, refs).orderBy("gene").limit(most).collect()]:
        raise ValueError(f"references missing: {', '.join(missing)}")


def enrich_metadata(samples: DataFrame, metadata: DataFrame, id_col: str = "genome_id") -> DataFrame:
    """Samples with the metadata of their id and metadata_found 1 or 0; nested values become JSON text. Ids are stripped on both sides."""
    nested = {f.name for f in metadata.schema.fields if f.dataType.typeName() in ("struct", "array", "map")}
    own = metadata.select(
        strip(F.col(id_col)).alias("__id"), *((F.to_json(c) if c in nested else F.col(c)).alias(c) for c in metadata.columns if c != id_col), F.lit(1).alias("metadata_found")
    ).dropDuplicates(["__id"])
    out = samples.withColumn("__sid", strip(F.col(id_col))).join(own, F.col("__sid") == F.col("__id"), "left").drop("__sid", "__id")
    return out.withColumn("metadata_found", F.coalesce("metadata_found", F.lit(0)))


def enrichment_counts(enriched: DataFrame) -> DataFrame:
    return enriched.agg(F.count("*").alias("samples"), F.coalesce(F.sum("metadata_found"), F.lit(0)).alias("found"),
        F.coalesce(F.sum(1 - F.col("metadata_found")), F.lit(0)).alias("not_found"))
