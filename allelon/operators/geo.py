"""Location by mutation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelon.functions.text import clean_location, strip
from allelon.storage import store

REGULATORY = ("marr", "acrr")
#: Locations that the top-N table leaves out by default; a fixed value.
EXCLUDED = ("Asia", "Egypt", "United Kingdom", "UK", "Unknown", "UNKNOWN", "India")


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__rn = 1").drop("__rn")


def geo_master(isolates: DataFrame, id_col: str = "Genome ID", location_col: str = "geographic_location", order: tuple[str, ...] = ("src_ord", "row_ord")) -> DataFrame:
    """One row of each genome, the first, with its cleaned location."""
    return first_rows(isolates, [id_col], list(order)).withColumn("geographic_location_clean", clean_location(F.col(location_col)))


def geo_merged(master: DataFrame, report: DataFrame, id_col: str = "Genome ID", genes: tuple[str, ...] = REGULATORY) -> DataFrame:
    """Genomes with their distinct mutations in the given genes."""
    own = report.where(F.lower("Gene").isin(*genes)).dropDuplicates(["Accession", "Gene", "Mutation"])
    return master.join(own, F.col(f"`{id_col}`") == F.col("Accession"))


def geo_long(merged: DataFrame, id_col: str = "Genome ID") -> DataFrame:
    """Distinct genomes of each location and mutation.

    Rows come partitioned by genome from the join, so the distinct ones need no exchange, and their counts are combined before the only one.
    """
    own = merged.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), "geographic_location_clean", "Mutation").distinct()
    return own.groupBy("geographic_location_clean", "Mutation").agg(F.count("*").alias("mutation_frequency"))


def geo_matrix(long: DataFrame, columns: list[str], name: str = "Mutation") -> DataFrame:
    """``long`` as a matrix over a given, bounded list of columns, 0 where there is none."""
    return long.groupBy("geographic_location_clean").pivot(name, columns).agg(F.sum("mutation_frequency")).na.fill(0)


def geo_counts(merged: DataFrame, excluded: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """Rows of each location and gene:mutation, without excluded and missing locations, genes or mutations."""
    loc, gene, mut = (strip(F.coalesce(F.col(c), F.lit(""))) for c in ("geographic_location_clean", "Gene", "Mutation"))
    rows = merged.select(loc.alias("geographic_location_clean"), gene.alias("g"), mut.alias("m"))
    rows = rows.where(~F.col("geographic_location_clean").isin("", "nan", "None") & ~F.lower("geographic_location_clean").isin(*(x.strip().lower() for x in excluded)))
    rows = rows.where("g <> '' AND m <> ''")
    return rows.groupBy("geographic_location_clean", F.concat_ws(":", "g", "m").alias("Gene_Mutation")).agg(F.count("*").alias("mutation_frequency"))


def margins(counts: DataFrame, column: str) -> DataFrame:
    """Sums by one side of the table."""
    return counts.groupBy(column).agg(F.sum("mutation_frequency").alias("total"))


def geo_topn(counts: DataFrame, n: int = 20) -> DataFrame:
    """The n rows and n columns of the largest sums over the whole table, in long form; ties by label."""
    n = max(1, n)
    rows = margins(counts, "geographic_location_clean").orderBy(F.desc("total"), "geographic_location_clean").limit(n)
    cols = margins(counts, "Gene_Mutation").orderBy(F.desc("total"), "Gene_Mutation").limit(n)
    return counts.join(rows.drop("total"), "geographic_location_clean", "left_semi").join(cols.drop("total"), "Gene_Mutation", "left_semi")


def geo_topn_matrix(counts: DataFrame, n: int = 20) -> DataFrame:
    """The same rows and columns as a dense matrix: a row for each of the n locations, a column for each of the n mutations, 0 where they don't meet.

    Both sides' sums are of one pass over the counts; only the n column names come to the driver, as the matrix has to have them.
    """
    n, place, name = max(1, n), "geographic_location_clean", "Gene_Mutation"
    both = counts.groupingSets([[place], [name]], place, name).agg(F.grouping(name).alias("side"), F.sum("mutation_frequency").alias("total"))
    label = F.coalesce(place, name)
    best = Window.partitionBy("side").orderBy(F.desc("total"), label)
    top = both.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= n)
    top = store(top.select("side", label.alias("label"), "rn"), "margins")  # 2 n rows
    columns = [r["label"] for r in top.where("side = 0").orderBy("rn").collect()]
    rows = top.where("side = 1").select(F.col("label").alias(place))
    return rows.join(counts, place, "left").groupBy(place).pivot(name, columns).agg(F.sum("mutation_frequency")).na.fill(0)


def geo_summary(master: DataFrame, report: DataFrame, merged: DataFrame, id_col: str = "Genome ID") -> DataFrame:
    """Counts of a run, in one row."""
    a = master.agg(F.count("*").alias("metadata_rows"))
    b = report.agg(F.count("*").alias("mutation_rows"))
    c = merged.agg(F.count("*").alias("merged_rows"), F.countDistinct("geographic_location_clean").alias("unique_locations"), F.countDistinct("Mutation").alias("unique_mutations"))
    return a.join(F.broadcast(b)).join(F.broadcast(c))  # one row each
