"""Co-occurrence networks of mutations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelon.functions.scoring import score_mutations
from allelon.functions.text import after_colon, before_colon, gene_class, mutation_token
from allelon.storage import store

TOP_NETWORKS, TOP_MUTATIONS = 5, 15


def report_tokens(report: DataFrame, accession: str = "Accession", gene: str = "Gene", mutation: str = "Mutation", unscored: float = 1.0) -> DataFrame:
    """Distinct (acc, tok, score): scored once for each distinct token pair, not for each report row.

    Rows without an accession, gene or mutation are left out; mutations that can't be scored count ``unscored``.
    """
    rows = report.where(F.col(accession).isNotNull() & F.col(gene).isNotNull() & F.col(mutation).isNotNull())
    distinct = rows.select(F.col(accession).alias("acc"), mutation_token(F.col(gene), F.col(mutation)).alias("tok")).distinct()
    scored = score_mutations(distinct.withColumn("__mut", after_colon(F.col("tok"))), "__mut").drop("__mut")
    return scored.select("acc", "tok", F.coalesce("Severity", F.lit(unscored)).alias("score"))


def token_dictionary(tokens: DataFrame, unscored: float = 1.0) -> DataFrame:
    """(tok, score, id) of each distinct token (tok), stored: ids are numbers of no meaning, scores those of ``report_tokens``."""
    scored = score_mutations(tokens.select("tok").distinct().withColumn("__mut", after_colon(F.col("tok"))), "__mut")
    return store(scored.select("tok", F.coalesce("Severity", F.lit(unscored)).alias("score"), F.monotonically_increasing_id().alias("id")), "tokens")


def tile_sides(coded: DataFrame, tile: int) -> tuple[DataFrame, DataFrame]:
    """The two sides (acc, t1, t2, a or b) of a self-join of (acc, id) in which an accession's ids are dealt into tiles of about ``tile``."""
    crowded = coded.groupBy("acc").agg(F.count("*").alias("n")).where(F.col("n") > tile).select("acc", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    dealt = coded.join(crowded, "acc", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    a = dealt.select("acc", F.col("own").alias("t1"), F.explode(F.sequence("own", F.col("tiles") - 1)).alias("t2"), F.col("id").alias("a"))
    b = dealt.select("acc", F.explode(F.sequence(F.lit(0), "own")).alias("t1"), F.col("own").alias("t2"), F.col("id").alias("b"))
    return a, b


def tile_pairs(coded: DataFrame, tile: int = 1000) -> DataFrame:
    """(low, high, Frequency) of the pairs of ids that occur together, from distinct (acc, id).

    Each pair of an accession's tiles is a join key of its own, so that an accession of very many ids is spread over tasks and a key has about
    tile^2 pairs at most. Most accessions are one tile.
    """
    a, b = tile_sides(coded, tile)
    pairs = a.join(b, ["acc", "t1", "t2"]).where("t1 < t2 OR a < b")
    return pairs.groupBy(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).agg(F.count("*").alias("Frequency"))


def epistasis_edges(report: DataFrame, accession: str = "Accession", gene: str = "Gene", mutation: str = "Mutation", unscored: float = 1.0, tile: int = 1000) -> DataFrame:
    """Pairs of mutations that occur in one accession: how often, their mean severity and composite score.

    Tokens are scored once each in a dictionary and go through the joins as numbers; their texts come back once the pairs are counted.
    """
    rows = report.where(F.col(accession).isNotNull() & F.col(gene).isNotNull() & F.col(mutation).isNotNull())
    rows = rows.select(F.col(accession).alias("acc"), mutation_token(F.col(gene), F.col(mutation)).alias("tok"))
    words = token_dictionary(rows, unscored)
    pairs = tile_pairs(store(rows.join(words, "tok").select("acc", "id").distinct(), "accession-tokens"), tile)
    side = lambda i, k: words.select(F.col("id").alias(i), F.col("tok").alias(f"t{k}"), F.col("score").alias(f"s{k}"))
    named = pairs.join(side("low", 1), "low").join(side("high", 2), "high").withColumns({"Node_1": F.least("t1", "t2"), "Node_2": F.greatest("t1", "t2")})
    mean = (F.col("s1") + F.col("s2")) / 2
    return named.select(
        "Node_1", "Node_2", before_colon(F.col("Node_1")).alias("Node_1_Gene"), before_colon(F.col("Node_2")).alias("Node_2_Gene"),
        after_colon(F.col("Node_1")).alias("Node_1_Mutation"), after_colon(F.col("Node_2")).alias("Node_2_Mutation"),
        "Frequency", mean.alias("Avg_Biochemical_Severity"), (F.col("Frequency") * mean).alias("Composite_Network_Score"),
    )


def crowded_accessions(report: DataFrame, limit: int = 1000, **names) -> DataFrame:
    """Accessions with more than ``limit`` tokens, whose pairs would dominate the self-join."""
    return report_tokens(report, **names).groupBy("acc").agg(F.count("*").alias("tokens")).where(F.col("tokens") > limit)


def top_networks(edges: DataFrame, k: int = TOP_NETWORKS) -> DataFrame:
    """The k edges of highest composite score, ranked; ties by name."""
    order = (F.desc("Composite_Network_Score"), F.asc("Node_1"), F.asc("Node_2"))
    return edges.orderBy(*order).limit(k).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def _named(edges: DataFrame) -> DataFrame:
    clean = lambda c: F.trim(F.coalesce(c, F.lit("")))
    return edges.withColumns({c: clean(F.col(c)) for c in ("Node_1", "Node_2")})


def node_weights(edges: DataFrame) -> DataFrame:
    """Sum of the frequencies of a node's edges; edges need both nodes."""
    rows = _named(edges).where("Node_1 <> '' AND Node_2 <> ''").select(F.explode(F.array("Node_1", "Node_2")).alias("node"), "Frequency")
    return rows.groupBy("node").agg(F.sum("Frequency").alias("weight"))


def edge_weights(edges: DataFrame) -> DataFrame:
    """Highest composite score of each unordered pair of nodes, at least 0."""
    rows = _named(edges).where("Node_1 <> '' AND Node_2 <> ''")
    return rows.groupBy(F.least("Node_1", "Node_2").alias("node_a"), F.greatest("Node_1", "Node_2").alias("node_b")).agg(
        F.greatest(F.max("Composite_Network_Score"), F.lit(0.0)).alias("weight")
    )


def mutation_frequency(edges: DataFrame) -> DataFrame:
    """Frequency of each mutation over all edges, with its gene and the gene's class."""
    rows = _named(edges).select(F.explode(F.array("Node_1", "Node_2")).alias("mutation"), "Frequency").where("mutation <> ''")
    gene = F.lower(F.trim(F.coalesce(before_colon(F.col("mutation")), F.lit(""))))
    return rows.select("mutation", gene.alias("gene"), gene_class(gene).alias("gene_class"), "Frequency").groupBy("mutation", "gene",
        "gene_class").agg(F.sum("Frequency").alias("frequency"))


def top_mutations(edges: DataFrame, k: int = TOP_MUTATIONS) -> DataFrame:
    return mutation_frequency(edges).orderBy(F.desc("frequency"), "mutation").limit(k)


def scaled(df: DataFrame, column: str, low: float, high: float, out: str = "scaled") -> DataFrame:
    """``column`` mapped linearly to low..high; missing values and NaN count as the least, equal values give the middle.

    The range is a one-row aggregate that is joined back, so no window gathers the rows in one task.
    """
    own = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    ends = df.agg(F.min(own).alias("__lo"), F.max(own).alias("__hi"))
    value = F.coalesce(own, F.col("__lo"), F.lit(0.0))
    size = F.col("__hi") - F.col("__lo")
    found = F.when(F.coalesce(size, F.lit(0.0)) < 1e-12, F.lit((low + high) / 2)).otherwise(F.lit(low) + (value - F.col("__lo")) * F.lit(high - low) / size)
    return df.join(F.broadcast(ends)).withColumn(out, found).drop("__lo", "__hi")  # one row
