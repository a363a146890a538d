"""Mutation-analytics inputs derived from the driver's tables, in Spark; plans/sql.py has the same in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelon.functions.sequence import codons, reverse_complement, translate_dna

#: Letters from the most frequent one, as residues from the most frequent one.
LETTER_RESIDUES = ("etaoinshrdlucmfwygpbvkxjqz", "LAGVSEKTIDRPNQFYMHCWLAGVSE")
RES, MUT = "ARNDCQEGHILKMFPSTWYV", "ARNDCQEGHILKMFPSTWYV*X"
GENE = "CASE l_suppkey % 5 WHEN 0 THEN 'acrA' WHEN 1 THEN 'acrB' WHEN 2 THEN 'tolC' WHEN 3 THEN 'acrR' ELSE 'marR' END"
CODE = f"concat(substr('{RES}', cast((l_partkey % 40) % 20 + 1 AS int), 1), cast(10 + l_partkey % 40 AS string), substr('{MUT}', cast(((l_partkey % 40) * 7 + 3) % 22 + 1 AS int), 1))"
#: DNA quality thresholds for the derived assemblies, which are far shorter than genomes.
QC_LIMITS = {
    "min_bp": 30_000, "max_bp": 120_000, "moderate_fragmentation": 40, "high_fragmentation": 60, "low_n50": 1_500, "moderate_n50": 2_500,
    "moderate_n_fraction": 0.012, "high_n_fraction": 0.02, "ready_max_contigs": 55, "ready_min_n50": 2_000, "ready_max_n_fraction": 0.015,
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def report(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr("cast(l_orderkey AS string) AS Accession", f"{GENE} AS Gene", f"{CODE} AS Mutation",
        "l_linenumber AS ord", "l_partkey", "l_suppkey")


def letters() -> Column:
    return F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+", "")


def _dna() -> Column:
    return F.translate(letters(), "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTNN")


def contigs(spark: SparkSession, sf: str, parts: int = 0) -> DataFrame:
    """A contig for each document, an assembly for each source. With ``parts``, documents are dealt into so many by their ids first, as a row group is one task's whatever its size."""
    docs = table(spark, sf, "documents")
    return (docs.repartition(parts, "doc_id") if parts else docs).select(
        F.col("source").alias("genome_id"), F.concat("source", F.lit(".fna")).alias("file_name"), F.lit(0).cast("long").alias("file_size"), F.col("doc_id").alias("contig_ord"),
        F.col("doc_id").cast("string").alias("contig_id"), F.concat(F.lit("contig "), F.col("doc_id").cast("string")).alias("header"),
        _dna().alias("seq"), F.length(letters()).cast("long").alias("seq_len"),
    )


def searched_proteins(spark: SparkSession, sf: str) -> DataFrame:
    """Whole proteins to search for: every benchmark passage and three contigs, translated."""
    passages = table(spark, sf, "benchmark").select(F.concat(F.lit("item"), F.col("item_id").cast("string")).alias("gene"), translate_dna(_dna()).alias("seq"))
    own = contigs(spark, sf).where("contig_ord IN (1, 2, 4)").select(F.concat(F.lit("gene"), F.col("contig_ord").cast("string")).alias("gene"),
        translate_dna(F.col("seq")).alias("seq"))
    return passages.unionByName(own).where("seq <> ''")


def item_proteins(spark: SparkSession, sf: str) -> DataFrame:
    """(item_id, gene, ref, dna): every benchmark passage of 20 letters or more, letter by letter as residues, and DNA that codes for it."""
    back = {a: c for c, a in codons().items()}
    codon = F.create_map(*(F.lit(x) for r in RES for x in (r, back[r])))
    ref = F.translate(letters(), *LETTER_RESIDUES)
    rows = table(spark, sf, "benchmark").select("item_id", F.concat(F.lit("item"), F.col("item_id").cast("string")).alias("gene"), ref.alias("ref")).where("length(ref) >= 20")
    return rows.withColumn("dna", F.array_join(F.transform(F.regexp_extract_all("ref", F.lit("(.)"), F.lit(1)), lambda r: codon[r]), ""))


def planted_contigs(spark: SparkSession, sf: str) -> DataFrame:
    """The contigs of the documents, each with a passage's protein in its middle, on the other strand for odd ids."""
    n = table(spark, sf, "benchmark").agg(F.count("*").alias("n"))  # one row
    rows = contigs(spark, sf).select("genome_id", F.col("contig_ord").alias("doc_id"), "seq").join(F.broadcast(n)).withColumn("item_id", F.expr("doc_id % n"))
    rows = rows.join(item_proteins(spark, sf), "item_id")
    own = F.when(F.col("doc_id") % 2 == 1, reverse_complement(F.col("dna"))).otherwise(F.col("dna"))
    half = F.expr("length(seq) div 2")
    seq = F.concat(F.substring("seq", F.lit(1), half), own, F.substring("seq", half + 1, F.lit(2**31 - 1)))
    return rows.select("genome_id", F.col("doc_id").cast("string").alias("contig_id"), "gene", seq.alias("seq"))


def blast_hits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(
        "cast(l_orderkey AS string) AS qseqid", f"{GENE} AS sseqid", "cast(75 + l_partkey % 25 AS double) AS pident", "cast(50 + l_quantity AS bigint) AS length",
        "cast(CASE WHEN l_linenumber % 2 = 0 THEN l_partkey ELSE l_partkey + l_quantity END AS bigint) AS qstart",
        "cast(CASE WHEN l_linenumber % 2 = 0 THEN l_partkey + l_quantity ELSE l_partkey END AS bigint) AS qend",
        "1L AS sstart", "cast(50 + l_quantity AS bigint) AS send", "CASE WHEN l_linenumber % 2 = 0 THEN 'plus' ELSE 'minus' END AS sstrand", "cast(100 AS bigint) AS slen",
        "cast(l_linenumber AS double) / 1000 AS evalue", "cast(l_extendedprice AS double) AS bitscore", "l_linenumber", "l_partkey",
    )


def gene_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Three coordinate hits on each contig, one in each third of it, of which some start below 1 or end behind a short contig."""
    return contigs(spark, sf).selectExpr("genome_id", "contig_id AS Contig", "contig_ord", "seq_len", "explode(array(0, 1, 2)) AS k").selectExpr(
        "genome_id AS Accession", "Contig", "CASE k WHEN 0 THEN 'acrA' WHEN 1 THEN 'acrB' ELSE 'tolC' END AS Gene",
        "contig_ord % 7 + seq_len * k div 3 AS Start", "contig_ord % 7 + seq_len * k div 3 + 59 AS End", "CASE WHEN (contig_ord + k) % 2 = 0 THEN '+' ELSE '-' END AS Strand",
    )


def protein_references(spark: SparkSession, sf: str) -> DataFrame:
    """(item_id, gene, ref): every benchmark passage as a protein of the 20 residues, the first five named like known genes."""
    gene = "CASE item_id WHEN 0 THEN 'acrA' WHEN 1 THEN 'acrB' WHEN 2 THEN 'tolC' WHEN 3 THEN 'acrR' WHEN 4 THEN 'marR' ELSE concat('item', cast(item_id AS string)) END"
    return table(spark, sf, "benchmark").select("item_id", F.expr(gene).alias("gene"), F.translate(translate_dna(_dna()), "X*", "GQ").alias("ref")).where("ref <> ''")


def changed_proteins(spark: SparkSession, sf: str) -> DataFrame:
    """A protein for each document: a reference with changes that the document's own whole protein decides.

    Two residues (at p1 and p2) become the document's last two. Of references with 60 residues or more, every third protein
    lacks four residues and every third has five more, from the middle of the document's protein. Every eleventh is a part of the document's
    protein instead, which the identity gate drops.
    """
    items = protein_references(spark, sf)
    n = table(spark, sf, "benchmark").agg(F.count("*").alias("n"))  # one row
    docs = contigs(spark, sf).select("contig_ord", F.translate(translate_dna(F.col("seq")), "X*", "GQ").alias("own")).join(F.broadcast(n))
    rows = docs.withColumn("item_id", F.expr("contig_ord % n")).join(items, "item_id").selectExpr(
        "contig_ord AS doc_id", "gene", "ref", "own", "length(ref) AS l", "length(own) AS m", "length(ref) div 6 + 1 AS p1",
            "length(ref) div 3 + 1 AS p2", "2 * length(ref) div 3 AS g",
        "coalesce(nullif(substring(own, -1, 1), ''), 'W') AS a1", "CASE WHEN length(own) > 1 THEN substring(own, -2, 1) ELSE 'W' END AS a2", "contig_ord % 11 = 10 AS other",
    ).selectExpr(
        "*", "CASE WHEN l >= 60 AND doc_id % 3 = 1 THEN 4 ELSE 0 END AS lost", "CASE WHEN l >= 60 AND doc_id % 3 = 2 THEN substring(own, m div 2 + 1, 5) ELSE '' END AS more",
    )
    seq = """CASE WHEN other THEN substring(own, m div 2 + 1, l) ELSE concat(substring(ref, 1, p1 - 1), a1, substring(ref, p1 + 1, p2 - p1 - 1), a2,
        substring(ref, p2 + 1, g - p2), more, substring(ref, g + lost + 1, 2147483647)) END AS seq"""
    return rows.selectExpr("doc_id", "cast(doc_id AS string) AS accession", "gene", seq, "other", *(f"substring(ref, p{k}, 1) AS w{k}" for k in (1, 2)), "p1", "p2", "a1", "a2")


def known_variants(changed: DataFrame) -> DataFrame:
    """A table of known mutations: the first change of every seventh document of ``changed_proteins``."""
    return changed.where("NOT other AND doc_id % 7 = 0").selectExpr("gene", "concat(w1, cast(p1 AS string), a1) AS mutation",
        "CASE WHEN doc_id % 2 = 0 THEN concat('Known by ', accession) END AS phenotype", "accession AS pdb", "doc_id AS ord")


def isolates(spark: SparkSession, sf: str) -> DataFrame:
    """Isolates from customers and nations, every tenth id twice."""
    base = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.expr("c_nationkey = n_nationkey"))
    place = "CASE c_custkey % 4 WHEN 0 THEN concat(n_name, ': site ', cast(c_custkey % 7 AS string), ' (x)') WHEN 1 THEN concat(n_name, ': ') WHEN 2 THEN n_name ELSE '' END"
    one = base.selectExpr("cast(c_custkey AS string) AS `Genome ID`", f"{place} AS geographic_location", "0 AS src_ord", "c_custkey AS row_ord")
    two = base.where("c_custkey % 10 = 0").selectExpr("cast(c_custkey AS string) AS `Genome ID`", "'Second: place' AS geographic_location", "1 AS src_ord", "c_custkey AS row_ord")
    return one.unionByName(two)


def isolate_report(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "cast(o_custkey AS string) AS Accession", "CASE WHEN o_orderkey % 5 < 2 THEN 'marR' WHEN o_orderkey % 5 < 4 THEN 'acrR' ELSE 'acrB' END AS Gene", "concat('A', cast(o_orderkey % 40 AS string), 'V') AS Mutation"
    )


def atoms(spark: SparkSession, sf: str, scale: float) -> DataFrame:
    part = lambda i: (F.element_at("embedding", i).cast("double") * scale)
    return table(spark, sf, "embeddings").select(
        F.col("label").cast("string").alias("structure"), F.col("vec_id").alias("ord"), F.col("vec_id").alias("line_ord"),
            (F.col("vec_id") % 2).cast("string").alias("chain"), F.col("vec_id").cast("string").alias("resseq"),
        part(1).alias("x"), part(2).alias("y"), part(3).alias("z"), F.lit("ATOM").alias("record"), F.lit("CA").alias("atom"), F.lit("C").alias("element"),
        F.expr("element_at(array('ALA', 'SER', 'GLY'), cast(vec_id % 3 + 1 AS int))").alias("resname"),
    )


def affinities(spark: SparkSession, sf: str) -> DataFrame:
    """A run and network for each user: the first two values in time, divided by 100."""
    # Spark keeps the first two of a user in each task before the shuffle.
    first = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id", "value"))
    two = table(spark, sf, "events").select("user_id", "ts", "event_id", "value").withColumn("rn", first).where("rn <= 2")
    value = lambda i: F.max(F.when(F.col("rn") == i, F.col("value") / 100))
    rows = two.groupBy("user_id").agg(value(1).alias("wt_affinity"), value(2).alias("mut_affinity"))
    return rows.select(
        F.concat(F.lit("run"), (F.col("user_id") % 4).cast("string")).alias("run"),
            F.format_string("%s:S%sL", F.when(F.col("user_id") % 3 == 0, "acrR").otherwise("acrB"), F.col("user_id")).alias("Node_1"),
        F.when(F.col("user_id") % 5 == 0, F.format_string("tolC:A%sV", F.col("user_id"))).alias("Node_2"), "wt_affinity", "mut_affinity", "user_id",
    )


DB = [("acrA", "A10D", "Efflux", "1ABC", 0), ("acrA", "A10D", "Second entry", "9ZZZ", 1), ("marR", "R31P", None, "2DEF", 0),
    ("tolC", "N12W", "Porin loss", None, 0), ("acrb", "D13S", "Case", "3GHI", 0)]
DRUGS = [("acrr", "fluoroquinolones"), ("marr", "multiple_antibiotics")]
PREDICTED = "l_partkey % 40 < 20"
