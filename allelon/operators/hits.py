"""Alignment hits: standard form, best hits, extraction of sequences, translated search."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelon.functions.sequence import protein_table11, reverse_complement, ungapped
from allelon.operators.search import translated_search
from allelon.storage import store

__all__ = ["best_hits", "extract_sequences", "extraction_stats", "filter_hits", "proteins_from_hits", "select_reference", "standardize_hits", "target_hits", "translated_search", "union_hits"]


def filter_hits(hits: DataFrame, min_identity: float = 80.0, min_coverage: float = 80.0) -> DataFrame:
    return hits.where((F.col("pident") >= min_identity) & (F.col("length") * 100.0 / F.col("slen") >= min_coverage))


def standardize_hits(hits: DataFrame, min_identity: float = 80.0, min_coverage: float = 80.0, source: str = "blastn", keep: tuple[str, ...] = ()) -> DataFrame:
    """blastn rows as Gene, Contig, Start, End, Strand, Identity, Source."""
    return filter_hits(hits, min_identity, min_coverage).select(
        *keep, F.col("sseqid").alias("Gene"), F.col("qseqid").alias("Contig"), F.least("qstart", "qend").alias("Start"), F.greatest("qstart", "qend").alias("End"),
        F.when(F.contains(F.lower("sstrand"), F.lit("minus")), "-").otherwise("+").alias("Strand"), F.col("pident").cast("double").alias("Identity"), F.lit(source).alias("Source"),
    )


def names_with_parts(names: DataFrame, targets: DataFrame, part_letters: int = 1 << 22) -> DataFrame:
    """The names (name) that hold one of the targets (t). An automaton of all targets walks each name once, whatever their number.

    It is broadcast, for about ``part_letters`` letters of targets; more targets take a pass over the names for each part.
    """
    count, letters, blank = targets.agg(F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0)), F.count_if(F.col("t") == "")).first()
    if blank:  # every name holds it
        return names
    n, found = max(1, min(count, -(-letters // max(1, part_letters)))), None
    for k in range(n):
        own = [r["t"] for r in targets.where(F.pmod(F.xxhash64("t"), F.lit(n)) == k).collect()]
        if not own:
            continue
        sent = names.sparkSession.sparkContext.broadcast(own)

        def walk(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for t in sent.value:
                automaton.add_word(t)
            automaton.make_automaton()
            for b in batches:
                hit = [next(automaton.iter(x), None) is not None for x in b.column(0).to_pylist()]
                yield b.filter(pa.array(hit, pa.bool_()))

        some = names.mapInArrow(walk, "name string")
        found = some if found is None else found.unionByName(some)
    return names.limit(0) if found is None else found.distinct() if n > 1 else found


def target_hits(hits: DataFrame, targets: DataFrame, gene: str = "Gene", substring: bool = False) -> DataFrame:
    """Hits of the target genes (gene, any case): exact match, or targets that are part of the hit's name, each different name looked at once."""
    small = targets.select(F.lower("gene").alias("__t")).distinct()
    if not substring:
        return hits.join(small, F.lower(gene) == F.col("__t"), "left_semi")
    names = hits.select(F.lower(gene).alias("name")).where("name IS NOT NULL").distinct()
    return hits.join(names_with_parts(names, small.where("__t IS NOT NULL").select(F.col("__t").alias("t"))), F.lower(gene) == F.col("name"), "left_semi")


def union_hits(*hits: DataFrame) -> DataFrame:
    out = hits[0]
    for h in hits[1:]:
        out = out.unionByName(h)
    return out


def best_hits(hits: DataFrame, keys: list[str], score: str = "bitscore") -> DataFrame:
    """The best hit of each key: highest score, then lowest e-value, name and start."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), "evalue", "sseqid", "sstart")
    return hits.withColumn("__rn", F.row_number().over(order)).where("__rn = 1").drop("__rn")


def proteins_from_hits(hits: DataFrame, keys: list[str]) -> DataFrame:
    """The best hit's subject sequence without gaps, null where nothing is left."""
    return best_hits(hits, keys).withColumn("seq", ungapped(F.col("sseq")))


def select_reference(candidates: DataFrame, gene: str = "gene", rank: str = "rank", refseq: str = "is_refseq", length: str = "length", top: int = 5,
    low: int = 100, high: int = 2000) -> DataFrame:
    """One reference for each gene: of the first ``top`` RefSeq candidates the first of valid length, else of the first of all."""
    best = Window.partitionBy(gene)
    passes = candidates.withColumns(
        {"__r1": F.row_number().over(Window.partitionBy(gene, refseq).orderBy(rank)), "__r2": F.row_number().over(best.orderBy(rank))}
    ).where(F.col(length).between(low, high))
    own = passes.withColumn("__pass", F.when(F.col(refseq) & (F.col("__r1") <= top), 0).when(F.col("__r2") <= top, 1)).where("__pass IS NOT NULL")
    return own.withColumn("__rn", F.row_number().over(best.orderBy("__pass", rank))).where("__rn = 1").drop("__rn", "__r1", "__r2").withColumnRenamed("__pass", "search_pass")


def extract_sequences(hits: DataFrame, contigs: DataFrame, keys: list[str], translate: bool = True, chunk: int = 1 << 16) -> DataFrame:
    """DNA and protein of each hit by its coordinates; ``dna`` is null for an unknown contig or a start below 1.

    Contigs are read as chunks of ``chunk`` letters, and a hit meets the chunks that it lies in only, so that no contig is copied for a hit and a
    contig of very many hits is many keys. An end behind the contig's counts as its end. Of contigs with equal keys
    each gives a row; equal contigs count once.
    """
    own = store(hits.withColumn("__hit", F.monotonically_increasing_id()), "hits")
    known = contigs.where("seq IS NOT NULL").select(*keys, "seq").withColumn("__cid", F.xxhash64(*keys, "seq"))
    spans = own.join(known.select(*keys, "__cid", F.length("seq").cast("long").alias("__len")).distinct(), keys, "left")
    end = F.least("End", "__len")
    inside = spans.where((F.col("Start") >= 1) & (F.col("End") >= F.col("Start")) & (F.col("Start") <= F.col("__len")))
    wanted = inside.select("__hit", *keys, "__cid", "Start", end.alias("End"), F.explode(F.sequence(F.floor((F.col("Start") - 1) / chunk), F.floor((end - 1) / chunk))).alias("__k"))
    # All chunks in one pass over the text; a substring for each would walk it from the start each time.
    pieces = known.select(*keys, "__cid", F.posexplode(F.regexp_extract_all("seq", F.lit(f"(?s)(.{{1,{chunk}}})"), F.lit(1))).alias("__k", "__piece"))
    low = F.greatest(F.col("Start") - F.col("__k") * chunk, F.lit(1))
    part = F.substring("__piece", low.cast("int"), (F.least(F.col("End") - F.col("__k") * chunk, F.lit(chunk)) - low + 1).cast("int"))
    found = wanted.join(pieces.withColumn("__k", F.col("__k").cast("long")), [*keys, "__cid", "__k"]).groupBy("__hit", "__cid").agg(
        F.array_join(F.transform(F.sort_array(F.collect_set(F.struct("__k", part.alias("p")))), lambda x: x["p"]), "").alias("dna"))
    out = spans.join(found, ["__hit", "__cid"], "left").select(*hits.columns, F.when(F.col("Strand") == "-", reverse_complement(F.col("dna"))).otherwise(F.col("dna")).alias("dna"))
    return out.withColumn("protein", protein_table11(F.col("dna"))) if translate else out


def extraction_stats(wanted: DataFrame, genome: str, value: str = "protein") -> DataFrame:
    """Extracted and failed genes of each genome, and whether all were found."""
    got = F.count(value)
    return wanted.groupBy(genome).agg(got.alias("extracted"), (F.count("*") - got).alias("failed"), (F.count("*") == got).alias("complete"))
