"""Amino-acid substitutions against wild-type references, and what is known about them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from allelon.operators.alignment import identities_and_substitutions
from allelon.storage import store


def align_proteins(proteins: DataFrame, refs: DataFrame, min_identity: float = 80.0) -> DataFrame:
    """(accession, gene, identity, mutations) of each protein (accession, gene, seq) that has a reference (gene, seq) and can be aligned.

    identity: residues equal to the reference's, in per cent of its length; mutations: substitutions, none below ``min_identity``. Each
    distinct sequence of a gene is aligned once, and only if its length allows the identity gate (shorter ones have no row); sequences
    equal to the reference aren't aligned at all. The references are a table of one row a gene; Spark broadcasts it
    where it is small.
    """
    # Stored, as they are read twice and may be dear to derive.
    named = store(proteins.where("seq IS NOT NULL AND seq <> ''").select("accession", "gene", "seq", F.md5("seq").alias("__key")), "proteins")
    # A sequence moves once, to where its copies meet; its digest stands for it from then on.
    distinct = named.groupBy("gene", "__key").agg(F.first("seq").alias("seq")).join(refs.select("gene", F.col("seq").alias("ref")), "gene")
    distinct = distinct.where(F.least(F.length("seq"), F.length("ref")) * 100.0 >= F.lit(min_identity) * F.length("ref"))

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found: list = [None] * len(pdf)
            for ref, rows in pdf.groupby("ref").indices.items():
                for i, own in zip(rows, identities_and_substitutions(ref, pdf["seq"].iloc[rows].tolist(), min_identity), strict=True):
                    found[i] = own
            kept = [i for i, f in enumerate(found) if f is not None]
            own = pdf[["gene", "__key"]].iloc[kept].reset_index(drop=True)
            yield own.assign(identity=[float(found[i][0]) for i in kept], mutations=[found[i][1] for i in kept])

    called = distinct.mapInPandas(align, "gene string, __key string, identity double, mutations array<string>")
    return named.select("accession", "gene", "__key").join(called, ["gene", "__key"]).select("accession", "gene", "identity", "mutations")


def call_variants(proteins: DataFrame, refs: DataFrame, min_identity: float = 80.0) -> DataFrame:
    """(accession, gene, Mutation): the substitutions of ``align_proteins``, a row for each."""
    return align_proteins(proteins, refs, min_identity).select("accession", "gene", F.explode("mutations").alias("Mutation"))


def _letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all letters as numbers, where each text starts and the last one ends); a null text is empty."""
    texts = pc.fill_null(texts, "")
    if len(texts) and pc.all(pc.equal(pc.utf8_length(texts), pc.binary_length(texts))).as_py():
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        return np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]], at - at[0]
    own = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts.to_pylist()]
    return np.concatenate([np.empty(0, np.uint32), *own]), np.concatenate([[0], np.cumsum([len(x) for x in own], dtype=np.int64)])


def _strings(letters: np.ndarray) -> pa.Array:
    """A string of one letter for each number."""
    if letters.dtype == np.uint8 or not len(letters) or letters.max() < 128:
        return pa.StringArray.from_buffers(len(letters), pa.py_buffer(np.arange(len(letters) + 1, dtype=np.int32)), pa.py_buffer(letters.astype(np.uint8)))
    return pa.array([chr(x) for x in letters.tolist()], pa.string())


def residue_changes(aligned: DataFrame, keys: list[str], ref: str, query: str, together: int = 1 << 19) -> DataFrame:
    """(keys, wt, position, mut): the substitutions of ``residue_positions``, a row for each, of aligned strings in the columns ``ref`` and ``query``.

    Strings are compared ``together`` letters at a time, so that a row of any length takes bounded room beside itself.
    """
    kinds = ", ".join(f"`{c}` {aligned.schema[c].dataType.simpleString()}" for c in keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gap = ord("-")
        for batch in batches:
            (x, a), (y, b) = _letters(batch.column(len(keys))), _letters(batch.column(len(keys) + 1))
            # Where lengths differ, the shorter one counts.
            if not np.array_equal(a, b):
                size = np.minimum(np.diff(a), np.diff(b))
                x, y = (np.concatenate([z[i : i + n] for i, n in zip(at[:-1].tolist(), size.tolist(), strict=True)]) for z, at in ((x, a), (y, b)))
                a = np.concatenate([[0], np.cumsum(size)])
            counted = 0  # residues of ref before this part, in all rows of the batch
            before = np.zeros(len(a) - 1, np.int64)  # and before each row
            for low in range(0, len(x), together):
                p, q = x[low : low + together], y[low : low + together]
                own = p != gap
                place = np.cumsum(own)
                begun = np.flatnonzero((a[:-1] >= low) & (a[:-1] < low + len(p)))
                before[begun] = counted + np.concatenate([[0], place])[a[:-1][begun] - low]
                at = np.flatnonzero(own & (p != q) & (q != gap))
                row = np.searchsorted(a, at + low, "right") - 1
                columns = [batch.column(k).take(pa.array(row)) for k in range(len(keys))]
                position = (place[at] + counted - before[row]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*columns, _strings(p[at]), pa.array(position), _strings(q[at])], names=[*keys, "wt", "position", "mut"])
                counted += int(place[-1])

    return aligned.select(*keys, ref, query).mapInArrow(compare, f"{kinds}, wt string, position int, mut string")


def unreferenced(proteins: DataFrame, refs: DataFrame) -> DataFrame:
    """Proteins without a reference."""
    return proteins.join(refs, "gene", "left_anti")


def unalignable(proteins: DataFrame) -> DataFrame:
    """Proteins with letters that the matrix doesn't have, which yield no mutation."""
    return proteins.where(F.col("seq").rlike("[^ARNDCQEGHILKMFPSTWYVBZX*]"))


def interpret_mutations(mutations: DataFrame, db: DataFrame, drugs: DataFrame, predictions: DataFrame | None = None,
    antibiotic: str = "Ciprofloxacin", ci_gene: bool = False) -> DataFrame:
    """Report rows of (Accession, Gene, Mutation): a known mutation, else a prediction where there is a model, else of unknown significance.

    ``db`` (gene, mutation, phenotype, pdb, ord): the first entry counts. ``drugs`` (gene in lower case, drug).
    ``predictions`` (mutation, antibiotic, resistance_prob, risk_level).
    """
    first = db.withColumn("__rn", F.row_number().over(Window.partitionBy("gene", "mutation").orderBy("ord"))).where("__rn = 1")
    key = F.lower if ci_gene else lambda c: F.col(c)
    known = first.select(key("gene").alias("__g"), F.col("mutation").alias("__m"), "phenotype", "pdb", F.lit(True).alias("hit"))
    drug = drugs.select(F.col("gene").alias("__dg"), "drug")
    rows = mutations.join(known, (key("Gene") == F.col("__g")) & (F.col("Mutation") == F.col("__m")), "left").join(drug, F.lower("Gene") == F.col("__dg"), "left")
    hit = F.col("hit").isNotNull()
    status = F.when(hit, "Resistant")
    phenotype = F.when(hit, F.coalesce("phenotype", F.when(F.col("drug").isNotNull(), F.concat("drug", F.lit(" resistance"))), F.lit("Unknown drug resistance")))
    score, source = F.when(hit, F.lit(1.0)), F.when(hit, "Clinical DB")
    if predictions is None:
        vus = F.coalesce(F.concat("drug", F.lit(" resistance (VUS)")), F.lit("Variant of Unknown Significance"))
        status, phenotype, source = status.otherwise(vus), phenotype.otherwise("N/A"), source.otherwise("Clinical DB")
    else:
        asked = F.coalesce("drug", F.lit(antibiotic))
        model = predictions.select(F.col("mutation").alias("__pm"), F.col("antibiotic").alias("__pa"), "resistance_prob", "risk_level")
        rows = rows.withColumn("__asked", asked).join(model, (F.col("Mutation") == F.col("__pm")) & (F.col("__asked") == F.col("__pa")), "left")
        told = F.col("resistance_prob").isNotNull()
        status = status.when(told, F.concat(F.lit("Predicted "), "risk_level", F.lit(" Risk"))).otherwise("Unknown (ML Parse Failed)")
        phenotype = phenotype.when(told, F.concat(F.lit("Predicted "), "__asked", F.lit(" resistance risk"))).otherwise(F.concat("__asked", F.lit(" resistance (Unknown)")))
        score, source = score.otherwise(F.col("resistance_prob")), source.otherwise("AI Model")
    return rows.select(
        "Accession", "Gene", "Mutation", status.alias("Status"), phenotype.alias("Phenotype"), F.when(hit, F.coalesce("pdb", F.lit("N/A"))).otherwise("N/A").alias("Reference_PDB"),
        score.alias("prediction_score"), source.alias("prediction_source"),
    )


def variant_report(proteins: DataFrame, refs: DataFrame, db: DataFrame, drugs: DataFrame, predictions: DataFrame | None = None, min_identity: float = 80.0) -> DataFrame:
    called = call_variants(proteins, refs, min_identity).select(F.col("accession").alias("Accession"), F.col("gene").alias("Gene"), "Mutation")
    return interpret_mutations(called, db, drugs, predictions)


def distinct_rows(rows: DataFrame, together: int = 1 << 18) -> DataFrame:
    """The different rows, dealt by all columns into parts of about ``together`` rows before they are compared, so that no task's table of rows grows with the whole."""
    count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, -(-count // together), min(cores, count // 10_000)), *rows.columns).distinct()


def mutation_summary(report: DataFrame) -> DataFrame:
    """Totals of a report in one row; rows of unknown significance are told by their status text."""
    status = F.col("Status")
    return report.agg(
        F.count("*").alias("total_mutations"), F.count_if(status == "Resistant").alias("resistant_mutations"), F.count_if(status == "VUS").alias("vus_mutations"),
        F.count_if(F.contains(status, F.lit("(VUS)")) | (status == "Variant of Unknown Significance")).alias("unresolved_mutations"),
        F.countDistinct("Gene").alias("unique_genes"), F.countDistinct("Accession").alias("unique_accessions"),
    )


def gene_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("Gene").agg(F.count("*").alias("mutations"))
