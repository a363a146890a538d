"""Readers. Every one has a fixed schema and reads a directory or glob in parallel."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from allelon import schemas
from allelon.functions.scoring import RESIDUES
from allelon.storage import store


def _split(spark: SparkSession, path: str) -> list[tuple[str, str, list[str]]]:
    """(file system, folder or file, expressions for the names below it) of a path or glob, as Hadoop understands it."""
    hadoop, out = spark._jvm.org.apache.hadoop.fs, []
    for own in hadoop.GlobExpander.expand(path):
        top = hadoop.Path(own)
        uri = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toUri()
        names = uri.getPath().split("/")
        plain = next((k for k, n in enumerate(names) if re.search(r"[*?\[{\\]", n)), len(names))
        rest = [str(hadoop.GlobPattern(n).compiled().toString()) for n in names[plain:]]
        out.append((f"{uri.getScheme()}://{uri.getAuthority() or ''}/", "/".join(names[:plain]) or "/", rest))
    return out


def _entries(system: fs.FileSystem, path: str) -> Iterator[tuple[str, bool, int]]:
    """(name, whether it is a folder, size) of all in a folder; a local one is never held whole."""
    if isinstance(system, fs.LocalFileSystem):
        with os.scandir(path) as found:
            yield from ((e.name, e.is_dir(), 0 if e.is_dir() else e.stat().st_size) for e in found)
    else:
        yield from ((i.base_name, i.type == fs.FileType.Directory, max(0, i.size or 0)) for i in system.get_file_info(fs.FileSelector(path)))


_LISTED = "system string, path string, rest array<string>, folder boolean, size long"


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(system, path, size) of the files of a file, directory or glob, also of those of no bytes, listed by tasks: no name comes to the driver.

    Of a directory, its own files and those of folders named key=value count, at any depth; names that start with _ or a dot don't. There is a job for each
    level of folders, which are dealt to tasks. A path without a file or folder is an error.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("system", pa.string()), ("path", pa.string()), ("rest", pa.list_(pa.string())), ("folder", pa.bool_()), ("size", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                system, own, rest = fs.FileSystem.from_uri(row["system"])[0], row["path"], row["rest"]
                info = system.get_file_info(own)
                if info.type == fs.FileType.File:
                    yield pa.RecordBatch.from_pylist([{**row, "folder": False, "size": info.size}] if not rest else [], schema)
                if info.type != fs.FileType.Directory:
                    continue
                first, more = (re.compile(rest[0]), rest[1:]) if rest else (None, [])
                out = []
                for name, folder, size in _entries(system, own):
                    hidden = name.startswith((".", "_")) and "=" not in name
                    wanted = first.fullmatch(name) and (folder or not more) if first else not folder or "=" in name
                    if wanted and not hidden:
                        out.append({"system": row["system"], "path": f"{own.rstrip('/')}/{name}", "rest": more, "folder": folder, "size": size})
                    if len(out) == 10_000:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out = []
                yield pa.RecordBatch.from_pylist(out, schema)

    tops = _split(spark, path)
    if not any(rest or _exists(spark, f"{system}{own.lstrip('/')}") for system, own, rest in tops):
        raise AnalysisException(f"no such path: {path}")
    level, found = spark.createDataFrame([(*t, True, 0) for t in tops], _LISTED), None
    while (n := level.count()) > 0:
        own = store(level.repartition(min(n, 2 * spark.sparkContext.defaultParallelism)).mapInArrow(look, _LISTED), "listed")
        found = own if found is None else found.unionByName(own)
        level = own.where("folder")
    if all(rest for _, _, rest in tops) and found.isEmpty():
        raise AnalysisException(f"no such path: {path}")
    return found.where("NOT folder").select("system", "path", "size")


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files of no bytes, for a look at a few files; no reader needs it."""
    return [r["path"] for r in list_files(spark, path).where("size = 0").collect()]


#: Tasks at most of one job over files, bytes of files that a task reads, and bytes that opening a file counts as.
MOST_TASKS, TASK_BYTES, OPEN_BYTES = 20_000, 64 << 20, 16 << 10


def _whole(spark: SparkSession, path: str, ending: str = "") -> DataFrame:
    """(value, file_name, file_size) of each file whose name has the ending, also of those of no bytes. Tasks list the files and open them, however many there are."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, systems = pa.schema([("value", pa.binary()), ("file_name", pa.string()), ("file_size", pa.int64())]), {}
        for batch in batches:
            out, held = [], 0
            for row in batch.to_pylist():
                system = systems.setdefault(row["system"], None) or fs.FileSystem.from_uri(row["system"])[0]
                systems[row["system"]] = system
                with system.open_input_stream(row["path"]) as f:  # decompressed by the name's ending
                    out.append({"value": f.read(), "file_name": row["path"].rsplit("/", 1)[-1], "file_size": row["size"]})
                held += len(out[-1]["value"]) + 200
                if held > 4 << 20:
                    yield pa.RecordBatch.from_pylist(out, kinds)
                    out, held = [], 0
            yield pa.RecordBatch.from_pylist(out, kinds)

    files = list_files(spark, path).where(F.endswith("path", F.lit(ending)))
    count, size = files.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    n = max(min(count, spark.sparkContext.defaultParallelism), -(-(size + count * OPEN_BYTES) // TASK_BYTES), 1)
    rows = files.repartition(min(n, MOST_TASKS), "path").mapInArrow(read, "value binary, file_name string, file_size long")
    return rows.withColumn("value", F.col("value").cast("string"))  # the bytes as they are


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """Contigs of multi-FASTA assemblies, in order; text before the first header is contig 0 with a null header, as is the one row of a file without any text."""
    split = F.split("value", r"(?:^|\r?\n)>")
    parts = _whole(spark, path).select("file_name", "file_size", F.size(split).alias("parts"), F.posexplode(split).alias("contig_ord", "body"))
    body = F.when(F.col("contig_ord") > 0, F.regexp_replace("body", r"^[^\r\n]*", "")).otherwise(F.col("body"))
    rows = parts.select(
        F.regexp_replace("file_name", r"\.[^.]*$", "").alias("genome_id"),
        "file_name",
        "file_size",
        "contig_ord",
        F.when(F.col("contig_ord") > 0, F.regexp_extract("body", r"^\s*(\S*)", 1)).alias("contig_id"),
        F.when(F.col("contig_ord") > 0, F.trim(F.regexp_extract("body", r"^([^\r\n]*)", 1))).alias("header"),
        F.regexp_replace(body, r"\s+", "").alias("seq"),
        "parts",
    )
    return rows.where("contig_ord > 0 OR seq <> '' OR parts = 1").drop("parts").withColumn("seq_len", F.length("seq").cast("long"))


def read_long_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, header, seq) of very large multi-FASTA files, split within a file; text before the first header is read as a record."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_name").alias("file_name"), F.regexp_replace("value", "^>", "").alias("value"))
    return rows.select("file_name", F.regexp_extract("value", r"^([^\r\n]*)", 1).alias("header"),
        F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", "").alias("seq"))


def read_sequences(spark: SparkSession, path: str, ending: str = "") -> DataFrame:
    """One sequence for each file: one FASTA record, or raw text. ``error`` is set for files of no bytes or of white space only, and for several records."""
    text = F.col("value")
    fasta = F.ltrim(text).startswith(">")
    seq = F.upper(F.regexp_replace(F.when(fasta, F.regexp_replace(text, r"^\s*>[^\r\n]*", "")).otherwise(text), r"\s+", ""))
    several = fasta & text.rlike(r"(?s)\n>.*")
    return _whole(spark, path, ending).select(
        "file_name",
        F.regexp_replace("file_name", r"\.[^.]*$", "").alias("name"),
        F.when(~several & (seq != ""), seq).alias("seq"),
        F.when(several, "more than one record").when(seq == "", "empty").when(seq.rlike(f"[^{RESIDUES}BZX*]"), "non-standard letters").alias("error"),
    )


def read_proteins(spark: SparkSession, path: str) -> DataFrame:
    """(accession, gene, seq) of ACCESSION_Gene.faa files; names without an underscore and unreadable files are left out."""
    cut = lambda k: F.regexp_extract("name", "^(.*)_([^_]*)$", k)
    return read_sequences(spark, path).where(F.contains("name", F.lit("_")) & F.col("seq").isNotNull()).select(cut(1).alias("accession"), cut(2).alias("gene"), "seq")


def read_references(spark: SparkSession, path: str) -> DataFrame:
    """(gene, seq) of Gene_WT.faa files below a directory."""
    return read_sequences(spark, path, "_WT.faa").where("seq IS NOT NULL").select(F.regexp_replace("name", "_WT$", "").alias("gene"), "seq")


def read_gene_list(spark: SparkSession, path: str, comments: bool = True, lower: bool = True) -> DataFrame:
    """Target genes, one a line; blank lines and, with ``comments``, lines that start with # are left out."""
    gene = F.regexp_replace("value", r"^\s+|\s+$", "")
    rows = spark.read.text(path).select(gene.alias("gene")).where("gene <> ''")
    rows = rows.where(~F.col("gene").startswith("#")) if comments else rows
    return rows.select(F.lower("gene").alias("gene")) if lower else rows


def _json_or_empty(spark: SparkSession, path: str, kind: str) -> DataFrame:
    try:
        return _whole(spark, path).select(F.from_json("value", kind).alias("m"))
    except AnalysisException:  # no such file
        return spark.createDataFrame([], f"m {kind}")


def read_resistance_db(spark: SparkSession, path: str) -> DataFrame:
    """(gene, mutation, phenotype, pdb, ord) of a JSON of known mutations; empty if it is missing or invalid."""
    rows = _json_or_empty(spark, path, "map<string,array<struct<mutation:string,phenotype:string,pdb:string>>>").select(F.explode("m").alias("gene", "entries"))
    return rows.select("gene", F.posexplode("entries").alias("ord", "e")).select("gene", "e.mutation", "e.phenotype", "e.pdb", "ord")


def read_drug_map(spark: SparkSession, path: str) -> DataFrame:
    """(gene, drug), genes in lower case; keys that start with an underscore are comments."""
    rows = _json_or_empty(spark, path, "map<string,string>").select(F.explode("m").alias("gene", "drug"))
    return rows.where(~F.col("gene").startswith("_")).select(F.lower("gene").alias("gene"), "drug")


def read_abricate(spark: SparkSession, path: str) -> DataFrame:
    """Standard hits of ABRicate tables."""
    rows = spark.read.csv(path, sep="\t", header=True)
    rows = rows.withColumnsRenamed({c: c.lstrip("#") for c in rows.columns})
    return rows.select(
        F.col("GENE").alias("Gene"), F.col("SEQUENCE").alias("Contig"), F.expr("try_cast(START AS long)").alias("Start"), F.expr("try_cast(END AS long)").alias("End"),
        F.col("STRAND").alias("Strand"), F.expr("try_cast(`%IDENTITY` AS double)").alias("Identity"), F.lit("abricate").alias("Source"),
    )


def read_blast(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schemas.BLAST10, comment="#")


def read_tblastn(spark: SparkSession, path: str) -> DataFrame:
    """Rows with all 13 columns."""
    return spark.read.csv(path, sep="\t", schema=schemas.TBLASTN13).where("sseq IS NOT NULL")


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df``, or an error that names the columns it lacks."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def _named(df: DataFrame, schema: str) -> list[Column]:
    """The columns of ``schema`` found by their names, null where they are missing or cells aren't of their type."""
    kinds = StructType.fromDDL(schema)
    cols = [F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})") if f.name in df.columns else F.lit(None).cast(f.dataType) for f in kinds]
    return [c.alias(f.name) for c, f in zip(cols, kinds, strict=True)]


def _by_name(spark: SparkSession, path: str, schema: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV with a header as ``schema``: columns are found by their names, missing ones are null, further ones left out.

    Cells that aren't of their column's type are null. An empty file is an empty table; a header without a required column is an error.
    """
    df = spark.read.csv(path, header=True)
    if df.columns:
        require_columns(df, *required)
    return df.select(*_named(df, schema))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return _by_name(spark, path, schemas.REPORT, ("Accession", "Gene", "Mutation"))


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    return _by_name(spark, path, schemas.EDGES)


def _exists(spark: SparkSession, path: str) -> bool:
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).exists(own)


def by_header(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """CSV files with headers, a scan for each *different* header line whatever the number of files: all columns as text, and __k, the number of the file's path.

    ``paths`` are files or directories of files; the driver holds their names and header lines. A header stands in one line.
    """
    if not paths:
        return []
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "n").alias("head")).collect()
    bare = lambda p: re.sub("^[a-z0-9]+:/+", "/", p.rstrip("/"))
    order = {bare(p): k for k, p in enumerate(paths)}
    groups: dict[str, list[tuple[str, int]]] = {}
    for r in first:
        own = bare(unquote(r["file"]))
        groups.setdefault(r["head"].rstrip("\r"), []).append((r["file"], order[own] if own in order else order[own.rsplit("/", 1)[0]]))
    out = []
    for _, files in sorted(groups.items()):
        numbers = spark.createDataFrame(files, "__file string, __k int")  # a row a file, as in Spark's own listing
        df = spark.read.csv([unquote(f) for f, _ in files], header=True)
        out.append(df.withColumn("__file", F.col("_metadata.file_path")).join(F.broadcast(numbers), "__file").drop("__file"))
    return out


def read_isolates(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The kept columns of isolate tables with differing headers, missing ones empty, with the order of files and rows."""

    def kept(df: DataFrame) -> DataFrame:
        cols = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in schemas.ISOLATE_COLUMNS]
        return df.select(*cols, F.col("__k").alias("src_ord"), F.monotonically_increasing_id().alias("row_ord"))

    none = ", ".join(f"`{c}` string" for c in schemas.ISOLATE_COLUMNS)
    return reduce(DataFrame.unionByName, map(kept, by_header(spark, paths)), spark.createDataFrame([], f"{none}, src_ord int, row_ord long"))


def _field(start: int, size: int) -> Column:
    return F.trim(F.substring("value", start, size))


def read_atoms(spark: SparkSession, path: str) -> DataFrame:
    """Atoms of fixed-width structure files, in line order."""
    rows = _whole(spark, path).select(F.regexp_replace("file_name", r"\.[^.]*$", "").alias("structure"), F.posexplode(F.split("value", "\r?\n")).alias("line_ord", "value"))
    number = lambda a: F.expr(f"try_cast(trim(substring(value, {a}, 8)) AS double)")
    atoms = rows.select(
        "structure", _field(1, 6).alias("record"), _field(13, 4).alias("atom"), F.upper(_field(18, 3)).alias("resname"), _field(22, 1).alias("chain"),
            _field(23, 4).alias("resseq"),
        number(31).alias("x"), number(39).alias("y"), number(47).alias("z"), F.upper(_field(77, 2)).alias("element"), F.col("line_ord").cast("long").alias("line_ord"),
    )
    return atoms.where("record IN ('ATOM', 'HETATM') AND x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")


def read_docking_logs(spark: SparkSession, path: str) -> DataFrame:
    """(name, affinity): the first line whose first word is 1 and whose second is a number."""
    rows = _whole(spark, path).select(F.regexp_replace("file_name", r"\.[^.]*$", "").alias("name"), F.posexplode(F.split("value", "\n")).alias("ord", "line"))
    words = F.split(F.trim("line"), r"\s+")
    found = rows.select("name", "ord", F.when(words[0] == "1", F.get(words, F.lit(1))).alias("w")).withColumn("affinity", F.expr("try_cast(w AS double)"))
    return found.groupBy("name").agg(F.min_by("affinity", F.when(F.col("affinity").isNotNull(), F.col("ord"))).alias("affinity"))


def read_runs(spark: SparkSession, runs: dict[str, str], schema: str, defaults: dict[str, str] | None = None) -> DataFrame:
    """The tables of many runs with a run column, columns by their names; missing files count as empty, null cells get their default."""
    names = [n for n, p in runs.items() if _exists(spark, p)]
    of = spark.createDataFrame(list(enumerate(names)), "__k int, run string")
    found = [df.select("__k", *_named(df, schema)) for df in by_header(spark, [runs[n] for n in names])]
    none = spark.createDataFrame([], f"__k int, {schema}")
    out = reduce(DataFrame.unionByName, found, none).join(F.broadcast(of), "__k").select(*StructType.fromDDL(schema).names, "run")  # a row a run
    return out.na.fill(defaults or {})
