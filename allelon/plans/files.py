"""Queries over files: tables derived from the driver's are written in the reference formats and read back. Each stands beside its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from allelon import schemas
from allelon.functions.sequence import codons, translate_dna
from allelon.operators import assembly, hits, structures
from allelon.plans import derived as X
from allelon.plans import queries as Q
from allelon.plans import sql as S
from allelon.sources import readers, writers
from allelon.storage import new_path, store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return register


def _files(df: DataFrame, name: str, text: str, folder: str) -> str:
    """The folder of a file for each row of ``df``."""
    path = new_path(df.sparkSession, folder)
    writers.write_files(df.selectExpr(f"{name} AS name", f"{text} AS text"), path)
    return path


def _spread(df: DataFrame, *columns: str) -> DataFrame:
    """Rows of a few columns over all cores: a small table is one task's, but may name very many files."""
    return df.select(*columns).repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def _contigs(spark: SparkSession, sf: str) -> DataFrame:
    """Contigs over all cores, whatever the documents' row groups: deriving them and writing a file for each is the most of a query's work."""
    return X.contigs(spark, sf, 8 * spark.sparkContext.defaultParallelism)


def _table(df: DataFrame, folder: str, **options) -> str:
    path = new_path(df.sparkSession, folder)
    df.write.csv(path, **options)
    return path


# Sequences


@query(
    f"""WITH {S.CONTIGS}, c AS (SELECT doc_id, seq, length(seq) // 2 AS h FROM contigs)
SELECT 'd' || doc_id AS genome_id, cast(1 AS int) AS contig_ord, 'a' || doc_id AS contig_id, 'a' || doc_id || ' first' AS header, h AS seq_len,
    sha256(substr(seq, 1, h)) AS digest FROM c
UNION ALL SELECT 'd' || doc_id, 2, 'b' || doc_id, 'b' || doc_id, length(seq) - h, sha256(substr(seq, h + 1)) FROM c
UNION ALL SELECT 'd' || doc_id, 0, NULL, NULL, 4, sha256('ACGT') FROM c WHERE doc_id % 5 = 0"""
)
def fasta_files(spark, sf):
    """An assembly file of two contigs for each document, some with text before the first header."""
    rows = _contigs(spark, sf).selectExpr("contig_id AS id", "contig_ord", "seq", "length(seq) div 2 AS h")
    text = """concat(CASE WHEN contig_ord % 5 = 0 THEN 'ACGT\\n' ELSE '' END, '>a', id, ' first\\n', substring(seq, 1, h), '\\n>b', id, '\\r\\n',
        substring(seq, h + 1, 10), '\\r\\n', substring(seq, h + 11, 2147483647), '\\n')"""
    found = readers.read_contigs(spark, _files(rows, "concat('d', id, '.fna')", text, "fasta"))
    return found.select("genome_id", "contig_ord", "contig_id", "header", "seq_len", F.sha2("seq", 256).alias("digest"))


def _sequence_files(spark, sf) -> str:
    """A protein file for each document: FASTA, plain text in lower case, two records, nothing (no bytes, or white space), or a name without a gene."""
    rows = _contigs(spark, sf).select("contig_id", "contig_ord", (F.col("contig_ord") % 6).alias("k"), F.translate(translate_dna(F.col("seq")), "X*", "GQ").alias("p"))
    text = """CASE k WHEN 1 THEN concat(' ', lower(substring(p, 1, 7)), '\\n ', lower(substring(p, 8, 2147483647))) WHEN 2 THEN concat('>a\\n', p,
    '\\n>b\\nMK\\n') WHEN 3 THEN CASE WHEN contig_ord % 12 = 3 THEN '' ELSE ' \n' END
        ELSE concat('>x y\\n', substring(p, 1, 60), '\\n', substring(p, 61, 2147483647), '\\n') END"""
    return _files(rows, "CASE k WHEN 4 THEN concat('plain', contig_id, '.faa') WHEN 5 THEN concat('A_', contig_id, '_tolC.faa') ELSE concat('A_', contig_id, '_acrA.faa') END", text, "proteins")


_PROTEINS = f"""{S.CONTIGS}, code AS (SELECT {S._map(codons())} AS m), p AS (SELECT doc_id, doc_id % 6 AS k, translate({S._protein('seq', 'm')},
    'X*', 'GQ') AS p FROM contigs CROSS JOIN code)"""


#: Thresholds for files of one contig.
FILE_LIMITS = {"min_bp": 300, "max_bp": 20_000, "low_n50": 400, "moderate_n50": 1_000, "moderate_n_fraction": 0.005, "high_n_fraction": 0.02, "ready_min_n50": 500, "ready_max_n_fraction": 0.01}
_L = FILE_LIMITS


@query(
    f"""WITH {S.CONTIGS}, f AS (SELECT doc_id, CASE WHEN doc_id % 9 = 4 THEN '' ELSE seq END AS seq FROM contigs),
c AS (SELECT doc_id, length(seq) AS bp, CASE WHEN seq = '' THEN 1.0 ELSE (length(seq) - length(replace(seq, 'N', ''))) / length(seq) END AS n FROM f)
SELECT 'd' || doc_id AS genome_id, bp AS total_bp, cast(bp > 0 AS bigint) AS contigs, bp AS n50, round(n, 6) AS n_fraction,
    CASE WHEN bp < {_L['min_bp']} OR bp < {_L['low_n50']} OR n > {_L['high_n_fraction']} THEN 'poor' WHEN bp > {_L['max_bp']} OR bp < {_L['moderate_n50']} OR n > {_L['moderate_n_fraction']} THEN 'moderate' ELSE 'good' END AS quality,
    cast(bp BETWEEN {_L['min_bp']} AND {_L['max_bp']} AND bp >= {_L['ready_min_n50']} AND n <= {_L['ready_max_n_fraction']} AS int) AS extraction_ready,
    cast(CASE WHEN doc_id % 9 = 4 THEN 0 ELSE bp + 4 END AS bigint) AS file_size FROM c"""
)
def assembly_files(spark, sf):
    """Quality of an assembly file for each document, of which every ninth has no bytes; with the files' sizes."""
    text = "CASE WHEN contig_ord % 9 = 4 THEN '' ELSE concat('>c\\n', seq, '\\n') END"
    own = store(readers.read_contigs(spark, _files(_contigs(spark, sf), "concat('d', contig_id, '.fna')", text, "assemblies")), "read-contigs")
    qc = assembly.assembly_qc(own, **FILE_LIMITS).drop("file_name", "flags")
    return qc.join(assembly.genome_metadata(own).select("genome_id", "file_size"), "genome_id")


@query(f"WITH {_PROTEINS} SELECT 'A_' || doc_id AS accession, CASE k WHEN 5 THEN 'tolC' ELSE 'acrA' END AS gene, length(p) AS residues, sha256(p) AS digest FROM p WHERE k IN (0, 1, 5) AND p <> ''")
def protein_files(spark, sf):
    found = readers.read_proteins(spark, _sequence_files(spark, sf))
    return found.select("accession", "gene", F.length("seq").cast("long").alias("residues"), F.sha2("seq", 256).alias("digest"))


@query(
    f"""WITH {_PROTEINS} SELECT CASE k WHEN 4 THEN 'plain' || doc_id WHEN 5 THEN 'A_' || doc_id || '_tolC' ELSE 'A_' || doc_id || '_acrA' END AS name,
CASE WHEN k = 2 THEN 'more than one record' WHEN k = 3 OR p = '' THEN 'empty' END AS error, CASE WHEN k NOT IN (2, 3) AND p <> ''
    THEN length(p) END AS residues FROM p"""
)
def sequence_files(spark, sf):
    return readers.read_sequences(spark, _sequence_files(spark, sf)).select("name", "error", F.length("seq").cast("long").alias("residues"))


@query(f"WITH {S.CONTIGS}, {S.PLANTED} SELECT gene, sha256(ref) AS digest FROM items WHERE ref <> ''")
def reference_files(spark, sf):
    """Wild-type references among other files."""
    refs = X.protein_references(spark, sf).selectExpr("gene", "ref", "explode(array('_WT', '_other')) AS kind")
    path = _files(refs, "concat(gene, kind, '.faa')", "concat('>', gene, '\\n', ref, '\\n')", "references")
    return readers.read_references(spark, path).select("gene", F.sha2("seq", 256).alias("digest"))


@query(
    f"""WITH {S.CONTIGS}, {S.GENE_HITS}
SELECT "Gene" || '|' || Accession || '|' || Contig || '|' || s || '-' || e AS header, sha256(dna) AS digest FROM ex WHERE dna IS NOT NULL"""
)
def fasta_sink(spark, sf):
    """Extracted sequences, written by genome and read in splits."""
    path = new_path(spark, "extracted")
    writers.write_fasta(Q._extracted(spark, sf), path, writers.fasta_header(), "dna")
    return readers.read_long_fasta(spark, path).select("header", F.sha2("seq", 256).alias("digest"))


# Lists and maps


@query("SELECT lower(CASE p_partkey % 4 WHEN 0 THEN p_brand || '_' || p_partkey ELSE p_name END) AS gene FROM part WHERE p_partkey % 4 IN (0, 3)")
def gene_lists(spark, sf):
    line = "CASE p_partkey % 4 WHEN 0 THEN concat('  ', p_brand, '_', cast(p_partkey AS string), ' ') WHEN 1 THEN '# note' WHEN 2 THEN '   ' ELSE p_name END AS value"
    path = new_path(spark, "targets")
    X.table(spark, sf, "part").selectExpr(line).write.text(path)
    return readers.read_gene_list(spark, path)


@query(
    """WITH p AS (SELECT p_partkey AS k, 'g' || p_partkey % 7 AS gene FROM part WHERE p_partkey % 50 <> 0)
SELECT gene, 'A' || k || 'V' AS mutation, 'Efflux' AS phenotype, '1ABC' AS pdb, cast(0 AS int) AS ord FROM p UNION ALL SELECT gene, 'S' || k || 'L',
    NULL, NULL, 1 FROM p"""
)
def resistance_files(spark, sf):
    """Known mutations in a file for each part, of which some aren't JSON."""
    text = """CASE WHEN p_partkey % 50 = 0 THEN '{' ELSE concat('{"g', cast(p_partkey % 7 AS string), '": [{"mutation": "A', cast(p_partkey AS string),
        'V", "phenotype": "Efflux", "pdb": "1ABC"}, {"mutation": "S', cast(p_partkey AS string), 'L", "phenotype": null}]}') END"""
    return readers.read_resistance_db(spark, _files(_spread(X.table(spark, sf, "part"), "p_partkey"), "concat('p', cast(p_partkey AS string), '.json')", text, "resistance"))


@query("SELECT 'gene' || s_suppkey AS gene, 'drug' || s_suppkey % 3 AS drug FROM supplier")
def drug_files(spark, sf):
    text = """concat('{"_note": "x", "GENE', cast(s_suppkey AS string), '": "drug', cast(s_suppkey % 3 AS string), '"}')"""
    return readers.read_drug_map(spark, _files(_spread(X.table(spark, sf, "supplier"), "s_suppkey"), "concat(cast(s_suppkey AS string), '.json')", text, "drugs"))


# Hits


@query(
    f"""{S.HITS} SELECT sseqid AS "Gene", qseqid AS "Contig", CASE WHEN evalue <> 3 / 1000 THEN a END AS "Start", b AS "End", CASE
    WHEN sstrand = 'minus' THEN '-' ELSE '+' END AS "Strand", pident AS "Identity", 'abricate' AS "Source" FROM h"""
)
def abricate_files(spark, sf):
    rows = X.blast_hits(spark, sf).selectExpr(
        "'x.fna' AS `#FILE`", "qseqid AS SEQUENCE", "CASE WHEN l_linenumber = 3 THEN 'none' ELSE cast(least(qstart, qend) AS string) END AS START", "greatest(qstart, qend) AS END",
        "CASE sstrand WHEN 'minus' THEN '-' ELSE '+' END AS STRAND", "sseqid AS GENE", "pident AS `%IDENTITY`",
    )
    return readers.read_abricate(spark, _table(rows, "abricate", sep="\t", header=True))


@query(f"{S.HITS} SELECT * FROM std WHERE \"Contig\" NOT LIKE '%5'")
def blast_files(spark, sf):
    """Tabular hits among comment lines."""
    rows = X.blast_hits(spark, sf).selectExpr(
        "CASE WHEN qseqid LIKE '%5' THEN concat('# ', qseqid) ELSE qseqid END AS qseqid", "sseqid", "pident", "length", "qstart", "qend", "sstart", "send", "sstrand", "slen"
    )
    path = new_path(spark, "blast")
    rows.select(F.concat_ws("\t", *(F.col(c).cast("string") for c in rows.columns)).alias("value")).write.text(path)
    return hits.standardize_hits(readers.read_blast(spark, path))


@query(
    f"""{S.HITS}, t AS (SELECT *, CASE WHEN l_partkey % 9 = 0 THEN '---' ELSE 'M-' || substr('{X.RES}', l_partkey % 16 + 1, 5) || '-' END AS sseq
    FROM h WHERE evalue <> 2 / 1000)
SELECT qseqid, sseqid, bitscore, nullif(replace(sseq, '-', ''), '') AS seq FROM t QUALIFY row_number() OVER (PARTITION BY qseqid
    ORDER BY bitscore DESC, evalue, sseqid, l_partkey) = 1"""
)
def tblastn_files(spark, sf):
    """The best hit of each contig; rows without the last column are no hits."""
    sseq = f"CASE WHEN l_linenumber = 2 THEN NULL WHEN l_partkey % 9 = 0 THEN '---' ELSE concat('M-', substr('{X.RES}', cast(l_partkey % 16 + 1 AS int), 5), '-') END AS sseq"
    rows = X.blast_hits(spark, sf).selectExpr("qseqid", "sseqid", "pident", "length", "1 AS mismatch", "0 AS gapopen", "qstart", "qend",
        "l_partkey AS sstart", "send", "evalue", "bitscore", sseq)
    return hits.proteins_from_hits(readers.read_tblastn(spark, _table(rows, "tblastn", sep="\t")), ["qseqid"]).select("qseqid", "sseqid", "bitscore", "seq")


# Tables


@query(f"{S.REPORTED} SELECT * FROM found")
def report_files(spark, sf):
    """A report whose columns stand in another order, with one more."""
    path = new_path(spark, "report")
    writers.write_csv(Q.interpret_mutations(spark, sf).select("Status", "Mutation", F.lit("x").alias("note"), "Accession", "prediction_score", "Gene",
        "Phenotype", "prediction_source", "Reference_PDB"), path)
    return readers.read_report(spark, path)


def _edge_file(spark, sf) -> str:
    path = new_path(spark, "edges")
    writers.write_csv(Q.epistasis_edges(spark, sf).select("Frequency", "Node_2", "Node_1", "Composite_Network_Score", "Avg_Biochemical_Severity"), path)
    return path


@query(f"{S.EDGES} SELECT Node_1, Node_2, Frequency, avg_s AS Avg_Biochemical_Severity, Frequency * avg_s AS Composite_Network_Score, cast(NULL AS varchar) AS Node_1_Gene FROM edges")
def edge_files(spark, sf):
    """Edges in another order of columns, without the optional ones."""
    return readers.read_edges(spark, _edge_file(spark, sf)).select("Node_1", "Node_2", "Frequency", "Avg_Biochemical_Severity", "Composite_Network_Score", "Node_1_Gene")


_TRIAGE = S.ORACLE_SQL["triage_counts"].removeprefix(S.DOCK)


@query(
    f"""{S.FREQ}, {S.DOCK.removeprefix('WITH ')}, t AS ({_TRIAGE})
SELECT 'node' AS kind, mutation AS name, '' AS other, cast(frequency AS double) AS value FROM freq
UNION ALL SELECT 'edge', least(Node_1, Node_2), greatest(Node_1, Node_2), greatest(max(Frequency * avg_s), 0) FROM edges GROUP BY ALL
UNION ALL SELECT 'mutation', mutation, gene_class, frequency FROM (SELECT * FROM freq ORDER BY frequency DESC, mutation LIMIT 15)
UNION ALL SELECT 'triage', run, category, networks FROM t"""
)
def run_summary(spark, sf):
    """The tables of a summary over runs, each run's docking table in a file of its own, one run without a file."""
    docking, runs = Q._docking(spark, sf), {"none": new_path(spark, "missing")}
    for k in range(4):  # the derivation has four runs
        runs[f"run{k}"] = new_path(spark, f"docking{k}")
        writers.write_csv(docking.where(f"run = 'run{k}'").select("status", "interpretation", "delta_delta_g", "mutation_network"), runs[f"run{k}"])
    edges = readers.read_runs(spark, {"all": _edge_file(spark, sf)}, schemas.EDGES)
    found = structures.run_summary(edges, readers.read_runs(spark, runs, schemas.DOCKING, {"status": ""}))
    columns = {"nodes": ("node", "node", F.lit(""), "weight"), "edges": ("edge", "node_a", F.col("node_b"), "weight"),
        "top_mutations": ("mutation", "mutation", F.col("gene_class"), "frequency"), "triage": ("triage", "run", F.col("category"), "networks")}
    rows = [found[t].select(F.lit(kind).alias("kind"), F.col(name).alias("name"), other.alias("other"),
        F.col(value).cast("double").alias("value")) for t, (kind, name, other, value) in columns.items()]
    return reduce(DataFrame.unionByName, rows)


@query(
    f"""WITH {S.ISOLATES} SELECT gid AS genome_id, CASE src WHEN 0 THEN loc ELSE '' END AS geographic_location, CASE src WHEN 0 THEN ''
    ELSE 'sepsis' END AS disease, '' AS "Antibiotic", cast(src AS int) AS src_ord FROM iso"""
)
def isolate_files(spark, sf):
    """Isolate tables with differing headers."""
    rows, paths = X.isolates(spark, sf), [new_path(spark, "isolates") for _ in range(2)]
    writers.write_csv(rows.where("src_ord = 0").select("geographic_location", F.lit("x").alias("note"), "Genome ID"), paths[0])
    writers.write_csv(rows.where("src_ord = 1").select("Genome ID", F.lit("sepsis").alias("disease")), paths[1])
    return readers.read_isolates(spark, paths).select(F.col("Genome ID").alias("genome_id"), "geographic_location", "disease", "Antibiotic", "src_ord")


# Structures


@query(
    """WITH k AS (SELECT vec_id, embedding, unnest(range(21)) AS k FROM embeddings)
SELECT 'v' || vec_id AS structure, k + 1 AS line_ord, ['ALA', 'SER', 'GLY'][k % 3 + 1] AS resname, CASE WHEN k < 10 THEN 'A' ELSE 'B' END AS chain,
    cast(k + 1 AS varchar) AS resseq, 'C' AS element,
  floor(cast(embedding[3 * k + 1] AS double) * 60000) / 1000 AS x, floor(cast(embedding[3 * k + 2] AS double) * 60000) / 1000 AS y,
    floor(cast(embedding[3 * k + 3] AS double) * 60000) / 1000 AS z FROM k"""
)
def atom_files(spark, sf):
    """A structure file for each vector, an atom for each three components."""
    part = lambda k, i: F.floor(F.element_at("embedding", 3 * k + i).cast("double") * 60000) / 1000
    name = lambda k: F.element_at(F.array(*map(F.lit, ("ALA", "SER", "GLY"))), k % 3 + 1)
    line = lambda k: F.format_string(
        "ATOM  %5d  CA  %s %s%4d    %8.3f%8.3f%8.3f%22s%2s", k, name(k), F.when(k < 10, "A").otherwise("B"), k + 1, part(k, 1), part(k, 2), part(k, 3), F.lit(""), F.lit("C")
    )
    rows = X.table(spark, sf, "embeddings").select("vec_id", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(20)), line), "\n").alias("lines"))
    found = readers.read_atoms(spark, _files(rows, "concat('v', cast(vec_id AS string), '.pdb')", "concat('HEADER\\n', lines, '\\nEND\\n')", "structures"))
    return found.select("structure", "line_ord", "resname", "chain", "resseq", "element", "x", "y", "z")


@query(f"{S.DOCK} SELECT 'u' || user_id AS name, CASE WHEN user_id % 5 <> 0 THEN wt END AS affinity FROM af")
def docking_logs(spark, sf):
    """A log for each user, some without a result line."""
    text = "concat('mode | affinity\\n 1 none\\n', CASE WHEN user_id % 5 = 0 THEN '' ELSE concat('   1   ', cast(wt_affinity AS string), '  0.0\\n   1 -99\\n') END, '   2  -1.5\\n')"
    return readers.read_docking_logs(spark, _files(_spread(X.affinities(spark, sf), "user_id", "wt_affinity"), "concat('u', cast(user_id AS string), '.log')", text, "logs"))


# Genomes


@query(S.ORACLE_SQL["ready_subset"])
def ready_files(spark, sf):
    path = new_path(spark, "ready")
    writers.write_ready_genomes(X.contigs(spark, sf), Q.assembly_qc(spark, sf), path)
    return spark.read.parquet(path).select("genome_id", "contig_id", "seq_len")


@query(f"{S.QC} SELECT genome_id || chr(9) || quality AS value FROM qc WHERE extraction_ready = 0")
def id_files(spark, sf):
    path = new_path(spark, "ids")
    writers.write_ids(Q.assembly_qc(spark, sf).where("extraction_ready = 0"), path, "genome_id", "quality")
    return spark.read.text(path)
