"""The queries of plans/queries.py in DuckDB's SQL, written from the rules rather than from the Spark code."""

from __future__ import annotations

from allelon.functions.scoring import RESIDUES, blosum, properties, published
from allelon.functions.sequence import codons, complement_letters, wide_codons
from allelon.plans import derived as X

_v = lambda c: c.replace("AS string)", "AS varchar)")
REPORT = f"report AS (SELECT cast(l_orderkey AS varchar) AS acc, {X.GENE} AS gene, {_v(X.CODE)} AS mut, l_linenumber AS ord, l_partkey, l_suppkey FROM lineitem)"
SUBST = f"""props(aa, c, p, v) AS (VALUES {', '.join(f"('{a}', {c}::double, {p}::double, {v}::double)" for a, (c, p, v) in properties().items())}),
bl(a, b, s) AS (VALUES {', '.join(f"('{a}', '{b}', {s})" for (a, b), s in blosum().items())}),
far AS (SELECT x.aa AS wt, y.aa AS mut, bl.s AS blosum, sqrt(1.833 * (x.c - y.c) ** 2 + 0.1018 * (x.p - y.p) ** 2 + 0.000399 * (x.v - y.v) ** 2) AS g
  FROM props x CROSS JOIN props y JOIN bl ON bl.a = x.aa AND bl.b = y.aa),
sev AS (SELECT wt, mut, blosum, g, CASE WHEN wt = mut THEN 0 ELSE 100 * (0.4 * (1 - least(1, greatest(0,
    (blosum + 4) / 15.0::double))) + 0.6 * least(g / 215, 1)) END AS s FROM far),
subst AS (SELECT wt, mut, blosum, g, round(s, 2) AS severity, CASE WHEN s < 30 THEN 'BENIGN' WHEN s < 60 THEN 'UNCERTAIN' ELSE 'PATHOGENIC' END AS category FROM sev
  UNION ALL SELECT aa, '*', -4, 215, 100, 'PATHOGENIC' FROM props)"""


def _parts(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[{RESIDUES}][0-9]+[{RESIDUES}*]') THEN left({c}, 1) END AS wt, CASE WHEN regexp_full_match({c}, '[{RESIDUES}][0-9]+[{RESIDUES}*]') THEN right({c}, 1) END AS m"


TOKENS = f"""{REPORT}, {SUBST},
tok AS (SELECT DISTINCT acc, lower(gene) || ':' || mut AS tok, mut FROM report),
parsed AS (SELECT acc, tok, {_parts('mut')} FROM tok),
scored AS (SELECT acc, tok, coalesce(severity, 1.0) AS score FROM parsed LEFT JOIN subst ON parsed.wt = subst.wt AND parsed.m = subst.mut)"""
EDGES = f"""WITH {TOKENS},
edges AS (SELECT a.tok AS Node_1, b.tok AS Node_2, count(*) AS Frequency, (a.score + b.score) / 2 AS avg_s
  FROM scored a JOIN scored b ON a.acc = b.acc AND a.tok < b.tok GROUP BY a.tok, b.tok, a.score, b.score)"""
ISOLATES = """iso AS (
 SELECT cast(c_custkey AS varchar) AS gid, CASE c_custkey % 4 WHEN 0 THEN n_name || ': site ' || cast(c_custkey % 7 AS varchar) || ' (x)' WHEN 1
    THEN n_name || ': ' WHEN 2 THEN n_name ELSE '' END AS loc, 0 AS src, c_custkey AS ord
 FROM customer JOIN nation ON c_nationkey = n_nationkey
 UNION ALL SELECT cast(c_custkey AS varchar), 'Second: place', 1, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 10 = 0),
bare AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(loc, '^[^:]*:', ''), '\\s*\\([^)]*\\)', '', 'g'), '\\s+', ' ', 'g'), ' ,;-') AS p FROM iso),
clean AS (SELECT gid, src, ord, CASE WHEN p = '' THEN 'Unknown' ELSE p END AS place FROM bare)"""
MERGED = f"""WITH {ISOLATES},
master AS (SELECT gid, place FROM clean QUALIFY row_number() OVER (PARTITION BY gid ORDER BY src, ord) = 1),
rep AS (SELECT cast(o_custkey AS varchar) AS acc, CASE WHEN o_orderkey % 5 < 2 THEN 'marR' WHEN o_orderkey % 5 < 4 THEN 'acrR'
    ELSE 'acrB' END AS gene, 'A' || cast(o_orderkey % 40 AS varchar) || 'V' AS mut FROM orders),
merged AS (SELECT m.gid, m.place, r.gene, r.mut FROM master m JOIN (SELECT DISTINCT * FROM rep WHERE lower(gene) IN ('marr', 'acrr')) r ON m.gid = r.acc),
long AS (SELECT place, mut, count(DISTINCT gid) AS n FROM merged GROUP BY place, mut),
counts AS (SELECT place, gene || ':' || mut AS gm, count(*) AS n FROM merged
  WHERE lower(place) NOT IN ('asia', 'egypt', 'united kingdom', 'uk', 'unknown', 'india') GROUP BY ALL)"""
CONTIGS = """contigs AS (SELECT source AS genome_id, doc_id, cast(doc_id AS varchar) AS contig_id,
  translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTNN') AS seq FROM documents)"""
_q = X.QC_LIMITS
QC = f"""WITH {CONTIGS},
base AS (SELECT genome_id, sum(length(seq)) AS bp, count(*) FILTER (length(seq) > 0) AS contigs, sum(length(seq) - length(replace(seq, 'N',
    ''))) AS ns FROM contigs GROUP BY genome_id),
run AS (SELECT genome_id, length(seq) AS len, sum(length(seq)) OVER (PARTITION BY genome_id ORDER BY length(seq) DESC,
    doc_id ROWS UNBOUNDED PRECEDING) AS r, sum(length(seq)) OVER (PARTITION BY genome_id) AS t FROM contigs WHERE length(seq) > 0),
half AS (SELECT genome_id, max(CASE WHEN r * 2 >= t THEN len END) AS n50 FROM run GROUP BY genome_id),
f AS (SELECT base.genome_id, bp, contigs, coalesce(n50, 0) AS n50, CASE WHEN bp > 0 THEN ns / bp ELSE 1.0 END AS nf FROM base LEFT JOIN half USING (genome_id)),
g AS (SELECT *, concat_ws(';', CASE WHEN bp < {_q['min_bp']} THEN 'small_assembly' END, CASE WHEN bp > {_q['max_bp']} THEN 'large_assembly' END,
   CASE WHEN contigs > {_q['high_fragmentation']} THEN 'high_fragmentation' WHEN contigs > {_q['moderate_fragmentation']} THEN 'moderate_fragmentation' END,
   CASE WHEN n50 < {_q['low_n50']} THEN 'low_n50' WHEN n50 < {_q['moderate_n50']} THEN 'moderate_n50' END,
   CASE WHEN nf > {_q['high_n_fraction']} THEN 'high_ambiguous_bases' WHEN nf > {_q['moderate_n_fraction']} THEN 'moderate_ambiguous_bases' END) AS fl FROM f),
qc AS (SELECT genome_id, genome_id || '.fna' AS file_name, cast(bp AS bigint) AS total_bp, contigs, cast(n50 AS bigint) AS n50, round(nf, 6) AS n_fraction,
   CASE WHEN bp < {_q['min_bp']} OR contigs > {_q['high_fragmentation']} OR n50 < {_q['low_n50']} OR nf > {_q['high_n_fraction']} THEN 'poor'
    WHEN fl <> '' THEN 'moderate' ELSE 'good' END AS quality,
   cast(bp BETWEEN {_q['min_bp']} AND {_q['max_bp']} AND contigs <= {_q['ready_max_contigs']} AND n50 >= {_q['ready_min_n50']}
    AND nf <= {_q['ready_max_n_fraction']} AS int) AS extraction_ready,
   CASE WHEN fl = '' THEN 'none' ELSE fl END AS flags FROM g)"""
_A, _B = complement_letters()
_map = lambda t: "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in t.items()) + "}"


def _protein(c: str, table: str) -> str:
    return f"coalesce(array_to_string(list_transform(range(cast(floor(length({c}) / 3) AS bigint)), lambda i: coalesce({table}[substr({c}, cast(3 * i + 1 AS bigint), 3)], 'X')), ''), '')"


GENE_HITS = """gh AS (SELECT genome_id AS Accession, contig_id AS Contig, CASE k WHEN 0 THEN 'acrA' WHEN 1 THEN 'acrB' ELSE 'tolC' END AS Gene,
    doc_id % 7 + length(seq) * k // 3 AS s, doc_id % 7 + length(seq) * k // 3 + 59 AS e,
   CASE WHEN (doc_id + k) % 2 = 0 THEN '+' ELSE '-' END AS Strand, seq FROM contigs CROSS JOIN (SELECT unnest([0, 1, 2]) AS k)),
cut AS (SELECT *, CASE WHEN s >= 1 THEN nullif(substr(seq, s, e - s + 1), '') END AS c FROM gh)""" + f""",
ex AS (SELECT *, CASE WHEN Strand = '-' THEN reverse(translate(c, '{_A}', '{_B}')) ELSE c END AS dna FROM cut)"""
HITS = f"""WITH h AS (SELECT cast(l_orderkey AS varchar) AS qseqid, {X.GENE} AS sseqid, cast(75 + l_partkey % 25 AS double) AS pident,
    cast(50 + l_quantity AS bigint) AS length,
  l_partkey AS a, cast(l_partkey + l_quantity AS bigint) AS b, CASE WHEN l_linenumber % 2 = 0 THEN 'plus' ELSE 'minus' END AS sstrand,
    l_linenumber / 1000 AS evalue, l_extendedprice AS bitscore, l_partkey FROM lineitem),
std AS (SELECT sseqid AS "Gene", qseqid AS "Contig", least(a, b) AS "Start", greatest(a, b) AS "End", CASE WHEN sstrand = 'minus' THEN '-'
    ELSE '+' END AS "Strand", pident AS "Identity", 'blastn' AS "Source"
  FROM h WHERE pident >= 80 AND length >= 80)"""
_db = ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in X.DB)
_drugs = ", ".join(str(r) for r in X.DRUGS)
KNOWN = f"""db(g, m, phenotype, pdb, ord) AS (VALUES {_db}), db1 AS (SELECT * FROM db QUALIFY row_number() OVER (PARTITION BY g, m
    ORDER BY ord) = 1), drugs(dg, drug) AS (VALUES {_drugs})"""
INTERPRET = """SELECT r.acc AS "Accession", r.gene AS "Gene", r.mut AS "Mutation",
  CASE WHEN db1.g IS NOT NULL THEN 'Resistant' WHEN drug IS NOT NULL THEN drug || ' resistance (VUS)' ELSE 'Variant of Unknown Significance' END AS "Status",
  CASE WHEN db1.g IS NOT NULL THEN coalesce(phenotype, drug || ' resistance', 'Unknown drug resistance') ELSE 'N/A' END AS "Phenotype",
  CASE WHEN db1.g IS NOT NULL THEN coalesce(pdb, 'N/A') ELSE 'N/A' END AS "Reference_PDB", CASE WHEN db1.g IS NOT NULL
    THEN 1.0::double END AS prediction_score, 'Clinical DB' AS prediction_source
FROM r LEFT JOIN db1 ON r.gene = db1.g AND r.mut = db1.m LEFT JOIN drugs ON lower(r.gene) = dg"""
REPORTED = f"WITH {REPORT}, {KNOWN}, r AS (SELECT DISTINCT acc, gene, mut FROM report), found AS ({INTERPRET})"
# Proteins by construction: what was planted is what the best alignment has to give back.
PLANTED = f"""code AS (SELECT {_map(codons())} AS m),
items AS (SELECT item_id, CASE item_id WHEN 0 THEN 'acrA' WHEN 1 THEN 'acrB' WHEN 2 THEN 'tolC' WHEN 3 THEN 'acrR' WHEN 4 THEN 'marR'
    ELSE 'item' || item_id END AS gene, translate({_protein('d', 'm')}, 'X*', 'GQ') AS ref
  FROM (SELECT item_id, translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz',
    'ACGTACGTACGTACGTACGTACGTNN') AS d FROM benchmark) CROSS JOIN code),
own AS (SELECT doc_id, contig_id AS acc, translate({_protein('seq', 'm')}, 'X*', 'GQ') AS own FROM contigs CROSS JOIN code),
pl AS (SELECT doc_id, acc, gene, ref, length(ref) AS l, length(ref) // 6 + 1 AS p1, length(ref) // 3 + 1 AS p2, coalesce(nullif(right(own, 1), ''), 'W') AS a1,
  coalesce(CASE WHEN length(own) > 1 THEN left(right(own, 2), 1) END, 'W') AS a2 FROM own JOIN items ON item_id = doc_id % (SELECT count(*)
    FROM benchmark) WHERE ref <> '' AND doc_id % 11 <> 10),
changes AS (SELECT doc_id, acc, gene, substr(ref, p1, 1) AS w, p1 AS p, a1 AS a FROM pl UNION ALL SELECT doc_id, acc, gene, substr(ref, p2, 1), p2, a2 FROM pl),
r AS (SELECT acc, gene, w || p || a AS mut FROM changes WHERE w <> a)"""


def _atoms(scale: float) -> str:
    part = ", ".join(f"cast(embedding[{i}] AS double) * {scale} AS {c}" for i, c in enumerate("xyz", 1))
    return f"pts AS (SELECT cast(label AS varchar) AS structure, vec_id, vec_id % 2 AS chain, {part}, ['ALA', 'SER', 'GLY'][vec_id % 3 + 1] AS resname FROM embeddings)"


def _clash(scale: float) -> str:
    return f"""WITH {_atoms(scale)},
close AS (SELECT a.structure, count(*) AS n FROM pts a JOIN pts b ON a.structure = b.structure AND a.vec_id < b.vec_id
  AND (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2 < 4 AND NOT (a.chain = b.chain AND abs(a.vec_id - b.vec_id) <= 1) GROUP BY a.structure)
SELECT structure, count(*) AS atoms, cast(least(coalesce(max(n), 0), 21) AS bigint) AS clash_pairs, count(*) >= 2 AND coalesce(max(n),
    0) <= 20 AS qc_pass FROM pts LEFT JOIN close USING (structure) GROUP BY structure"""


DOCK = """WITH ev AS (SELECT user_id, value / 100 AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
af AS (SELECT user_id, max(v) FILTER (k = 1) AS wt, max(v) FILTER (k = 2) AS mt FROM ev GROUP BY user_id),
n AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN 'acrR' ELSE 'acrB' END || ':S' || user_id || 'L' || CASE WHEN user_id % 5 = 0
    THEN ' + tolC:A' || user_id || 'V' ELSE '' END AS net,
  CASE WHEN user_id % 3 = 0 THEN 'skipped_no_target_mutation:acrb' WHEN user_id % 7 = 0 THEN 'FAILED_QC' WHEN wt IS NULL
    THEN 'wildtype_docking_failed' WHEN mt IS NULL THEN 'mutant_docking_failed' ELSE 'ok' END AS status FROM af),
d AS (SELECT *, CASE WHEN status = 'ok' THEN mt - wt END AS ddg FROM n),
doc AS (SELECT *, CASE WHEN abs(ddg) < 0.5 THEN 'NO_SIGNIFICANT_BINDING_CHANGE' WHEN ddg >= 1 THEN 'REDUCED_SUBSTRATE_AFFINITY' WHEN ddg <= -1
    THEN 'INCREASED_SUBSTRATE_AFFINITY' WHEN ddg IS NOT NULL THEN 'MODERATE_BINDING_SHIFT' END AS interp FROM d)"""

_gap = lambda c, k: f"list_transform({c}, lambda x, i: CASE WHEN i % {k} = 0 THEN '-' ELSE x END)"
_three = "MAP {'A': 'ALA', 'R': 'ARG', 'N': 'ASN', 'D': 'ASP', 'C': 'CYS', 'Q': 'GLN', 'E': 'GLU', 'G': 'GLY', 'H': 'HIS', 'I': 'ILE', 'L': 'LEU', 'K': 'LYS', 'M': 'MET', 'F': 'PHE', 'P': 'PRO', 'S': 'SER', 'T': 'THR', 'W': 'TRP', 'Y': 'TYR', 'V': 'VAL'}"

FREQ = f"""{EDGES}, ends AS (SELECT Node_1 AS mutation, Frequency FROM edges UNION ALL SELECT Node_2, Frequency FROM edges),
freq AS (SELECT mutation, split_part(mutation, ':', 1) AS gene, CASE WHEN split_part(mutation, ':', 1) IN ('marr', 'acrr') THEN 'regulatory'
    WHEN split_part(mutation, ':', 1) IN ('acra', 'acrb', 'tolc') THEN 'structural' ELSE 'other' END AS gene_class,
  cast(sum(Frequency) AS bigint) AS frequency FROM ends GROUP BY mutation)"""

ORACLE_SQL: dict[str, str] = {
    "score_mutation_codes": f"""WITH {SUBST}, c AS (SELECT p_partkey, substr('{X.RES}', cast(p_partkey % 20 + 1 AS int),
    1) || cast(p_size AS varchar) || substr('{X.MUT}', cast((p_partkey * 7 + 3) % 22 + 1 AS int), 1) AS mut FROM part),
parsed AS (SELECT p_partkey, mut, {_parts('mut')} FROM c)
SELECT p_partkey, parsed.mut AS "Mutation", blosum AS "BLOSUM", round(g, 4) * (CASE WHEN parsed.wt = parsed.m THEN 0 ELSE 1 END) AS "Grantham",
    severity AS "Severity", coalesce(category, 'ERROR') AS "Category"
FROM parsed LEFT JOIN subst ON parsed.wt = subst.wt AND parsed.m = subst.mut""",
    "network_severity": f"""WITH {REPORT}, {SUBST}, parsed AS (SELECT *, {_parts('mut')} FROM report),
s AS (SELECT parsed.*, cast(round(severity * 100) AS bigint) AS cents, severity FROM parsed LEFT JOIN subst ON parsed.wt = subst.wt AND parsed.m = subst.mut)
SELECT acc AS "Accession", string_agg(mut, '_' ORDER BY ord, l_partkey, l_suppkey) AS network_name, count(cents) AS valid_mutations,
  CASE WHEN count(cents) > 0 THEN floor((2 * sum(cents) + count(cents)) / (2 * count(cents))) / 100 END AS mean_severity,
    max(severity) AS max_severity, CASE WHEN count(cents) = 0 THEN 'No valid mutations' END AS error
FROM s GROUP BY acc""",
    "epistasis_edges": f"""{EDGES} SELECT Node_1, Node_2, split_part(Node_1, ':', 1) AS Node_1_Gene, split_part(Node_2, ':', 1) AS Node_2_Gene,
    split_part(Node_1, ':', 2) AS Node_1_Mutation, split_part(Node_2, ':', 2) AS Node_2_Mutation,
  Frequency, avg_s AS Avg_Biochemical_Severity, Frequency * avg_s AS Composite_Network_Score FROM edges""",
    "top_networks": f"""{EDGES} SELECT cast(row_number() OVER (ORDER BY Frequency * avg_s DESC, Node_1, Node_2) AS int) AS rank, Node_1, Node_2,
    Frequency, avg_s AS Avg_Biochemical_Severity, Frequency * avg_s AS Composite_Network_Score
FROM edges QUALIFY rank <= 5""",
    "crowded_accessions": f"WITH {REPORT} SELECT acc, count(DISTINCT lower(gene) || ':' || mut) AS tokens FROM report GROUP BY acc HAVING tokens > 5",
    "node_weights": f"{EDGES}, ends AS (SELECT Node_1 AS node, Frequency FROM edges UNION ALL SELECT Node_2, Frequency FROM edges) SELECT node, cast(sum(Frequency) AS bigint) AS weight FROM ends GROUP BY node",
    "node_sizes": f"""{EDGES}, ends AS (SELECT Node_1 AS node, Frequency FROM edges UNION ALL SELECT Node_2, Frequency FROM edges),
    w AS (SELECT node, cast(sum(Frequency) AS bigint) AS weight FROM ends GROUP BY node)
SELECT node, weight, round(100 + (weight - min(weight) OVER ()) * 900.0::double / (max(weight) OVER () - min(weight) OVER ()), 6) AS size FROM w""",
    "edge_weights": f"{EDGES} SELECT least(Node_1, Node_2) AS node_a, greatest(Node_1, Node_2) AS node_b, greatest(max(Frequency * avg_s), 0) AS weight FROM edges GROUP BY ALL",
    "mutation_frequency": f"{FREQ} SELECT * FROM freq",
    "mutation_freq_top15": f"{FREQ} SELECT * FROM freq ORDER BY frequency DESC, mutation LIMIT 15",
    "edges_of_gene": f"{EDGES} SELECT Node_1, Node_2, Frequency FROM edges WHERE Node_1 LIKE 'marr:%' OR Node_2 LIKE 'marr:%'",
    "interpret_mutations": f"{REPORTED} SELECT * FROM found",
    "interpret_predicted": f"""WITH {REPORT}, {KNOWN}, r AS (SELECT DISTINCT acc, gene, mut FROM report), seen AS (SELECT DISTINCT mut AS pm,
    (l_partkey % 40) / 40 AS p FROM report WHERE l_partkey % 40 < 20),
x AS (SELECT r.*, db1.g, phenotype, pdb, drug, coalesce(drug, 'Ciprofloxacin') AS asked, CASE WHEN coalesce(drug,
    'Ciprofloxacin') IN ('Ciprofloxacin', 'fluoroquinolones') THEN p END AS p
  FROM r LEFT JOIN db1 ON r.gene = db1.g AND r.mut = db1.m LEFT JOIN drugs ON lower(r.gene) = dg LEFT JOIN seen ON seen.pm = r.mut)
SELECT acc AS "Accession", gene AS "Gene", mut AS "Mutation", CASE WHEN g IS NOT NULL THEN 'Resistant' WHEN p >= 0.25 THEN 'Predicted High Risk'
    WHEN p IS NOT NULL THEN 'Predicted Low Risk' ELSE 'Unknown (ML Parse Failed)' END AS "Status",
  CASE WHEN g IS NOT NULL THEN coalesce(phenotype, drug || ' resistance', 'Unknown drug resistance') WHEN p IS NOT NULL
    THEN 'Predicted ' || asked || ' resistance risk' ELSE asked || ' resistance (Unknown)' END AS "Phenotype",
  CASE WHEN g IS NOT NULL THEN coalesce(pdb, 'N/A') ELSE 'N/A' END AS "Reference_PDB", CASE WHEN g IS NOT NULL THEN 1.0
    ELSE p END AS prediction_score, CASE WHEN g IS NOT NULL THEN 'Clinical DB' ELSE 'AI Model' END AS prediction_source FROM x""",
    "mutation_summary": f"""{REPORTED} SELECT count(*) AS total_mutations, count(*) FILTER ("Status" = 'Resistant') AS resistant_mutations,
    count(*) FILTER ("Status" = 'VUS') AS vus_mutations,
  count(*) FILTER ("Status" LIKE '%(VUS)%' OR "Status" = 'Variant of Unknown Significance') AS unresolved_mutations,
    count(DISTINCT "Gene") AS unique_genes, count(DISTINCT "Accession") AS unique_accessions FROM found""",
    "gene_counts": f'{REPORTED} SELECT "Gene", count(*) AS mutations FROM found GROUP BY "Gene"',
    "call_variants": f'WITH {CONTIGS}, {PLANTED} SELECT acc AS accession, gene, mut AS "Mutation" FROM r',
    "protein_identity": f"""WITH {CONTIGS}, {PLANTED}, n AS (SELECT acc, gene, count(*) AS k FROM r GROUP BY ALL)
SELECT acc AS accession, gene, round(100.0::double * (l - coalesce(k, 0) - CASE WHEN l >= 60 AND doc_id % 3 = 1 THEN 4 ELSE 0 END) / l,
    6) AS identity, cast(coalesce(k, 0) AS int) AS mutations FROM pl LEFT JOIN n USING (acc, gene)""",
    "variant_report": f"""WITH {CONTIGS}, {PLANTED}, drugs(dg, drug) AS (VALUES {_drugs}),
db AS (SELECT gene AS g, substr(ref, p1, 1) || p1 || a1 AS m, CASE WHEN doc_id % 2 = 0 THEN 'Known by ' || acc END AS phenotype, acc AS pdb, doc_id
    FROM pl WHERE doc_id % 7 = 0),
db1 AS (SELECT * FROM db QUALIFY row_number() OVER (PARTITION BY g, m ORDER BY doc_id) = 1) {INTERPRET}""",
    "residue_counter": f"""WITH {CONTIGS}, s AS (SELECT contig_id, string_split(seq, '') AS s FROM contigs WHERE seq <> ''), a AS (SELECT contig_id,
    {_gap('s', 5)} AS x, {_gap('list_reverse(s)', 7)} AS y FROM s),
k AS (SELECT contig_id, unnest(x) AS w, unnest(y) AS m, unnest(range(len(x))) AS i FROM a), p AS (SELECT contig_id, w, m,
    sum(cast(w <> '-' AS int)) OVER (PARTITION BY contig_id ORDER BY i) AS pos FROM k)
SELECT contig_id, w || cast(pos AS varchar) || m AS mutation FROM p WHERE w <> m AND w <> '-' AND m <> '-'""",
    "clean_locations": f"WITH {ISOLATES} SELECT ord AS row_ord, src AS src_ord, place AS location FROM clean",
    "geo_master": f"{MERGED} SELECT gid AS genome_id, place AS geographic_location_clean FROM master",
    "geo_merged": f'{MERGED} SELECT gid AS "Accession", place AS geographic_location_clean, gene AS "Gene", mut AS "Mutation" FROM merged',
    "geo_long": f'{MERGED} SELECT place AS geographic_location_clean, mut AS "Mutation", n AS mutation_frequency FROM long',
    "geo_matrix": f"{MERGED} SELECT place AS geographic_location_clean, " + ", ".join(f"cast(coalesce(sum(n) FILTER (mut = 'A{k}V'), 0) AS bigint) AS \"A{k}V\"" for k in range(40)) + " FROM long GROUP BY place",
    "geo_counts": f'{MERGED} SELECT place AS geographic_location_clean, gm AS "Gene_Mutation", n AS mutation_frequency FROM counts',
    "geo_margins": f'{MERGED} SELECT gm AS "Gene_Mutation", cast(sum(n) AS bigint) AS total FROM counts GROUP BY gm',
    "geo_place_margins": f'{MERGED} SELECT place AS geographic_location_clean, cast(sum(n) AS bigint) AS total FROM counts GROUP BY place',
    "geo_topn": f"""{MERGED} SELECT place AS geographic_location_clean, gm AS "Gene_Mutation", n AS mutation_frequency FROM counts
WHERE place IN (SELECT place FROM counts GROUP BY place ORDER BY sum(n) DESC, place LIMIT 10) AND gm IN (SELECT gm FROM counts GROUP BY gm
    ORDER BY sum(n) DESC, gm LIMIT 10)""",
    "geo_summary": f"{MERGED} SELECT (SELECT count(*) FROM master) AS metadata_rows, (SELECT count(*) FROM rep) AS mutation_rows, count(*) AS merged_rows, count(DISTINCT place) AS unique_locations, count(DISTINCT mut) AS unique_mutations FROM merged",
    "n50_of_orders": """WITH r AS (SELECT l_orderkey, l_quantity AS len, sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC,
    l_linenumber, l_partkey ROWS UNBOUNDED PRECEDING) AS r, sum(l_quantity) OVER (PARTITION BY l_orderkey) AS t FROM lineitem)
SELECT l_orderkey, cast(max(CASE WHEN r >= t / 2 THEN len END) AS bigint) AS n50 FROM r GROUP BY l_orderkey""",
    "assembly_qc": f"{QC} SELECT * FROM qc",
    "qc_levels": f"{QC} SELECT quality, count(*) AS genomes, cast(sum(extraction_ready) AS bigint) AS ready FROM qc GROUP BY quality",
    "contig_histogram": f"{QC} SELECT contigs, count(*) AS genomes FROM qc GROUP BY contigs",
    "ready_subset": f"{QC} SELECT genome_id, contig_id, length(seq) AS seq_len FROM contigs WHERE genome_id IN (SELECT genome_id FROM qc WHERE extraction_ready = 1)",
    "genome_validate": f"""WITH {CONTIGS}, s AS (SELECT genome_id, cast(sum(length(seq)) AS bigint) AS n FROM contigs GROUP BY genome_id)
SELECT genome_id, n AS length, n >= 80000 AS is_valid, CASE WHEN n < 80000 THEN 'Sequence too short: ' || n || 'bp < 80000bp'
    ELSE 'Valid FASTA: ' || n || 'bp' END AS status, n * 100.0::double / 100000 AS coverage FROM s""",
    "genome_metadata": f"WITH {CONTIGS} SELECT genome_id, genome_id || '.fna' AS file_name, count(*) AS records, 'contig ' || min(doc_id) AS first_header FROM contigs GROUP BY genome_id",
    "revcomp": f"WITH {CONTIGS} SELECT contig_id, sha256(reverse(translate(seq, '{_A}', '{_B}'))) AS digest FROM contigs",
    "translate_frames": f"""WITH {CONTIGS}, f AS (SELECT contig_id, k AS frame, substr(seq, k + 1) AS s FROM contigs CROSS JOIN (SELECT unnest([0, 1,
    2]) AS k)), code AS (SELECT {_map(codons())} AS m),
p AS (SELECT contig_id, cast(frame AS int) AS frame, {_protein('s', 'm')} AS protein FROM f CROSS JOIN code) SELECT contig_id, frame,
    length(protein) AS residues, sha256(protein) AS digest FROM p""",
    "extract_sequences": f"""WITH {CONTIGS}, {GENE_HITS}, code AS (SELECT {_map({k: v for k, v in wide_codons().items() if set(k) <= set('ACGTN')})} AS m)
SELECT Accession AS "Accession", Contig AS "Contig", Gene AS "Gene", s AS "Start", e AS "End", Strand AS "Strand", dna,
    nullif(rtrim({_protein('dna', 'm')}, '*'), '') AS protein FROM ex CROSS JOIN code""",
    "extraction_stats": f'WITH {CONTIGS}, {GENE_HITS} SELECT Accession AS "Accession", count(dna) AS extracted, count(*) - count(dna) AS failed, count(*) = count(dna) AS complete FROM ex GROUP BY Accession',
    "standardize_hits": f"{HITS} SELECT * FROM std",
    "target_hits": f"{HITS} SELECT * FROM std WHERE lower(\"Gene\") IN ('acra', 'marr')",
    "named_hits": f"""{HITS}, both_ AS (SELECT * FROM std UNION ALL SELECT sseqid, qseqid, least(a, b), greatest(a, b), CASE WHEN sstrand = 'minus'
    THEN '-' ELSE '+' END, pident, 'second' FROM h WHERE evalue = 1 / 1000 AND pident >= 90 AND length >= 80)
SELECT * FROM both_ WHERE contains(lower("Gene"), 'cra') OR contains(lower("Gene"), 'marr')""",
    "missing_references": "SELECT lower(p_brand) AS gene FROM part GROUP BY p_brand HAVING max(p_size) <= 49",
    "best_hits": f"{HITS} SELECT qseqid, sseqid, bitscore, evalue, l_partkey AS sstart FROM h QUALIFY row_number() OVER (PARTITION BY qseqid, sseqid ORDER BY bitscore DESC, evalue, l_partkey) = 1",
    "select_reference": """WITH c AS (SELECT p_brand, p_partkey AS rank, p_size % 3 = 0 AS is_refseq, cast(p_size * 50 AS bigint) AS length FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand, is_refseq ORDER BY rank) AS r1, row_number() OVER (PARTITION BY p_brand ORDER BY rank) AS r2 FROM c),
p AS (SELECT *, CASE WHEN is_refseq AND r1 <= 5 THEN 0 WHEN r2 <= 5 THEN 1 END AS search_pass FROM r WHERE length BETWEEN 100 AND 2000)
SELECT p_brand, rank, is_refseq, length, search_pass FROM p WHERE search_pass IS NOT NULL QUALIFY row_number() OVER (PARTITION BY p_brand
    ORDER BY search_pass, rank) = 1""",
    "normalize_ids": """SELECT cast(o_custkey AS varchar) AS id, min(o_orderkey) AS first_ord FROM orders WHERE o_orderkey % 4 < 2 GROUP BY o_custkey""",
    "missing_ids": "SELECT cast(c_custkey AS varchar) AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)",
    "enrich_metadata": """WITH o AS (SELECT o_custkey, '["' || array_to_string(list_sort(list(DISTINCT o_orderpriority)),
    '","') || '"]' AS priorities, count(*) AS orders FROM orders GROUP BY o_custkey)
SELECT cast(c_custkey AS varchar) || ' ' AS genome_id, c_name, priorities, orders, CASE WHEN o_custkey IS NULL THEN 0 ELSE 1 END AS metadata_found
    FROM customer LEFT JOIN o ON c_custkey = o_custkey""",
    "enrichment_counts": "SELECT count(*) AS samples, count(o.k) AS found, count(*) - count(o.k) AS not_found FROM customer LEFT JOIN (SELECT DISTINCT o_custkey AS k FROM orders) o ON c_custkey = o.k",
    "clash_qc": _clash(60.0),
    "clash_qc_dense": _clash(20.0),
    "residue_reconcile": f"""WITH {_atoms(20.0)} SELECT p_partkey, cast(p_partkey % 10 AS varchar) AS structure,
    cast(p_partkey % 2 AS varchar) AS chain, cast(p_partkey AS varchar) AS residue, resname AS structure_residue
FROM part JOIN pts ON p_partkey = vec_id AND cast(p_partkey % 10 AS varchar) = structure AND p_partkey % 2 = chain""",
    "pocket_center": f"""WITH {_atoms(20.0)}, s AS (SELECT cast(p_partkey % 10 AS varchar) AS structure, p_partkey FROM part),
m AS (SELECT s.structure, avg(x) AS x, avg(y) AS y, avg(z) AS z FROM s JOIN pts ON p_partkey = vec_id AND s.structure = pts.structure
    AND p_partkey % 2 = chain GROUP BY s.structure)
SELECT structure, round(coalesce(x, 18.5), 6) AS center_x, round(coalesce(y, 55.2), 6) AS center_y, round(coalesce(z, 20.1), 6) AS center_z
    FROM (SELECT DISTINCT structure FROM s) LEFT JOIN m USING (structure)""",
    "docking_report": f"""{DOCK} SELECT net AS mutation_network, status, round(ddg, 6) AS delta_delta_g, CASE WHEN abs(ddg) < 0.5 THEN 'LOW'
    WHEN abs(ddg) >= 1 THEN 'HIGH' WHEN ddg IS NOT NULL THEN 'MEDIUM' END AS confidence,
  CASE WHEN abs(ddg) < 0.5 THEN 'LOW_CONFIDENCE_NOISE' WHEN abs(ddg) >= 1 THEN 'STRONG_DDG_SIGNAL' WHEN ddg IS NOT NULL
    THEN '' END AS confidence_flags, interp AS interpretation,
  CASE WHEN status IN ('ok', 'mutant_docking_failed') THEN printf('%.3f', wt * 100) ELSE 'N/A' END AS wt_text,
  CASE WHEN user_id % 3 = 0 THEN '' ELSE 'SER-' || user_id || '-LEU' END AS mutations, CASE WHEN user_id % 3 = 0 THEN ''
    ELSE 'A:' || user_id END AS flexible_residues, 18.0::double AS center_x, -24.0::double AS center_y, 5.0::double AS center_z FROM doc""",
    "focus_docking": """WITH ev AS (SELECT user_id, value / 100 AS v, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
af AS (SELECT max(v) FILTER (k = 1) AS wt, max(v) FILTER (k = 2) AS mt FROM ev GROUP BY user_id)
SELECT 'acrb:S83L' AS mutation_network, CASE WHEN wt IS NULL THEN 'wildtype_docking_failed' WHEN mt IS NULL THEN 'mutant_docking_failed'
    ELSE 'ok' END AS status, round(mt - wt, 6) AS delta_delta_g,
  'SER-83-LEU' AS mutations, 1.0::double AS center_x, 2.5::double AS center_y, -3.0::double AS center_z FROM af""",
    "triage_counts": f"""{DOCK} SELECT 'run' || user_id % 4 AS run, CASE WHEN status LIKE '%FAILED_QC%' OR lower(status) LIKE '%failed%'
    THEN 'FAILED_QC_or_DockingFailed' WHEN interp = 'NO_SIGNIFICANT_BINDING_CHANGE' THEN interp
  WHEN abs(ddg) < 0.5 THEN 'NearZero_DDG' ELSE 'Shift_or_Other' END AS category, count(*) AS networks FROM doc GROUP BY ALL""",
    "docking_tokens": f"""WITH {REPORT}, t AS (SELECT DISTINCT gene || ':' || mut AS token, lower(gene) AS gene, mut FROM report), p AS (SELECT *,
    regexp_full_match(mut, '[{RESIDUES}][0-9]+[{RESIDUES}]') AS ok,
  CASE lower(gene) WHEN 'acra' THEN 'A' WHEN 'acrb' THEN 'B' WHEN 'tolc' THEN 'D' ELSE 'A' END AS chain, regexp_extract(mut, '[0-9]+') AS residue FROM t)
SELECT token, CASE WHEN ok THEN gene END AS gene, CASE WHEN ok THEN chain END AS chain, CASE WHEN ok THEN residue END AS residue,
  CASE WHEN ok THEN {_three}[left(mut, 1)] || '-' || residue || '-' || {_three}[right(mut, 1)] END AS label, CASE WHEN ok
    THEN chain || ':' || residue ELSE '' END AS flexible FROM p""",
}
# What was planted is found whole: with its own score, in the frame in which it begins.
_self = {a: s for (a, b), s in published().items() if a == b}
ORACLE_SQL["planted_search"] = f"""WITH {CONTIGS}, maps AS (SELECT {_map({a: str(s) for a, s in _self.items()})} AS own),
items AS (SELECT item_id, 'item' || item_id AS gene, translate(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), '{X.LETTER_RESIDUES[0]}', '{X.LETTER_RESIDUES[1]}') AS ref
  FROM benchmark),
scored AS (SELECT item_id, gene, ref, list_sum(list_transform(string_split(ref, ''), lambda r: cast(own[r] AS double))) AS score FROM items CROSS JOIN maps WHERE length(ref) >= 20)
SELECT genome_id, gene, contig_id, cast(CASE WHEN doc_id % 2 = 1 THEN 3 + (length(seq) - length(seq) // 2) % 3 ELSE length(seq) // 2 % 3 END AS int) AS frame, score,
    sha256(ref) AS digest
FROM contigs JOIN scored ON item_id = doc_id % (SELECT count(*) FROM benchmark) WHERE genome_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY genome_id, gene ORDER BY contig_id) = 1"""

ORACLE_SQL["docking_runs"] = f"""{DOCK}, r AS (SELECT 'run' || k AS run, net, user_id, k, CASE WHEN k = 3 AND user_id % 4 = 1 THEN NULL ELSE wt + k * 0.25::double END AS wt,
    CASE WHEN k = 3 AND user_id % 4 = 1 THEN NULL ELSE mt END AS mt FROM n CROSS JOIN range(4) AS runs(k)),
s AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN 'skipped_no_target_mutation:acrb' WHEN k > 0 AND (user_id + k) % 7 = 0 THEN 'FAILED_QC' WHEN wt IS NULL THEN 'wildtype_docking_failed'
    WHEN mt IS NULL THEN 'mutant_docking_failed' ELSE 'ok' END AS status FROM r),
g AS (SELECT *, CASE WHEN status = 'ok' THEN mt - wt END AS ddg FROM s)
SELECT run, net AS mutation_network, status, round(ddg, 6) AS delta_delta_g, CASE WHEN abs(ddg) < 0.5 THEN 'NO_SIGNIFICANT_BINDING_CHANGE' WHEN ddg >= 1 THEN 'REDUCED_SUBSTRATE_AFFINITY'
    WHEN ddg <= -1 THEN 'INCREASED_SUBSTRATE_AFFINITY' WHEN ddg IS NOT NULL THEN 'MODERATE_BINDING_SHIFT' END AS interpretation FROM g"""

ORACLE_SQL["geo_topn_matrix"] = f"""{MERGED}, r AS (SELECT place FROM counts GROUP BY place ORDER BY sum(n) DESC, place LIMIT 10),
c AS (SELECT gm FROM counts GROUP BY gm ORDER BY sum(n) DESC, gm LIMIT 10)
SELECT place AS geographic_location_clean, gm AS "Gene_Mutation", coalesce(n, 0) AS mutation_frequency FROM r CROSS JOIN c LEFT JOIN counts USING (place, gm)"""
ORACLE_SQL["many_targets"] = """WITH t AS (SELECT DISTINCT lower(substr(p_name, 2, 7)) AS t FROM part WHERE p_partkey % 3 = 0)
SELECT p_partkey FROM part WHERE p_partkey % 3 > 0 AND EXISTS (SELECT 1 FROM t WHERE contains(lower(CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE reverse(p_name) END), t))"""
ORACLE_SQL["unreferenced_proteins"] = f"""WITH {CONTIGS}, {PLANTED}, named AS (SELECT doc_id, contig_id AS acc, gene, ref FROM contigs JOIN items ON item_id = doc_id % (SELECT count(*) FROM benchmark) WHERE ref <> '')
SELECT acc AS accession, gene FROM named WHERE gene LIKE '%5'"""
ORACLE_SQL["unalignable_proteins"] = """SELECT cast(doc_id AS varchar) AS accession FROM documents WHERE regexp_matches(regexp_replace(lower(coalesce(text, '')), '[^a-z]', '', 'g'), '[jou]')"""
