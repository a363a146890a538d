"""Skewed, long, empty and repeated inputs of the mutation operators, against plain versions."""

import gzip
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from allelon.functions.scoring import RESIDUES
from allelon.functions.sequence import codons, protein_table11, reverse_complement, subsequence
from allelon.operators import alignment, assembly, hits, networks, search, structures, variants
from allelon.plans import files
from allelon.sources import readers, writers

BACK = {a: c for c, a in codons().items()}


# Pairs


def test_one_accession_of_many_tokens(spark):
    """Each pair counts once, and no join key has much more than a tile on either side."""
    n, tile = 5000, 500
    coded = spark.range(n).select(F.lit("big").alias("acc"), (F.col("id") * 7).alias("id")).unionByName(spark.range(3).select(F.lit("small").alias("acc"), (F.col("id") * 7).alias("id")))
    for side, c in zip(networks.tile_sides(coded, tile), "ab", strict=True):
        assert side.groupBy("acc", "t1", "t2").agg(F.count(c).alias("n")).agg(F.max("n")).first()[0] <= 1.3 * tile
    found = networks.tile_pairs(coded, tile).agg(F.count("*"), F.sum("Frequency"), F.count_if(F.col("low") < F.col("high")), F.count_if(F.col("Frequency") == 2)).first()
    assert tuple(found) == (n * (n - 1) // 2, n * (n - 1) // 2 + 3, n * (n - 1) // 2, 3)


def test_edges_in_tiles_equal_edges_at_once(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.3 else str(rng.randrange(20)), rng.choice(["acrA", "marR", "tolC"]), f"{rng.choice('ASL')}{rng.randrange(30)}V") for _ in range(600)]
    report = spark.createDataFrame(rows, "Accession string, Gene string, Mutation string")
    tiled, whole = (sorted(tuple(r) for r in networks.epistasis_edges(report, tile=t).collect()) for t in (7, 10_000))
    assert tiled == whole and len(whole) > 100


def test_nan_counts_as_the_least(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,), (4.0,)], "v double")
    assert sorted(r["scaled"] for r in networks.scaled(df, "v", 0.0, 1.0).collect()) == [0.0, 0.0, 0.0, 1.0]
    assert [r["scaled"] for r in networks.scaled(df.where("isnan(v)"), "v", 0.0, 1.0).collect()] == [0.5]


# Files


@pytest.mark.parametrize("query", ["sequence_files", "protein_files", "fasta_files", "assembly_files"])
def test_one_row_group_is_written_by_all_cores(spark, monkeypatch, query):
    """The documents at hand are one row group: contigs are derived and their files written by many tasks."""
    class Seen(Exception):
        pass

    def write_files(df, path):
        raise Seen(df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect())

    monkeypatch.setattr(writers, "write_files", write_files)
    with pytest.raises(Seen) as found:
        files.QUERIES[query](spark, "/root/testdata/sf0.001")
    own = [r["count"] for r in found.value.args[0]]
    assert len(own) > 2 * spark.sparkContext.defaultParallelism and max(own) < sum(own) / 8


# Files of no bytes


def test_files_of_no_bytes(spark, tmp_path):
    for name, text in (("a.fna", ">c\nACGN\n"), ("b b+é.fna", ""), ("c.fna", " \n"), ("d.fna", "ACGT\n"), ("_skip.fna", "")):
        (tmp_path / name).write_text(text)
    own = readers.read_contigs(spark, str(tmp_path))
    got = {r["genome_id"]: (r["total_bp"], r["contigs"], r["n50"], r["n_fraction"], r["quality"]) for r in assembly.assembly_qc(own).collect()}
    none = (0, 0, 0, 1.0, "poor")
    assert got == {"a": (4, 1, 4, 0.25, "poor"), "b b+é": none, "c": none, "d": (4, 1, 4, 0.0, "poor")}
    assert {r["genome_id"]: r["is_valid"] for r in assembly.genome_validate(own, min_length=1).collect()} == {"a": True, "b b+é": False, "c": False, "d": False}
    assert {r["name"]: r["error"] for r in readers.read_sequences(spark, f"{tmp_path}/*.fna").collect()}["b b+é"] == "empty"
    assert readers.empty_files(spark, f"{tmp_path}/a.fna") == []


# Alignment


def changed(ref, rng, share):
    out = []
    for c in ref:
        x = rng.random()
        out += [rng.choice(RESIDUES)] if x < share / 2 else [] if x < share * 0.75 else [c, rng.choice(RESIDUES)] if x < share else [c]
    return "".join(out)


def test_blocks_give_the_same_paths(monkeypatch):
    rng, cases = random.Random(9), []
    for k in range(120):
        letters = RESIDUES if k % 2 else "AC"  # few letters give many equal optima
        ref = "".join(rng.choices(letters, k=rng.randint(1, 70)))
        cases.append((ref, [changed(ref, rng, rng.random()) for _ in range(3)] + ["".join(rng.choices(letters, k=rng.randint(0, 50)))]))
    whole = [(alignment.global_aligns(r, q), [alignment.local_align(r, x) for x in q]) for r, q in cases]
    monkeypatch.setattr(alignment, "WHOLE_CELLS", 40)
    assert [(alignment.global_aligns(r, q), [alignment.local_align(r, x) for x in q]) for r, q in cases] == whole


def test_long_proteins_in_little_memory():
    rng = random.Random(3)
    ref = "".join(rng.choices(RESIDUES, k=4000))
    query = changed(ref, rng, 0.1)
    tracemalloc.start()
    score, x, y = alignment.global_align(ref, query)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 40e6 and x.replace("-", "") == ref and y.replace("-", "") == query and score > 15_000


def test_repeated_proteins_are_joined_by_digest(spark):
    refs = spark.createDataFrame([("g", "MKTIALWWYV")], "gene string, seq string")
    rows = [(str(i), "g", s) for i, s in enumerate(["MRTIALWWYV", "MRTIALWWYV", "MKTIALWWYV", None, "", "MK"])]
    got = variants.align_proteins(spark.createDataFrame(rows, "accession string, gene string, seq string"), refs).collect()
    assert sorted((r["accession"], r["identity"], r["mutations"]) for r in got) == [("0", 90.0, ["K2R"]), ("1", 90.0, ["K2R"]), ("2", 100.0, [])]


# Search


def test_recall_of_distant_proteins(spark):
    """Proteins of 150 to 500 residues with 40 to 60 % of them kept: nine in ten are found at least, with the score of a whole alignment."""
    rng = random.Random(12)
    refs, contigs, want = [], [], {}
    for k in range(45):
        ref = "".join(rng.choices(RESIDUES, k=rng.choice([150, 250, 500])))
        own = "".join(c if rng.random() < (0.4, 0.5, 0.6)[k % 3] else rng.choice(RESIDUES) for c in ref)
        refs.append((f"p{k}", ref))
        around = ["".join(rng.choices("ACGT", k=rng.randrange(100, 700))) for _ in range(2)]
        contigs.append((f"g{k}", "c", around[0] + "".join(BACK[a] for a in own) + around[1]))
        want[f"g{k}", f"p{k}"] = alignment.local_align(ref, own)[0]
    found = hits.translated_search(spark.createDataFrame(contigs, "genome_id string, contig_id string, seq string"), spark.createDataFrame(refs, "gene string, seq string"),
        ["genome_id", "contig_id"], "genome_id")
    got = {(r["genome_id"], r["gene"]): r["score"] for r in found.collect()}
    assert sum(got.get(k, 0) >= v for k, v in want.items()) >= 0.9 * len(want)


def test_windows_equal_whole_tables():
    """The best alignment through a box, from both ends, where it doesn't reach the window's edge."""
    rng = np.random.default_rng(5)
    for _ in range(30):
        core = rng.integers(0, 20, 24)
        a, target = np.concatenate([rng.integers(0, 20, 4), core, rng.integers(0, 20, 4)]), np.concatenate([rng.integers(0, 20, 20), core, rng.integers(0, 20, 20)])
        letters = np.array(list(alignment.LETTERS))
        want = alignment.local_align("".join(letters[a]), "".join(letters[target]))[0]
        row, width = 0, 33
        first = 16 - width // 2  # the core's diagonal is 16
        b = np.full(len(a) + width - 1, search.WALL)
        part = target[max(0, first) : first + len(a) + width - 1]
        b[max(0, -first) : max(0, -first) + len(part)] = part
        box = np.array([[4, 28, 16 - first, 17 - first]])
        one = search.window_scores(a[None] - row, b[None], box)
        other = search.window_scores(a[None, ::-1], b[None, ::-1], np.array([[len(a) - 28, len(a) - 4, width - (17 - first), width - (16 - first)]]))
        assert one[0][0] == other[0][0] == want


def test_odd_contigs_are_searched(spark):
    refs = [("p", "MKWVTFISLLFLFSSAYSRGVFRRDAHKSE"), ("none", ""), (None, "MKWV"), ("xx", "X" * 40)]
    own = "".join(BACK[a] for a in refs[0][1])
    contigs = [("g", "a", own), ("g", "b", own), (None, "c", own), ("h", "d", None), ("h", "e", ""), ("h", "f", "AC"), ("i", "g", own.lower() + "é")]
    df = spark.createDataFrame(contigs, "genome_id string, contig_id string, seq string")
    found = hits.translated_search(df, spark.createDataFrame(refs, "gene string, seq string"), ["genome_id", "contig_id"], "genome_id")
    assert sorted((r["genome_id"], r["contig_id"], r["gene"], r["frame"], r["seq"]) for r in found.collect()) == [("g", "a", "p", 0, refs[0][1]), ("i", "g", "p", 0, refs[0][1])]


# Extraction


@pytest.mark.parametrize("chunk", [5, 1 << 16])
def test_extraction_by_chunks_equals_whole_contigs(spark, chunk):
    rng = random.Random(chunk)
    contigs = [(f"g{k % 3}", f"c{k}", "".join(rng.choices("ACGTN", k=rng.randint(0, 60)))) for k in range(12)] + [("g0", "null", None), (None, "c1", "ACGT")]
    rows = [(g, c, rng.randint(-2, 60), rng.randint(-2, 90), rng.choice("+-"), k) for k in range(40) for g, c, _ in [rng.choice(contigs)]]
    rows += [("g1", "c1", 1, 60, "+", i) for i in range(50)] + [("g9", "c1", 1, 5, "+", 0), ("g0", "c0", None, 5, "+", 0), ("g0", "c0", 1, 2**40, "-", 1)]
    known = spark.createDataFrame(contigs, "Accession string, Contig string, seq string")
    found = spark.createDataFrame(rows, "Accession string, Contig string, Start long, End long, Strand string, seq_len long")
    both = found.join(known.withColumnRenamed("seq", "s"), ["Accession", "Contig"], "left")
    cut = subsequence(F.col("s"), F.col("Start"), F.least("End", F.length("s").cast("long")))
    dna = F.when(F.col("Strand") == "-", reverse_complement(cut)).otherwise(cut)
    want = both.withColumn("dna", F.when(dna != "", dna)).withColumn("protein", protein_table11(F.col("dna"))).select(*found.columns, "dna", "protein")
    got = hits.extract_sequences(found, known, ["Accession", "Contig"], chunk=chunk)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


# Runs


def test_one_network_in_two_runs(spark):
    edges = spark.createDataFrame([("r1", "acrb:S83L", None), ("r2", "acrb:S83L", None)], "run string, Node_1 string, Node_2 string")
    own = spark.createDataFrame([("r1", "acrb:S83L", -5.0, -4.0), ("r2", "acrb:S83L", -5.0, -7.0)], "run string, mutation_network string, wt_affinity double, mut_affinity double")
    qc = spark.createDataFrame([("r2", "acrb:S83L", False)], "run string, mutation_network string, qc_pass boolean")
    got = structures.docking_report(edges, own, "acrB", qc, run="run").collect()
    assert sorted((r["run"], r["status"], r["delta_delta_g"]) for r in got) == [("r1", "ok", 1.0), ("r2", "FAILED_QC", None)]


# Names


@pytest.mark.parametrize("letters", [1 << 22, 40])
def test_names_that_hold_targets(spark, letters):
    rng = random.Random(letters)
    targets = {"".join(rng.choices("abc", k=rng.randint(3, 9))) for _ in range(200)} | {"é ü"}
    names = ["".join(rng.choices("abcABC", k=rng.randint(0, 8))) for _ in range(300)] + ["x É Ü y", "", None, "zzz"]
    want = sorted(str(x) for x in names if x is not None and any(t in x.lower() for t in targets))
    few = spark.createDataFrame([(t.upper(),) for t in targets] + [(None,)], "gene string")
    found = hits.target_hits(spark.createDataFrame([(x,) for x in names], "Gene string"), few, substring=True)
    assert sorted(r["Gene"] for r in found.collect()) == want
    own = spark.createDataFrame([(x.lower(),) for x in names if x is not None], "name string")
    parts = hits.names_with_parts(own.distinct(), spark.createDataFrame([(t,) for t in targets], "t string"), letters)
    assert sorted(r["name"] for r in parts.collect()) == sorted({x.lower() for x in want})


def test_a_hundred_thousand_targets(spark):
    targets = spark.range(100_000).select(F.concat(F.lit("t"), F.hex("id"), F.lit("_")).alias("gene"))
    names = [f"xx t{k:X}_" for k in (0, 99_999, 100_000)] + ["t_", "aT1F_b"]
    found = hits.target_hits(spark.createDataFrame([(x,) for x in names], "Gene string"), targets, substring=True)
    assert sorted(r["Gene"] for r in found.collect()) == sorted(["xx t0_", "xx t1869F_", "aT1F_b"])
    none = hits.target_hits(found, targets.limit(0), substring=True)
    assert none.count() == 0 and hits.target_hits(found, spark.createDataFrame([("",)], "gene string"), substring=True).count() == 3


# Matrices and clashes


def test_dense_matrix_of_the_largest_sides(spark):
    counts = [("p", "a:1", 5), ("p", "b:1", 1), ("q", "a:1", 4), ("q", "c.d:2", 3), ("r", "e:9", 3), ("s", "b:1", 1)]
    df = spark.createDataFrame(counts, "geographic_location_clean string, Gene_Mutation string, mutation_frequency long")
    from allelon.operators import geo

    found = geo.geo_topn_matrix(df, 3)
    assert found.columns == ["geographic_location_clean", "a:1", "c.d:2", "e:9"]
    assert sorted(tuple(r) for r in found.collect()) == [("p", 5, 0, 0), ("q", 4, 3, 0), ("r", 0, 0, 3)]
    assert geo.geo_topn_matrix(df.limit(0), 3).collect() == []


def test_sure_clashes_are_exact_within_cells(spark):
    rng, rows = random.Random(6), []
    for k in range(400):
        residue = rng.choice([str(rng.randrange(6)), "07", "7", "x", "y", None])
        rows.append((f"s{k % 3}", k, rng.choice(["A", "B", None]), residue, *(rng.uniform(0, 4) for _ in range(3))))
    atoms = spark.createDataFrame(rows, "structure string, ord int, chain string, resseq string, x double, y double, z double")
    side, want, close = 2.0 / 3**0.5 * (1 - 1e-9), {}, {}
    number = lambda r: int(r) if r is not None and r.isdigit() else None
    for i, a in enumerate(rows):
        for b in rows[:i]:
            if a[0] != b[0]:
                continue
            p, q = number(a[3]), number(b[3])
            same = abs(p - q) <= 1 if p is not None and q is not None else a[3] is not None and a[3] == b[3]
            if a[2] is not None and a[2] == b[2] and same:
                continue
            want[a[0]] = want.get(a[0], 0) + all(x // side == y // side for x, y in zip(a[4:], b[4:], strict=True))
            close[a[0]] = close.get(a[0], 0) + (sum((x - y) ** 2 for x, y in zip(a[4:], b[4:], strict=True)) < 4)
    assert {r["structure"]: r["sure"] for r in structures.sure_clashes(atoms).collect()} == want
    for most in (5, 10_000):
        got = {r["structure"]: r["clash_pairs"] for r in structures.clash_qc(atoms, most=most).collect()}
        assert got == {s: min(n, most + 1) for s, n in close.items()}


# Many files


def test_files_are_scanned_by_header(spark, tmp_path):
    heads = ["Genome ID,isolation_country", "isolation_country,Genome ID,note", "Genome ID"]
    paths = []
    for k in range(40):
        own = tmp_path / f"f {k}é.csv"
        cells = {"Genome ID": f"g{k}", "isolation_country": f"c{k}", "note": "x"}
        names = heads[k % 3].split(",")
        own.write_text(heads[k % 3] + ("\r\n" if k % 2 else "\n") + "".join(",".join(f"{cells[n]}.{r}" for n in names) + "\n" for r in range(2)))
        paths.append(str(own))
    assert len(readers.by_header(spark, paths)) == 3
    found = readers.read_isolates(spark, paths).orderBy("src_ord", "row_ord").collect()
    assert [(r["Genome ID"], r["isolation_country"], r["src_ord"]) for r in found] == [(f"g{k}.{r}", f"c{k}.{r}" if k % 3 < 2 else "", k) for k in range(40) for r in range(2)]
    assert readers.read_isolates(spark, []).collect() == []
    runs = {f"r{k}": p for k, p in enumerate(paths)} | {"none": str(tmp_path / "missing.csv")}
    got = readers.read_runs(spark, runs, "`Genome ID` string, isolation_country string, other int", {"isolation_country": "-"})
    assert sorted((r["run"], r["Genome ID"], r["isolation_country"], r["other"]) for r in got.collect()) == sorted(
        (f"r{k}", f"g{k}.{r}", f"c{k}.{r}" if k % 3 < 2 else "-", None) for k in range(40) for r in range(2))
    assert readers.read_runs(spark, {"none": str(tmp_path / "missing.csv")}, "a int").collect() == []


def test_a_name_of_too_many_mutations(spark):
    from allelon.functions.scoring import network_scores

    df = spark.createDataFrame([("a", "S83L", k) for k in range(5)] + [("b", "S83L", 0)], "acc string, Mutation string, k int")
    assert network_scores(df, "acc", "Mutation", ["k"], most=5).count() == 2
    with pytest.raises(ValueError, match="network a has 5"):
        network_scores(df, "acc", "Mutation", ["k"], most=4)


def test_files_are_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Files in folders by key are read with those beside them, each once and its bytes as they are; Spark's own listing on the driver isn't asked."""
    writers.write_files(spark.createDataFrame([(f"n{k}.fna", f">c\nAC{'G' * k}\n") for k in range(40)] + [("e.fna", None)], "name string, text string"), str(tmp_path / "a"))
    writers.write_files(spark.createDataFrame([("flat.fna", ">c\nA\n")], "name string, text string"), str(tmp_path / "a"), folders=0)
    for name in ("old/deep.fna", "part=_/x y+%20{é}.fna", "part=_/.hid"):
        (tmp_path / "a" / name).parent.mkdir(exist_ok=True)
        (tmp_path / "a" / name).write_text(">c\nT\n")
    (tmp_path / "a" / "z.fna.gz").write_bytes(gzip.compress(b">c\nTT\n"))
    monkeypatch.setattr(type(spark.read), "text", lambda *a, **k: pytest.fail("listed on the driver"))
    got = sorted((r["genome_id"], r["seq"]) for r in readers.read_contigs(spark, str(tmp_path / "a")).collect())
    assert got == sorted([(f"n{k}", f"AC{'G' * k}") for k in range(40)] + [("e", ""), ("flat", "A"), ("x y+%20{é}", "T"), ("z.fna", "TT")])
    assert len(list((tmp_path / "a").glob("n*.fna"))) == 0
    assert sorted(r["seq"] for r in readers.read_contigs(spark, f"{tmp_path}/[a]/{{flat,z}}*").collect()) == ["A", "TT"]
    assert [r["gene"] for r in readers.read_resistance_db(spark, str(tmp_path / "a")).collect()] == []
    with pytest.raises(AnalysisException):
        readers.read_contigs(spark, f"{tmp_path}/none")
