"""Golden values of the operators and readers."""

import random

import pytest
from pyspark.sql import functions as F

from allelon.functions import docking as D
from allelon.functions import scoring, sequence, text
from allelon.operators import alignment, assembly, curation, geo, hits, networks, structures, variants
from allelon.sources import readers, writers


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "code,want",
    [("S83L", (-2, 192.2628, 88.32, "PATHOGENIC")), ("K2R", (2, 10.2932, 26.87, "BENIGN")), (" i4v ", (3, 0.5837, 21.5, "BENIGN")), ("D87N", (1, 142.5646, 66.45, "PATHOGENIC")),
     ("A10T", (0, 96.1277, 56.16, "UNCERTAIN")), ("Q45*", (-4, 215.0, 100.0, "PATHOGENIC")), ("I174I", (4, 0.0, 0.0, "BENIGN")),
         ("S83X", (None, None, None, "ERROR")), (None, (None, None, None, "ERROR"))],
)
def test_scores(spark, code, want):
    r = scoring.score_mutations(spark.createDataFrame([(code,)], "Mutation string")).first()
    assert (r["BLOSUM"], r["Grantham"] and round(r["Grantham"], 4), r["Severity"], r["Category"]) == want


def test_score_table():
    table = [scoring.substitution(a, b) for a in scoring.RESIDUES for b in scoring.RESIDUES if a != b]
    assert round(sum(t[4] for t in table), 2) == 20299.42
    assert [sum(t[5] == c for t in table) for c in ("BENIGN", "UNCERTAIN", "PATHOGENIC")] == [28, 238, 114]


@pytest.mark.parametrize("raw,want", [(None, "Unknown"), ("", "Unknown"), (" \t", "Unknown"), ("(x)", "Unknown"), ("India: ", "Unknown"),
    ("USA: New York  City (NYC)", "New York City"), ("Nigeria:Lagos, ", "Lagos"), ("Egypt", "Egypt"), ("A:B:C", "B:C")])
def test_locations(spark, raw, want):
    assert one(spark, raw, text.clean_location) == want


def test_translation(spark):
    assert one(spark, "ATGAAAGCGTAACGTAAA", sequence.translate_dna) == "MKA*RK"
    assert one(spark, "atgaaagcg", sequence.translate_dna) == "MKA" and one(spark, "", sequence.translate_dna) == "" and one(spark, None, sequence.translate_dna) is None
    assert one(spark, "CATGNNNAT", lambda c: sequence.translate_dna(c, 1)) == "MX"
    assert one(spark, "ATGGCNTAA", sequence.protein_table11) == "MA" and one(spark, "TAA", sequence.protein_table11) is None
    assert one(spark, "ACGTRYKMBDHVSWN", sequence.reverse_complement) == "NWSBDHVKMRYACGT"


def test_reverse_complement_twice(spark):
    s = "".join(random.Random(1).choices("ACGTNacgtRY", k=500))
    assert one(spark, s, lambda c: sequence.reverse_complement(sequence.reverse_complement(c))) == s


@pytest.mark.parametrize(
    "ref,query,gate,want", [("MKTIAL", "MRTIAL", 80, ["K2R"]), ("MKTIA", "MKTVIA", 80, []),
        ("YDYAMSVIVGRALPDVRDG", "YDYAMLVIVGRALPDVRDG", 80, ["S6L"]), ("MKTIALSY", "MRTVALSY", 75, ["K2R", "I4V"]), ("MKTIALSY", "MRTVALSY", 80, []), ("MKT", "MJT", 0, None)]
)
def test_substitutions(ref, query, gate, want):
    assert alignment.substitutions(ref, query, gate) == want


def test_alignment_is_optimal():
    rng, m = random.Random(3), alignment.matrix()
    score = lambda a, b: m[alignment.LETTERS.index(a), alignment.LETTERS.index(b)]

    def brute(a, b):
        from functools import lru_cache

        @lru_cache(None)
        def go(i, j, gap):
            if i == len(a) and j == len(b):
                return 0.0
            out = []
            if i < len(a) and j < len(b):
                out.append(score(a[i], b[j]) + go(i + 1, j + 1, 0))
            if i < len(a):
                out.append(-(0.5 if gap == 1 else 10) + go(i + 1, j, 1))
            if j < len(b):
                out.append(-(0.5 if gap == 2 else 10) + go(i, j + 1, 2))
            return max(out)

        return go(0, 0, 0)

    for _ in range(60):
        a, b = ("".join(rng.choices("ARNDC", k=rng.randint(1, 9))) for _ in "ab")
        got, x, y = alignment.global_align(a, b)
        assert got == pytest.approx(brute(a, b)) and x.replace("-", "") == a and y.replace("-", "") == b
        cost, gap = 0.0, 0
        for p, q in zip(x, y, strict=True):
            now = 1 if q == "-" else 2 if p == "-" else 0
            cost += score(p, q) if not now else -(0.5 if now == gap else 10)
            gap = now
        assert cost == pytest.approx(got)


def test_local_alignment():
    assert alignment.local_align("MKTIALSY", "WWWMKTIALSYWWW")[1] == "MKTIALSY" and alignment.local_align("", "A") == (0.0, None)


def test_variant_report(spark):
    refs = spark.createDataFrame([("test", "MKTIAL")], "gene string, seq string")
    proteins = spark.createDataFrame([("g1", "test", "MRTIAL"), ("g2", "test", "MKTIAL"), ("g3", "none", "MRTIAL"), ("g4", "test", None),
        ("g5", "test", "MRTIAL")], "accession string, gene string, seq string")
    db = spark.createDataFrame([("test", "K2R", "Test resistance", "TEST", 0)], "gene string, mutation string, phenotype string, pdb string, ord int")
    drugs = spark.createDataFrame([], "gene string, drug string")
    got = sorted(tuple(r) for r in variants.variant_report(proteins, refs, db, drugs).collect())
    assert got == [(g, "test", "K2R", "Resistant", "Test resistance", "TEST", 1.0, "Clinical DB") for g in ("g1", "g5")]
    assert [r["accession"] for r in variants.unreferenced(proteins, refs).collect()] == ["g3"]


def test_n50(spark):
    rows = spark.createDataFrame([("g", n) for n in (5, 4, 3, 2, 1)], "g string, len long")
    assert assembly.n50(rows, ["g"], "len").first()["n50"] == 4


def test_edges_are_bounded_by_supports(spark):
    rng = random.Random(2)
    rows = [(str(rng.randrange(30)), rng.choice(["acrA", "marR"]), f"A{rng.randrange(5)}V") for _ in range(200)] + [(None, "acrA", "A1V"), ("1", None, "A1V")]
    report = spark.createDataFrame(rows, "Accession string, Gene string, Mutation string")
    seen = {}
    for a, g, m in rows:
        if a and g:
            seen.setdefault(f"{g.lower()}:{m}", set()).add(a)
    for r in networks.epistasis_edges(report).collect():
        assert r["Frequency"] == len(seen[r["Node_1"]] & seen[r["Node_2"]]) and r["Node_1"] < r["Node_2"]
    assert networks.top_networks(networks.epistasis_edges(report.where("1 = 0"))).count() == 0


@pytest.mark.parametrize("ddg,want", [(0.49, ("LOW", D.NO_CHANGE)), (0.5, ("MEDIUM", "MODERATE_BINDING_SHIFT")),
    (1.0, ("HIGH", "REDUCED_SUBSTRATE_AFFINITY")), (-1.0, ("HIGH", "INCREASED_SUBSTRATE_AFFINITY")), (None, (None, None))])
def test_ddg(spark, ddg, want):
    assert (one(spark, ddg, D.confidence, "double"), one(spark, ddg, D.interpretation, "double")) == want


def test_docking_tokens(spark):
    got = one(spark, "acrB:s83l", lambda c: D.parse_token(c, D.chain_map(F.lit("acrb:B,x"))))
    assert tuple(got) == ("acrb", "S83L", "B", "83", "SER-83-LEU") and one(spark, "acrB:S83*", D.parse_token) is None


def test_clashes_equal_all_pairs(spark):
    rng = random.Random(4)
    pts = [(str(s), i, rng.choice("AB"), str(rng.randrange(20)), rng.uniform(-6, 6), rng.uniform(-6, 6), rng.uniform(-6, 6)) for s in range(3) for i in range(40 if s else 1)]
    got = {r["structure"]: r for r in structures.clash_qc(spark.createDataFrame(pts,
        "structure string, ord long, chain string, resseq string, x double, y double, z double"), most=10_000).collect()}
    for s in "012":
        own = [p for p in pts if p[0] == s]
        n = sum(sum((a[k] - b[k]) ** 2 for k in (4, 5, 6)) < 4 and not (a[2] == b[2] and abs(int(a[3]) - int(b[3])) <= 1) for i, a in enumerate(own) for b in own[i + 1 :])
        assert got[s]["clash_pairs"] == n and got[s]["qc_pass"] == (len(own) > 1)


def test_first_rows_and_scaling(spark):
    df = spark.createDataFrame([("a", 2, 5.0), ("a", 1, 7.0), ("b", 1, None)], "k string, o int, v double")
    assert sorted((r["k"], r["o"]) for r in geo.first_rows(df, ["k"], ["o"]).collect()) == [("a", 1), ("b", 1)]
    assert sorted(r["scaled"] for r in networks.scaled(df, "v", 0.0, 1.0).collect()) == [0.0, 0.0, 1.0]


def test_metadata(spark):
    s = spark.createDataFrame([(" 1 ",), ("2",)], "genome_id string")
    m = spark.createDataFrame([("1", ["x"])], "genome_id string, tags array<string>")
    got = {r["genome_id"]: (r["tags"], r["metadata_found"]) for r in curation.enrich_metadata(s, m).collect()}
    assert got == {" 1 ": ('["x"]', 1), "2": (None, 0)}


def test_readers(spark, tmp_path):
    def put(name, data):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(data, newline="")
        return str(path)

    put("g/a.fna", "ACGT\n>c1 x\nAAAA\n>empty\n>c3\r\nCC\r\n")
    got = [(r["contig_id"], r["header"], r["seq"]) for r in readers.read_contigs(spark, str(tmp_path / "g")).orderBy("contig_ord").collect()]
    assert got == [(None, None, "ACGT"), ("c1", "c1 x", "AAAA"), ("empty", "empty", ""), ("c3", "c3", "CC")]
    for name, data in (("X_1_acrA.faa", ">x\nMK\nTI\n"), ("Y_acrB.faa", "mk ti\n"), ("none.faa", "MK"), ("Z_acrB.faa", ">a\nM\n>b\nK\n"), ("E_acrB.faa", "")):
        put(f"p/{name}", data)
    assert sorted(tuple(r) for r in readers.read_proteins(spark, str(tmp_path / "p")).collect()) == [("X_1", "acrA", "MKTI"), ("Y", "acrB", "MKTI")]
    put("w/acrA_WT.faa", ">w\nMK\n")
    assert [tuple(r) for r in readers.read_references(spark, str(tmp_path / "w")).collect()] == [("acrA", "MK")]
    assert [r["gene"] for r in readers.read_gene_list(spark, put("t.txt", " AcrA \n\n# c\ntolC\n")).collect()] == ["acra", "tolc"]
    db = readers.read_resistance_db(spark, put("d.json", '{"test":[{"mutation":"K2R","phenotype":"T","pdb":"P"}]}'))
    assert [tuple(r) for r in db.collect()] == [("test", "K2R", "T", "P", 0)] and readers.read_resistance_db(spark, str(tmp_path / "no")).count() == 0
    assert [tuple(r) for r in readers.read_drug_map(spark, put("m.json", '{"_c":"x","gyrA":"cipro"}')).collect()] == [("gyra", "cipro")]
    assert readers.read_drug_map(spark, put("bad.json", "{")).count() == 0
    b = readers.read_blast(spark, put("b.tsv", "# c\nctg\tacrA\t99.0\t90\t10\t1\t1\t90\tminus\t100\n"))
    assert [tuple(r) for r in hits.standardize_hits(b).collect()] == [("acrA", "ctg", 1, 10, "-", 99.0, "blastn")]
    t = readers.read_tblastn(spark, put("t.tsv", "q\ts\t99\t9\t0\t0\t1\t9\t1\t27\t1e-5\t50\tMK-T\nq\ts\t9\n"))
    assert [r["seq"] for r in hits.proteins_from_hits(t, ["qseqid"]).collect()] == ["MKT"]
    a = readers.read_abricate(spark, put("a.tsv", "#FILE\tSEQUENCE\tSTART\tEND\tSTRAND\tGENE\t%IDENTITY\nf\tc\t1\t9\t+\tacrA\t98.5\n"))
    assert [tuple(r) for r in a.collect()] == [("acrA", "c", 1, 9, "+", 98.5, "abricate")]
    atom = readers.read_atoms(spark, put("s.pdb", "HEADER\nATOM      1  CA  SER A  83      11.104   6.134  -6.504  1.00  0.00           C\n")).first()
    assert (atom["atom"], atom["resname"], atom["chain"], atom["resseq"], atom["x"], atom["element"]) == ("CA", "SER", "A", "83", 11.104, "C")
    log = readers.read_docking_logs(spark, put("l.log", "mode\n1 x\n   1   -7.5  0\n1 -6\n"))
    assert [tuple(r) for r in log.collect()] == [("l", -7.5)]
    put("i1.csv", "Genome ID,geographic_location\n562.10,USA: x\n")
    put("i2.csv", "Genome ID,disease\n562.1,\n")
    iso = readers.read_isolates(spark, [str(tmp_path / "i1.csv"), str(tmp_path / "i2.csv")])
    assert sorted((r["Genome ID"], r["geographic_location"], r["disease"]) for r in iso.collect()) == [("562.1", "", ""), ("562.10", "USA: x", "")]
    runs = readers.read_runs(spark, {"r1": put("r1.csv", "status\nok\n"), "r2": str(tmp_path / "no.csv")}, "status string")
    assert [tuple(r) for r in runs.collect()] == [("ok", "r1")]
    out = str(tmp_path / "out")
    writers.write_csv(iso.limit(0), out + "c")
    writers.write_fasta(spark.createDataFrame([("g", "acrA", "MK")], "Accession string, Gene string, seq string"), out + "f", F.col("Gene"))
    assert spark.read.text(out + "f").select("value").collect()[0][0] == ">acrA"
    with pytest.raises(ValueError, match="missing columns: x"):
        readers.require_columns(iso, "x")


def test_tables_by_header_name(spark, tmp_path):
    """Columns in any order, missing and further ones, files without rows and without bytes."""

    def put(name, data):
        (tmp_path / name).write_text(data, newline="")
        return str(tmp_path / name)

    edges = readers.read_edges(spark, put("e.csv", "Node_2,note,Node_1,Frequency\nb:A1V,x,a:A1V,3\nc:A1V,x,a:A1V,many\n"))
    assert [(r["Node_1"], r["Node_2"], r["Frequency"], r["Avg_Biochemical_Severity"]) for r in edges.collect()] == [("a:A1V", "b:A1V", 3, None), ("a:A1V", "c:A1V", None, None)]
    report = readers.read_report(spark, put("r.csv", "Mutation,Accession,prediction_score,Gene\nA1V,562.10,0.5,acrA\n"))
    assert [(r["Accession"], r["Gene"], r["Mutation"], r["prediction_score"], r["Status"]) for r in report.collect()] == [("562.10", "acrA", "A1V", 0.5, None)]
    with pytest.raises(ValueError, match="missing columns: Gene"):
        readers.read_report(spark, put("m.csv", "Accession,Mutation\n1,A1V\n"))
    assert readers.read_report(spark, put("h.csv", "Accession,Gene,Mutation\n")).count() == readers.read_report(spark,
        put("z.csv", "")).count() == readers.read_edges(spark, put("y.csv", "")).count() == 0
    runs = readers.read_runs(spark, {"r1": put("r1.csv", "b,a\n1,x\n"), "r2": put("r2.csv", "a\ny\n"), "r3": str(tmp_path / "no.csv")},
        "a string, b long, c string", {"b": 7, "c": ""})
    assert sorted(tuple(r) for r in runs.collect()) == [("x", 1, "", "r1"), ("y", 7, "", "r2")]


def test_csv_is_sorted_and_keeps_blanks(spark, tmp_path):
    rows = spark.createDataFrame([(3, " c "), (1, "a"), (2, "b")], "k long, v string").repartition(3)
    writers.write_csv(rows, str(tmp_path / "s"), "k")
    lines = [x for p in sorted((tmp_path / "s").glob("part-*")) for x in p.read_text().splitlines() if not x.startswith("k")]
    assert lines == ["1,a", "2,b", "3, c "]


def test_identity_and_gaps(spark):
    refs = spark.createDataFrame([("g", "MKTIALSYVN")], "gene string, seq string")
    proteins = spark.createDataFrame([("same", "g", "MKTIALSYVN"), ("one", "g", "MRTIALSYVN"), ("lost", "g", "MKTIALSYV"), ("far", "g", "WWWWWWWWWW"),
        ("odd", "g", "MKTIALSYVJ"), ("short", "g", "MK")], "accession string, gene string, seq string")
    got = {r["accession"]: (r["identity"], r["mutations"]) for r in variants.align_proteins(proteins, refs).collect()}
    assert got == {"same": (100.0, []), "one": (90.0, ["K2R"]), "lost": (90.0, []), "far": (0.0, [])}
    assert [r["accession"] for r in variants.unalignable(proteins).collect()] == ["odd"]


def test_docking_keeps_the_targets_mutations(spark):
    edges = spark.createDataFrame([("acrB:S83L", "acrB:A10V"), ("tolC:A1V", "acrB:s5l"), ("tolC:A1V", None), ("bad", None)], "Node_1 string, Node_2 string")
    none = spark.createDataFrame([], "mutation_network string, wt_affinity double, mut_affinity double")
    got = {r["Node_1"] + (r["Node_2"] or ""): (r["mutations"], r["flexible_residues"], r["status"]) for r in structures.docking_report(edges, none, "acrB").collect()}
    assert got == {
        "acrB:S83LacrB:A10V": ("SER-83-LEU,ALA-10-VAL", "A:83,A:10", "wildtype_docking_failed"), "tolC:A1VacrB:s5l": ("SER-5-LEU", "A:5", "wildtype_docking_failed"),
        "tolC:A1V": ("", "", "skipped_no_target_mutation:acrb"), "bad": ("", "", "skipped_unparseable_mutations"),
    }


def test_missing_references_are_named(spark):
    refs = spark.createDataFrame([("acrA", "MK"), ("acrB", "")], "gene string, seq string")
    with pytest.raises(ValueError, match="acrb, tolc$"):
        curation.require_references(spark.createDataFrame([("acra",), ("tolc",), ("acrb",)], "gene string"), refs)
    curation.require_references(spark.createDataFrame([("acra",)], "gene string"), refs)


def test_empty_and_zero_assemblies(spark):
    rows = [("a", "a.fna", s) for s in ("ACGN", "", "NN", "AC")] + [("b", "b.fna", "")]
    got = {r["genome_id"]: (r["total_bp"], r["contigs"], r["n50"],
        r["n_fraction"]) for r in assembly.assembly_qc(spark.createDataFrame(rows, "genome_id string, file_name string, seq string")).collect()}
    assert got == {"a": (8, 3, 4, 0.375), "b": (0, 0, 0, 1.0)}


def test_triage_is_sorted(spark):
    rows = [("r2", "ok"), ("r1", "FAILED_QC"), ("r1", "ok"), ("r1", "ok"), ("r2", "x failed")]
    docking = spark.createDataFrame([(run, status, None, 2.0) for run, status in rows], "run string, status string, interpretation string, delta_delta_g double")
    edges = spark.createDataFrame([("a:A1V", "b:A1V", 2, 3.5)], "Node_1 string, Node_2 string, Frequency long, Composite_Network_Score double")
    got = [tuple(r) for r in structures.run_summary(edges, docking)["triage"].collect()]
    failed = "FAILED_QC_or_DockingFailed"
    assert got == [("r1", "Shift_or_Other", 2), ("r1", failed, 1), ("r2", failed, 1), ("r2", "Shift_or_Other", 1)]


def test_one_gap_equals_whole_tables(monkeypatch):
    """Alignments that are known without a table are those of the table, ties included; some need one."""
    rng, known, seen = random.Random(14), alignment._one_gap, []
    cases = []
    for k in range(400):
        ref = "".join(rng.choices("ARNDCQEGX*B" if k % 3 else "AG", k=rng.randint(1, 30)))
        own, at, n = "".join(rng.choice("ARNDW") if rng.random() < 0.06 * (k % 4) else c for c in ref), rng.randrange(len(ref) + 1), rng.randrange(6)
        cases.append((ref, [own, own[:at] + own[at + n :], own[:at] + ref[:n] + own[at:], own[:at] + "".join(rng.choices("AGW", k=n)) + own[at:], "".join(rng.choices("AGW", k=n + 1))]))
    monkeypatch.setattr(alignment, "_one_gap", lambda *x: seen.append(known(*x)) or seen[-1])
    fast = [alignment.global_aligns(r, q) for r, q in cases]
    sure = sum(int(x[0].sum()) for x in seen), sum(len(x[0]) for x in seen)
    monkeypatch.setattr(alignment, "_one_gap", lambda *x: tuple(v if i else v & False for i, v in enumerate(known(*x))))
    assert fast == [alignment.global_aligns(r, q) for r, q in cases] and 0.5 * sure[1] < sure[0] < sure[1]


def test_different_rows_in_bounded_parts(spark):
    """No task compares more rows than a few times the bound, and they are dealt before they are compared."""
    own = spark.range(0, 60_000, 1, 3).selectExpr("id % 20000 AS a", "IF(id % 7 = 0, NULL, cast(id % 5 AS string)) AS b")
    found = variants.distinct_rows(own, together=5_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("HashAggregate") < plan.index("Exchange") and "HashAggregate" not in plan[plan.index("Exchange") :]
    sizes = [len(p) for p in found.rdd.glom().collect()]
    assert len(sizes) == 12 and max(sizes) < 10_000 and sorted(map(str, found.collect())) == sorted(set(map(str, own.collect())))
