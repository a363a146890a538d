"""The translated search against brute-force local alignment."""

import random

from allelon.functions.scoring import RESIDUES
from allelon.functions.sequence import codons, complement_letters
from allelon.operators import alignment, hits

BACK = {a: c for c, a in codons().items()}


def dna(protein):
    return "".join(BACK[a] for a in protein)


def six(seq):
    for s, own in ((0, seq), (3, seq[::-1].translate(str.maketrans(*complement_letters())))):
        for k in range(3):
            yield s + k, "".join(codons().get(own[i : i + 3], "X") for i in range(k, len(own) - 2, 3))


def search(spark, contigs, refs, **more):
    own = spark.createDataFrame(contigs, "genome_id string, contig_id string, seq string")
    found = hits.translated_search(own, spark.createDataFrame(refs, "gene string, seq string"), ["genome_id", "contig_id"], "genome_id", **more)
    return {(r["genome_id"], r["gene"]): (r["score"], r["contig_id"], r["frame"], r["seq"]) for r in found.collect()}


def brute(contigs, refs):
    out = {}
    for genome, contig, seq in contigs:
        for frame, protein in six(seq):
            for gene, ref in refs:
                score, part = alignment.local_align(ref, protein)
                out[genome, gene] = min(out.get((genome, gene), (0, "", 0, "")), (-score, contig, frame, part))
    return {k: (-v[0], *v[1:]) for k, v in out.items()}


def test_scores_and_bounds():
    rng = random.Random(5)
    for _ in range(40):
        ref = "".join(rng.choices(RESIDUES + "X*", k=rng.randint(1, 60)))
        queries = ["".join(rng.choices(RESIDUES + "XJ", k=rng.randint(0,
            30))) + ref[rng.randrange(len(ref)) :] + "A" * rng.randrange(3) + ref[: rng.randrange(len(ref) + 1)] for _ in range(8)] + [""]
        want = [alignment.local_align(ref, q)[0] for q in queries]
        assert alignment.local_scores(ref, queries).tolist() == want
        seeds = [[i for i in range(len(ref) - 4) if ref[i : i + 5] in q] for q in queries]
        assert all(m >= w for m, w in zip(alignment.most_scores(ref, 5, seeds), want, strict=True))


def test_best_hit_behind_many_repeats(spark):
    """Repeats have more seeds than the best alignment, on more contigs than any list of places holds."""
    rng = random.Random(6)
    core = "".join(rng.choices(RESIDUES, k=30))
    refs = [("rep", "A" * 12 + core), ("far", "".join(rng.choices(RESIDUES, k=50)))]
    far = refs[1][1]
    contigs = [("g", f"a{i}", dna("".join(rng.choices(RESIDUES, k=20)) + "A" * 40)) for i in range(8)]
    contigs += [("g", "z", "C" + dna("WW" + core + "WW")), ("g", "y", dna(far[:20] + "G" + far[20:])), ("h", "x", dna(far[5:45] + "".join(rng.choices(RESIDUES, k=30))))]
    contigs += [("h", "w", dna(core[:12] + "HHH" + core[12:])[::-1].translate(str.maketrans(*complement_letters())))]
    got = search(spark, contigs, refs)
    assert got == brute(contigs, refs) and got["g", "rep"][1] == "z"


def test_recall_at_every_offset_strand_and_size_of_references(spark):
    """Proteins of 1,049 and 2,000 residues at offsets of all kinds, on both strands, with changes; references sent out or joined."""
    rng = random.Random(11)
    turned = lambda s: s[::-1].translate(str.maketrans(*complement_letters()))
    refs = [(f"p{n}", "".join(rng.choices(RESIDUES, k=n))) for n in (1049, 2000)] + [("xx", "X" * 30 + "".join(rng.choices(RESIDUES, k=20)))]
    contigs, want = [], {}
    for i, offset in enumerate((0, 1, 2, 2_989, 2_990, 3_001, 5_999, 7_777)):
        for gene, ref in refs[:2]:
            own = "".join(rng.choice(RESIDUES) if rng.random() < 0.05 else c for c in ref) if i % 3 == 2 else ref
            seq = "".join(rng.choices("ACGT", k=offset)) + dna(own) + "".join(rng.choices("ACGT", k=rng.randrange(500)))
            contigs.append((f"{gene}-{offset}", "c", turned(seq) if i % 2 else seq))
            want[f"{gene}-{offset}", gene] = own
    contigs.append(("n", "c", "N" * 300))
    got = search(spark, contigs, refs)
    for (genome, gene), own in want.items():
        score, _, _, found = got[genome, gene]
        assert score >= alignment.local_scores(dict(refs)[gene], [own])[0] and (own != dict(refs)[gene] or found == own)
    assert got == search(spark, contigs, refs, broadcast_residues=0) and not any(g == "n" for g, _ in got)


def test_long_match_is_not_cut(spark):
    """1,100 residues, from base 2,901 to 6,200."""
    rng = random.Random(7)
    ref = "".join(rng.choices(RESIDUES, k=1100))
    contigs = [("g", "c", "".join(rng.choices("ACGT", k=2900)) + dna(ref) + "".join(rng.choices("ACGT", k=3000)))]
    got = search(spark, contigs, [("long", ref)])
    assert got == {("g", "long"): (sum(alignment.matrix()[alignment.LETTERS.index(c)][alignment.LETTERS.index(c)] for c in ref), "c", 2, ref)}


def test_alignment_in_a_part_of_the_query():
    """The part that is searched back equals the one from the whole table."""
    rng = random.Random(8)
    for _ in range(60):
        ref = "".join(rng.choices("ARNDC", k=rng.randint(3, 25)))
        query = "".join(rng.choices("ARNDC", k=40)) + ref[:10] + "".join(rng.choices("ARNDC", k=rng.randint(0, 20))) + ref[10:] + "".join(rng.choices("ARNDC", k=40))
        best = alignment._tables(alignment.coded(ref), alignment.coded(query), 12.0, 1.0, local=True)[0]
        score, part = alignment.local_align(ref, query)
        assert score == best.max() and part in query and alignment.local_scores(ref, [part])[0] == score


def test_query_searches_whole_proteins(spark, monkeypatch):
    """Every benchmark passage and the three contigs, none of them cut."""
    from allelon.plans import derived, queries

    sf, asked = "/root/testdata/sf0.001", []
    monkeypatch.setattr(hits, "translated_search", lambda contigs, refs, *a,
        **b: asked.append((refs, a, b)) or contigs.selectExpr("genome_id", "'' gene", "contig_id", "0 frame", "0 score", "seq"))
    queries.QUERIES["translated_search"](spark, sf)
    refs, _, more = asked[0]
    text = {f"item{r['item_id']}": r["text"] for r in derived.table(spark, sf, "benchmark").collect()}
    text |= {f"gene{r['doc_id']}": r["text"] for r in derived.table(spark, sf, "documents").where("doc_id IN (1, 2, 4)").collect()}
    bases = lambda t: "".join("ACGT"[(ord(c) - 97) % 4] if c < "y" else "N" for c in t.lower() if "a" <= c <= "z")
    assert {r["gene"]: r["seq"] for r in refs.collect()} == {g: next(six(bases(t)))[1] for g, t in text.items()} and not more


def test_whole_references_and_wanted_pairs(spark):
    """A whole reference is told by its seeds, on both strands and not across contigs; only the wanted pairs are scored, with the results of the whole search."""
    from allelon.operators import search as S

    rng = random.Random(13)
    refs = [(f"p{k}", "".join(rng.choices(RESIDUES, k=k))) for k in (10, 60, 90)] + [("x", "X" + "".join(rng.choices(RESIDUES, k=50)))]
    turned = lambda s: s[::-1].translate(str.maketrans(*complement_letters()))
    words, around = S.Words([r for _, r in refs]), ["".join(rng.choices("ACGT", k=n)) for n in (7, 41)]
    whole = [around[0] + dna(refs[1][1]) + around[1], around[1] + dna(refs[2][1]), dna(refs[2][1])[:120], dna(refs[2][1])[120:], "", "GCG" + dna(refs[3][1][1:])]
    assert sorted(words.candidates([S.bases(s) for s in whole])[1]) == [(0, 1, 1, 2), (1, 2, 2, 13)]
    contigs = [("g", "a", whole[0]), ("g", "b", turned(whole[0])), ("g", "c", dna(refs[1][1][:50])), ("h", "d", turned(whole[1])), ("h", "e", dna(refs[1][1][:40] + refs[2][1][:30])), ("i", "f", whole[5])]
    full, pairs = search(spark, contigs, refs), [("g", "p60"), ("h", "p60"), ("h", "none"), ("i", "p60"), ("k", "x")]
    assert full["g", "p60"][1:3] == ("a", 1) and full["h", "p90"][2] == 5 and all(v == brute(contigs, refs)[k] for k, v in full.items() if v[0] > 60)
    wanted = spark.createDataFrame(pairs, "genome_id string, gene string")
    assert search(spark, contigs, refs, wanted=wanted) == {k: v for k, v in full.items() if k in pairs}
