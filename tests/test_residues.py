"""Substitutions of aligned strings against a plain loop."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from allelon.functions.sequence import codons, proteins, residue_positions, wide_codons
from allelon.operators.variants import residue_changes


def test_positions_of_long_strings_in_one_pass(spark):
    rng = random.Random(9)
    pairs = [("".join(rng.choices("ACGT-", k=n)), "".join(rng.choices("ACGT-", k=n))) for n in (0, 1, 2, 59, 60, 61, 5000)] + [("--A", "AC-"), ("-", "A")]
    want = {}
    for x, y in pairs:
        at, want[x, y] = 0, []
        for p, q in zip(x, y, strict=True):
            at += p != "-"
            if p != q and "-" not in (p, q):
                want[x, y].append((p, at, q))
    found = residue_positions(F.col("x"), F.col("y"))
    rows = spark.createDataFrame(pairs, "x string, y string").select("x", "y", found.alias("r"))
    assert {(r["x"], r["y"]): [tuple(v) for v in r["r"]] for r in rows.collect()} == want
    assert "substring" not in rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("together", [3, 1 << 19])
def test_changes_in_parts_equal_positions(spark, together):
    """A row for each substitution, whatever the parts, of strings of different lengths, other letters and nulls."""
    rng = random.Random(10)
    pairs = [(k, "".join(rng.choices("ACGT-", k=n)), "".join(rng.choices("ACGT-", k=n))) for k, n in enumerate((0, 1, 2, 7, 60, 700))]
    for more in ([], [(6, "AC-GT", "TC"), (7, None, "A"), (8, "", "AA")], [(9, "Aé𝒳-C", "eXy-G")]):
        rows = spark.createDataFrame(pairs + more, "k int, x string, y string").coalesce(1)
        want = rows.select("k", F.explode(residue_positions(F.col("x"), F.col("y"))).alias("r")).select("k", "r.*")
        found = residue_changes(rows, ["k"], "x", "y", together)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect())) and found.count() > 300


@pytest.mark.parametrize("together", [1, 50, 1 << 21])
@pytest.mark.parametrize("wide", [False, True])
def test_proteins_of_batches(wide, together):
    rng, table = random.Random(11), wide_codons() if wide else codons()
    seqs = [None, "", "A", "AC", "ACG", "ACGA"] + ["".join(rng.choices("ACGTNRY-" if k % 2 else "ACGT", k=rng.randrange(200))) for k in range(60)]
    for more in ([], ["AéGACGÉ𝒳C"]):
        want = [None if s is None else "".join(table.get(s[i : i + 3], "X") for i in range(0, len(s) - 2, 3)) for s in seqs + more]
        assert proteins(pa.array(seqs + more, pa.string()), wide, together).to_pylist() == want
        assert proteins(pa.array(["GG", *seqs, *more], pa.string())[1:], wide, together).to_pylist() == want
