"""Biochemical severity of amino-acid substitutions: BLOSUM62 and a composition/polarity/volume distance."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from allelon.functions.text import strip

# The published BLOSUM62 matrix (lower triangle, in the order of RESIDUES) and residue properties.
RESIDUES = "ARNDCQEGHILKMFPSTWYV"
BLOSUM62 = """
 4
-1  5
-2  0  6
-2 -2  1  6
 0 -3 -3 -3  9
-1  1  0  0 -3  5
-1  0  0  2 -4  2  5
 0 -2  0 -1 -3 -2 -2  6
-2  0  1 -1 -3  0  0 -2  8
-1 -3 -3 -3 -1 -3 -3 -4 -3  4
-1 -2 -3 -4 -1 -2 -3 -4 -3  2  4
-1  2  0 -1 -3  1  1 -2 -1 -3 -2  5
-1 -1 -2 -3 -1  0 -2 -3 -2  1  2 -1  5
-2 -3 -3 -3 -2 -3 -3 -3 -1  0  0 -3  0  6
-1 -2 -2 -1 -3 -1 -1 -2 -2 -3 -3 -1 -2 -4  7
 1 -1  1  0 -1  0  0  0 -1 -2 -2  0 -1 -2 -1  4
 0 -1  0 -1 -1 -1 -1 -2 -2 -1 -1 -1 -1 -2 -1  1  5
-3 -3 -4 -4 -2 -2 -3 -2 -2 -3 -2 -3 -1  1 -4 -3 -2 11
-2 -2 -2 -3 -2 -1 -2 -3  2 -1 -1 -2 -1  3 -3 -2 -2  2  7
 0 -3 -3 -3 -1 -2 -2 -3 -3  3  1 -2  1 -1 -2 -2  0 -3 -1  4
"""
# Pairs whose score in severities differs from the published one.
SEVERITY_SCORES = {("F", "S"): -3, ("F", "T"): -3}
# residue, composition, polarity, volume
PROPERTIES = """
A   0.0  8.1  31.0
R  65.6 10.5 124.0
N 133.0 11.6  56.0
D  27.7 13.0  54.0
C  59.9  5.5  55.0
Q  79.7 10.5  85.0
E  43.1 12.3  83.0
G   0.0  9.0   3.0
H  74.0 10.4  96.0
I   0.0  5.2 111.0
L   0.0  4.9 111.0
K  58.0 11.3 119.0
M   0.0  5.7 105.0
F   0.0  5.2 132.0
P  39.8  8.0  32.5
S 142.0  9.2  32.0
T  71.0  8.6  61.0
W 130.0  5.4 170.0
Y  71.0  6.2 136.0
V   0.0  5.9  84.0
"""
# Weights of composition, polarity and volume; distance and score of a stop; highest distance.
DISTANCE_WEIGHTS = (1.833, 0.1018, 0.000399)
STOP_BLOSUM, TOP_DISTANCE, UNKNOWN_BLOSUM = -4, 215.0, -4


@lru_cache(maxsize=1)
def published() -> dict[tuple[str, str], int]:
    """Published score of each ordered pair of the 20 residues; alignments use these."""
    rows = [list(map(int, line.split())) for line in BLOSUM62.strip().splitlines()]
    return {(a, b): rows[max(i, j)][min(i, j)] for i, a in enumerate(RESIDUES) for j, b in enumerate(RESIDUES)}


def blosum() -> dict[tuple[str, str], int]:
    """The scores that severities use: the published ones but for two pairs."""
    return published() | {(a, b): v for (x, y), v in SEVERITY_SCORES.items() for a, b in ((x, y), (y, x))}


@lru_cache(maxsize=1)
def properties() -> dict[str, tuple[float, float, float]]:
    return {w[0]: tuple(map(float, w[1:])) for w in map(str.split, PROPERTIES.strip().splitlines())}


def distance(a: str, b: str) -> float:
    return math.sqrt(sum(w * (x - y) ** 2 for w, x, y in zip(DISTANCE_WEIGHTS, properties()[a], properties()[b], strict=True)))


def substitution(a: str, b: str) -> tuple[str, str, int, float, float, str]:
    """(wild type, mutant, BLOSUM, distance, severity rounded to 2 places, category)."""
    if b == "*":
        return a, b, STOP_BLOSUM, TOP_DISTANCE, 100.0, "PATHOGENIC"
    score = blosum()[a, b]
    if a == b:
        return a, b, score, 0.0, 0.0, "BENIGN"
    far = distance(a, b)
    severity = 100 * (0.4 * (1 - min(1.0, max(0.0, (score + 4) / 15))) + 0.6 * min(far / TOP_DISTANCE, 1.0))
    severity = min(100.0, max(0.0, severity))
    return a, b, score, far, round(severity, 2), "BENIGN" if severity < 30 else "UNCERTAIN" if severity < 60 else "PATHOGENIC"


def subst_table(spark: SparkSession) -> DataFrame:
    """The 420 scored pairs: 400 of residues and 20 of a residue and a stop."""
    return spark.createDataFrame(
        [substitution(a, b) for a in RESIDUES for b in RESIDUES + "*"], "wt string, mut string, BLOSUM int, Grantham double, Severity double, Category string"
    )


def parse_mutation(c: Column) -> dict[str, Column]:
    """wt, position and mut of a mutation such as S83L; all null where it isn't one."""
    text = F.upper(strip(c))
    valid = text.rlike(rf"^[{RESIDUES}]\d+[{RESIDUES}*]$")
    part = lambda k: F.when(valid, F.regexp_extract(text, r"^([A-Z])(\d+)([A-Z*])$", k))
    return {"wt": part(1), "position": part(2), "mut": part(3)}


def score_mutations(df: DataFrame, mutation_col: str = "Mutation") -> DataFrame:
    """``df`` with BLOSUM, Grantham, Severity, Category (ERROR and nulls where the mutation can't be parsed) and Error."""
    parts = parse_mutation(F.col(mutation_col))
    table = F.broadcast(subst_table(df.sparkSession).withColumnsRenamed({"wt": "__wt", "mut": "__m"}))  # 420 rows
    scored = df.withColumns({"__wt": parts["wt"], "__m": parts["mut"]}).join(table, ["__wt", "__m"], "left").drop("__wt", "__m")
    bad = F.col("Category").isNull()
    return scored.withColumn("Error", F.when(bad, F.concat(F.lit("Invalid mutation format: "), F.coalesce(mutation_col, F.lit(""))))).withColumn(
        "Category", F.coalesce("Category", F.lit("ERROR"))
    )


def network_scores(df: DataFrame, network: str, mutation_col: str, order: list[str], most: int = 1_000_000) -> DataFrame:
    """Name, mean and highest severity of each network of mutations, to 2 places; an error where none can be scored.

    The name holds all of a network's mutations in one text, so a network of more than ``most`` rows is an error, raised before any is
    gathered. Severities are averaged in hundredths, so that the mean is rounded half up exactly.
    """
    if large := df.groupBy(network).agg(F.count("*").alias("__n")).where(F.col("__n") > most).limit(1).collect():
        raise ValueError(f"the network {large[0][0]} has {large[0][1]} mutations, more than {most} for one name")
    cents = F.round(F.col("Severity") * 100).cast("long")
    total, n = F.sum(cents), F.count(cents)
    return (
        score_mutations(df, mutation_col)
        .groupBy(network)
        .agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*order, mutation_col))), lambda s: s[mutation_col]), "_").alias("network_name"),
            n.alias("valid_mutations"),
            F.when(n > 0, F.floor((2 * total + n) / (2 * n)) / 100).alias("mean_severity"),
            F.max("Severity").alias("max_severity"),
            F.when(n == 0, F.lit("No valid mutations")).alias("error"),
        )
    )
