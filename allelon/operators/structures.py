"""Structure atoms, steric clashes and docking tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from allelon.functions import docking as D
from allelon.functions.text import before_colon

CLASH_DISTANCE, MAX_CLASHES = 2.0, 20


def heavy_atoms(atoms: DataFrame) -> DataFrame:
    return atoms.where("element <> 'H' AND NOT startswith(atom, 'H')")


def _resint(c: str = "resseq") -> Column:
    return F.expr(f"try_cast({c} AS int)")


def sure_clashes(atoms: DataFrame, distance: float = CLASH_DISTANCE) -> DataFrame:
    """(structure, sure): close pairs that sharing a cell proves, by counts alone: the cells are so small that all atoms of one are close.

    Of a cell's pairs those of one residue or of neighbours in a chain don't count; residues without a number have no neighbours.
    """
    side = distance / math.sqrt(3) * (1 - 1e-9)
    cell = ["structure", *(f"c{c}" for c in "xyz")]
    own = atoms.select("structure", "chain", "resseq", _resint().alias("r"), *(F.floor(F.col(c) / side).cast("long").alias(f"c{c}") for c in "xyz"))
    # Residues of one number but different texts ("7", "07") are one for the distance of numbers.
    counted = own.groupBy(*cell, "chain", "r", F.when(F.col("r").isNull(), F.col("resseq")).alias("name")).agg(F.count("*").alias("n"))
    around = F.sum("n").over(Window.partitionBy(*cell, "chain").orderBy("r").rangeBetween(-1, 1))
    near = F.when(F.col("chain").isNull(), F.lit(0)).when(F.col("r").isNotNull(), around).when(F.col("name").isNotNull(), F.col("n")).otherwise(F.lit(0))
    # Ordered pairs with each other and with themselves: bonded ones of a residue are its atoms times those around it, less themselves.
    bonded = F.when(near > 0, F.col("n") * (near - 1)).otherwise(F.lit(0))
    cells = counted.withColumn("bonded", bonded).groupBy(*cell).agg(F.sum("n").alias("all"), F.sum("bonded").alias("bonded"))
    return cells.groupBy("structure").agg(F.sum((F.col("all") * (F.col("all") - 1) - F.col("bonded")) / 2).cast("long").alias("sure"))


def clash_qc(atoms: DataFrame, distance: float = CLASH_DISTANCE, most: int = MAX_CLASHES) -> DataFrame:
    """Close pairs of each structure (counted to one above ``most``) and whether it passes: two atoms or more, few close pairs.

    ``atoms``: structure, ord, chain, resseq, x, y, z. A structure whose crowded cells prove more than ``most`` pairs isn't joined. Atoms of the others are put in
    cells as wide as the distance; an atom meets those in its own cell and in the 13 of its 26 neighbours that come after
    it, so each pair is joined once and only if near.
    """
    d = float(distance)
    crowded = sure_clashes(atoms, d).where(F.col("sure") > most)
    rest = atoms.join(crowded, "structure", "left_anti")
    placed = rest.select("structure", "ord", "chain", "resseq", "x", "y", "z", *(F.floor(F.col(c) / d).cast("long").alias(f"c{c}") for c in "xyz"))
    steps = [(i, j, k) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1) if (i, j, k) >= (0, 0, 0)]
    near = F.array(*(F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy"), (F.col("cz") + k).alias("cz"),
        F.lit((i, j, k) == (0, 0, 0)).alias("own")) for i, j, k in steps))
    a = placed.select("structure", *(F.col(c).alias(f"{c}1") for c in ("ord", "chain", "resseq", "x", "y", "z")),
        F.explode(near).alias("n")).select("*", "n.cx", "n.cy", "n.cz", "n.own").drop("n")
    gap = F.abs(_resint() - _resint("resseq1"))
    bonded = F.coalesce((F.col("chain") == F.col("chain1")) & F.coalesce(gap <= 1, F.col("resseq") == F.col("resseq1")), F.lit(False))
    square = sum(((F.col(f"{c}1") - F.col(c)) * (F.col(f"{c}1") - F.col(c)) for c in "xyz"), F.lit(0.0))
    pairs = a.join(placed, ["structure", "cx", "cy", "cz"]).where((~F.col("own") | (F.col("ord1") < F.col("ord"))) & (square < d * d) & ~bonded)
    close = pairs.groupBy("structure").agg(F.count("*").alias("n")).unionByName(crowded.select("structure", F.col("sure").alias("n")))
    n = F.least(F.coalesce("n", F.lit(0)), F.lit(most + 1)).cast("long")
    return atoms.groupBy("structure").agg(F.count("*").alias("atoms")).join(close, "structure", "left").select(
        "structure", "atoms", n.alias("clash_pairs"), ((F.col("atoms") >= 2) & (n <= most)).alias("qc_pass")
    )


def residue_reconcile(mutations: DataFrame, atoms: DataFrame) -> DataFrame:
    """Mutations (structure, chain, residue, ...) with the residue name that the structure has there, of its first atom row; others are dropped."""
    first = atoms.where("record = 'ATOM'").groupBy("structure", "chain", F.col("resseq").alias("residue")).agg(F.min_by("resname", "line_ord").alias("structure_residue"))
    return mutations.join(first, ["structure", "chain", "residue"])


def pocket_centers(mutations: DataFrame, atoms: DataFrame, fallback_site: tuple[str, str] = ("A", "596")) -> DataFrame:
    """Mean C-alpha position of each structure's mutated residues, else that of the fallback site, else the fixed centre."""
    ca = atoms.where("record = 'ATOM' AND atom = 'CA'").groupBy("structure", "chain", F.col("resseq").alias("residue")).agg(*(F.min_by(c, "line_ord").alias(c) for c in "xyz"))
    mean = mutations.select("structure", "chain", "residue").join(ca, ["structure", "chain", "residue"]).groupBy("structure").agg(*(F.avg(c).alias(f"m{c}") for c in "xyz"))
    site = ca.where((F.col("chain") == fallback_site[0]) & (F.col("residue") == fallback_site[1])).select("structure", *(F.col(c).alias(f"f{c}") for c in "xyz"))
    named = mutations.select("structure").distinct().join(mean, "structure", "left").join(site, "structure", "left")
    return named.select("structure", *(F.coalesce(f"m{c}", f"f{c}", F.lit(v)).alias(f"center_{c}") for c, v in zip("xyz", D.FALLBACK_CENTER, strict=True)))


def filter_by_gene(edges: DataFrame, target: str) -> DataFrame:
    """Edges with a node of the gene, by the gene columns or else by the node's own prefix."""
    gene = lambda k: F.lower(F.coalesce(F.col(f"Node_{k}_Gene"), before_colon(F.col(f"Node_{k}")), F.lit("")))
    t = target.lower()
    return edges.where((gene(1) == t) | (gene(2) == t))


def focus_edge(spark, gene: str, mutation: str) -> DataFrame:
    """A table of one edge for one mutation."""
    token = f"{gene.lower()}:{mutation}"
    return spark.createDataFrame([(token, None, gene.lower(), None, mutation, None, 1, 0.0, 0.0)],
        "Node_1 string, Node_2 string, Node_1_Gene string, Node_2_Gene string, Node_1_Mutation string, Node_2_Mutation string, Frequency long, Avg_Biochemical_Severity double, Composite_Network_Score double")


def docking_report(edges: DataFrame, affinities: DataFrame, target: str, qc: DataFrame | None = None, chains: Column | None = None,
    override: tuple[float, float, float] | None = None, run: str | None = None) -> DataFrame:
    """Affinity change, confidence and status of each edge, and the target's mutations in it with their flexible residues.

    ``affinities``: mutation_network, wt_affinity, mut_affinity. ``qc``: mutation_network, qc_pass; networks without a row pass. With the column
    ``run``, all three tables hold many runs: a network stands for itself in each of them, and the report has the column too.
    """
    keys = ["mutation_network"] if run is None else [run, "mutation_network"]
    label = D.network_label(F.col("Node_1"), F.col("Node_2"))
    tokens = F.filter(F.array(D.parse_token(F.col("Node_1"), chains), D.parse_token(F.col("Node_2"), chains)), lambda t: t.isNotNull())
    kept = F.filter("tokens", lambda t: t["gene"] == target.lower())
    rows = edges.select(*keys[:-1], "Node_1", "Node_2", label.alias("mutation_network"), tokens.alias("tokens")).withColumn("kept", kept).join(affinities, keys, "left")
    rows = rows.join(qc, keys, "left") if qc is not None else rows.withColumn("qc_pass", F.lit(True))
    status = (
        F.when(F.size("tokens") == 0, "skipped_unparseable_mutations")
        .when(F.size("kept") == 0, f"skipped_no_target_mutation:{target.lower()}")
        .when(~F.coalesce("qc_pass", F.lit(True)), "FAILED_QC")
        .when(F.col("wt_affinity").isNull(), "wildtype_docking_failed")
        .when(F.col("mut_affinity").isNull(), "mutant_docking_failed")
        .otherwise("ok")
    )
    rows = rows.withColumn("status", status)
    docked = F.col("status").isin("ok", "wildtype_docking_failed", "mutant_docking_failed")
    rows = rows.withColumns({c: F.when(docked, F.col(c)) for c in ("wt_affinity", "mut_affinity")}).withColumn("delta_delta_g", F.col("mut_affinity") - F.col("wt_affinity"))
    ddg, center = F.col("delta_delta_g"), D.pocket_center(F.lit(target), override=override)
    return rows.select(
        *keys[:-1], "Node_1", "Node_2", "mutation_network", "wt_affinity", "mut_affinity", "delta_delta_g", D.confidence(ddg).alias("confidence"),
            D.confidence_flags(ddg).alias("confidence_flags"),
        D.interpretation(ddg).alias("interpretation"), "status", F.array_join(F.transform("kept", lambda t: t["label"]), ",").alias("mutations"),
            D.flexible_residues(F.col("kept")).alias("flexible_residues"),
        *(center[f"center_{c}"].alias(f"center_{c}") for c in "xyz"),
    )


def triage_counts(docking: DataFrame) -> DataFrame:
    """Rows of each run and triage category."""
    kind = D.triage(F.col("status"), F.col("interpretation"), F.col("delta_delta_g"))
    return docking.groupBy("run", kind.alias("category")).agg(F.count("*").alias("networks"))


def run_summary(edges: DataFrame, docking: DataFrame) -> dict[str, DataFrame]:
    """The tables of a cross-run summary."""
    from allelon.operators import networks

    return {
        "nodes": networks.node_weights(edges),
        "edges": networks.edge_weights(edges),
        "top_mutations": networks.top_mutations(edges),
        "triage": triage_counts(docking).orderBy("run", F.desc("networks"), "category"),
    }
