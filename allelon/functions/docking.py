"""Expressions over docking results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Three-letter names, pocket centres by gene, the centre of all others.
THREE_LETTERS = {
    "A": "ALA", "R": "ARG", "N": "ASN", "D": "ASP", "C": "CYS", "Q": "GLN", "E": "GLU", "G": "GLY", "H": "HIS", "I": "ILE",
    "L": "LEU", "K": "LYS", "M": "MET", "F": "PHE", "P": "PRO", "S": "SER", "T": "THR", "W": "TRP", "Y": "TYR", "V": "VAL",
}
POCKET_CENTERS = {"acrb": (18.0, -24.0, 5.0)}
FALLBACK_CENTER = (18.5, 55.2, 20.1)
NO_CHANGE = "NO_SIGNIFICANT_BINDING_CHANGE"


def confidence(ddg: Column) -> Column:
    return F.when(F.abs(ddg) < 0.5, "LOW").when(F.abs(ddg) >= 1.0, "HIGH").when(ddg.isNotNull(), "MEDIUM")


def confidence_flags(ddg: Column) -> Column:
    return F.when(F.abs(ddg) < 0.5, "LOW_CONFIDENCE_NOISE").when(F.abs(ddg) >= 1.0, "STRONG_DDG_SIGNAL").when(ddg.isNotNull(), "")


def interpretation(ddg: Column, protein_type: str = "efflux_pump") -> Column:
    out = F.when(F.abs(ddg) < 0.5, NO_CHANGE)
    if protein_type == "efflux_pump":
        out = out.when(ddg >= 1.0, "REDUCED_SUBSTRATE_AFFINITY").when(ddg <= -1.0, "INCREASED_SUBSTRATE_AFFINITY")
    return out.when(ddg.isNotNull(), "MODERATE_BINDING_SHIFT")


def triage(status: Column, interp: Column, ddg: Column) -> Column:
    s = F.coalesce(status, F.lit(""))
    return (
        F.when(F.contains(s, F.lit("FAILED_QC")) | F.contains(F.lower(s), F.lit("failed")), "FAILED_QC_or_DockingFailed")
        .when(F.trim(interp) == NO_CHANGE, NO_CHANGE)
        .when(F.abs(ddg) < 0.5, "NearZero_DDG")
        .otherwise("Shift_or_Other")
    )


def network_label(first: Column, second: Column) -> Column:
    return F.when(F.coalesce(second, F.lit("")) == "", first).otherwise(F.concat_ws(" + ", first, second))


def three_letter(residue: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in THREE_LETTERS.items() for x in kv)), F.upper(residue))


def chain_map(text: Column) -> Column:
    """gene:chain,gene:chain as a map; pairs that lack a part are dropped, of equal genes the last counts."""
    parts = F.filter(F.split(text, ","), lambda x: x.rlike(r"^\s*[^:\s][^:]*:\s*\S+\s*$"))
    pairs = F.transform(parts, lambda x: F.struct(F.lower(F.trim(F.split(x, ":", 2)[0])).alias("key"), F.trim(F.split(x, ":", 2)[1]).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def parse_token(token: Column, chains: Column | None = None) -> Column:
    """gene:A1B as struct(gene, token, chain, residue, label OLD3-residue-NEW3); null where it isn't one. No stops; any case."""
    gene, text = F.lower(F.trim(F.split(token, ":", 2)[0])), F.trim(F.split(token, ":", 2)[1])
    letters = "".join(THREE_LETTERS)
    part = lambda k: F.regexp_extract(text, r"^([A-Za-z])(\d+)([A-Za-z])$", k)
    chain = F.coalesce(F.try_element_at(chains, gene), F.lit("A")) if chains is not None else F.lit("A")
    whole = F.struct(
        gene.alias("gene"), F.upper(text).alias("token"), chain.alias("chain"), part(2).alias("residue"),
            F.concat_ws("-", three_letter(part(1)), part(2), three_letter(part(3))).alias("label")
    )
    return F.when(F.contains(token, F.lit(":")) & F.upper(text).rlike(rf"^[{letters}]\d+[{letters}]$"), whole)


def flexible_residues(tokens: Column) -> Column:
    """chain:residue of each parsed token, the first of equal ones, comma-separated."""
    return F.array_join(F.array_distinct(F.transform(tokens, lambda t: F.concat_ws(":", t["chain"], t["residue"]))), ",")


def three_places(x: Column) -> Column:
    return F.when(x.isNull(), "N/A").otherwise(F.format_string("%.3f", x))


def pocket_center(gene: Column, fallback: tuple[float, float, float] = FALLBACK_CENTER, override: tuple[float, float, float] | None = None) -> Column:
    """Centre of the docking box: the user's, else the gene's, else the fallback."""
    if override is not None:
        x = override
        return F.struct(*(F.lit(float(v)).alias(f"center_{a}") for a, v in zip("xyz", x, strict=True)))
    out = None
    for g, xyz in POCKET_CENTERS.items():
        own = F.struct(*(F.lit(v).alias(f"center_{a}") for a, v in zip("xyz", xyz, strict=True)))
        out = F.when(F.lower(gene) == g, own) if out is None else out.when(F.lower(gene) == g, own)
    return out.otherwise(F.struct(*(F.lit(v).alias(f"center_{a}") for a, v in zip("xyz", fallback, strict=True))))
