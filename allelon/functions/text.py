"""Text expressions: Python-like strip, location cleaning, tokens of the form gene:mutation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends (trim only drops blanks)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def clean_location(c: Column) -> Column:
    """The place after the first colon, without bracketed notes, with single blanks; Unknown where nothing is left."""
    after = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?s)^[^:]*:", "")
    plain = F.regexp_replace(F.regexp_replace(after, r"\s*\([^)]*\)", ""), r"\s+", " ")
    bare = F.btrim(plain, F.lit(" ,;-"))
    return F.when(bare == "", F.lit("Unknown")).otherwise(bare)


def mutation_token(gene: Column, mutation: Column) -> Column:
    return F.concat_ws(":", F.lower(strip(gene)), strip(mutation))


def before_colon(c: Column) -> Column:
    """What stands before the first colon; null without one."""
    return F.when(F.contains(c, F.lit(":")), F.split(c, ":", 2)[0])


def after_colon(c: Column) -> Column:
    """What stands after the first colon; all of it without one."""
    return F.when(F.contains(c, F.lit(":")), F.split(c, ":", 2)[1]).otherwise(c)


def gene_class(gene: Column) -> Column:
    return F.when(gene.isin("marr", "acrr"), "regulatory").when(gene.isin("acra", "acrb", "tolc"), "structural").otherwise("other")
