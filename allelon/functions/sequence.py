"""Sequence expressions: reverse complement, translation, sub-sequences. All but the translation, which works on Arrow batches, stay in the JVM."""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard genetic code (bases in the order TCAG) and the IUPAC letters with what they stand for.
CODE_BASES = "TCAG"
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT",
    "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}


@lru_cache(maxsize=1)
def codons() -> dict[str, str]:
    return dict(zip(map("".join, product(CODE_BASES, repeat=3)), CODE, strict=True))


@lru_cache(maxsize=1)
def wide_codons() -> dict[str, str]:
    """Codons of IUPAC letters whose expansions all give the same residue, the plain ones included."""
    out = {}
    for c in product(IUPAC, repeat=3):
        found = {codons()["".join(x)] for x in product(*(IUPAC[b] for b in c))}
        if len(found) == 1:
            out["".join(c)] = found.pop()
    return out


def complement_letters() -> tuple[str, str]:
    """Letters and their complements, upper and lower case."""
    by_set = {frozenset(v): k for k, v in IUPAC.items()}
    pair = {"A": "T", "T": "A", "C": "G", "G": "C"}
    upper = "".join(IUPAC)
    other = "".join(by_set[frozenset(pair[b] for b in IUPAC[k])] for k in upper)
    return upper + upper.lower(), other + other.lower()


def reverse_complement(seq: Column) -> Column:
    a, b = complement_letters()
    return F.reverse(F.translate(seq, a, b))


@lru_cache(maxsize=2)
def _codon_table(ambiguous: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(letter to number, codon number to residue, how many numbers there are) of capitals; the last number stands for all other letters."""
    table, letters = (wide_codons(), "".join(IUPAC)) if ambiguous else (codons(), CODE_BASES)
    n = len(letters) + 1
    number, out = np.full(128, n - 1, np.uint16), np.full(n**3, ord("X"), np.uint8)
    for i, c in enumerate(letters):
        number[ord(c)] = i
    for codon, residue in table.items():
        a, b, c = (letters.index(x) for x in codon)
        out[(a * n + b) * n + c] = ord(residue)
    return number, out, n


def _residues(letters: np.ndarray, ambiguous: bool) -> np.ndarray:
    """The residue of the codon that starts at each letter (below 128)."""
    number, table, n = _codon_table(ambiguous)
    b = number[letters]
    return table[(b[:-2] * np.uint16(n) + b[1:-1]) * np.uint16(n) + b[2:]] if len(b) > 2 else np.empty(0, np.uint8)


def proteins(seqs: pa.Array, ambiguous: bool = False, together: int = 1 << 21) -> pa.Array:
    """The proteins of DNA in capitals, frame 0. Letters that aren't ASCII count as one letter each."""
    n = len(seqs)
    wide = np.flatnonzero(pc.fill_null(pc.not_equal(pc.utf8_length(seqs), pc.binary_length(seqs)), False).to_numpy(zero_copy_only=False))
    if len(wide):
        plain = lambda s: "".join(c if c < "\x80" else "?" for c in s)
        odd = set(wide.tolist())
        seqs = pa.array([plain(s) if k in odd else s for k, s in enumerate(seqs.to_pylist())], pa.string())
    ends = pc.fill_null(pc.binary_length(seqs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.concatenate([[0], np.cumsum(ends // 3)])
    if not out[-1]:
        return pc.if_else(pc.is_valid(seqs), pa.scalar(""), pa.scalar(None, pa.string()))
    starts = np.frombuffer(seqs.buffers()[1], np.int32)[seqs.offset : seqs.offset + n].astype(np.int64)
    text, own, k = np.frombuffer(seqs.buffers()[2], np.uint8), np.empty(out[-1], np.uint8), 0
    while k < n:  # some rows at once, one longer row alone
        to = max(k + 1, int(np.searchsorted(starts, starts[k] + together)))
        found = _residues(text[starts[k] : starts[to - 1] + ends[to - 1]], ambiguous)
        for i in range(k, to):
            at = starts[i] - starts[k]
            own[out[i] : out[i + 1]] = found[at : at + 3 * (out[i + 1] - out[i]) : 3]
        k = to
    got = pa.StringArray.from_buffers(n, pa.py_buffer(out.astype(np.int32)), pa.py_buffer(own))
    return pc.if_else(pc.is_valid(seqs), got, pa.scalar(None, pa.string())) if seqs.null_count else got


def _proteins(seqs: pa.Array) -> pa.Array:
    return proteins(seqs)


def _wide_proteins(seqs: pa.Array) -> pa.Array:
    return proteins(seqs, True)


def translate_dna(seq: Column, frame: int = 0, ambiguous: bool = False) -> Column:
    """Protein of a frame (0, 1, 2): unknown codons give X, a partial last codon is dropped.

    With ``ambiguous``, IUPAC codons are resolved where all that they stand for agree.
    """
    own = F.substring(seq, frame + 1, 2**31 - 1)
    own = F.upper(F.regexp_replace(own, "[Uu]", "T") if ambiguous else own)
    # A function named here goes to the workers by its name.
    return F.arrow_udf(_wide_proteins if ambiguous else _proteins, "string")(own)


def protein_table11(seq: Column) -> Column:
    """Protein by table 11 without its final stops; null where nothing is left."""
    out = F.regexp_replace(translate_dna(seq, ambiguous=True), r"\*+$", "")
    return F.when(out != "", out)


def subsequence(seq: Column, start: Column, end: Column) -> Column:
    """1-based, both ends included; null for a start below 1 or an end before it, cut at the end of the sequence."""
    return F.when((start >= 1) & (end >= start), F.substring(seq, start.cast("int"), (end - start + 1).cast("int")))


def ungapped(seq: Column) -> Column:
    """Without alignment gaps; null where nothing is left."""
    out = F.regexp_replace(seq, "-", "")
    return F.when(out != "", out)


def residue_positions(ref: Column, query: Column) -> Column:
    """Array of substitutions (wild type, position, mutant) of two aligned strings; the position counts residues of ``ref``."""
    letters = F.arrays_zip(F.split(ref, "").alias("wt"), F.split(query, "").alias("mut"))
    # Without the gaps of ref, a place in the array is the position.
    own = F.transform(F.filter(letters, lambda x: x["wt"] != "-"), lambda x, i: F.struct(x["wt"].alias("wt"), (i + 1).alias("position"), x["mut"].alias("mut")))
    return F.filter(own, lambda r: (r["wt"] != r["mut"]) & (r["mut"] != "-") & (r["wt"] != "") & (r["mut"] != ""))
