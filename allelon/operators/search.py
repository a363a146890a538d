"""Translated search: proteins in the six frames of contigs, by seeds of similar words.

A word of ``k`` residues of a contig is a seed for every place of a reference whose word scores ``least`` or more with it. Two seeds on one diagonal,
apart by ``k`` to ``apart`` residues, whose diagonal scores ``TRIGGER`` or more about them without gaps, make a candidate, together with those nearby. It is scored in a window of rows and diagonals about its
seeds, which is widened as long as an alignment through the seeds reaches the window's edge, from either end, with a score above zero and no
more than ``DROP`` below its best so far, unless what leaves the window can't be better than what its genome has already.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.functions.scoring import RESIDUES
from allelon.functions.sequence import CODE_BASES, codons
from allelon.operators.alignment import LETTERS, coded, local_align, matrix
from allelon.storage import store

K, LEAST, APART, DROP = 5, 19, 40, 38
NEAR_DIAGONALS, NEAR_PLACES = 16, 64  # seeds of one candidate
TRIGGER, ABOUT = 41, 64  # least score without gaps (22 bits with BLOSUM62), over so many residues on each side
FIRST, MORE = 12, 1
UNKNOWN, STOP, WALL = LETTERS.index("X"), LETTERS.index("*"), len(LETTERS)
N_WORDS = len(RESIDUES) ** K
#: Bases that are looked through at once, and bases of contigs whose candidates wait to be scored together.
TOGETHER, WAITING = 1 << 18, 1 << 24


def known_letters(protein: str) -> str:
    """A protein in capitals, letters that the matrix doesn't have as X."""
    return "".join(c if c in LETTERS else "X" for c in protein.upper())


@lru_cache(maxsize=1)
def _base_numbers() -> np.ndarray:
    """Byte to base (in the order of the genetic code's table), 4 for anything else."""
    out = np.full(256, 4, np.uint8)
    for i, b in enumerate(CODE_BASES):
        out[ord(b)] = out[ord(b.lower())] = i
    return out


@lru_cache(maxsize=1)
def _residue_numbers() -> np.ndarray:
    """Codon number, with five values a base, to letter number; X where a base isn't known."""
    out = np.full(125, UNKNOWN, np.uint8)
    for codon, residue in codons().items():
        a, b, c = (CODE_BASES.index(x) for x in codon)
        out[a * 25 + b * 5 + c] = LETTERS.index(residue)
    return out


def bases(seq: str) -> np.ndarray:
    return _base_numbers()[np.frombuffer(seq.encode("latin-1", "replace"), np.uint8)]


def turned(own: np.ndarray) -> np.ndarray:
    """The other strand of bases by number: T and A, C and G are pairs."""
    return np.array([2, 3, 0, 1, 4], np.uint8)[own[::-1]]


def residues(own: np.ndarray, frame: int, low: int = 0, high: int | None = None) -> np.ndarray:
    """Letter numbers of the residues ``low`` to ``high`` of one frame (0, 1, 2) of a strand."""
    count = max(0, (len(own) - frame) // 3)
    high = count if high is None else min(high, count)
    part = own[frame + 3 * low : frame + 3 * max(low, high)].reshape(-1, 3).astype(np.int64)
    return _residue_numbers()[part @ np.array([25, 5, 1])]


class Words:
    """The places of references by each similar word: those of word w stand from ``starts[w]`` to ``starts[w + 1]``."""

    def __init__(self, refs: list[str], least: int = LEAST):
        score = matrix()[: len(RESIDUES), : len(RESIDUES)].astype(np.int16)
        own, ref, place = [], [], []
        codes = self.codes = [coded(known_letters(r)) for r in refs]
        # A residue scores most with itself alone, so a reference of such residues has its best score only where it stands as it is.
        self.plain = np.array([len(c) >= 2 * K and bool((c < len(RESIDUES)).all()) for c in codes], bool)
        gap = np.full(ABOUT + K, WALL)
        self.letters = np.concatenate([gap, *(x for c in codes for x in (c, gap))])
        self.begin = np.cumsum([len(gap), *(len(c) + len(gap) for c in codes)])
        for g, c in enumerate(codes):
            if len(c) < K:
                continue
            w = np.lib.stride_tricks.sliding_window_view(c, K)
            at = np.flatnonzero((w < len(RESIDUES)).all(1))
            own.append(w[at])
            ref.append(np.full(len(at), g))
            place.append(at)
        letters = np.concatenate([*own, np.empty((0, K), np.int64)])
        ref, place = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int32) for x in (ref, place))
        # Letter by letter, only beginnings whose best end still reaches the score.
        most = np.zeros((len(letters), K + 1), np.int16)
        for j in range(K - 1, -1, -1):
            most[:, j] = most[:, j + 1] + score.max(1)[letters[:, j]]
        who, word, total = np.arange(len(letters)), np.zeros(len(letters), np.int64), np.zeros(len(letters), np.int16)
        for j in range(K):
            new = total[:, None] + score[letters[who, j]]
            a, b = np.nonzero(new + most[who, j + 1][:, None] >= least)
            who, word, total = who[a], word[a] * len(RESIDUES) + b, new[a, b]
        order = np.argsort(word, kind="stable")
        self.ref, self.place = ref[who[order]], place[who[order]]
        count = np.bincount(word, minlength=N_WORDS)
        self.shifts, self.most = {}, max(map(len, codes), default=0)
        self.known, self.starts = count > 0, np.concatenate([[0], np.cumsum(count)]).astype(np.int32)

    def words(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first base, word) of the words that some place has, in order of the base; given is the residue that starts at each base."""
        bases, found = [], []
        for low in range(0, max(0, len(codes) - 3 * (K - 1)), TOGETHER):
            r = codes[low : low + TOGETHER + 3 * (K - 1)]
            n = len(r) - 3 * (K - 1)
            known = r < len(RESIDUES)
            good, word = known[:n].copy(), r[:n].astype(np.int32)
            for j in range(1, K):
                good &= known[3 * j : 3 * j + n]
                word *= len(RESIDUES)
                word += r[3 * j : 3 * j + n]
            at = np.flatnonzero(good)
            word = word[at]
            some = self.known[word]  # a small table first
            bases.append(at[some] + low)
            found.append(word[some])
        return np.concatenate([np.empty(0, np.int64), *bases]), np.concatenate([np.empty(0, np.int32), *found])

    def _shifts(self, wide: int, room: int) -> np.ndarray:
        """What a place adds to the number of a seed (see candidates), kept for the last sizes."""
        if (wide, room) not in self.shifts:
            if len(self.shifts) > 2:
                self.shifts.clear()
            self.shifts[wide, room] = (self.ref.astype(np.int64) * (3 * wide) - self.place) * room
        return self.shifts[wide, room]

    def _ungapped(self, codes: np.ndarray, first: np.ndarray, ref: np.ndarray, place: np.ndarray, together: int = 1 << 10) -> np.ndarray:
        """The best score without gaps of stretches of each seed's diagonal that take in the seed, whose first base is given. Walls in ``codes`` part the contigs."""
        score = np.pad(matrix(), ((0, 1), (0, 1)), constant_values=-1e4).astype(np.float32).reshape(-1)
        steps, side = np.arange(-ABOUT, ABOUT + K), np.full(3 * (ABOUT + K), WALL, np.uint8)
        rows = np.concatenate([side, codes, side]).astype(np.int16) * np.int16(WALL + 1)
        first, place = first + len(side), self.begin[ref] + place
        out = np.zeros(len(first), np.float32)
        for i in range(0, len(first), together):
            k = slice(i, i + together)
            pair = score[rows[first[k, None] + 3 * steps] + self.letters[place[k, None] + steps]]
            word, left, right = pair[:, ABOUT : ABOUT + K].sum(1), pair[:, :ABOUT][:, ::-1], pair[:, ABOUT + K :]
            out[k] = word + sum(np.maximum(np.cumsum(x, axis=1).max(1), 0) for x in (left, right))
        return out

    def _whole(self, own: np.ndarray, last: np.ndarray, begin: np.ndarray, ref: np.ndarray) -> np.ndarray:
        """Whether the reference stands before the end of each seed, whose first base is given with its contig's."""
        out = np.zeros(len(last), bool)
        for k, (base, low, r) in enumerate(zip(last.tolist(), begin.tolist(), ref.tolist(), strict=True)):
            start = base - 3 * (len(self.codes[r]) - K)
            out[k] = start >= low and np.array_equal(residues(own[start : base + 3 * K], 0), self.codes[r])
        return out

    def candidates(self, contigs: list[np.ndarray], apart: int = APART) -> tuple[list[tuple[int, ...]], list[tuple[int, int, int, int]]]:
        """(contig, frame, reference, lowest and highest diagonal, first place in the reference, one after the last) of one strand of several contigs,
        and (contig, frame, reference, first residue) of those among them that are a whole reference as it is.

        A diagonal is a place in the frame less one in the reference. An unknown base parts the contigs, so no word lies in two.
        """
        gap = np.full(1, 4, np.uint8)
        own = np.concatenate([x for c in contigs for x in (c, gap)])
        sizes = np.array([len(c) for c in contigs])
        starts = np.cumsum(sizes + 1) - sizes - 1
        b = own.astype(np.uint8)
        codes = _residue_numbers()[b[:-2] * np.uint8(25) + b[1:-1] * np.uint8(5) + b[2:]] if len(b) > 2 else np.empty(0, np.uint8)
        base, word = self.words(codes)
        if not len(base):
            return [], []
        contig = np.searchsorted(starts, base, "right") - 1
        within = base - starts[contig]
        at = within // 3
        frame = within - 3 * at
        # One number a diagonal of a contig's frame and reference, with room for places. Round sizes keep what the places add, where they fit.
        most = int(at.max())
        low, wide, room = -self.most, most + self.most + 1, most + apart + 1
        if len(contigs) * len(self.begin) * 12 * wide * room < 1 << 60:
            wide, room = 1 << wide.bit_length(), 1 << room.bit_length()
        size = (self.starts[word + 1] - self.starts[word]).astype(np.int64)
        ends = np.cumsum(size)
        source = np.repeat(self.starts[word] - ends + size, size) + np.arange(ends[-1])
        number = np.repeat(((contig * (3 * len(self.begin)) + frame) * wide + (at - low)) * room + at, size) + self._shifts(wide, room)[source]
        number.sort()
        near = number[1:][np.diff(number) <= apart]
        # The first seed on the diagonal within reach lies a word's length or more before.
        near = near[near - number[np.searchsorted(number, near - apart)] >= K]
        group, at = near // room, near % room
        group, diagonal = group // wide, group % wide + low
        frame, ref, contig, place = group % 3, group // 3 % len(self.begin), group // 3 // len(self.begin), at - diagonal
        base = starts[contig] + 3 * at + frame
        ends = (starts + sizes)[:, None] - [2, 1, 0]
        codes[ends[(ends >= 0) & (ends < len(codes))]] = WALL  # no stretch leaves its contig
        hit = np.flatnonzero(self._ungapped(codes, base, ref, place) >= TRIGGER)
        if not len(hit):
            return [], []
        size = (self.begin[1:] - self.begin[:-1] - ABOUT - K)[ref[hit]]
        last = hit[self.plain[ref[hit]] & (place[hit] == size - K)]
        last = last[self._whole(own, base[last], starts[contig[last]], ref[last])]
        whole = list(zip(contig[last].tolist(), frame[last].tolist(), ref[last].tolist(), diagonal[last].tolist(), strict=True))
        group, diagonal, place = group[hit], diagonal[hit], place[hit]
        order = np.lexsort((diagonal, group))
        group, diagonal, place = group[order], diagonal[order], place[order]
        near = np.cumsum((np.diff(group, prepend=-1) != 0) | (np.diff(diagonal, prepend=0) > NEAR_DIAGONALS))
        order = np.lexsort((place, near))
        group, diagonal, place, near = group[order], diagonal[order], place[order], near[order]
        first = np.flatnonzero((np.diff(near, prepend=0) != 0) | (np.diff(place, prepend=0) > NEAR_PLACES))
        last = np.append(first[1:], len(group)) - 1
        low, high = np.minimum.reduceat(diagonal, first), np.maximum.reduceat(diagonal, first)
        group = group[first]
        columns = (group // 3 // len(self.begin), group % 3, group // 3 % len(self.begin), low, high, place[first], place[last] + K)
        return list(zip(*(c.tolist() for c in columns), strict=True)), whole


def window_scores(a: np.ndarray, b: np.ndarray, boxes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(score, reaches the side, reaches the end) of lanes of one size, of the alignments that touch each lane's box.

    Row r of a lane has its reference's letter a[r] and, on diagonal d, its contig's letter b[r + d]; a box is (first row, one after its last, first
    diagonal, one after its last). Two tables are kept: of all local alignments, and of those that have touched the box. A lane ends where, behind
    its box, the latter lie more than DROP below their best.
    """
    lanes, rows = a.shape
    width = b.shape[1] - rows + 1
    score = np.pad(matrix(), ((0, 1), (0, 1)), constant_values=-1e4).astype(np.float32).reshape(-1)
    # A row of an array is a diagonal (or a place) of all lanes, so that steps from one to the next are on whole blocks.
    letters, rest = np.ascontiguousarray(a.T) * (WALL + 1), np.ascontiguousarray(b.T)
    place = np.repeat(np.arange(width, dtype=np.float32) * MORE, lanes).reshape(width, lanes)
    back = place[1:] - MORE + FIRST
    d = np.arange(width)[:, None]
    inside = (d >= boxes[:, 2]) & (d < boxes[:, 3])
    first, last = int(boxes[:, 0].min()), int(boxes[:, 1].max())
    best, touched = np.zeros((width, lanes), np.float32), np.full((width, lanes), -1e6, np.float32)
    down, down_touched, reach, other, pair, at = np.full_like(touched, -1e6), np.full_like(touched, -1e6), np.empty_like(touched), np.empty_like(touched), np.empty_like(touched), np.empty(touched.shape, np.intp)
    top, side, ends = np.zeros(lanes, np.float32), np.zeros(lanes, bool), np.zeros(lanes, bool)
    lane, own_top = np.arange(lanes), np.zeros(lanes, np.float32)

    def step(own: np.ndarray, gap: np.ndarray) -> None:
        """The next row of a table but for gaps across: a pair, or a gap down, which comes from the next diagonal."""
        np.subtract(gap[1:], MORE, out=gap[:-1])
        gap[-1] = -1e6
        np.subtract(own[1:], FIRST, out=reach[1:])
        np.maximum(gap[:-1], reach[1:], out=gap[:-1])
        np.add(own, pair, out=own)
        np.maximum(own, gap, out=own)

    def across(own: np.ndarray) -> None:
        """Gaps across start at any diagonal before: a running maximum, by steps that double."""
        most, free, k = np.add(own, place, out=reach), other, 1
        while k < width - 1:
            np.maximum(most[k:], most[:-k], out=free[k:])
            free[:k] = most[:k]
            most, free, k = free, most, 2 * k
        np.subtract(most[:-1], back, out=free[:-1])
        np.maximum(own[1:], free[:-1], out=own[1:])

    for r in range(rows):
        np.add(rest[r : r + width], letters[r], out=at)
        np.take(score, at, out=pair, mode="clip")
        if r < last:  # below all boxes only what has touched one counts
            step(best, down)
            np.maximum(best, 0, out=best)
        if r >= first:
            step(touched, down_touched)
            if r < last and (live := (boxes[:, 0] <= r) & (r < boxes[:, 1])).any():
                np.copyto(touched, best, where=inside & live)
            across(touched)
            most = touched.max(0)
            np.maximum(own_top, most, out=own_top)
            floor = np.maximum(own_top - DROP, 0)
            side[lane] |= np.maximum(touched[0], touched[-1]) > floor
            alive = (most > floor) | (r < boxes[lane, 1])
            if not alive.all():
                np.copyto(touched, -1e6, where=~alive)
                np.copyto(down_touched, -1e6, where=~alive)
            if r >= last and np.count_nonzero(alive) < 0.6 * len(alive):
                top[lane] = own_top
                lane, own_top = lane[alive], own_top[alive]
                if not len(lane):
                    break
                touched, down_touched, letters, rest, place, back = (np.ascontiguousarray(x[:, alive]) for x in (touched, down_touched, letters, rest, place, back))
                reach, other, pair, at = np.empty_like(touched), np.empty_like(touched), np.empty_like(touched), np.empty(touched.shape, np.intp)
        if r < last:
            across(best)
    top[lane] = own_top
    ends[lane] = touched.max(0) > np.maximum(own_top - DROP, 0) if len(lane) else False
    return top.astype(np.int64), side, ends


def _rounded(size: int, unit: int) -> int:
    """The next of unit, 3/2 unit, 2 unit, 3 unit, 4 unit and so on, so that windows have few sizes."""
    n = unit
    while n < size:
        n = n * 3 // 2 if (n & (n - 1)) == 0 else n // 3 * 4
    return n


def best_scores(refs: list[str]) -> list[int]:
    """What each reference can score at most."""
    return [int(np.maximum(matrix().max(1), 0)[coded(known_letters(r))].sum()) for r in refs]


class Scorer:
    """Scores candidates of many contigs together; what a genome has already found of a reference leaves out what can't be better."""

    def __init__(self, refs: list[str]):
        self.refs = [coded(known_letters(r)) for r in refs]
        self.most = best_scores(refs)
        self.best: dict[tuple, int] = {}

    def _window(self, candidate: tuple, rows: int, band: int) -> tuple[int, int, int, int]:
        """First row, number of rows, first diagonal, number of diagonals, in steps so that many candidates are of one size."""
        ref, low, high, first, last = candidate[4:9]
        row = max(0, first - rows)
        size, width = min(len(self.refs[ref]), last + rows) - row, high - low + 1 + 2 * band
        return row, _rounded(size, 32), low - band, _rounded(width, 64)

    def _run(self, candidates: list[tuple], windows: list[tuple], turn: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """window_scores of candidates with windows of one size; with ``turn``, from the other end."""
        _, rows, _, width = windows[0]
        a, b = np.full((len(windows), rows), WALL), np.full((len(windows), rows + width - 1), WALL)
        boxes = np.zeros((len(windows), 4), np.int64)
        for k, ((_, _, own, frame, ref, low, high, first, last), (row, _, diagonal, _)) in enumerate(zip(candidates, windows, strict=True)):
            r = self.refs[ref]
            part = r[max(0, row) : row + rows]
            a[k, max(0, -row) : max(0, -row) + len(part)] = part
            at = row + diagonal
            part = residues(own, frame % 3, max(0, at), max(0, at + rows + width - 1))
            b[k, max(0, -at) : max(0, -at) + len(part)] = part
            boxes[k] = first - row, last - row, low - diagonal, high - diagonal + 1
        if turn:
            a, b = a[:, ::-1], b[:, ::-1]
            boxes = np.stack([rows - boxes[:, 1], rows - boxes[:, 0], width - boxes[:, 3], width - boxes[:, 2]], 1)
        return window_scores(a, b, boxes)

    def score(self, waiting: list[tuple], cells: int = 1 << 14) -> Iterator[tuple]:
        """(row, frame, reference, score, low, high, strand's bases) for each candidate that may be its genome's best, with its window's residues.

        A candidate: row, genome, strand's bases, frame, reference, lowest and highest diagonal, first place and one after the last.
        """
        if len(self.best) > 1 << 20:
            self.best.clear()  # it only saves work
        room = [(32, 28)] * len(waiting)  # rows and diagonals on each side
        while waiting:
            sizes: dict[tuple, list[int]] = {}
            windows = [self._window(c, *x) for c, x in zip(waiting, room, strict=True)]
            for k, (_, size, _, width) in enumerate(windows):
                sizes.setdefault((size, width), []).append(k)
            score, taller, wider = np.zeros(len(waiting), np.int64), np.zeros(len(waiting), bool), np.zeros(len(waiting), bool)
            for (_, width), own in sizes.items():
                step = max(1, cells // width)
                for part in (own[i : i + step] for i in range(0, len(own), step)):
                    for turn in (False, True):
                        if turn:  # a window that has to grow anyway isn't run from its other end
                            part = [k for k in part if not (taller[k] or wider[k])]
                        if not part:
                            continue
                        top, side, end = self._run([waiting[k] for k in part], [windows[k] for k in part], turn)
                        score[part] = np.maximum(score[part], top)
                        wider[part] |= side
                        # Past the reference's end there is nothing to reach.
                        over = [windows[k][0] > 0 if turn else windows[k][0] + windows[k][1] < len(self.refs[waiting[k][4]]) for k in part]
                        taller[part] |= end & np.array(over)
            for c, s in zip(waiting, score.tolist(), strict=True):
                self.best[c[1], c[4]] = max(s, self.best.get((c[1], c[4]), 0))
            more, wide = [], []
            for k, (c, s, (row, size, diagonal, width)) in enumerate(zip(waiting, score.tolist(), windows, strict=True)):
                at, genome, own, frame, ref = c[:5]
                least = self.best[genome, ref]
                # What leaves by a side has at least so long a gap; what leaves by an end has all that the reference can score.
                rows, band = room[k]
                outside = self.most[ref] - (0 if taller[k] else FIRST + MORE * band)
                if (taller[k] or wider[k]) and outside > s and outside >= least:
                    more.append(c)
                    wide.append((rows * 3 if taller[k] else rows, band * 2 if wider[k] else band))
                elif s >= least:
                    count = (len(own) - frame % 3) // 3
                    yield at, frame, ref, s, max(0, row + diagonal), min(count, row + diagonal + size + width - 1), own
            waiting, room = more, wide


def _parts(refs: DataFrame, residues_of_part: int) -> list[list[tuple[str, str]]]:
    """The references (gene, seq) in parts of about so many residues; the driver holds one part at a time."""
    rows = refs.where("seq IS NOT NULL AND seq <> '' AND gene IS NOT NULL")
    total, count = rows.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)), F.count("*")).first()
    n = max(1, min(count, -(-total // max(1, residues_of_part))))
    for k in range(n):
        own = rows.where(F.pmod(F.xxhash64("gene"), F.lit(n)) == k) if n > 1 else rows
        yield sorted((r["gene"], r["seq"]) for r in own.select("gene", "seq").collect())


def translated_search(contigs: DataFrame, refs: DataFrame, keys: list[str], genome: str, least: int = LEAST, broadcast_residues: int = 1 << 16,
    wanted: DataFrame | None = None) -> DataFrame:
    """(keys, frame, gene, score, seq): the best local alignment of each reference protein (gene, seq) in each genome (BLOSUM62, gap 11 and 1).

    ``contigs`` has ``keys``, among them ``genome``, and seq. What is searched are the candidates of the seeds (see above), which are found
    where the contig is; contigs that have some are stored with them. A genome that has the whole reference as it is somewhere can't have a better alignment, so
    none of its other candidates is scored. With ``wanted`` (genome, gene) only those pairs are scored and returned. A contig may be of any length. Of equal scores the first contig
    and frame count; frames 3 to 5 are of the other strand. seq is the contig's part of the alignment without gaps. References are broadcast as a word table in parts of
    about ``broadcast_residues`` residues, which is some 140 places a residue; more references take a pass over the contigs for each part.
    A word with an unknown residue (X) or a stop is no seed. Genomes without a candidate have no row for the gene; contigs with a null key aren't searched.
    """
    spark = contigs.sparkSession
    kinds = ", ".join(f"`{c}` {contigs.schema[c].dataType.simpleString()}" for c in keys)
    own = contigs.dropna(subset=[*keys, "seq"]).select(*keys, "seq")
    at, found = keys.index(genome), None
    for genes in _parts(refs, broadcast_residues):
        names = [g for g, _ in genes]
        table = spark.sparkContext.broadcast((Words([s for _, s in genes], least), [s for _, s in genes]))

        def find(batches: Iterator[pd.DataFrame], table=table) -> Iterator[pd.DataFrame]:
            """Contigs with their candidates (six numbers each), and whole references."""
            words, done = table.value[0], set()

            def look(held: list[tuple]) -> pd.DataFrame:
                boxes, out = {}, []
                for strand in (0, 3):
                    some, whole = words.candidates([turned(b) if strand else b for _, b, _ in held])
                    for k, frame, ref, low in whole:
                        done.add((held[k][0][at], ref))
                        out.append((*held[k][0], None, None, strand + frame, ref, low))
                    for k, frame, *box in some:
                        boxes.setdefault(k, []).append((strand + frame, *box))
                for k, some in boxes.items():
                    if left := [x for box in some if (held[k][0][at], box[1]) not in done for x in box]:
                        out.append((*held[k][0], held[k][2], left, None, None, None))
                if len(done) > 1 << 20:
                    done.clear()  # it only saves room
                return pd.DataFrame(out, columns=[*keys, "seq", "boxes", "frame", "ref", "low"]).astype({"frame": "Int32", "ref": "Int32", "low": "Int64"})

            for pdf in batches:
                held, n = [], 0
                for own_keys, seq in zip(pdf[keys].itertuples(index=False, name=None), pdf["seq"], strict=True):
                    held.append((own_keys, bases(seq), seq))
                    n += len(seq) + 1
                    if n >= TOGETHER:
                        yield look(held)
                        held, n = [], 0
                if held:
                    yield look(held)

        def score(batches: Iterator[pd.DataFrame], names=names, table=table) -> Iterator[pd.DataFrame]:
            proteins = table.value[1]
            scorer, waiting, rows, size, letters = Scorer(proteins), [], [], 0, np.array(list(LETTERS))

            def flush() -> pd.DataFrame:
                out = [(*rows[r], f, names[g], s, low, "".join(letters[residues(own, f % 3, low, high)])) for r, f, g, s, low, high, own in scorer.score(waiting)]
                waiting.clear()
                rows.clear()
                return pd.DataFrame(out, columns=[*keys, "frame", "gene", "score", "low", "part"])

            for pdf in batches:
                for own_keys, seq, boxes, done, asked in zip(pdf[keys].itertuples(index=False, name=None), pdf["seq"], pdf["boxes"], pdf["done"], pdf["asked"], strict=True):
                    boxes = np.asarray(boxes).reshape(-1, 6)
                    boxes = boxes if done is None else boxes[~np.isin(boxes[:, 1], done)]
                    boxes = boxes if asked is None else boxes[np.isin(boxes[:, 1], asked)]
                    if not len(boxes):
                        continue
                    strands = [bases(seq)]
                    if (boxes[:, 0] > 2).any():
                        strands.append(turned(strands[0]))
                    waiting += [(len(rows), own_keys[at], strands[box[0] // 3], *box) for box in boxes.tolist()]
                    rows.append(own_keys)
                    size += 2 * len(seq)
                    if size > WAITING or len(waiting) > 1 << 14:
                        yield flush()
                        size = 0
            yield flush()

        first = store(own.mapInPandas(find, f"{kinds}, seq string, boxes array<int>, frame int, ref int, low long"), "search-candidates")
        whole = first.where("ref IS NOT NULL")
        done = store(whole.groupBy(genome).agg(F.collect_set("ref").alias("done")), "search-whole")
        listed = spark.createDataFrame([(k, g, int(s), known_letters(p)) for k, ((g, p), s) in enumerate(zip(genes, best_scores([p for _, p in genes]), strict=True))],
            "ref int, gene string, score long, part string")
        rest = first.where("seq IS NOT NULL").select(*keys, "seq", "boxes").join(done, genome, "left")
        if wanted is None:
            rest = rest.withColumn("asked", F.lit(None).cast("array<int>"))
        else:
            asked = wanted.join(F.broadcast(listed), "gene").groupBy(genome).agg(F.collect_set("ref").alias("asked"))
            rest = rest.join(store(asked, "search-asked"), genome)
        rest = rest.select(*keys, "seq", "boxes", "done", "asked")
        part = rest.mapInPandas(score, f"{kinds}, frame int, gene string, score long, low long, part string")
        order = F.struct((-F.col("score")).alias("by"), *(c for c in keys if c != genome), "frame", "low", "part")
        part = part.unionByName(whole.join(F.broadcast(listed), "ref").select(*keys, "frame", "gene", "score", "low", "part"))
        part = store(part.groupBy(genome, "gene").agg(F.min(order).alias("b")).select(genome, "gene", "b.*"), "search-best")
        found = part if found is None else found.unionByName(part)

    def align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [local_align(ref, part) for ref, part in zip(pdf["ref"], pdf["part"], strict=True)]
            yield pdf[[*keys, "frame", "gene"]].assign(score=[float(s) for s, _ in got], seq=[p for _, p in got])

    found = found if wanted is None else found.join(wanted.select(genome, "gene"), [genome, "gene"], "left_semi")
    whole = found.join(refs.select("gene", F.col("seq").alias("ref")), "gene").select(*keys, "frame", "gene", "ref", "part")
    return whole.mapInPandas(align, f"{kinds}, frame int, gene string, score double, seq string")
