"""Language identification by unigrams of pieces, summed over all segmentations of each word."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from allelon.llm.common import crc_fold, hidden, kept, parts, shown, texts_of
from allelon.llm.wordcount import word_counts
from allelon.storage import store

#: Letters and letter-like numbers; the latter are taken out afterwards.
_RUNS = re.compile(r"[^\W\d_]+")
#: Probability of a single letter that isn't among the pieces, the same in all languages.
UNKNOWN = 1e-8
UNDETERMINED = "und"
#: Sums over runs with more letters are scaled every STEP letters, as they would leave the range of floats.
SHORT, STEP = 24, 16
#: Letters whose sums are held at once; a longer run is summed on in parts, with the same result.
TOGETHER = 1 << 16
#: Words with more letters aren't kept between batches.
KEPT_LETTERS = 64


def letter_runs(text: str) -> list[str]:
    """Lower-case runs of letters (Unicode's letters; marks and number signs aren't)."""
    found = []
    for w in _RUNS.findall(text.lower()):
        if w.isalpha():
            found.append(w)
        else:
            found += "".join(c if c.isalpha() else " " for c in w).split()
    return found


def fit_runs(text: str) -> list[str]:
    """Letter runs for the fit, in parts of at most TOGETHER letters."""
    return [w[i : i + TOGETHER] for w in letter_runs(text) for i in range(0, len(w), TOGETHER)]


def vocabulary(path: str) -> list[str]:
    """Lower-case letter pieces of a sentencepiece file (others can't occur in lower-case runs); the mark of a word's start is kept."""
    from sentencepiece import SentencePieceProcessor

    own = SentencePieceProcessor(model_file=path)
    pieces = (own.id_to_piece(i) for i in range(own.get_piece_size()))
    return sorted({p for p in pieces if (w := p.removeprefix("▁")) and w.isalpha() and w == w.lower()})


@dataclass
class _Sums:
    """Sums over all segmentations of each prefix. A word has a slot for each of its letters and one for its end.

    ``alpha`` holds the sums times exp(``shift``). Spans, ordered by their end within the word, go from slot ``start`` to
    ``end`` by the piece ``row`` with probabilities ``p``; ``cuts`` parts them into groups whose starts all differ.
    """

    alpha: np.ndarray
    shift: np.ndarray | None
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    p: np.ndarray
    word: np.ndarray
    cuts: list[int]
    last: np.ndarray

    def factor(self, g: slice) -> np.ndarray | float:
        """What makes sums at the starts of spans comparable with those at their ends."""
        return 1.0 if self.shift is None else np.exp(self.shift[self.end[g]] - self.shift[self.start[g]])

    def logs(self) -> np.ndarray:
        return np.log(self.alpha[self.last]) - (0.0 if self.shift is None else self.shift[self.last])


class Unigrams:
    """Piece probabilities of several languages over a fixed vocabulary."""

    def __init__(self, pieces: list[str], probabilities: np.ndarray, languages: list[str]):
        self.languages = languages
        self.pieces = pieces
        n, k = len(pieces), len(languages)
        self.none, self.unknown = n, n + 1
        self.p = np.vstack([probabilities, np.zeros((1, k)), np.full((1, k), UNKNOWN)])
        self.longest = max(map(len, pieces), default=1)
        #: A tree of the pieces: (state, letter) as one sorted number, the state that follows, and the piece that ends in a state.
        tree: dict[int, int] = {}
        ends = {}
        for i, piece in enumerate(pieces):
            state = 0
            for c in piece:
                state = tree.setdefault(state << 21 | ord(c), len(tree) + 1)
            ends[state] = i
        self.arcs = np.array(sorted(tree), np.int64)
        self.target = np.array([tree[x] for x in sorted(tree)], np.int64)
        self.piece_of = np.array([ends.get(x, self.none) for x in range(len(tree) + 1)], np.int64)

    def _spans(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, slots, rows of p): the pieces that start in each slot, and UNKNOWN for other single letters. 0 ends a word."""
        on = np.flatnonzero(codes)
        state = np.zeros(len(on), np.int64)
        for n in range(1, self.longest + 1):
            keys = state << 21 | codes[on + n - 1]
            arc = np.searchsorted(self.arcs, keys)
            known = self.arcs.take(arc, mode="clip") == keys if len(self.arcs) else np.zeros(len(on), bool)
            if n == 1:
                single = np.full(len(on), self.unknown)
                rows = self.piece_of[self.target[arc[known]]]
                single[known] = np.where(rows == self.none, self.unknown, rows)
                yield n, on, single
            on, state = on[known], self.target[arc[known]]
            if n > 1:
                rows = self.piece_of[state]
                hit = rows != self.none
                yield n, on[hit], rows[hit]
            if not len(on):
                return

    def _forward(self, codes: np.ndarray, sizes: np.ndarray, column: np.ndarray | None = None, scaled: bool = False, before: tuple[np.ndarray, np.ndarray] | None = None) -> _Sums:
        """Sums for words of ``sizes`` letters (their mark included), each followed by 0 in ``codes``.

        With ``column``, only for the language of each word. ``before``: sums and shifts that are known for the first slots of a single word.
        """
        first = np.cumsum(sizes + 1) - sizes - 1
        word = np.repeat(np.arange(len(sizes)), sizes + 1)
        lengths, starts, rows = zip(*self._spans(codes), strict=True)
        n = np.repeat(lengths, [len(x) for x in starts])
        start, row = np.concatenate(starts), np.concatenate(rows)
        at = start - first[word[start]] + n
        alone = len(sizes) == 1  # then all spans that end in a slot are summed at once
        key = at if alone else at * (self.longest + 1) + n
        order = np.argsort(key.astype(np.uint16) if key.max() < 1 << 16 else key, kind="stable")
        start, row, at, key, end = start[order], row[order], at[order], key[order], (start + n)[order]
        cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
        p = self.p[row] if column is None else self.p[row, column[word[start]]][:, None]
        alpha = np.zeros((len(codes), p.shape[1]))
        alpha[first] = 1.0
        shift = np.zeros_like(alpha) if scaled else None
        given, now = 0, np.zeros((len(sizes), p.shape[1]))
        if before is not None:
            given = len(before[0]) - 1
            alpha[: given + 1], shift[: given + 1] = before
            now[:] = shift[given]
        out = _Sums(alpha, shift, start, end, row, p, word, cuts, first + sizes)
        ends = at[cuts[:-1]].tolist()
        for i, t in enumerate(ends):
            if t <= given:
                continue
            g = slice(cuts[i], cuts[i + 1])
            s, e = start[g], end[g]
            if not scaled:
                part = alpha[s] * p[g]
            else:
                part = alpha[s] * p[g] * np.exp(now[word[s]] - shift[s])
            if alone:
                alpha[t] = part.sum(0)
            else:
                alpha[e] += part
            if not scaled:
                continue
            if i + 1 == len(ends) or ends[i + 1] != t:  # all spans that end here are summed
                own = np.flatnonzero(sizes >= t)
                here = first[own] + t
                if t % STEP == 0:
                    now[own] -= np.log(alpha[here])
                    alpha[here] = 1.0
                shift[here] = now[own]
        return out

    def _batches(self, words: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, bool]]:
        """(numbers of words, codes, sizes, whether sums need scaling) of batches of like words."""
        most = max(1 << 10, min(TOGETHER, (1 << 21) // max(1, len(self.languages))))
        order = sorted(range(len(words)), key=lambda k: len(words[k]))
        at = 0
        while at < len(order):
            to, slots, scaled = at, 0, len(words[order[at]]) > SHORT
            while to < len(order) and (to == at or slots + len(words[order[to]]) + 2 <= most) and (len(words[order[to]]) > SHORT) == scaled:
                slots += len(words[order[to]]) + 2
                to += 1
            part = order[at:to]
            codes = np.frombuffer("".join("▁" + words[k] + "\0" for k in part).encode("utf-32-le"), np.uint32).astype(np.int64)
            yield part, codes, np.fromiter((len(words[k]) + 1 for k in part), np.int64, len(part)), scaled
            at = to

    def log_likelihoods(self, words: list[str]) -> np.ndarray:
        """Log of the sum over all segmentations, a row for each word and a column for each language."""
        out = np.zeros((len(words), len(self.languages)))
        for part, codes, sizes, scaled in self._batches(words):
            out[part] = self._long(codes[:-1]) if len(part) == 1 and len(codes) > TOGETHER else self._forward(codes, sizes, scaled=scaled).logs()
        return out

    def _long(self, codes: np.ndarray) -> np.ndarray:
        """The same for one long word, of which only the last sums are carried from part to part."""
        before, back = None, 0
        for at in range(0, len(codes), TOGETHER):
            own = codes[at - back : at + TOGETHER]
            sums = self._forward(np.append(own, 0), np.array([len(own)]), scaled=True, before=before)
            back = min(self.longest, at + TOGETHER)
            before = sums.alpha[-back - 1 :], sums.shift[-back - 1 :]
        return sums.logs()[0]

    def expected(self, words: list[str], times: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (row) in each language (column): word k occurs times[k] times in language column[k]."""
        k = len(self.languages)
        out = np.zeros(self.p.size)
        for part, codes, sizes, scaled in self._batches(words):
            col = column[part]
            f = self._forward(codes, sizes, col, scaled)
            back = np.zeros(len(codes))
            back[f.last] = times[part] / f.alpha[f.last, 0]
            use = np.zeros(len(f.start))
            for a, b in zip(f.cuts[-2::-1], f.cuts[:0:-1], strict=True):
                g = slice(a, b)
                step = f.p[g, 0] * back[f.end[g]] * (f.factor(g) if f.shift is None else f.factor(g)[:, 0])
                back[f.start[g]] += step
                use[g] = f.alpha[f.start[g], 0] * step
            out += np.bincount(f.row * k + col[f.word[f.start]], use, len(out))
        return out.reshape(self.p.shape)[:-2]


def sample_bound(eligible: int, wanted: int) -> int:
    """The bound below which a 62-bit hash lies for about ``wanted`` of ``eligible`` rows, at any number of rows."""
    return (1 << 62) if eligible <= wanted else max(1, (wanted << 62) // eligible)


def fit(
    docs: DataFrame, piece_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = 4000, max_languages: int = 256, rounds: int = 3
) -> Unigrams:
    """Piece probabilities by expectation-maximisation, from rows with a text and a language whose id's crc32 modulo 3 isn't 1.

    Of those, about ``max_docs`` whole documents are used, chosen by a hash of id and text (so that repeated rows are chosen together,
    and rows with a null id not at all); if none was chosen, the share is doubled. At most ``max_languages`` languages are
    learned, those with the most words in the sample. What comes to the driver is a number for each (language, piece) of the
    fixed vocabulary. An empty table gives a model without languages.
    """
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull() & (crc_fold(id_col, 3) != 1))
    eligible = known.count()
    bound = sample_bound(eligible, max_docs)
    while True:
        chosen = known.where(F.xxhash64(id_col, text_col).bitwiseAND(F.lit((1 << 62) - 1)) < bound)
        counted = store(word_counts(chosen, fit_runs, text_col, lang_col), "language-words")
        named = [r["grp"] for r in counted.groupBy("grp").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "grp").limit(max_languages).collect()]
        if named or not eligible or bound == 1 << 62:
            break
        bound = min(1 << 62, 2 * bound)
    languages = sorted(named)
    counted = counted.repartition(max(8, math.ceil(counted.count() / 25_000)), "word")
    pieces = vocabulary(piece_path)
    model = Unigrams(pieces, np.full((len(pieces), len(languages)), 1 / max(1, len(pieces))), languages)
    schema = pa.schema([("piece", pa.int32()), ("lang", pa.int32()), ("n", pa.float64())])
    for _ in range(rounds if languages else 0):

        def expect(batches: Iterator[pa.RecordBatch], model: Unigrams = model) -> Iterator[pa.RecordBatch]:
            total, number = 0, {g: i for i, g in enumerate(model.languages)}
            for batch in parts(batches, "word"):
                rows = [(w, n, number[g]) for g, w, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True) if g in number]
                if rows:
                    words, times, column = zip(*rows, strict=True)
                    total = total + model.expected(list(words), np.array(times, float), np.array(column))
            if isinstance(total, np.ndarray):
                i, j = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], schema=schema)

        p = np.full((len(pieces), len(languages)), 0.01)
        for r in counted.mapInArrow(expect, "piece int, lang int, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas().itertuples():
            p[r.piece, r.lang] += r.n
        model = Unigrams(pieces, p / p.sum(0), languages)
    return model


class WordScores:
    """A bounded table of words' scores: log-likelihoods of a white-space word's letter runs, and their number."""

    def __init__(self, model: Unigrams, most: int = 300_000):
        self.model, self.most = model, min(most, (1 << 24) // (len(model.languages) + 1))
        self.row: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages) + 1))

    def fill(self, words: set[str]) -> None:
        new = sorted((w for w in words if w not in self.row), key=lambda w: len(w) > KEPT_LETTERS)
        if len(self.row) + len(new) > self.most:
            kept = [w for w in words if w in self.row]
            self.table = self.table[[self.row[w] for w in kept]]
            self.row = {w: i for i, w in enumerate(kept)}
        if not new:
            return
        runs = [letter_runs(w) for w in new]
        flat = sorted({r for own in runs for r in own})
        place = {r: i for i, r in enumerate(flat)}
        scores = np.zeros((len(new), self.table.shape[1]))
        if flat:
            each = np.repeat(np.arange(len(new)), [len(own) for own in runs])
            found = np.column_stack([self.model.log_likelihoods(flat), np.ones(len(flat))])
            np.add.at(scores, each, found[[place[r] for own in runs for r in own]])
        self.row.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
        self.table = np.vstack([self.table, scores])

    def score(self, texts: list[str], evidence: int = 20) -> list[tuple[str, float]]:
        """(language, score) of each text; the score is the language's share if the text had at most ``evidence`` letter runs."""
        split = [t.lower().split() for t in texts]
        words = set().union(*split)
        self.fill(words)
        found = []
        for own in split:
            total = self.table[np.fromiter(map(self.row.__getitem__, own), np.int64, len(own))].sum(0)
            runs, logs = total[-1], total[:-1]
            if not runs or not len(logs):
                found.append((UNDETERMINED, 0.0))
                continue
            best = int(np.argmax(logs))
            found.append((self.model.languages[best], 1 / sum(math.exp(max(-700.0, x)) for x in (logs - logs[best]) * min(1.0, evidence / runs))))
        long = [w for w in words if len(w) > KEPT_LETTERS]  # the last rows of the table
        for w in long:
            del self.row[w]
        self.table = self.table[: len(self.row)]
        return found


def predict(docs: DataFrame, model: Unigrams, text_col: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all by default) plus lang_pred and score, which replace equally named ones.

    ``und`` and 0 for texts that are null or have no letter, and for all without languages. Whole texts are scored, of any length. Ties go to
    the first language in order. Repeated rows and null ids are rows like any other. The model's size is bounded by
    the fixed vocabulary and the number of languages.
    """
    name = uuid.uuid4().hex
    shipped = docs.sparkSession.sparkContext.broadcast((model.pieces, model.p[:-2].astype(np.float32), model.languages))
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scorer() -> WordScores:
            pieces, p, languages = shipped.value
            return WordScores(Unigrams(pieces, p.astype(float), languages))

        own_scores = kept(("language", name), scorer)
        for batch in parts(batches, text_col):
            found = own_scores.score(texts_of(batch, text_col))
            own = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*names, "lang_pred", "score"])

    out = StructType([docs.schema[c] for c in names]).add("lang_pred", "string").add("score", "double")
    return docs.select(*(f"`{c}`" for c in {*names, text_col})).mapInArrow(run, out)


def keep_identified(docs: DataFrame, piece_path: str, min_score: float = 0.5, text_col: str = "text", **more) -> DataFrame:
    """``docs`` without the rows whose language can't be told: null texts, no letters, or a score below ``min_score``.

    All columns stay as they are, those named lang_pred and score included. A row is judged by its text alone, so repeated rows
    stay or go together. An empty table stays empty.
    """
    found = predict(hidden(docs), fit(docs, piece_path, text_col=text_col, **more), f"__in_{text_col}")
    return shown(found.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)))
