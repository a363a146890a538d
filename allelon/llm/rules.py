"""Quality rules: repetition counts, and distances of character-class and common-word histograms from language references."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from allelon.llm.common import hidden, parts, shown, texts_of
from allelon.llm.wordcount import LONG_WORD, word_counts
from allelon.storage import store

SYMBOLS = "#*$%&|<>"
N_CLASSES = 8
#: Largest distances of documents with at least so many words.
LIMITS = {"class_limit": 0.37, "word_limit": 0.36, "class_words": 30, "common_words": 60}


def _byte_classes() -> np.ndarray:
    """The class of each UTF-8 byte: 0 lower, 1 upper, 2 digit, 3 blank, 4 line end, 5 sentence mark, 6 other ASCII, 7 first byte of another letter; -1 following bytes."""
    out = np.full(256, 6, np.int64)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\x0c", b".,;:?'\"()-")):
        out[list(chars)] = k
    out[0x80:0xC0] = -1
    out[0xC0:] = 7
    return out


_CLASS = np.eye(N_CLASSES + 1, dtype=np.int64)[_byte_classes()][:, :N_CLASSES]


def class_histogram(data: bytes) -> np.ndarray:
    """Characters of each class."""
    return np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; 1 where one is empty."""
    if not p.sum() or not q.sum():
        return 1.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    part = lambda x: float((x[x > 0] * np.log2(x[x > 0] / m[x > 0])).sum())
    return max(0.0, (part(p) + part(q)) / 2) ** 0.5


def repeated_words(ids: np.ndarray, window: int = 8) -> int:
    """Words in windows of 8 words that occur twice or more, the first included. Exact: windows are numbered by doubling."""
    n = len(ids)
    if n <= window:
        return 0
    rank, size = ids.astype(np.int64), 1
    while size < window:
        wide = rank[:-size] * n + rank[size:]  # ranks stay below n
        values, rank = np.unique(wide, return_inverse=True)
        if len(values) == len(wide):
            return 0
        size *= 2
    often = np.flatnonzero(np.bincount(rank)[rank] > 1)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, often, 1)
    np.add.at(cover, often + window, -1)
    return int(np.count_nonzero(np.cumsum(cover)[:n]))


def base_counts(text: str) -> tuple[int, int, int, int, int, dict[bytes, int], np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, number of each distinct word, and the words by number."""
    data = text.encode()
    words = data.split()  # bytes: ASCII white space only
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    lines = [x for x in data.split(b"\n") if x.strip()]
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    return len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(ids), known, ids


#: What a row of ``_language_counts`` is about, besides character classes from 0 on.
_TOTAL, _WORD = -1, -2


def _language_counts(docs: DataFrame, top: int, most: int) -> DataFrame:
    """(lang, k, word, n, bound) summed over all texts (lang, text): characters of class k, all words (_TOTAL), and frequent words (_WORD).

    A task counts all words in units of about ``most`` different ones. Of a unit only the ``top`` most frequent words are passed on; its
    bound is the largest count of those left out. So a word occurs at least n times, and at most n times plus the bounds of the units that
    left it out: the sum of all bounds (on the row of _TOTAL) less those of the units that passed it on (on its own row).
    """
    schema = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("word", pa.binary()), ("n", pa.int64()), ("bound", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[Counter, np.ndarray]] = {}

        def rows(lang: str, k: list, words: list, n: list, bound: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(([lang] * len(k), k, words, n, bound), schema.types, strict=True)], schema=schema)

        def out(lang: str, c: Counter, classes: np.ndarray) -> Iterator[pa.RecordBatch]:
            ranked = c.most_common(top + 1)
            bound = ranked.pop()[1] if len(ranked) > top else 0
            yield rows(lang, [*range(N_CLASSES), _TOTAL], [None] * (N_CLASSES + 1), [*classes.tolist(), c.total()], [0] * N_CLASSES + [bound])
            if ranked:
                words, n = zip(*ranked, strict=True)
                yield rows(lang, [_WORD] * len(n), list(words), list(n), [bound] * len(n))

        for batch in parts(batches):
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch, "text"), strict=True):
                data = text.encode()
                words = data.split()  # bytes: ASCII white space only
                c, classes = held.setdefault(lang, (Counter(), np.zeros(N_CLASSES, np.int64)))
                c.update(words)
                classes += class_histogram(data)
                if words and max(map(len, words)) > LONG_WORD:  # not held, so that what a task holds is bounded in bytes
                    yield from out(lang, Counter({w: c.pop(w) for w in {w for w in words if len(w) > LONG_WORD}}), np.zeros(N_CLASSES, np.int64))
            if sum(len(c) for c, _ in held.values()) > most:
                for lang, own in held.items():
                    yield from out(lang, *own)
                held.clear()
        for lang, own in held.items():
            yield from out(lang, *own)

    found = docs.mapInArrow(count, "lang string, k int, word binary, n long, bound long")
    return found.groupBy("lang", "k", "word").agg(F.sum("n").alias("n"), F.sum("bound").alias("bound"))


def _top(words: DataFrame, common: int) -> DataFrame:
    """The ``common`` most frequent words of each language of (lang, word, n, ...), with their rank k; ties go to the word that sorts first.

    Only words whose count reaches a level are ranked: a histogram of counts in sixteenths of an octave gives the
    level of each language above which there are enough, so that few rows of a language meet in a task.
    """
    level, found = F.floor(F.log2("n") * 16).cast("int"), {}
    for r in words.groupBy("lang", level.alias("level")).count().collect():  # a thousand levels of a language at most
        found.setdefault(r["lang"], []).append((r["level"], r["count"]))
    bounds = []
    for lang, levels in found.items():
        total = 0
        for bound, n in sorted(levels, reverse=True):
            total += n
            if total >= common:
                break
        bounds.append((lang, bound))
    small = F.broadcast(words.sparkSession.createDataFrame(bounds, "lang string, __bound int"))  # a row for each language
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    return words.join(small, "lang").where(level >= F.col("__bound")).drop("__bound").withColumn("k", rank).where(F.col("k") <= common)


def language_references(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", common: int = 50, top: int = 2000, most: int = 300_000, max_languages: int = 256, most_candidates: int = 10_000
) -> dict[str, tuple[np.ndarray, list[bytes], np.ndarray]]:
    """lang -> (class histogram, its ``common`` most frequent words, their counts and that of all others), exact over all documents.

    Documents without a language count for none; ``max_languages`` languages have a reference, those with the most words. Only words that
    are frequent in a part of the corpus are shuffled (``_language_counts``); those whose bounds reach the last common word's count
    are the candidates. The candidates of a language are counted once more if any isn't counted exactly, and all its words if there are
    more than ``most_candidates`` or if the bounds leave room for a word that no part passed on. Ties go to the word that sorts first.
    """
    named = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    own = named.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counted = store(_language_counts(own, top, most), "language-counts")
    totals = {r["lang"]: r for r in counted.where(F.col("k") == _TOTAL).orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    if not totals:
        return {}
    spark = docs.sparkSession
    hist: dict[str, np.ndarray] = {g: np.zeros(N_CLASSES) for g in totals}
    bounds = F.broadcast(spark.createDataFrame([(g, r["bound"]) for g, r in totals.items()], "lang string, all_bounds long"))  # max_languages rows
    for r in counted.where("k >= 0").join(bounds, "lang", "left_semi").collect():
        hist[r["lang"]][r["k"]] = r["n"]
    words = counted.where(F.col("k") == _WORD).join(bounds, "lang").select("lang", "word", "n", (F.col("n") + F.col("all_bounds") - F.col("bound")).alias("upper"))
    least = _top(words, common).groupBy("lang").agg(F.min("n").alias("least"), F.count("*").alias("size"))
    # A word that no unit passed on can't reach the least count unless the bounds together do.
    ends = {r["lang"]: (r["least"] if r["size"] == common else 1) for r in least.collect()}
    least = F.broadcast(spark.createDataFrame([(g, ends.get(g, 1)) for g in totals], "lang string, least long"))
    near = words.join(least, "lang").where("upper >= least")
    exact = near.select("lang", "word", "n")
    split = lambda t: [w.decode() for w in t.encode().split()]
    again = sorted({g for g, r in totals.items() if r["bound"] >= ends.get(g, 1)})  # in these, a word that no unit passed on may be common
    unsure = near.where("upper > n").select("lang").distinct()
    if some := sorted({r["lang"] for r in unsure.collect()} - {*again}):
        found = near.where(F.col("lang").isin(some)).select("word").distinct().limit(most_candidates + 1).collect()
        if len(found) > most_candidates:
            again = sorted({*again, *some})
        else:
            wanted = {bytes(r["word"]).decode() for r in found}
            counts = word_counts(own.where(F.col("lang").isin(some)), lambda t: [w for w in split(t) if w in wanted], "text", "lang")
            exact = exact.where(~F.col("lang").isin(some)).unionByName(counts.select(F.col("grp").alias("lang"), F.col("word").cast("binary").alias("word"), "n"))
    if again:
        counts = word_counts(own.where(F.col("lang").isin(again)), split, "text", "lang")
        exact = exact.where(~F.col("lang").isin(again)).unionByName(counts.select(F.col("grp").alias("lang"), F.col("word").cast("binary").alias("word"), "n"))
    best: dict[str, tuple[list, list]] = {g: ([], []) for g in totals}
    for r in _top(store(exact, "common-words"), common).orderBy("lang", "k").collect():
        best[r["lang"]][0].append(bytes(r["word"]))
        best[r["lang"]][1].append(r["n"])
    return {g: (hist[g], w, np.array([*n, totals[g]["n"] - sum(n)], float)) for g, (w, n) in sorted(best.items())}


def divergences(data: bytes, known: dict[bytes, int], ids: np.ndarray, references: dict) -> tuple[float, float]:
    """(class distance, common-word distance) from the language whose common words are closest; (0, 0) without references."""
    best = None
    hist, times = class_histogram(data), np.bincount(ids, minlength=1)
    for classes, common, counts in references.values():
        own = np.array([times[known[w]] if w in known else 0 for w in common], float)
        found = (js_distance(np.append(own, len(ids) - own.sum()), counts), js_distance(hist, classes))
        best = found if best is None or found < best else best
    return (best[1], best[0]) if best else (0.0, 0.0)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    common: int = 50,
    **limits: float,
) -> DataFrame:
    """Counts, base verdict, distances and verdict of each row.

    A document fails the base rules with fewer than 20 words or over 30 % of them in repeated 8-word windows. Of the
    others, one with at least ``class_words`` words is rejected if its character classes lie more than ``class_limit``
    from its closest language, one with at least ``common_words`` words also if its common words lie more than ``word_limit`` from it;
    shorter ones are left to the other rules. Null and empty texts have no words and fail; without any
    language the distances are 0. Of languages equally close by common words, that with the closer classes counts. Equal texts have
    equal verdicts, repeated rows stay repeated, a null id stays null, texts of any length count whole. Other columns aren't read or
    returned; an empty table gives an empty result.
    """
    references = language_references(docs, text_col, lang_col, common)
    own = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"))
    return _judged(own, references, "__text", False, **(LIMITS | limits)).withColumnRenamed("__id", id_col)


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judged(docs: DataFrame, references: dict, text_col: str, keep_text: bool, class_limit: float, word_limit: float, class_words: int, common_words: int) -> DataFrame:
    """The columns of ``docs``, without the text unless ``keep_text``, plus the counts, distances and verdicts."""
    types = [*((c, "long") for c in _COUNTS), ("base_failed", "boolean"), ("class_distance", "double"), ("word_distance", "double"), ("kept", "boolean")]
    arrow = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    names = [c for c in docs.columns if c != text_col or keep_text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, text_col):
            rows = []
            for text in texts_of(batch, text_col):
                n, chars, symbols, lines, repeats, known, ids = base_counts(text)
                failed = n < 20 or 100 * repeats > 30 * n
                far, odd = divergences(text.encode(), known, ids, references)
                bad = (n >= class_words and far > class_limit) or (n >= common_words and odd > word_limit)
                rows.append((n, chars, symbols, lines, repeats, failed, far, odd, not failed and not bad))
            found = [pa.array(c, arrow[t]) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)]
            own = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*own, *found], names=[*names, *(c for c, _ in types)])

    out = StructType([docs.schema[c] for c in names])
    for c, t in types:
        out = out.add(c, t)
    return docs.mapInArrow(run, out)


def keep_by_rules(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **limits: float) -> DataFrame:
    """The rows of ``docs`` that the rules of ``quality_rules`` keep, with all their own columns, whatever their names.

    A row is judged by its text alone, so repeated rows stay or go together; an empty table stays empty.
    """
    references = language_references(docs, text_col, lang_col)
    return shown(_judged(hidden(docs), references, f"__in_{text_col}", True, **(LIMITS | limits)).where("kept"))
