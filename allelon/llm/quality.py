"""Quality scores learned from preference pairs (Bradley-Terry), with a threshold at a score quantile."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.llm.common import crc_fold, parts, texts_of
from allelon.llm.rules import class_histogram, repeated_words
from allelon.storage import store

MARKS = b"!?|#*$%&<>{}=_~^@/\\"
#: A score of at least this is predicted good.
CUT = 0.7


def features(text: str) -> list[float]:
    """Numbers of a whole text: length, character classes, marks, repetition, word lengths."""
    data = text.encode()
    words = data.split()
    n, size = max(1, len(words)), max(1, len(data))
    times: dict[bytes, int] = {}
    ids = np.array([times.setdefault(w, len(times)) for w in words], np.int64)
    lines = [x for x in data.split(b"\n") if x.strip()]
    letters = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return [
        math.log1p(len(words)),
        math.log1p(len(lines)),
        *(class_histogram(data) / size),
        *(min(1.0, math.sqrt(letters[c] / n)) for c in MARKS),
        len(times) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        repeated_words(ids) / n,
        float(lengths.mean()) if len(words) else 0.0,
        float((lengths <= 3).mean()) if len(words) else 0.0,
        float((lengths > 15).mean()) if len(words) else 0.0,
    ]


N_FEATURES = len(features(""))


@dataclass
class Ranking:
    """A linear score of standardised features, its cut and its scale."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    cut: float = 0.0
    scale: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, rising with the raw score, and CUT at the raw score ``cut``."""
        z = (self.raw(x) - self.cut) / self.scale + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int = 100_000, penalty: float = 1e-3, steps: int = 30, seed: int = 42) -> Ranking:
    """Weights that make the better document of each pair score higher: logistic loss on feature differences, by Newton steps.

    Pairs are drawn at random between the two classes, all of them if there are no more than ``pairs``. The cut is the score
    quantile at the share of bad documents. With one class or no rows, all weights are 0 and every document passes.
    """
    k = x.shape[1]
    model = Ranking(np.zeros(k), np.ones(k), np.zeros(k))
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(a) or not len(b):
        return model
    model.mean, model.spread = x.mean(0), np.where(x.std(0) > 1e-9, x.std(0), 1.0)
    z = np.clip((x - model.mean) / model.spread, -8, 8)
    if len(a) * len(b) <= pairs:
        i, j = np.repeat(a, len(b)), np.tile(b, len(a))
    else:
        rng = np.random.default_rng(seed)
        i, j = rng.choice(a, pairs), rng.choice(b, pairs)
    d, w = z[i] - z[j], np.zeros(k)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -500, 500)))
        gradient = d.T @ (1 - p) / len(d) - penalty * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / len(d) + penalty * np.eye(k)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    model.weights = w
    raw = model.raw(x)
    model.cut, model.scale = float(np.quantile(raw, len(b) / len(x))), max(1e-9, float(raw.std()) / 2)
    return model


def feature_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x) of each row: the features of its whole text, null texts like empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([features(t) for t in texts_of(batch, "text")], pa.list_(pa.float64()))], names=["id", "x"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, x array<double>")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index("x")).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, len(flat) // max(1, batch.num_rows))


def _sums(rows: DataFrame, model: Ranking, width: float) -> tuple[np.ndarray, ...]:
    """Label, count, sum and second moments of all rows by class and bin of the raw score, of standardised features (as they are with width 0, in one bin).

    Tasks sum up their rows, then the parts of a bin meet in a task a core, however many partitions the session's shuffles have; a row a class and bin comes to the driver.
    """

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in filter(lambda b: b.num_rows, batches):
            x, labels = _matrix(batch), np.asarray(batch.column(0))
            z = np.clip((x - model.mean) / model.spread, -8, 8) if width else x - model.mean
            bins = np.rint(z @ model.weights / width).astype(np.int64) if width else np.zeros(len(x), np.int64)
            order = np.lexsort((bins, labels))
            z, labels, bins = z[order], labels[order], bins[order]
            first = np.flatnonzero((np.diff(labels, prepend=-1) != 0) | (np.diff(bins, prepend=bins[0]) != 0))
            for at, part in zip(first.tolist(), np.split(z, first[1:]), strict=True):
                _add(held, (int(labels[at]), int(bins[at])), np.concatenate([[len(part)], part.sum(0), (part.T @ part).reshape(-1)]))
        yield _sent(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            sums = batch.column(2).flatten().to_numpy()
            for key, own_sums in zip(zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True), np.split(sums, max(1, batch.num_rows)), strict=False):
                _add(held, key, own_sums)
        yield _sent(held)

    kind = "label int, bin long, sums array<double>"
    dealt = rows.mapInArrow(own, kind).repartition("label", "bin").coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    found = sorted(dealt.mapInArrow(meet, kind).collect(), key=lambda r: (r["label"], r["bin"]))
    sums = np.array([r["sums"] for r in found], float).reshape(len(found), 1 + N_FEATURES * (N_FEATURES + 1))
    k = N_FEATURES
    return np.array([r["label"] for r in found], int), sums[:, 0], sums[:, 1 : k + 1], sums[:, k + 1 :].reshape(len(found), k, k) if len(found) else np.zeros((0, k, k))


def _add(held: dict, key: tuple[int, int], sums: np.ndarray) -> None:
    held[key] = held[key] + sums if key in held else sums


def _sent(held: dict) -> pa.RecordBatch:
    sums = np.concatenate([*held.values(), np.empty(0)])
    size = len(sums) // max(1, len(held))
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(held) + 1) * size, pa.int32()), pa.array(sums, pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in held], pa.int32()), pa.array([k[1] for k in held], pa.int64()), lists], names=["label", "bin", "sums"])


def _quantile(raws: DataFrame, share: float) -> float:
    """The quantile of the column raw over all rows, as numpy.quantile gives it: counts by bins that narrow about its place."""
    n, low, high = raws.agg(F.count("*"), F.min("raw"), F.max("raw")).first()
    place, before = math.floor(share * (n - 1)), 0
    for _ in range(6):
        width = (high - low) / 1024
        if width <= 0 or low + width == low:
            break
        counts = sorted(tuple(r) for r in raws.where(F.col("raw").between(low, high)).groupBy(F.least(F.floor((F.col("raw") - low) / width), F.lit(1023))).count().collect())
        for own, times in counts:
            if before + times > place:
                break
            before += times
        low, high = low + own * width, min(high, low + (own + 1) * width)
    # What lies in the last bin, and its neighbours by rounding, is one value but for the last digits.
    near = 1e-9 * max(1.0, abs(low))
    first = raws.where(F.col("raw") >= low - near).agg(F.min("raw")).first()[0]
    upto, second = raws.agg(F.count_if(F.col("raw") <= first + near), F.min(F.when(F.col("raw") > first + near, F.col("raw")))).first()
    second = first if second is None or upto > place + 1 else second
    return first + (share * (n - 1) - place) * (second - first)


#: Newton steps end once one promises less than this of the loss (gradient times step). Bins are dealt anew at each step, which alone moves weights by 0.001
#: at a promise of 1e-8 (labels of check_h), so that the steps' size is no measure.
GAIN = 1e-7


def fit_rows(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", penalty: float = 1e-3, steps: int = 30) -> Ranking:
    """``fit_pairs`` of all labelled rows (id, x) whose id's crc32 modulo 4 isn't 2, and of all their pairs, without a draw.

    Each Newton step is a pass over the rows, which are summed by class and bin of their score; in the logistic loss, and there only, a row's score is its
    bin's mean (a bin is 1/16 wide, or a 32nd of the scores' spread if that is more). Mean, spread and cut are those of all rows. Nothing but sums by bins comes to the driver.
    """
    own = labels.where(F.col(label_col).isin(0, 1) & (crc_fold(id_col, 4) != 2)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
    known = store(rows.join(own, "id").select("label", "x"), "quality-rows")
    k = N_FEATURES
    model = Ranking(np.zeros(k), np.ones(k), np.zeros(k))
    label, count, total, _ = _sums(known, model, 0.0)
    if set(label.tolist()) != {0, 1}:
        return model
    n = count.sum()
    mean = total.sum(0) / n
    _, _, _, square = _sums(known, Ranking(mean, model.spread, model.weights), 0.0)  # centred before squares are taken
    spread = np.sqrt(np.diagonal(square.sum(0)) / n)
    model.mean, model.spread = mean, np.where(spread > 1e-9, spread, 1.0)
    w, width = np.zeros(k), 1 / 16
    for _ in range(steps):
        model.weights = w
        label, count, total, square = _sums(known, model, width)
        good, bad = label == 1, label == 0
        a, b, x, y = count[good], count[bad], total[good], total[bad]
        p = 1 / (1 + np.exp(-np.clip((x @ w / a)[:, None] - (y @ w / b)[None, :], -500, 500)))
        q, r = 1 - p, p * (1 - p)
        pairs = a.sum() * b.sum()
        gradient = (x.T @ (q @ b) - y.T @ (a @ q)) / pairs - penalty * w
        both = x.T @ r @ y
        hessian = (np.tensordot(r @ b, square[good], 1) + np.tensordot(a @ r, square[bad], 1) - both - both.T) / pairs + penalty * np.eye(k)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        centre = total.sum(0) / n
        width = max(1 / 16, math.sqrt(max(0.0, float(w @ (square.sum(0) / n - np.outer(centre, centre)) @ w))) / 32)
        if gradient @ step < GAIN:
            break
    model.weights = w

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(lambda b: b.num_rows, batches):
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(_matrix(batch)), pa.float64())], names=["raw"])

    raws = store(known.mapInArrow(raw, "raw double"), "quality-raw")
    bad = float(count[label == 0].sum())
    model.cut, model.scale = _quantile(raws, bad / n), max(1e-9, raws.agg(F.stddev_pop("raw")).first()[0] / 2)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranking:
    """Learn from all labelled documents whose id's crc32 modulo 4 isn't 2 (``fit_rows``).

    Rows without a label or id aren't used; a document with several labels is used once for each, repeated rows once each. Null texts count as empty.
    """
    return fit_rows(feature_rows(docs.where(crc_fold(id_col, 4) != 2), id_col, text_col), labels, id_col, label_col)


def predict_rows(rows: DataFrame, model: Ranking, id_col: str = "doc_id") -> DataFrame:
    """(id, score) of rows (id, x)."""
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in filter(lambda b: b.num_rows, batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch)), pa.float64())], schema=schema)

    return rows.select("id", "x").mapInArrow(run, "id long, score double").withColumnRenamed("id", id_col)


def predict(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for each row; null texts are scored like empty ones, texts of any length whole.

    Equal texts have equal scores, so repeated rows and ties are kept as they are; a null id stays null. Other columns aren't read; an
    empty table gives an empty result.
    """
    return predict_rows(feature_rows(docs, id_col, text_col), model, id_col)
