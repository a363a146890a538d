"""Whitening of embeddings, by incremental eigendecomposition.

A task takes its vectors one after the other into a spectrum (count, mean, eigenvalues and eigenvectors of the scatter about the mean): each
is a centred rank-one update, whose new eigenvalues are the roots of the secular equation, after deflation. Several spectra
of a task are updated side by side, since numpy works on arrays. Spectra are combined by as many rank-one updates as they have
directions, and one for the distance of their means. What comes of it is the basis of a Rayleigh-Ritz step over all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allelon.llm.common import hidden, shown
from allelon.storage import store

#: What is too small to count, as a share of the largest eigenvalue.
SMALL = 1e-14
#: Eigenvalues below this share of the trace belong to no component.
RANK = 1e-12
LANES = 8


def _deflate(lam: np.ndarray, q: np.ndarray, z: np.ndarray, tiny: np.ndarray) -> None:
    """Turn eigenvectors of (nearly) equal eigenvalues so that all but the last of them have no share in the update."""
    near = np.diff(lam, axis=1) <= tiny[:, None]
    for i in np.flatnonzero(near.any(0)).tolist():
        own = np.flatnonzero(near[:, i] & (z[:, i] != 0))
        if not len(own):
            continue
        r = np.hypot(z[own, i], z[own, i + 1])
        c, s = (z[own, i + 1] / r)[:, None], (z[own, i] / r)[:, None]
        a, b = q[own, :, i], q[own, :, i + 1]
        q[own, :, i], q[own, :, i + 1] = c * a - s * b, s * a + c * b
        z[own, i], z[own, i + 1] = 0.0, r


def rank_one(lam: np.ndarray, q: np.ndarray, u: np.ndarray, rho: np.ndarray, rounds: int = 60) -> None:
    """Update spectra in place: q diag(lam) q' + rho u u', for stacks of spectra (lanes, d), (lanes, d, d), (lanes, d), (lanes,).

    ``lam`` is ascending. Each root of the secular equation is found as a distance from the nearer of its two poles, by steps
    of an interpolating rational function kept within a shrinking bracket; the shares are then computed anew from the roots (Loewner's
    formula), so that the eigenvectors are orthogonal however exact the roots are.
    """
    z = (u[:, None, :] @ q)[:, 0] * np.sqrt(np.maximum(rho, 0.0))[:, None]
    top = np.maximum(lam[:, -1], 0.0) + (z * z).sum(1)
    tiny = SMALL * top
    # A share whose whole effect is below the rounding of the largest eigenvalue.
    z[z * z <= tiny[:, None] * SMALL] = 0.0
    _deflate(lam, q, z, tiny)
    live = z != 0
    lanes = np.flatnonzero(live.any(1))
    if not len(lanes):
        return
    lam_, q_, z_, live_ = lam[lanes], q[lanes], z[lanes], live[lanes]
    n, d = z_.shape
    square = z_ * z_
    norm = square.sum(1)
    # The next pole above each live one; the last has none, its root lies within the norm.
    poles = np.where(live_, lam_, np.inf)
    above = np.minimum.accumulate(np.concatenate([poles[:, 1:], np.full((n, 1), np.inf)], 1)[:, ::-1], axis=1)[:, ::-1]
    last = np.isinf(above)
    gap = np.where(last, norm[:, None], above - lam_)
    l_at, i_at = np.nonzero(live_)
    own, width, sq = lam_[l_at, i_at], gap[l_at, i_at], square[l_at]
    is_last = last[l_at, i_at]
    next_pole = np.where(is_last, own, above[l_at, i_at])
    all_poles = np.where(live_, lam_, np.inf)[l_at]  # those without a share are far away
    half = 1 + (sq / ((all_poles - own[:, None]) - (width / 2)[:, None])).sum(1)
    upper = ~is_last & (half < 0)  # the root is nearer to the pole above
    shift = np.where(upper, next_pole, own)
    low, high = np.where(upper, -width / 2, 0.0), np.where(upper, 0.0, np.where(is_last, width, width / 2))
    t = (low + high) / 2
    base = all_poles - shift[:, None]
    near = (np.arange(d)[None, :] <= i_at[:, None]).astype(float)
    k, x = np.arange(len(t)), (base, sq, near, own - shift, next_pole - shift, is_last, low, high, t)
    for _ in range(rounds):
        base_k, sq_k, near_k, own_k, next_k, last_k, low_k, high_k, t_k = x
        diff = base_k - t_k[:, None]
        part = sq_k / diff
        value = 1 + part.sum(1)
        part /= diff
        slope, below = part.sum(1), np.einsum("ij,ij->i", part, near_k)
        low_k, high_k = np.where(value < 0, t_k, low_k), np.where(value < 0, high_k, t_k)
        # The poles on both sides stand for all below and all above: a quadratic for the step. Above the last pole there is one only.
        d1, d2 = own_k - t_k, next_k - t_k
        c = value - d1 * below - d2 * (slope - below)
        a = (d1 + d2) * value - d1 * d2 * slope
        b = d1 * d2 * value
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0.0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step = np.where(last_k, d1 + d1 * d1 * slope / (value - d1 * slope), step)
            new = t_k + step
        still = np.abs(step) <= 1e-9 * np.abs(t_k)  # false for a step that isn't a number
        new = np.where((new > low_k) & (new < high_k), new, np.where(still, t_k, (low_k + high_k) / 2))
        open_ = ~still & (high_k - low_k > 1e-15 * np.abs(high_k + low_k))
        t[k] = new
        if not open_.any():
            break
        if np.count_nonzero(open_) < 0.7 * len(k):
            k, x = k[open_], tuple(v[open_] for v in (base_k, sq_k, near_k, own_k, next_k, last_k, low_k, high_k, new))
        else:
            x = (base_k, sq_k, near_k, own_k, next_k, last_k, low_k, high_k, new)
    mu = lam_.copy()
    mu[l_at, i_at] = shift + t
    # Distances of poles from roots, exact near the own pole.
    dist = (lam_[l_at] - shift[:, None]) - t[:, None]
    eye = np.eye(d)[None]
    full = np.ones((n, d, d))
    full[l_at, i_at] = dist  # full[lane, root, pole]
    apart = lam_[:, None, :] - lam_[:, :, None] + eye  # [lane, i, j] = lam_j - lam_i
    if not live_.all():
        both = live_[:, :, None] & live_[:, None, :]
        full, apart = np.where(both, full, np.inf), np.where(both, apart, np.inf)
        ratio = np.where(both, full, 1.0).transpose(0, 2, 1) / np.where(both, apart, 1.0)
    else:
        ratio = full.transpose(0, 2, 1) / apart  # [lane, pole i, root j]
    share = np.sqrt(np.abs(ratio.prod(2))) * np.sign(z_)
    w = share[:, None, :] / full  # [lane, root, pole]
    size = np.sqrt(np.einsum("lij,lij->li", w, w))[:, :, None]
    w = w / np.where(size > 0, size, 1.0)
    if not live_.all():
        w = np.where(live_[:, :, None], w, eye)
    q_ = q_ @ w.transpose(0, 2, 1)
    order = np.argsort(mu, axis=1, kind="stable")
    lam[lanes] = np.take_along_axis(mu, order, 1)
    q[lanes] = np.take_along_axis(q_, order[:, None, :], 2)


class Spectra:
    """A stack of spectra: counts, means, eigenvalues (ascending) and eigenvectors (columns) of the scatter about the mean."""

    def __init__(self, lanes: int, d: int):
        self.n, self.mean = np.zeros(lanes), np.zeros((lanes, d))
        self.lam, self.q = np.zeros((lanes, d)), np.tile(np.eye(d), (lanes, 1, 1))

    def take(self, x: np.ndarray) -> None:
        """One vector into each of the first spectra."""
        k = len(x)
        n, u = self.n[:k], x - self.mean[:k]
        lam, q = self.lam[:k], self.q[:k]
        rank_one(lam, q, u, n / (n + 1))
        self.mean[:k] += u / (n + 1)[:, None]
        self.n[:k] += 1

    def halve(self) -> None:
        """Combine the spectra of the second half with those of the first."""
        lanes = len(self.n)
        k = lanes - lanes // 2
        m = lanes - k
        a_n, b_n = self.n[:m], self.n[k:]
        both = a_n + b_n
        lam, q = self.lam[:m], self.q[:m]
        for i in range(self.lam.shape[1]):
            rank_one(lam, q, self.q[k:, :, i], np.maximum(self.lam[k:, i], 0.0))
        u = self.mean[k:] - self.mean[:m]
        with np.errstate(divide="ignore", invalid="ignore"):
            rank_one(lam, q, u, np.where(both > 0, a_n * b_n / both, 0.0))
            self.mean[:m] += u * np.where(both > 0, b_n / both, 0.0)[:, None]
        self.n[:m] = both
        self.n, self.mean, self.lam, self.q = self.n[:k], self.mean[:k], self.lam[:k], self.q[:k]

    def combined(self) -> Spectra:
        while len(self.n) > 1:
            self.halve()
        return self

    def rows(self) -> list[tuple[float, bytes, bytes, bytes]]:
        return [(float(n), m.tobytes(), e.tobytes(), q.tobytes()) for n, m, e, q in zip(self.n, self.mean, self.lam, self.q, strict=True)]

    @staticmethod
    def of(rows: list, d: int) -> Spectra:
        out = Spectra(len(rows), d)
        for k, (n, mean, lam, q) in enumerate(rows):
            out.n[k], out.mean[k], out.lam[k] = n, np.frombuffer(mean), np.frombuffer(lam)
            out.q[k] = np.frombuffer(q).reshape(d, d)
        return out


_SPECTRUM = pa.schema([("n", pa.float64()), ("mean", pa.binary()), ("lam", pa.binary()), ("q", pa.binary())])
_KINDS = "n double, mean binary, lam binary, q binary"


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _spectra_rows(s: Spectra) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*s.rows(), strict=True), _SPECTRUM, strict=True)], schema=_SPECTRUM)


def spectrum(vectors: DataFrame, d: int, column: str = "x", shift: int = 1_000_000, task_rows: int = 4096, fan: int = 32) -> Spectra:
    """The spectrum of all vectors, less ``shift``: one of each task, then combined ``fan`` at a time until one is left."""
    tasks = max(1, -(-vectors.count() // task_rows))

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rest = None, np.empty((0, d))
        for b in batches:
            x = np.concatenate([rest, _matrix(b.column(0), d) - float(shift)])
            if own is None and len(x):
                own = Spectra(min(LANES, max(1, len(x) // d)), d)
            if own is None:
                continue
            k = len(own.n)
            for i in range(0, len(x) - k + 1, k):
                own.take(x[i : i + k])
            rest = x[len(x) - len(x) % k :]
        if own is not None:
            if len(rest):
                own.take(rest)
            yield _spectra_rows(own.combined())

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [tuple(r.values()) for b in batches for r in b.to_pylist()]
        if rows:
            yield _spectra_rows(Spectra.of(rows, d).combined())

    found = store(vectors.select(column).coalesce(tasks).mapInArrow(update, _KINDS), "spectra")
    while (left := found.count()) > 1:
        found = store(found.repartition(-(-left // fan)).mapInArrow(combine, _KINDS), "spectra")
    return Spectra.of([tuple(r) for r in found.collect()], d)  # one row


def _scatter(vectors: DataFrame, d: int, k: int, project) -> tuple[np.ndarray, np.ndarray]:
    """(sums, sums of products) over all vectors of ``project(x)``, which has k columns: a row for each matrix row of each task, added up by Spark."""
    schema = pa.schema([("i", pa.int32()), ("v", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            if b.num_rows:
                y = project(_matrix(b.column(0), d))
                total[:k] += y.T @ y
                total[k] += y.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], schema=schema)

    cells = vectors.select("x").mapInArrow(run, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    rows = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()  # (k + 1) x k numbers
    out = np.zeros((k + 1, k))
    for r in rows:
        out[r["i"], r["j"]] = r["v"]
    return out[k], out[:k]


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """All columns hidden, and x: floor(scale * c) + shift of each component. Vectors that are null, or hold null or non-finite components, are left out."""
    c = F.transform(F.col(f"__in_{vector_col}"), lambda v: F.floor(F.when(F.abs(v.cast("double")) < 1e15, v.cast("double")) * scale) + shift)
    named = hidden(vectors).withColumn("x", c)
    # A NaN is above all numbers, so it fails the bound as well.
    return named.where(F.col("x").isNotNull() & (F.size("x") > 0) & ~F.exists("x", lambda v: v.isNull()))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """``vectors`` with a row for each of the first ``components`` components: component (from 1), n, deviation, whitened, explained, identity_error.

    Each component c of a vector becomes x = floor(scale * c) + shift. Rows whose vector is null, empty, or holds null or non-finite
    entries (or some of 10^15 and more) are left out, as are those whose length isn't the most frequent one (of equally frequent ones, the
    longest). The fit list has each distinct x once: n vectors with sums S and covariance V (divisor n), with eigenvalues e in falling order.

    deviation: sum of (n x - S)^2, exact (an error beyond a long); whitened: the centred x on the component, over sqrt(e); explained: e over the
    trace; identity_error: largest entry of the whitened fit list's covariance less the identity. Eigenvalues below 10^-12 of the
    trace are no components, so a table of one distinct vector has no rows. Components of equal eigenvalues are any basis of their space. Repeated rows and null ids are
    whitened like any other; new columns replace those of their names. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_col, vector_col, scale, shift)
    more = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    none = whole.select(*(F.col(f"`{c}`") for c in whole.columns if c != "x"), *(F.lit(None).cast(k).alias(c) for c, k in (p.split(" ") for p in kinds.split(", "))))
    keep = lambda df: shown(df.drop(*(f"__in_{c}" for c in more)), *more)
    lengths = whole.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).limit(1).collect()
    if not lengths:
        return keep(none.limit(0))
    d = lengths[0]["d"]
    whole = whole.where(F.size("x") == d)
    fit = store(whole.select("x").distinct(), "fit-list")
    first = fit.agg(F.count("*").alias("n"), *(F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(d))).first()
    n, sums = first["n"], [first[f"s{i}"] for i in range(d)]
    basis, _ = np.linalg.qr(spectrum(fit, d, shift=shift).q[0])
    total = np.array(sums, np.int64)
    lowest, highest = (np.array(fit.agg(*(g(F.get("x", F.lit(i))) for i in range(d))).first(), dtype=object) for g in (F.min, F.max))
    far = max(max(abs(n * a - s), abs(n * b - s)) for a, b, s in zip(lowest, highest, sums, strict=True))
    if far * far * d >= 1 << 63:
        raise OverflowError("the deviations don't fit a long")

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x.astype(np.int64) - total) / n  # one rounding of an exact difference

    _, ritz = _scatter(fit, d, d, lambda x: centred(x) @ basis)
    e, w = np.linalg.eigh((ritz + ritz.T) / (2 * n))
    order = np.argsort(-e, kind="stable")
    e, vectors_of = e[order], (basis @ w)[:, order]
    trace = float(e.sum())
    k = min(components, d, int((e > RANK * trace).sum())) if trace > 0 else 0
    if not k:
        return keep(none.limit(0))
    to = vectors_of[:, :k] / np.sqrt(e[:k])
    s, products = _scatter(fit, d, k, lambda x: centred(x) @ to)
    error = float(np.abs(products / n - np.outer(s / n, s / n) - np.eye(k)).max())
    explained = e[:k] / trace
    named = [c for c in whole.columns if c not in ("x", *(f"__in_{m}" for m in more))]
    at = len(named)
    plain = pa.schema([("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(at), d).astype(np.int64)
            off = n * x - total
            times = np.repeat(np.arange(b.num_rows), k)
            m = b.num_rows
            new = [np.tile(np.arange(1, k + 1, dtype=np.int32), m), np.full(m * k, n), np.repeat((off * off).sum(1), k), ((off / n) @ to).reshape(-1),
                np.tile(explained, m), np.full(m * k, error)]
            kept = [b.column(i).take(pa.array(times)) for i in range(at)]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, f.type) for c, f in zip(new, plain, strict=True))], names=[*short, *more])

    # mapInArrow can't name columns with a dot, so they are numbered.
    short = [f"c{i}" for i in range(at)]
    schema = ", ".join(f"{s} {whole.schema[c].dataType.simpleString()}" for s, c in zip(short, named, strict=True))
    out = whole.select(*(F.col(f"`{c}`").alias(s) for s, c in zip(short, named, strict=True)), "x").mapInArrow(project, f"{schema}, {kinds}")
    out = out.select(*(F.col(s).alias(c) for s, c in zip(short, named, strict=True)), *more)
    return shown(out, *more)
