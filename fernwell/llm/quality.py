"""Quality classifier: a factorisation machine over hashed words and structure statistics.

score = logistic(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): all
pairwise interactions in time linear in the features. Features of a whole text: each distinct word
(hashed, lower-cased in A-Z, weight 1 / sqrt(distinct words)), and statistics of form and length,
each standardised and also as one of eight intervals. Labels, lang, source and doc_id are no
features.

Learning takes at most `max_train_rows` labelled rows, those with the least hashes of their id,
and only rows whose crc32(doc_id as text) mod 5 is not 0; the others are held out. Their features,
not their texts, go to the driver: the bound on rows and the number of distinct words bound them.
Scoring is one pass without a shuffle.

Cases: null and empty texts have the statistics of an empty text and are scored like any other;
null labels are left out; a repeated label counts once (the higher); without labels of both classes
the score is their rate, 0.5 if there are none; equal texts score equally; an empty table gives no
rows; extra columns are ignored by score_documents and kept by keep_good.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, column_bytes, lower_ascii, release, runs, sorted_distinct, word_bounds, word_hashes

WORD_BITS, RANK, INTERVALS = 15, 8, 8
N_STATS = 18
_SLICE = 1 << 20


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (c[off[1:]] - c[off[:-1]]).astype(np.float64)


def extract(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics (documents x N_STATS), and the distinct hashed words of all documents with their
    bounds (documents + 1)."""
    n = len(off) - 1
    size = np.diff(off).astype(np.float64)
    upper = ((data >= 65) & (data <= 90)).astype(np.int8)
    upper[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    letter = (((data | 32) >= 97) & ((data | 32) <= 122)) | (data >= 0xC3)
    s, e, at = word_bounds(data, off)
    words = np.diff(at).astype(np.float64)
    h = word_hashes(lower_ascii(data), s, e)
    doc = np.repeat(np.arange(n), np.diff(at))
    # distinct words of each document and how often each occurs
    order = np.lexsort((h, doc))
    hs, ds = h[order], doc[order]
    new = np.concatenate(([True], (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1]))) if len(hs) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    often = np.diff(np.append(first, len(hs)))
    distinct = np.bincount(ds[first], minlength=n).astype(np.float64)
    most = np.zeros(n)
    np.maximum.at(most, ds[first], often)
    once = np.bincount(ds[first], often == 1, minlength=n)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    # lines
    feed = data == 10
    line_bounds = sorted_distinct(np.concatenate((off, np.flatnonzero(feed) + 1)))
    ldoc = np.searchsorted(off, line_bounds[:-1], "right") - 1
    lh = word_hashes(data, line_bounds[:-1], line_bounds[1:])
    lorder = np.lexsort((lh, ldoc))
    l2, d2 = lh[lorder], ldoc[lorder]
    lnew = np.concatenate(([True], (l2[1:] != l2[:-1]) | (d2[1:] != d2[:-1]))) if len(l2) else np.zeros(0, bool)
    lines = np.bincount(ldoc, minlength=n).astype(np.float64)
    own_lines = np.bincount(d2[lnew], minlength=n).astype(np.float64)
    w, b, ln = np.maximum(words, 1), np.maximum(size, 1), np.maximum(lines, 1)
    in_class = lambda chars: _per_doc(np.isin(data, np.frombuffer(chars, np.uint8)), off)
    stats = np.stack(
        [
            np.log1p(size), np.log1p(words), size / w,
            _per_doc(upper, off) / np.maximum(_per_doc(letter, off), 1), in_class(b"0123456789") / b,
            in_class(b"!") / w, in_class(b"|") / w, in_class(b"#$%&*") / w, in_class(b".,;:?") / w,
            in_class(b"<>{}[]()=_/\\") / w, _per_doc(data >= 128, off) / b,
            distinct / w, once / w, most / w, _per_doc(same, at) / w,
            np.log1p(lines), words / ln, 1 - own_lines / ln,
        ],
        1,
    )
    ids = (hs[first] >> np.uint64(64 - WORD_BITS)).astype(np.int32)
    # two words of one document may share a hash: one feature
    order = np.lexsort((ids, ds[first]))
    ids, di = ids[order], ds[first][order]
    keep = np.concatenate(([True], (ids[1:] != ids[:-1]) | (di[1:] != di[:-1]))) if len(ids) else np.zeros(0, bool)
    ids, di = ids[keep], di[keep]
    return stats, ids, np.searchsorted(di, np.arange(n + 1))


def extract_column(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Features of slices of a column: first and last row, then what extract() returns."""
    off, data = column_bytes(col)
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + _SLICE, "right")) - 1)
        yield at, to, *extract(off[at : to + 1] - off[at], data[off[at] : off[to]])
        at = to


@dataclass
class FactorisationMachine:
    mean: np.ndarray
    spread: np.ndarray
    cuts: np.ndarray  # statistics x (INTERVALS - 1)
    bias: float
    w: np.ndarray
    v: np.ndarray

    @property
    def width(self) -> int:
        return (1 << WORD_BITS) + N_STATS * (1 + INTERVALS)

    def rows(self, stats: np.ndarray, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature numbers, values and bounds of each row; statistics come first."""
        n = len(stats)
        z = np.clip((stats - self.mean) / self.spread, -4, 4)
        base = 1 << WORD_BITS
        j = np.arange(N_STATS)
        bins = np.stack([np.searchsorted(self.cuts[k], stats[:, k], "right") for k in j], 1) if n else np.zeros((0, N_STATS), int)
        sf = np.concatenate((np.tile(base + j, (n, 1)), base + N_STATS + j * INTERVALS + bins), 1)
        sx = np.concatenate((z * 0.25, np.full((n, N_STATS), 0.5)), 1)
        count = np.diff(at)
        bounds = np.concatenate(([0], np.cumsum(count + 2 * N_STATS)))
        f = np.empty(bounds[-1], np.int64)
        x = np.empty(bounds[-1], np.float32)
        head = (bounds[:-1, None] + np.arange(2 * N_STATS)).ravel()
        f[head], x[head] = sf.ravel(), sx.ravel()
        rest = np.ones(len(f), bool)
        rest[head] = False
        f[rest] = ids
        x[rest] = np.repeat(1 / np.sqrt(np.maximum(count, 1)), count)
        return f, x, bounds

    def margin(self, f: np.ndarray, x: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the logistic, and the sums over v_if x_i."""
        vx = self.v[f] * x[:, None]
        sums = np.add.reduceat(vx, bounds[:-1], 0)
        squares = np.add.reduceat((vx * vx).sum(1), bounds[:-1])
        linear = np.add.reduceat(self.w[f] * x, bounds[:-1])
        return self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums

    def predict(self, stats: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        m, _ = self.margin(*self.rows(stats, ids, at))
        return 1 / (1 + np.exp(-m.astype(np.float64)))


def fit(stats: np.ndarray, ids: np.ndarray, at: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.08, l2: float = 1e-4, seed: int = 3) -> FactorisationMachine:
    """AdaGrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    rate_of = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    fm = FactorisationMachine(
        stats.mean(0) if len(y) else np.zeros(N_STATS),
        np.maximum(stats.std(0), 1e-6) if len(y) else np.ones(N_STATS),
        np.quantile(stats, np.linspace(0, 1, INTERVALS + 1)[1:-1], axis=0).T if len(y) else np.zeros((N_STATS, INTERVALS - 1)),
        float(np.log(rate_of / (1 - rate_of))), np.zeros(0), np.zeros(0),
    )
    fm.w = np.zeros(fm.width, np.float32)
    fm.v = np.zeros((fm.width, RANK), np.float32)
    if not len(y) or y.min() == y.max():
        return fm
    fm.v = rng.normal(0, 0.05, fm.v.shape).astype(np.float32)
    gw, gv, gb = np.full(fm.width, 1e-2, np.float32), np.full(fm.v.shape, 1e-2, np.float32), 1e-2
    f, x, bounds = fm.rows(stats, ids, at)
    epochs = max(epochs, 600 * batch // len(y))  # few rows: as many steps all the same
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            n = bounds[rows + 1] - bounds[rows]
            take = np.repeat(bounds[rows] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            bf, bx = f[take], x[take]
            bb = np.concatenate(([0], np.cumsum(n)))
            m, sums = fm.margin(bf, bx, bb)
            g = ((1 / (1 + np.exp(-m)) - y[rows]) / len(rows)).astype(np.float32)
            gx = np.repeat(g, n) * bx
            dv = gx[:, None] * (np.repeat(sums, n, 0) - fm.v[bf] * bx[:, None])
            order = np.argsort(bf, kind="stable")
            first = runs(bf[order])
            u = bf[order][first]
            dw = np.add.reduceat(gx[order], first) + l2 * fm.w[u]
            dv = np.add.reduceat(dv[order], first, 0) + l2 * fm.v[u]
            gw[u] += dw * dw
            gv[u] += dv * dv
            fm.w[u] -= rate * dw / np.sqrt(gw[u])
            fm.v[u] -= rate * dv / np.sqrt(gv[u])
            db = float(g.sum())
            gb += db * db
            fm.bias -= rate * db / gb**0.5
    return fm


def _held_out(doc_id: str = "doc_id"):  # noqa: ANN202
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def train(docs: DataFrame, labels: DataFrame, max_train_rows: int = 8000, target: str = "quality") -> FactorisationMachine:
    """Learns from at most max_train_rows labelled rows outside the held-out fifth."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y"))
        .where("y IN (0, 1) AND doc_id IS NOT NULL")
        .where(~_held_out())
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_train_rows)
    )
    text = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, to, stats, ids, bounds in extract_column(b["text"]):
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": b["doc_id"].slice(at, to - at), "y": b["y"].slice(at, to - at),
                        "stats": pa.array(list(stats), pa.list_(pa.float64())),
                        "words": pa.array([ids[bounds[i] : bounds[i + 1]].tobytes() for i in range(to - at)], pa.binary()),
                    }
                )

    # at most max_train_rows rows are broadcast
    got = (
        text.join(F.broadcast(chosen), "doc_id")
        .mapInArrow(run, "doc_id long, y int, stats array<double>, words binary")
        .toArrow()
        .sort_by([("doc_id", "ascending"), ("y", "ascending")])
    )
    release(docs.sparkSession)
    words = [np.frombuffer(x, np.int32) for x in got["words"].to_pylist()]
    stats = np.array(got["stats"].to_pylist(), np.float64).reshape(-1, N_STATS)
    # rows of one id are few; equal ids with different texts are put in order by their features
    order = sorted(range(len(words)), key=lambda i: (got["doc_id"][i].as_py(), words[i].tobytes(), stats[i].tobytes()))
    words = [words[i] for i in order]
    return fit(
        stats[order], np.concatenate(words) if words else np.zeros(0, np.int32),
        np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64), got["y"].to_numpy().astype(np.float64)[order],
    )


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train_rows: int = 8000) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    fm = train(docs, labels, max_train_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = np.concatenate([np.zeros(0), *(fm.predict(s, i, a) for _, _, s, i, a in extract_column(b["text"]))])
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "score": pa.array(score)})

    slim = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    return slim.mapInArrow(run, "doc_id long, score double").select(
        "doc_id", _held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train_rows: int = 8000) -> DataFrame:
    """The documents that reach the threshold, with their columns as they are."""
    fm = train(docs, labels, max_train_rows)

    @F.pandas_udf("double")
    def score(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        col = pa.array(texts.fillna(""), pa.large_string())
        return pd.Series(np.concatenate([np.zeros(0), *(fm.predict(s, i, a) for _, _, s, i, a in extract_column(col))]))

    return bounded_batches(docs).where(score(F.col("text").cast("string")) >= threshold)
