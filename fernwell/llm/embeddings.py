"""Near-duplicate embeddings by randomised-rotation binary codes.

Each vector is turned by several random rotations; the signs are its binary code, and for each
rotation the cosine between the turned vector and its code is stored as correction factor. The code
serves twice. Slices of its bits are the keys of hash tables that propose pairs; the number of
tables follows from the number of vectors so that a pair at the threshold is proposed with the
wanted probability. For a proposed pair the inner product of one vector's code with the other
vector, kept at one byte a coordinate, divided by the code's factor, is an unbiased estimate of the
cosine (over random rotations); estimates both ways and over several rotations are averaged. Only
where the upper confidence bound reaches the threshold is the cosine computed from the vectors, in
double precision, and that value alone decides.

1. Buckets of all tables get ids, codes, factors and the one-byte vectors; of each bucket only the
   rows that are in a pair left open by the bounds go on, in the first table that proposes the pair.
2. These rows are joined with their vectors, and the exact cosines are computed bucket by bucket.

Equal vectors form one class and are looked up once. Pairs are not emitted: a task returns, for the
pairs in its buckets, the links of each vector and a spanning forest. Buckets beyond `block` members
are split into blocks, and each pair of blocks is a task's work of bounded size.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths do not link; repeated rows of one id and one vector count as one
vector; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import components, discard, ranges, runs, stash


@lru_cache(maxsize=4)
def rotations(dim: int, count: int, seed: int = 11) -> np.ndarray:
    """dim x (dim * count): random orthogonal matrices side by side."""
    rng = np.random.default_rng((seed, dim))
    return np.concatenate([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(count)], 1).astype(np.float32)


def plan_tables(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Bits of a key and number of tables. Two vectors at angle a differ in a bit with chance
    a / pi."""
    same = 1 - math.acos(threshold) / math.pi
    bits = min(28, max(8, round(math.log2(max(n, 2))) - 2))
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same**bits))


def rotation_count(dim: int, width: int, tables: int, checked: int) -> int:
    """Rotations whose signs fill all keys, and the estimate's at least."""
    return max(checked, -(-width * tables // dim))


def encode(x: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows of 0/1) and correction factors (rows x count) of unit vectors."""
    n, dim = x.shape
    y = x.astype(np.float32) @ rotations(dim, count)
    factor = np.abs(y).reshape(n, count, dim).sum(2) / math.sqrt(dim)
    return (y > 0).astype(np.uint8), factor.astype(np.float32)


def table_keys(bits: np.ndarray, width: int, tables: int) -> np.ndarray:
    """Keys (rows x tables) from rows of code bits."""
    b = bits[:, : width * tables].reshape(len(bits), tables, width).astype(np.int64)
    return b @ (1 << np.arange(width, dtype=np.int64))


def in_bytes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors at one byte a coordinate, and the step of each."""
    step = np.maximum(np.abs(x).max(1), 1e-12) / 127
    return np.rint(x / step[:, None]).astype(np.int8), step.astype(np.float32)


def estimate(code: np.ndarray, factor: np.ndarray, turned: np.ndarray, step: np.ndarray, a: np.ndarray, b: np.ndarray, sigmas: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the cosines of rows a and b, and the half-width of their confidence
    interval. code (-1 or 1) and turned: rows x rotations x dim; factor: rows x rotations.

    With x' the code of x of length 1, <x', y> / <x', x> has mean <x, y>; its error has variance
    (1 - <x', x>^2) / <x', x>^2 / (dim - 1) at most."""
    dim = code.shape[2]
    one = np.einsum("nrd,nrd->nr", code[a], turned[b]) / (math.sqrt(dim) * factor[a])
    two = np.einsum("nrd,nrd->nr", code[b], turned[a]) / (math.sqrt(dim) * factor[b])
    spread = np.sqrt((1 - factor**2) / factor**2 / max(1, dim - 1)).mean(1)
    count = code.shape[1]
    # the two ways share both vectors: their errors are not taken to be independent
    half = sigmas * (spread[a] + spread[b]) / 2 / math.sqrt(count) + math.sqrt(dim) * (step[a] + step[b]) / 2
    return (one + two).mean(1) / 2, half


def _forest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node reachable) of the graph of the pairs."""
    nodes, flat = np.unique(np.concatenate((x, y)), return_inverse=True)
    a, b = flat[: len(x)], flat[len(x) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


class _Buckets:
    """Rows of whole buckets, in order: pairs within each, tested in chunks."""

    def __init__(self, width: int, tables: int, threshold: float, checked: int) -> None:
        self.width, self.tables, self.threshold, self.checked = width, tables, threshold, checked

    def open_pairs(self, t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows that the bounds leave open, each in the first table that proposes it."""
        g = t["g"].to_numpy()
        n = len(g)
        first = runs(g)
        size = np.diff(np.append(first, n))
        ids, table = t["vec_id"].to_numpy(), t["t"].to_numpy()
        block, bi, bj = t["blk"].to_numpy(), t["bi"].to_numpy(), t["bj"].to_numpy()
        dims = np.array([len(v) for v in t["small"].to_pylist()])
        after = np.repeat(first + size, size) - np.arange(n) - 1  # rows after it in its bucket
        bounds = np.cumsum(after)
        for dim in np.unique(dims).tolist():
            own = np.flatnonzero(dims == dim)
            taken = t.take(pa.array(own))
            raw = np.frombuffer(b"".join(taken["code"].to_pylist()), np.uint8).reshape(len(own), -1)
            factor = np.frombuffer(b"".join(taken["factor"].to_pylist()), np.float32).reshape(len(own), -1)[:, : self.checked]
            step = taken["step"].to_numpy()
            small = np.frombuffer(b"".join(taken["small"].to_pylist()), np.int8).reshape(len(own), dim)
            local = np.full(n, -1)
            local[own] = np.arange(len(own))
            count = rotation_count(dim, self.width, self.tables, self.checked)
            bits = np.unpackbits(raw, axis=1)[:, : dim * count]
            keys = table_keys(bits, self.width, self.tables)
            code = bits.reshape(len(own), count, dim)[:, : self.checked].astype(np.float32) * 2 - 1
            turned = (small * step[:, None]).astype(np.float32) @ rotations(dim, count)[:, : dim * self.checked]
            turned = turned.reshape(len(own), self.checked, dim)
            chunk, at = max(1000, (4 << 20) // (dim * self.checked)), 0
            while at < n:
                to = max(at + 1, int(np.searchsorted(bounds, (bounds[at - 1] if at else 0) + chunk, "right")))
                rows = np.arange(at, to)
                x, y = np.repeat(rows, after[at:to]), ranges(rows + 1, after[at:to])
                at = to
                # between two blocks, only pairs across; within one, all
                ok = ((bi[x] == bj[x]) | (block[x] != block[y])) & (dims[x] == dim) & (dims[y] == dim) & (ids[x] != ids[y])
                x, y = x[ok], y[ok]
                if not len(x):
                    continue
                lx, ly = local[x], local[y]
                est, half = estimate(code, factor, turned, step, lx, ly)
                near = np.flatnonzero(est + half >= self.threshold)
                near = near[(keys[lx[near]] == keys[ly[near]]).argmax(1) == table[x[near]]]
                if len(near):
                    yield x[near], y[near]

    def open_rows(self, t: pa.Table) -> pa.Table:
        """The rows that are in a pair left open."""
        keep = np.zeros(t.num_rows, bool)
        for x, y in self.open_pairs(t):
            keep[x] = keep[y] = True
        return t.filter(pa.array(keep))

    def links(self, t: pa.Table) -> pa.Table:
        """Exact cosines of the open pairs: links of each vector, and edges of a forest."""
        ids, weight = t["vec_id"].to_numpy(), t["size"].to_numpy()
        lists = t["v"].combine_chunks()
        at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
        links, edges = [], []
        for x, y in self.open_pairs(t):
            dim = int(at[x[0] + 1] - at[x[0]])
            rows, place = np.unique(np.concatenate((x, y)), return_inverse=True)
            vec = unit(flat[(at[rows][:, None] + np.arange(dim))])
            hit = np.einsum("ij,ij->i", vec[place[: len(x)]], vec[place[len(x) :]]) >= self.threshold
            x, y = x[hit], y[hit]
            if len(x):
                edges.append(_forest(ids[x], ids[y]))
                links.append((np.concatenate((ids[x], ids[y])), np.concatenate((weight[y], weight[x]))))
        who = np.concatenate([a for a, _ in links] or [np.zeros(0, np.int64)])
        u, inv = np.unique(who, return_inverse=True)
        total = np.bincount(inv, np.concatenate([b for _, b in links] or [np.zeros(0)]), len(u)).astype(np.int64)
        a = np.concatenate([e for e, _ in edges] or [np.zeros(0, np.int64)])
        b = np.concatenate([e for _, e in edges] or [np.zeros(0, np.int64)])
        return pa.table(
            {
                "vec_id": np.concatenate((u, a)),
                "n": np.concatenate((total, np.zeros(len(a), np.int64))),
                "to": pa.array(np.concatenate((np.zeros(len(u), np.int64), b)), mask=np.arange(len(u) + len(a)) < len(u)),
            }
        )


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_bucket(it: Iterator[pa.RecordBatch], run: Callable[[pa.Table], pa.Table], most: int) -> Iterator[pa.RecordBatch]:
    """Applies run to whole buckets (runs of g) of sorted rows, about `most` rows at a time."""
    held: pa.Table | None = None
    for b in it:
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        if held.num_rows < most:
            continue
        cut = int(runs(held["g"].to_numpy())[-1])  # the last bucket may go on
        if cut:
            yield from run(held.slice(0, cut).combine_chunks()).to_batches()
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield from run(held.combine_chunks()).to_batches()


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.98, block: int = 512, checked: int = 2) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector (vec_id, embedding). recall is the chance
    that a pair exactly at the threshold is proposed; alike pairs are proposed more surely."""
    v = F.col("embedding").cast("array<double>")
    good = F.expr("size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(v, x -> x <> 0)")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    keyed = rows.withColumn("ok", F.coalesce(good, F.lit(False))).withColumn(
        "h", F.when(F.col("ok"), F.sha2(F.concat_ws(",", F.transform("v", lambda x: x.cast("string"))), 256))
    )
    distinct = keyed.where("ok AND vec_id IS NOT NULL").groupBy("h", "vec_id").agg(F.first("v").alias("v"))
    classes = stash(
        distinct.groupBy("h").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("v").alias("v")), "classes"
    )
    n = classes.count()
    width, tables = plan_tables(n, threshold, recall)
    schema = "t int, key long, vec_id long, size long, code binary, factor binary, small binary, step float"

    def sketch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in it:
            for k in range(0, whole.num_rows, 512):
                b = whole.slice(k, 512)
                size = np.array([len(x) for x in b["v"]])
                for dim in np.unique(size).tolist():
                    own = np.flatnonzero(size == dim)
                    x = unit(np.array(b["v"].take(own).to_pylist(), np.float64))
                    small, step = in_bytes(x)
                    bits, factor = encode(x, rotation_count(dim, width, tables, checked))
                    keys = table_keys(bits, width, tables)
                    pick = np.repeat(np.arange(len(own)), tables)
                    column = lambda a: pa.array([r.tobytes() for r in a], pa.binary()).take(pa.array(pick))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "t": pa.array(np.tile(np.arange(tables, dtype=np.int32), len(own))), "key": pa.array(keys.ravel()),
                            "vec_id": b["rep"].take(own).take(pa.array(pick)), "size": b["size"].take(own).take(pa.array(pick)),
                            "code": column(np.packbits(bits, axis=1)), "factor": column(factor), "small": column(small), "step": pa.array(step).take(pa.array(pick)),
                        }
                    )

    hashed = classes.select("rep", "size", "v").mapInArrow(sketch, schema)
    # buckets beyond a block's size, at most rows / block of them, are split
    slim = hashed.select("t", "key")
    large = slim.groupBy("t", "key").agg(F.count("*").alias("m")).where(f"m > {2 * block}").select("t", "key", F.ceil(F.col("m") / block).cast("int").alias("s"))
    dealt = (
        hashed.join(large, ["t", "key"], "left")
        .withColumn("s", F.coalesce("s", F.lit(1)))
        .withColumn("blk", F.pmod(F.xxhash64("vec_id"), F.col("s")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("s") - 1)))
        .withColumn("bi", F.least("blk", "other"))
        .withColumn("bj", F.greatest("blk", "other"))
        .withColumn("g", F.xxhash64("t", "key", "bi", "bj"))
        .select("g", "t", "vec_id", "size", "blk", "bi", "bj", "code", "factor", "small", "step")
    )
    work = _Buckets(width, tables, threshold, checked)
    rows_open = stash(
        dealt.repartition(F.col("g")).sortWithinPartitions("g", "vec_id").mapInArrow(lambda it: _by_bucket(it, work.open_rows, 10_000), dealt.schema), "open"
    )
    exact = rows_open.join(classes.select(F.col("rep").alias("vec_id"), "v"), "vec_id")
    found = stash(
        exact.repartition(F.col("g")).sortWithinPartitions("g", "vec_id").mapInArrow(lambda it: _by_bucket(it, work.links, 10_000), "vec_id long, n long, to long"), "links"
    )
    discard(rows_open)
    links = found.where("to IS NULL").groupBy("vec_id").agg(F.sum("n").alias("n")).withColumnRenamed("vec_id", "rep")
    comp = components(found.where("to IS NOT NULL").select(F.col("vec_id").alias("a"), F.col("to").alias("b")), "near")
    per_class = classes.select("h", "rep", "size").join(links, "rep", "left").join(comp.withColumnRenamed("node", "rep"), "rep", "left")
    out = keyed.select("vec_id", "h").join(per_class, "h", "left")
    return out.select(
        "vec_id",
        F.coalesce(F.col("size") - 1 + F.coalesce("n", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "rep", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "rep", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
