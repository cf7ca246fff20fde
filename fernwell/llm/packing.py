"""Packing by order-preserving dynamic programming.

Each task packs the documents of its part of the table in their order. Windows may end at the end
of a document (free), after a sentence (cheap) or, in steps, inside a sentence (dear); the cuts
minimise padding plus these penalties. With P the tokens up to a cut and f the least cost,

    f(j) = penalty(j) + min over i, P(j) - P(i) <= capacity, of f(i) + capacity - (P(j) - P(i)),

and as capacity - P(j) does not depend on i, the minimum of f(i) + P(i) over a sliding window is
kept in a monotone queue: linear time. A buffer holds some hundred windows; all but the last few
are handed on, so that memory does not depend on the input and no padding arises between buffers.
What is left at the end of a task is cut into powers of two, which need no padding.

No shuffle; a task that is run again gives the same windows. Cases: a null text is only its end
id; an empty table gives no rows; equal rows are packed one after the other; a document longer
than a window spans windows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, ranges, sorted_distinct
from .tokens import encode_texts

_END_MARKS = (".", "!", "?", "…", "。", "！", "？")


@lru_cache(maxsize=2)
def sentence_ends(path: str) -> np.ndarray:
    """For each id whether a sentence or line may end after it."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    n = t.get_vocab_size()
    out = np.zeros(max(n, 1 << 16), bool)
    for i, s in enumerate(t.decode_batch([[i] for i in range(n)], skip_special_tokens=False)):
        out[i] = s.rstrip(" \"')").endswith(_END_MARKS) or "\n" in s
    return out


def cut_windows(places: np.ndarray, penalty: np.ndarray, capacity: int) -> list[int]:
    """Indices into places (ascending, first 0, gaps at most capacity) at which windows end, the
    last place being one."""
    p, pen = places.tolist(), penalty.tolist()
    n = len(p)
    f, came = [0] * n, [0] * n
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # key, place, index
    for j in range(1, n):
        pj = p[j]
        while queue[0][1] < pj - capacity:
            queue.popleft()
        key, _, i = queue[0]
        f[j] = key + capacity - pj + pen[j]
        came[j] = i
        key = f[j] + pj
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, pj, j))
    out, j = [], n - 1
    while j:
        out.append(j)
        j = came[j]
    return out[::-1]


def powers_of_two(n: int, least_padding: int, capacity: int) -> list[int]:
    """Lengths of the windows for the last n < capacity tokens."""
    if capacity - n <= least_padding:
        return [n]
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs a stream of documents; rows() has the finished pieces."""

    def __init__(self, ends: np.ndarray, capacity: int, sentence: int, inside: int, step: int, windows: int) -> None:
        self.ends, self.capacity, self.sentence, self.inside, self.step = ends, capacity, sentence, inside, step
        self.limit = max(windows, 16) * capacity
        self.ids = np.zeros(0, np.uint16)
        self.docs: list[tuple[int | None, int, int]] = []  # id, all its tokens, tokens already out
        self.waiting: list[np.ndarray] = []
        self.n, self.made, self.out = 0, 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids), 0))
        self.waiting.append(ids)
        self.n += len(ids)
        if self.n >= self.limit:
            self.pack(False)

    def pack(self, final: bool) -> None:
        ids = np.concatenate([self.ids, *self.waiting])
        self.waiting = []
        left = np.array([n - o for _, n, o in self.docs], np.int64)
        doc_ends = np.cumsum(left)
        whole = len(ids)
        target = whole
        if whole:
            sent = np.flatnonzero(self.ends[ids]) + 1
            marks = sorted_distinct(np.concatenate(([0], sent, doc_ends)))
            gap = np.diff(marks)
            extra = (gap - 1) // self.step
            inner = np.repeat(marks[:-1], extra) + ranges(np.ones(len(extra), np.int64), extra) * self.step
            places = np.concatenate((marks, inner))
            pen = np.concatenate((np.full(len(marks), self.sentence), np.full(len(inner), self.inside)))
            order = np.argsort(places, kind="stable")
            places, pen = places[order], pen[order]
            pen[np.isin(places, doc_ends)] = 0
            cuts = places[cut_windows(places, pen, self.capacity)].tolist()
            if not final:
                cuts = cuts[:-4]  # the end of the buffer bears on the last few
                target = cuts[-1] if cuts else 0
            else:
                start = cuts[-2] if len(cuts) > 1 else 0
                tail = powers_of_two(whole - start, 64, self.capacity) if whole - start < self.capacity else [whole - start]
                cuts = cuts[:-1] + (start + np.cumsum(tail)).tolist()
            self.emit(ids, doc_ends, cuts)
        self.ids = ids[target:]
        kept, at = [], 0
        for (doc_id, n, o), e in zip(self.docs, doc_ends.tolist(), strict=True):
            if e > target:
                kept.append((doc_id, n, o + max(0, target - at)))
            at = e
        self.docs = kept
        self.n = len(self.ids)

    def emit(self, ids: np.ndarray, doc_ends: np.ndarray, cuts: list[int]) -> None:
        wide = ids.astype("<u4")
        d, begin, doc_begin = 0, 0, 0
        ends = doc_ends.tolist()
        for cut in cuts:
            at = begin
            while at < cut:
                while ends[d] <= at:
                    doc_begin = ends[d]
                    d += 1
                to = min(cut, ends[d])
                doc_id, n, o = self.docs[d]
                self.out.append((doc_id, o + at - doc_begin, to - at, zlib.crc32(wide[at:to].tobytes()), n, self.made, at - begin))
                at = to
            self.made += 1
            begin = cut

    def rows(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, sentence: int = 4, inside: int = 10, step: int = 8, windows: int = 256) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    sentence and inside are the penalties, in tokens of padding, of a cut after a sentence and
    within one; step is the distance of the cuts within sentences; windows is the buffer's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(sentence_ends(tokenizer), capacity, sentence, inside, step, windows)
        base = TaskContext.get().partitionId() << 33
        tail = np.array([end_id], np.uint16)

        def flush() -> pa.RecordBatch:
            got = packer.rows()
            rows = np.array([[-1 if r[0] is None else r[0], *r[1:]] for r in got], np.int64).reshape(-1, 7)
            cols = [pa.array(rows[:, i] + (base if _COLUMNS[i] == "sequence_id" else 0)) for i in range(7)]
            if any(r[0] is None for r in got):
                cols[0] = pa.array([r[0] for r in got], pa.int64())
            return pa.RecordBatch.from_arrays(cols, list(_COLUMNS))

        for b in batches:
            names = b["doc_id"].to_pylist()
            for at, off, ids in encode_texts(tokenizer, b["text"]):
                for i in range(len(off) - 1):
                    packer.add(names[at + i], np.concatenate((ids[off[i] : off[i + 1]], tail)))
                if packer.out:
                    yield flush()
        packer.pack(True)
        yield flush()

    slim = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return slim.mapInArrow(run, ", ".join(f"{c} long" for c in _COLUMNS))
