"""Benchmark decontamination by latent semantic retrieval.

1. Document frequencies of hashed words over all documents give the TF-IDF weights.
2. The benchmark's passages (overlapping windows of its items) are the rows of a TF-IDF matrix; a
   distributed randomised SVD (a range finder with one power iteration, each pass a sum over the
   partitions) gives the latent space they span.
3. Every window of every document is compared with every passage there. The cosine divides by the
   window's whole length, so that a window whose rare words are not the benchmark's stays far from
   it. By Cauchy-Schwarz a window cannot reach the limit where the weights of its words that the
   benchmark has at all are too small; only the other windows are projected. That drops no window
   that could be a candidate.
   Passages that keep less than `least_kept` of their length in the latent space (its rank is
   bounded, the number of passages is not) are searched by their exact TF-IDF cosine as well. Their
   heaviest words are looked up, as many as leave the others without the limit by Cauchy-Schwarz;
   each place of such a word gives the window that aligns it with the passage.
   Items of up to two windows are searched whole in the same way, with windows of their own length
   at any offset: the words around a short copy do not count against it.
4. Candidates are checked on the words: the longest common subsequence of item and surrounding
   text must cover `least_common` of the item, and `least_answer` of its answer (its last sentence;
   with one sentence, its last quarter, one word at least). Changed, added or dropped words lower
   the share only.

The benchmark is taken in chunks of at most `chunk_items` items, which bounds what is broadcast
(vocabulary x rank) whatever its size. Two passes over the texts, no shuffle of texts.

Cases: null and empty texts and items match nothing; equal rows of an item or a document count
once per row; a document shorter than a window is one window; empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import column_bytes, documents_of, lower_ascii, ranges, release, runs, sorted_distinct, word_bounds, word_hashes

_BINS = 16
_SLICE = 1 << 20
_SENTENCE = re.compile(r"[.!?。！？]+(?=\s|$)|\n")


def words_of(off: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of ASCII letters and digits and of all other scripts' bytes,
    lower-cased in A-Z) and the first word of each document (documents + 1)."""
    low = lower_ascii(data)
    s, e, first = word_bounds(low, off, ((low >= 97) & (low <= 122)) | ((low >= 48) & (low <= 57)) | (low >= 128))
    return word_hashes(low, s, e), first


def slices(col: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, word hashes and word bounds of slices of a text column."""
    off, data = column_bytes(col)
    at, n = 0, len(off) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + _SLICE, "right")) - 1)
        yield at, *words_of(off[at : to + 1] - off[at], data[off[at] : off[to]])
        at = to


def _hash_words(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return words_of(np.array([0, len(raw)]), raw)[0]


def weights(docs: DataFrame) -> np.ndarray:
    """IDF of each of 2^16 bins of hashed words, over all documents (doc_id, text as bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((1 << _BINS) + 1, np.int64)
        for b in batches:
            for _, h, at in slices(b["text"]):
                n = len(at) - 1
                doc = np.repeat(np.arange(n, dtype=np.int64), np.diff(at))
                key = sorted_distinct((doc << _BINS) | (h >> np.uint64(64 - _BINS)).astype(np.int64))
                count[:-1] += np.bincount(key & ((1 << _BINS) - 1), minlength=1 << _BINS)
                count[-1] += n
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({"bin": pa.array(some.astype(np.int32)), "n": pa.array(count[some])})

    # at most 2^16 + 1 rows come back
    got = docs.select("text").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    release(docs.sparkSession)
    count = np.zeros((1 << _BINS) + 1, np.int64)
    count[got["bin"].to_numpy()] = got["n"].to_numpy()
    return np.log((count[-1] + 1.0) / (count[:-1] + 1.0)).astype(np.float32) + np.float32(0.01)


def windows(at: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and end of the windows; the last one of a document ends with it."""
    n = np.diff(at)
    count = np.where(n > 0, np.maximum(0, -(-(n - width) // stride)) + 1, 0)
    doc = np.repeat(np.arange(len(n)), count)
    nth = ranges(np.zeros(len(n), np.int64), count)
    start = at[doc] + np.minimum(nth * stride, np.maximum(n[doc] - width, 0))
    return doc, start, np.minimum(start + width, at[doc + 1])


class Exact:
    """Word sequences searched by their exact TF-IDF cosine: rows [start, end) of items' words."""

    def __init__(self, items: Items, item: np.ndarray, start: np.ndarray, end: np.ndarray, limit: float) -> None:
        v = max(1, len(items.vocabulary))
        self.item, self.size, self.limit, self.v = item, end - start, limit, v
        idx = ranges(start, self.size)
        row = np.repeat(np.arange(len(item)), self.size)
        c = items.columns(items.flat[idx])
        self.key, inverse, m = np.unique(row * v + c, return_inverse=True, return_counts=True)
        own = self.key // v
        x = m * items.weight[self.key % v].astype(np.float64)
        self.value = x / np.sqrt(np.bincount(own, x * x, len(item)))[own]
        # heaviest words first, until the rest of the sequence is shorter than the limit
        order = np.lexsort((-self.value, own))
        mass = np.cumsum(self.value[order] ** 2)
        before = np.concatenate(([0.0], mass))[:-1]
        first = runs(own[order])
        before -= np.repeat(before[first], np.diff(np.append(first, len(order))))
        anchor = np.zeros(len(self.key), bool)
        anchor[order] = before <= 1 - limit * limit + 1e-6
        use = np.flatnonzero(anchor[inverse])
        use = use[np.argsort(c[use], kind="stable")]
        self.row, self.place = row[use], (idx - start[row])[use]
        self.posts = np.searchsorted(c[use], np.arange(v + 1))

    def candidates(self, at: np.ndarray, col: np.ndarray, w2: np.ndarray, whole: np.ndarray, known: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, ...]]:
        """(document, item, start, end, cosine) of the windows that a heavy word aligns."""
        if not len(self.item):
            return
        where = np.flatnonzero(col >= 0)
        count = self.posts[col[where] + 1] - self.posts[col[where]]
        where, count = where[count > 0], count[count > 0]
        total = np.cumsum(count)
        i = 0
        while i < len(where):
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + most, "right")))
            n, pos = count[i:j], np.repeat(where[i:j], count[i:j])
            post = ranges(self.posts[col[where[i:j]]], n)
            i = j
            doc, row = np.searchsorted(at, pos, "right") - 1, self.row[post]
            s = np.maximum(np.minimum(pos - self.place[post], at[doc + 1] - self.size[row]), at[doc])
            e = np.minimum(s + self.size[row], at[doc + 1])
            go = known[e] - known[s] >= self.limit**2 * (whole[e] - whole[s]) * (1 - 1e-9)
            u, k = np.unique(s[go] * len(self.item) + row[go], return_index=True)
            if not len(u):
                continue
            doc, row, s, e = doc[go][k], row[go][k], s[go][k], e[go][k]
            idx, pair = ranges(s, e - s), np.repeat(np.arange(len(s)), e - s)
            has = col[idx] >= 0
            idx, pair = idx[has], pair[has]
            key = row[pair] * self.v + col[idx]
            f = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            dot = np.bincount(pair, np.where(self.key[f] == key, self.value[f], 0) * np.sqrt(w2[idx]), len(s))
            size2 = whole[e] - whole[s]
            near = dot * dot >= self.limit**2 * size2 * (1 - 1e-9)
            # a repeated word weighs by its square in the window's true length
            mine = near[pair]
            u, k, m = np.unique(pair[mine] * self.v + col[idx[mine]], return_index=True, return_counts=True)
            size2 = size2 + np.bincount(u // self.v, (m * m - m) * w2[idx[mine][k]], len(s))
            cos = dot / np.sqrt(np.maximum(size2, 1e-18))
            near = np.flatnonzero(near & (cos >= self.limit))
            yield doc[near], self.item[row[near]], s[near], e[near], cos[near].astype(np.float32)


class Items:
    """A chunk of the benchmark: its words, vocabulary and passages."""

    def __init__(self, rows: list[tuple[int, str]], idf: np.ndarray, width: int, stride: int) -> None:
        self.ids = [i for i, _ in rows]
        self.words = [_hash_words(t) for _, t in rows]
        self.answers = []
        for (_, t), w in zip(rows, self.words, strict=True):
            parts = [p for p in (_hash_words(x) for x in _SENTENCE.split(t)) if len(p)]
            self.answers.append(parts[-1] if len(parts) > 1 else w[min(-(-3 * len(w) // 4), len(w) - 1) :])
        flat = np.concatenate(self.words or [np.zeros(0, np.uint64)])
        self.vocabulary = np.unique(flat)
        self.weight = idf[(self.vocabulary >> np.uint64(64 - _BINS)).astype(np.int64)]
        self.in_bin = np.zeros(1 << _BINS, bool)
        self.in_bin[(self.vocabulary >> np.uint64(64 - _BINS)).astype(np.int64)] = True
        at = np.concatenate(([0], np.cumsum([len(w) for w in self.words]))).astype(np.int64)
        self.flat, self.at = flat, at
        self.item, self.start, self.end = windows(at, width, stride)
        self.space = np.zeros((len(self.vocabulary), 0), np.float32)
        self.weighted = self.space
        self.passages = np.zeros((0, 0), np.float32)
        self.exact: Exact | None = None

    def columns(self, h: np.ndarray) -> np.ndarray:
        """Place of each word in the vocabulary, -1 if it has none."""
        out = np.full(len(h), -1, np.int64)
        maybe = np.flatnonzero(self.in_bin[(h >> np.uint64(64 - _BINS)).astype(np.int64)])
        if len(maybe):
            k = np.searchsorted(self.vocabulary, h[maybe])
            k[k == len(self.vocabulary)] = 0
            out[maybe] = np.where(self.vocabulary[k] == h[maybe], k, -1)
        return out

    def matrix(self, which: np.ndarray) -> np.ndarray:
        """TF-IDF rows of passages, of length 1."""
        a = np.zeros((len(which), len(self.vocabulary)), np.float32)
        for r, p in enumerate(which.tolist()):
            c = self.columns(self.flat[self.start[p] : self.end[p]])
            np.add.at(a[r], c, self.weight[c])
        return a / np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-9)


def latent_space(benchmark: DataFrame, items: Items, rank: int, energy: float = 0.9, seed: int = 5) -> np.ndarray:
    """vocabulary x k: the leading right singular vectors of the passages' TF-IDF matrix, with the
    least k up to rank that keeps the wanted share of its energy. Passages are dealt over tasks;
    each task returns its part of A'AX, and the parts are added."""
    n, v = len(items.item), len(items.vocabulary)
    width = min(rank + 10, v, n)
    if not width:
        return np.zeros((v, 0), np.float32)
    spark = benchmark.sparkSession
    parts = max(1, min(8, n // 2000))

    def times(x: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(x.shape, np.float32)
            for b in batches:
                which = b["id"].to_numpy()
                for k in range(0, len(which), 512):
                    a = items.matrix(which[k : k + 512])
                    total += a.T @ (a @ x)
            yield pa.RecordBatch.from_pydict({"part": pa.array([total.tobytes()], pa.large_binary() if total.nbytes > 1 << 31 else pa.binary())})

        got = spark.range(0, n, 1, parts).mapInArrow(run, "part binary").toLocalIterator()
        out = np.zeros(x.shape, np.float32)
        for row in got:
            out += np.frombuffer(row["part"], np.float32).reshape(x.shape)
        return out

    q = np.random.default_rng(seed).normal(size=(v, width)).astype(np.float32)
    for _ in range(2):
        q = np.linalg.qr(times(q))[0].astype(np.float32)
    gram = q.T @ times(q)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    value, vector = np.maximum(value[::-1], 0), vector[:, ::-1]
    k = min(rank, int(np.searchsorted(np.cumsum(value), energy * n)) + 1, width)
    return np.ascontiguousarray((q @ vector[:, :k]).astype(np.float32))


def common_subsequence(pattern: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence; pattern has, for each word, the bits of its
    places among `size` words."""
    full = (1 << size) - 1
    row = full
    for w in text:
        m = pattern.get(w)
        if m is not None:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return size - row.bit_count()


def _bits(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | (1 << i)
    return out


def find(docs: DataFrame, benchmark: DataFrame, width: int = 16, stride: int = 8, item_stride: int = 4, rank: int = 512, limit: float = 0.5, least_common: float = 0.7, least_answer: float = 0.5, chunk_items: int = 2000, least_kept: float = 0.9) -> DataFrame:
    """doc_id, item_id, cosine (the highest), common and answer (shares of the item and of its
    answer that the document has in order): one row for each document and item that it holds."""
    texts = documents_of(docs)
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    idf = weights(texts)
    chunks = max(1, -(-bench.count() // chunk_items))
    schema = "doc_id long, item_id long, cosine double, common double, answer double"
    out: DataFrame | None = None
    for c in range(chunks):
        own = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(chunks)) == c)
        rows = sorted((r["item_id"], r["text"]) for r in own.where("item_id IS NOT NULL").toLocalIterator())
        items = Items([r for r in rows if len(_hash_words(r[1]))], idf, width, item_stride)
        items.space = latent_space(bench, items, rank)
        p = np.concatenate([items.matrix(np.arange(k, min(k + 512, len(items.item)))) @ items.space for k in range(0, len(items.item), 512)] or [np.zeros((0, 0), np.float32)])
        items.weighted = items.space * items.weight[:, None]
        kept = np.linalg.norm(p, axis=1)
        items.passages = p / np.maximum(kept[:, None], 1e-9)
        low, whole = kept < least_kept, np.flatnonzero(np.diff(items.at) <= 2 * width)
        join = lambda a, b: np.concatenate((a, b))
        items.exact = Exact(items, join(items.item[low], whole), join(items.start[low], items.at[whole]), join(items.end[low], items.at[whole + 1]), limit)
        part = texts.mapInArrow(_search(items, idf, width, stride, limit, least_common, least_answer), schema)
        out = part if out is None else out.unionByName(part)
    return out


def _search(items: Items, idf: np.ndarray, width: int, stride: int, limit: float, least_common: float, least_answer: float):  # noqa: ANN202
    def candidates(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """(document, item, start, end, cosine) of windows near a passage."""
        doc, s, e = windows(at, width, stride)
        nothing = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.float32),)
        if not len(s) or not len(items.passages):
            return nothing
        w2 = idf[(h >> np.uint64(64 - _BINS)).astype(np.int64)].astype(np.float64) ** 2
        col = items.columns(h)
        whole = np.concatenate(([0], np.cumsum(w2)))
        known = np.concatenate(([0], np.cumsum(np.where(col >= 0, w2, 0))))
        size2, known2 = whole[e] - whole[s], known[e] - known[s]
        go = np.flatnonzero(known2 >= limit * limit * size2 * (1 - 1e-9))
        found = list(items.exact.candidates(at, col, w2, whole, known))
        for k in range(0, len(go), 1000):
            g = go[k : k + 1000]
            n = e[g] - s[g]
            idx = ranges(s[g], n)
            row = np.repeat(np.arange(len(g)), n)
            has = col[idx] >= 0
            row, c = row[has], col[idx][has]
            if not len(row):
                continue
            # the windows' first known words are added, then their second ones, and so on
            first = runs(row)
            nth = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
            order = np.argsort(nth, kind="stable")
            cuts = np.append(runs(nth[order]), len(order)).tolist()
            z = np.zeros((len(g), items.space.shape[1]), np.float32)
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                pick = order[i:j]
                z[row[pick]] += items.weighted[c[pick]]
            # a repeated word weighs by its square in the window's true length
            key = row.astype(np.int64) * len(items.vocabulary) + c
            u, m = np.unique(key, return_counts=True)
            extra = np.bincount(u // len(items.vocabulary), (m * m - m) * items.weight[u % len(items.vocabulary)].astype(np.float64) ** 2, len(g))
            z /= np.sqrt(size2[g] + extra)[:, None].astype(np.float32)
            cos = z @ items.passages.T
            r, p = np.nonzero(cos >= limit)
            found.append((doc[g[r]], items.item[p], s[g[r]], e[g[r]], cos[r, p]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else nothing

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [_bits(w) for w in items.words]
        answers = [_bits(w) for w in items.answers]
        for b in batches:
            ids = b["doc_id"].to_pylist()
            cols: list[list] = [[], [], [], [], []]
            for base, h, at in slices(b["text"]):
                doc, item, s, e, cos = candidates(h, at)
                order = np.lexsort((s, item, doc))
                pair = doc[order] * max(1, len(items.ids)) + item[order]
                bounds = np.append(runs(pair), len(pair))
                for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    d, k = int(doc[order[i]]), int(item[order[i]])
                    m = len(items.words[k])
                    best = (0, 0)
                    lo = hi = -1
                    for w in [*order[i:j].tolist(), -1]:
                        # an item's length to both sides; overlapping stretches are one
                        a = max(int(at[d]), int(s[w]) - m) if w >= 0 else 1 << 62
                        if a > hi:
                            if hi > lo >= 0:
                                text = h[lo:hi].tolist()
                                lcs = common_subsequence(bits[k], m, text)
                                if lcs > best[0] and lcs >= least_common * m:
                                    best = max(best, (lcs, common_subsequence(answers[k], len(items.answers[k]), text)))
                            lo = a
                        if w >= 0:
                            hi = max(hi, min(int(at[d + 1]), int(e[w]) + m))
                    answer = best[1] / max(1, len(items.answers[k]))
                    if best[0] >= least_common * m and answer >= least_answer:
                        for c, x in zip(cols, (ids[base + d], items.ids[k], float(cos[order[i:j]].max()), best[0] / m, answer), strict=True):
                            c.append(x)
            yield pa.RecordBatch.from_pydict(
                {n: pa.array(c, pa.int64() if n.endswith("_id") else pa.float64()) for n, c in zip(("doc_id", "item_id", "cosine", "common", "answer"), cols, strict=True)}
            )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with their columns as they are. Rows without an
    id stay if no other row without an id holds one."""
    held = find(docs, benchmark).select(F.struct(F.col("doc_id").alias("id")).alias("doc_id")).distinct()
    # a struct, so that no id is like no id; the other columns go along under one name
    rows = docs.select(F.struct(F.col("doc_id").cast("long").alias("id")).alias("doc_id"), F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"))
    return rows.join(held, "doc_id", "left_anti").select("row.*")
