"""Exact substring deduplication by difference-cover blocks.

A byte goes when a string of `length` bytes that covers it also starts at another place, in the
same document or in another. Blocks and buckets (see shared.py) find these strings:

1. *Cover sample.* Positions whose remainder modulo v lies in a perfect difference set are ranked
   by the v' = length - v + 1 bytes that follow. For any two places of one long string there is a
   shift below v that brings both into the sample, so a string can only repeat if one of the
   sampled positions in its first v bytes has a rank that repeats. All else is settled here, after
   about 6 % of the positions were sent.
2. *Long ties.* What is left lies in long repeats. Its positions are cut into short stretches at
   places chosen by content (a synchronizing set), and a stretch is ranked together with all the
   bytes that its strings reach. Equal ranks settle all strings of all but one stretch at once.
3. *Buckets of strings.* The strings of one stretch of each rank, and of the stretches that tie
   with none, are sent to the bucket of their hash; each bucket is sorted for itself.

Passages of `passage_words` words that another document has too are found beside them: the same
cover idea over words, whose samples and windows of words travel with the hashes of steps 1 and 2.

Every step holds one block or one bucket; no suffix array of the corpus is ever in one place. Ranks
are equality classes by 64-bit hashes, so the order inside a bucket is that of the hashes and not
of the bytes, which the question does not need. Two different strings get one hash with a chance
of about n^2 / 2^63 for n candidate strings (two polynomial hashes modulo 2^31 - 1, mixed; for a
given pair of strings of m bytes it is at most (m / 2^31)^2 over all bases). Texts travel compressed.

Cases: a null text is empty; a text shorter than `length` loses nothing; equal rows lose all their
bytes when long enough; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import (
    block_count,
    bucket_answers,
    cut_by_bucket,
    documents_of,
    in_blocks,
    merged,
    mix,
    planes,
    prefix_hash,
    range_hash,
    ranges,
    runs,
    text_bytes,
    with_text_hash,
    word_bounds,
    word_hashes,
    words_at,
)

_SYNC, _SYNC_BITS = 16, 4
_ASKED = "block int, bucket int, payload binary"


@lru_cache(maxsize=8)
def difference_cover(p: int) -> tuple[int, tuple[int, ...]]:
    """A perfect difference set for a prime p: p + 1 residues modulo p^2 + p + 1 in which every
    residue is a difference. Powers of a generator of GF(p^3) that lie in a plane (Singer)."""
    v = p * p + p + 1
    for c in range(1, p**3):
        a, b, k = c % p, c // p % p, c // p // p % p  # x^3 = a + b x + k x^2
        x, seen, plane = (1, 0, 0), 0, []
        while True:
            if x[2] == 0:
                plane.append(seen)
            x = ((x[2] * a) % p, (x[0] + x[2] * b) % p, (x[1] + x[2] * k) % p)
            seen += 1
            if seen == v or (x[1] == 0 and x[2] == 0):
                break
        if seen == v and x[1] == 0 and x[2] == 0 and len(plane) == p + 1:
            if len({(i - j) % v for i in plane for j in plane}) == v:
                return v, tuple(sorted(plane))
    raise ValueError(f"{p} is not a prime")


def _twice(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes with at most two copies of each, and where each hash of the input stands."""
    if not len(hashes):
        return hashes, np.zeros(0, np.int64)
    order = np.argsort(hashes)
    s = hashes[order]
    first = runs(s)
    n = np.diff(np.append(first, len(s)))
    sent = np.repeat(s[first], np.minimum(n, 2))
    at = np.cumsum(np.minimum(n, 2)) - np.minimum(n, 2)
    place = np.empty(len(s), np.int64)
    place[order] = np.repeat(at, n)
    return sent, place


def _ask(block: int, hashes: np.ndarray, n_buckets: int) -> pa.Table:
    cuts = cut_by_bucket(hashes, n_buckets)
    some = np.flatnonzero(np.diff(cuts))
    return pa.table(
        {
            "block": pa.array(np.full(len(some), block, np.int32)),
            "bucket": pa.array(some.astype(np.int32)),
            "payload": pa.array([planes(hashes[cuts[b] : cuts[b + 1]]) for b in some], pa.binary()),
        }
    )


def _shared_codes(arrays: list[np.ndarray], _blocks: list[int]) -> list[np.ndarray]:
    """0: found once; 1: found again elsewhere; 2: so, and this is the first of them."""
    both = np.concatenate(arrays)
    order = np.argsort(both, kind="stable")
    first = runs(both[order])
    n = np.diff(np.append(first, len(both)))
    code = np.empty(len(both), np.uint8)
    code[order] = np.repeat(n > 1, n)
    code[order[first[n > 1]]] = 2
    return np.split(code, np.cumsum([len(a) for a in arrays])[:-1])


class _Passages:
    """The words of a block's documents, and which windows of them other documents have."""

    def __init__(self, b: _Block, words: int) -> None:
        s, e, self.at = word_bounds(b.data, b.off)
        self.words = words
        self.prime = max(p for p in (1, 2, 3, 5, 7, 11) if p * p + p + 1 < words) if words > 3 else 1
        self.v, self.cover = difference_cover(self.prime) if self.prime > 1 else (1, (0,))
        self.hash = word_hashes(b.data, s, e)
        pos = b.cover_places(np.diff(self.at), self.at[:-1], words, self.v, self.cover)
        self.pos = np.sort(pos)
        self.sample, self.sample_place = self.by_document(self.pos, words - self.v + 1)

    def windows(self, pos: np.ndarray, size: int) -> np.ndarray:
        """Hashes of `size` words from each place: two windows of a power of two that cover them."""
        h, n = self.hash, 1
        while 2 * n <= size:
            h = mix(h[: len(h) - n] * _ODD + h[n:]) if len(h) > n else h[:0]
            n *= 2
        return mix(h[pos] * _ODD + h[pos + size - n] + np.uint64(size)) if len(pos) else np.zeros(0, np.uint64)

    def by_document(self, pos: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes that the block sends, one for each document that has it, and where the hash of
        each place stands among them."""
        h = self.windows(pos, size)
        doc = np.searchsorted(self.at, pos, "right") - 1
        order = np.argsort(h, kind="stable")  # equal hashes stay in the order of documents
        hs, ds = h[order], doc[order]
        new = np.ones(len(hs), bool)
        new[1:] = (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1])
        place = np.empty(len(h), np.int64)
        place[order] = np.cumsum(new) - 1
        return hs[new], place

    def open_windows(self, again: np.ndarray) -> np.ndarray:
        """Starts of windows in whose first v words a sample that another document has stands."""
        return _starts(self.pos[again[self.sample_place]], self.at, self.v, self.words)

    def totals(self, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Maximal runs of words under the windows from these starts, and words in them."""
        return _by_document(start, self.words, self.at)[2:]


def _starts(p: np.ndarray, bounds: np.ndarray, v: int, length: int) -> np.ndarray:
    """Starts of strings of a length, within documents, in whose first v places one of p lies."""
    p = np.sort(p)
    doc = np.searchsorted(bounds, p, "right") - 1
    lo, hi = np.maximum(p - v + 1, bounds[doc]), np.minimum(p, bounds[doc + 1] - length) + 1
    ok = hi > lo
    a, b = merged(lo[ok], hi[ok])
    return ranges(a, b - a)


def _by_document(start: np.ndarray, length: int, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal runs (start, end) under strings of a length from ascending starts, none across two
    documents, and for each document its runs and the places in them."""
    doc = np.searchsorted(bounds, start, "right") - 1
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > start[:-1] + length) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    a = start[first]
    b = start[np.append(first[1:], len(start)) - 1] + length if len(first) else a
    n = len(bounds) - 1
    return a, b, np.bincount(doc[first], minlength=n), np.bincount(doc[first], b - a, minlength=n).astype(np.int64)


_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Block:
    """The documents of one block as one byte array, and the steps over it."""

    def __init__(self, t: pa.Table, length: int, prime: int) -> None:
        self.block = t["block"][0].as_py()
        t = t.sort_by([("doc_id", "ascending"), ("th", "ascending")])
        self.ids = t["doc_id"]
        unpack = zstandard.ZstdDecompressor().decompress
        texts = [unpack(x) for x in t["z"].to_pylist()]
        self.off = np.concatenate(([0], np.cumsum([len(x) for x in texts]))).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.length = length
        self.v, self.cover = difference_cover(prime)
        self.prefix = prefix_hash(self.data)

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the cover sample and hashes of their ranks."""
        pos = self.cover_places(np.diff(self.off), self.off[:-1], self.length, self.v, self.cover)
        return pos, range_hash(self.prefix, pos, pos + self.length - self.v + 1)

    def cover_places(self, sizes: np.ndarray, starts: np.ndarray, length: int, v: int, cover: tuple[int, ...]) -> np.ndarray:
        """Places of the cover sample in documents of the given sizes that start where stated."""
        last = np.where(sizes >= length, sizes - (length - v + 1), -1)  # last start in the document
        at = []
        for r in cover:
            count = np.where(last >= r, (last - r) // v + 1, 0)
            which = np.repeat(np.arange(len(sizes)), count)
            at.append(starts[which] + r + ranges(np.zeros(len(sizes), np.int64), count) * v)
        return np.concatenate(at) if at else np.zeros(0, np.int64)

    def candidates(self, pos: np.ndarray, again: np.ndarray) -> np.ndarray:
        """Starts whose string may repeat: a repeated sample lies in its first v bytes."""
        return _starts(pos[again], self.off, self.v, self.length)

    def stretches(self, cand: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each candidate its stretch (-1: none) and, for each stretch, its candidates' first
        index and the hash of all that its strings reach."""
        if not len(cand):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        n = len(self.data) - _SYNC + 1
        eight = words_at(self.data)
        value = eight[:n] * _ODD + eight[8 : n + 8] * np.uint64(0xD6E8FEB86659FD93)
        here = value >> np.uint64(64 - _SYNC_BITS) == 0
        sync = np.flatnonzero(here)
        before = np.zeros(len(self.data) + 1, np.int32)  # stretches that start before a place
        np.cumsum(here, out=before[1 : n + 1])
        before[n + 1 :] = before[n]
        k = before[cand]
        x = np.append(sync, 1 << 62)[k]
        none = x > cand + self.length - _SYNC
        key = np.where(none, -1, x)
        own = np.flatnonzero(~none)
        first = own[runs(key[own])]
        at = key[first]
        before = np.concatenate(([-1], sync))[k[first]] + 1
        doc = np.searchsorted(self.off, at, "right") - 1
        lo = np.maximum(np.maximum(before, at - self.length + _SYNC), self.off[doc])
        hi = np.minimum(at + self.length, self.off[doc + 1])
        h = mix(range_hash(self.prefix, lo, hi) ^ mix((at - lo).astype(np.uint64)))
        stretch = np.full(len(cand), -1, np.int64)
        stretch[own] = np.searchsorted(at, key[own])
        return stretch, first, h

    def open_strings(self, stretch: np.ndarray, codes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which candidates are sent on: those of no stretch, of a stretch that ties with none, and
        of the one stretch in all blocks that stands for its rank."""
        send = np.ones(len(stretch), bool)
        if len(place):
            code = codes[place]
            go = code == 0
            lead = np.flatnonzero(code == 2)
            go[lead[np.unique(place[lead], return_index=True)[1]]] = True
            inside = stretch >= 0
            send[inside] = go[stretch[inside]]
        return send


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed one by one."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for b in batches:
        z = pa.array([pack(x.as_buffer()) for x in b["text"]], pa.binary())
        yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "th": b["th"], "block": b["block"], "z": z})


def _answers(t: pa.Table, stage: int, n_buckets: int, words: bool) -> np.ndarray:
    own = [(b, p) for s, b, p in zip(t["stage"].to_pylist(), t["bucket"].to_pylist(), t["payload"].to_pylist(), strict=True) if s == stage and (b >= n_buckets) == words]
    return np.concatenate([np.frombuffer(p, np.uint8) for _, p in sorted(own)] or [np.zeros(0, np.uint8)])


def remove_repeats(docs: DataFrame, length: int = 400, prime: int = 17, block_bytes: int = 4 << 20, bucket_bytes: int = 8 << 20, with_text: bool = False, passage_words: int = 51) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_passages and n_passage_words (maximal runs
    of words that lie in windows of passage_words words which another document has, and their
    words), and kept (the remaining bytes) if with_text, of every document. prime sets the cover:
    prime^2 + prime + 1 must be under length."""
    v, cover = difference_cover(prime)
    if v >= length:
        raise ValueError("the cover's modulus must be less than the length")
    docs = with_text_hash(documents_of(docs))
    total = text_bytes(docs)
    n_blocks = block_count(total, block_bytes)
    n_buckets = block_count(total * 8 * len(cover) // v, bucket_bytes)
    d = in_blocks(docs, n_blocks).mapInArrow(_packed, "doc_id long, th long, block int, z binary")
    out_schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_passages long, n_passage_words long" + ", kept binary" * with_text

    def ask(b: _Block, hashes: np.ndarray, of_words: np.ndarray | None = None) -> pa.Table:
        """Hashes of bytes, and those of words behind them, for buckets of their own."""
        asked = _ask(b.block, _twice(hashes)[0], n_buckets)
        if of_words is None:
            return asked
        more = _ask(b.block, _twice(of_words)[0], n_buckets)
        return pa.concat_tables([asked, more.set_column(1, "bucket", pc.add(more["bucket"], pa.scalar(n_buckets, pa.int32())))])

    def codes_of(a: pa.Table, stage: int, hashes: np.ndarray, words: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The code of each place in what was sent, and the place of each hash."""
        return _answers(a, stage, n_buckets, words), _twice(hashes)[1]

    def first(t: pa.Table) -> pa.Table:
        b = _Block(t, length, prime)
        return ask(b, b.samples()[1], _Passages(b, passage_words).sample)

    def to_stretches(b: _Block, a: pa.Table):  # noqa: ANN202
        pos, h = b.samples()
        codes, place = codes_of(a, 1, h)
        cand = b.candidates(pos, codes[place] > 0)
        stretch, _, sh = b.stretches(cand)
        return cand, stretch, sh

    def to_windows(b: _Block, a: pa.Table):  # noqa: ANN202
        p = _Passages(b, passage_words)
        codes, place = codes_of(a, 1, p.sample, True)
        start = p.open_windows(codes[place] > 0)
        return p, start, *p.by_document(start, passage_words)

    def second(t: pa.Table, a: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _ask(0, np.zeros(0, np.uint64), n_buckets)
        b = _Block(t, length, prime)
        return ask(b, to_stretches(b, a)[2], to_windows(b, a)[2])

    def to_strings(b: _Block, a: pa.Table):  # noqa: ANN202
        cand, stretch, sh = to_stretches(b, a)
        codes, place = codes_of(a, 2, sh)
        send = b.open_strings(stretch, codes, place)
        again = np.zeros(len(cand), bool)
        if len(place):
            inside = stretch >= 0
            again[inside] = (codes[place] > 0)[stretch[inside]]
        s = cand[send]
        return cand, again, send, range_hash(b.prefix, s, s + length)

    def third(t: pa.Table, a: pa.Table) -> pa.Table:
        if not t.num_rows:
            return _ask(0, np.zeros(0, np.uint64), n_buckets)
        b = _Block(t, length, prime)
        return ask(b, to_strings(b, a)[3])

    def last(t: pa.Table, a: pa.Table) -> pa.Table:
        cols: dict[str, list] = {"doc_id": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "n_passages": [], "n_passage_words": []}
        if with_text:
            cols["kept"] = []
        if t.num_rows:
            b = _Block(t, length, prime)
            cand, again, send, strings = to_strings(b, a)
            codes, at = codes_of(a, 3, strings)
            p, start, windows, window = to_windows(b, a)
            found, place = codes_of(a, 2, windows, True)
            passages, passage_words_ = p.totals(start[(found[place] > 0)[window]])
            hit = again.copy()
            where = np.flatnonzero(send)
            if len(where):
                hit[where] |= codes[at] > 0
            from_, to, runs_, gone = _by_document(cand[hit], length, b.off)
            raw, k = b.data.tobytes(), 0
            for i, doc_id in enumerate(b.ids.to_pylist()):
                s, e = int(b.off[i]), int(b.off[i + 1])
                n, spans = int(gone[i]), int(runs_[i])
                parts, at_ = [], s
                for x, y in zip(from_[k : k + spans].tolist(), to[k : k + spans].tolist(), strict=True):
                    parts.append(raw[at_:x])
                    at_ = y
                k += spans
                kept = b"".join((*parts, raw[at_:e]))
                row = (doc_id, e - s, n, spans, hashlib.sha256(kept).hexdigest(), int(passages[i]), int(passage_words_[i]), kept)
                for c, x in zip(cols.values(), row, strict=False):
                    c.append(x)
        kinds = {"kept_sha256": pa.string(), "kept": pa.binary()}
        return pa.table({c: pa.array(x, kinds.get(c, pa.int64())) for c, x in cols.items()})

    def answered(asked: DataFrame, stage: int) -> DataFrame:
        return bucket_answers(asked, _shared_codes).select("block", F.lit(stage).alias("stage"), "bucket", "payload")

    by_block = d.groupBy("block")
    one = answered(by_block.applyInArrow(first, _ASKED), 1)
    two = answered(by_block.cogroup(one.groupBy("block")).applyInArrow(second, _ASKED), 2)
    two = one.unionByName(two)
    three = answered(by_block.cogroup(two.groupBy("block")).applyInArrow(third, _ASKED), 3)
    everything = two.unionByName(three)
    return by_block.cogroup(everything.groupBy("block")).applyInArrow(last, out_schema)
