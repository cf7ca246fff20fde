"""Token files compressed by a Re-Pair grammar.

A shard holds the ids of consecutive documents. Frequent pairs of neighbours are replaced by new
symbols, round by round, until no pair is frequent or a round saves next to nothing; each rule and the length of its expansion are
stored, and where each document begins in the compressed sequence and in the ids, so that one
document, or a range of its ids, is decoded without the others. Pairs never cross documents.

A round counts all pairs of the shard and replaces all frequent ones that do not overlap a more
frequent one, instead of one pair a round as the method is usually stated; the format is the same.

Layout of a shard (little-endian): magic `FWRP`, then seven 32-bit numbers (version, vocabulary,
rules, documents, symbols, 64-bit ids as two), the rules as pairs of 16-bit symbols, the expansion
lengths (32 bits each), the documents' first symbols and first ids (documents + 1 of 64 bits each),
the symbols (16 bits each). Shards are rows of a Parquet table (part, shard, first and last doc_id,
the ids of the documents, payload): Spark's writer gives atomic commits, any file system, and
pruning by document.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import block_count, bounded_batches, ranges, runs, shared_dir, text_bytes
from .tokens import encode_texts

_MAGIC, _SYMBOLS = b"FWRP", 1 << 16
_HEAD = struct.Struct("<4s5IQ")


def compress(ids: np.ndarray, starts: np.ndarray, vocabulary: int, least: int = 8) -> bytes:
    """A shard's payload. starts: first id of each document and the end (documents + 1). Rounds go on
    until no pair occurs `least` times, the 16-bit symbols are used up, or a round has shortened the
    shard by less than half a percent; a round takes seven
    eighths of those that are left at most, so that later ones can build on its rules."""
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)  # no pair begins at a document's last symbol
    ends = starts[1:][np.diff(starts) > 0] - 1
    last[ends] = True
    rules, lengths = [], []
    while True:
        room = _SYMBOLS - vocabulary - sum(map(len, rules))
        if len(seq) < 2 or room <= 0:
            break
        open_ = np.flatnonzero(~last[:-1])
        key = (seq[open_] << np.uint32(16)) | seq[open_ + 1]
        s = np.sort(key)
        first = runs(s)
        n = np.diff(np.append(first, len(s)))
        often = np.flatnonzero(n >= least)
        if not len(often):
            break
        often = often[np.argsort(-n[often], kind="stable")][: max(7 * room // 8, min(room, 2048))]
        pairs = s[first[often]]
        # pairs are looked up in a hash table; of pairs that fall together the most frequent stays
        table = np.zeros(1 << 20, np.uint16)
        table[_slot(pairs[::-1])] = np.arange(len(pairs) - 1, -1, -1)
        at = table[_slot(key)]
        hit = pairs[at] == key
        place = open_[hit]
        rank = len(pairs) - at[hit].astype(np.int32)  # high: frequent
        if not len(place):
            break
        # a place is kept where it outranks its neighbours; in a stretch of one rank (a run of one
        # symbol) every other place is
        beside = np.append(False, place[1:] == place[:-1] + 1)
        first = np.flatnonzero(~beside | np.append(True, rank[1:] != rank[:-1]))
        size = np.diff(np.append(first, len(place)))
        value, joined = rank[first], beside[first]
        before = np.where(joined, np.append(0, value[:-1]), 0)
        after = np.where(np.append(joined[1:], False), np.append(value[1:], 0), 0)
        which = np.repeat(np.arange(len(first)), size)
        inside = np.arange(len(place)) - first[which]
        keep = inside % 2 == 0
        keep &= (inside > 0) | (value > before)[which]
        keep &= (inside < size[which] - 1) | (value > after)[which]
        where = place[keep]
        if not len(where):
            break
        used, number = np.unique(len(pairs) - rank[keep], return_inverse=True)
        base = vocabulary + sum(map(len, rules))
        rules.append(np.stack((pairs[used] >> np.uint32(16), pairs[used] & np.uint32(0xFFFF)), 1))
        seq[where] = base + number
        last[where] = last[where + 1]
        gone = np.zeros(len(seq), bool)
        gone[where + 1] = True
        seq, last = seq[~gone], last[~gone]
        if 200 * len(where) < len(seq):
            break
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    size = _sizes(table, vocabulary)
    lengths = size[vocabulary:]
    before = np.concatenate(([0], np.cumsum(size[seq])))
    begin = np.searchsorted(before, starts).astype("<u8")
    head = _HEAD.pack(_MAGIC, 1, vocabulary, len(table), len(starts) - 1, len(seq), len(ids))
    return b"".join((head, table.astype("<u2").tobytes(), lengths.astype("<u4").tobytes(), begin.tobytes(), starts.astype("<u8").tobytes(), seq.astype("<u2").tobytes()))


def _sizes(table: np.ndarray, vocabulary: int) -> np.ndarray:
    """Expansion length of every symbol; rules only use earlier symbols."""
    size = np.ones(vocabulary + len(table), np.int64)
    for i, (a, b) in enumerate(table.tolist()):
        size[vocabulary + i] = size[a] + size[b]
    return size


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint32(2654435761)) >> np.uint32(12)


class Shard:
    """A payload opened for reading."""

    def __init__(self, payload: bytes) -> None:
        magic, version, self.vocabulary, r, self.documents, n, self.ids = _HEAD.unpack_from(payload)
        if magic != _MAGIC or version != 1:
            raise ValueError("not a shard of this format")
        at = _HEAD.size
        parts = []
        for kind, count in (("<u2", 2 * r), ("<u4", r), ("<u8", self.documents + 1), ("<u8", self.documents + 1), ("<u2", n)):
            parts.append(np.frombuffer(payload, kind, count, at))
            at += parts[-1].nbytes
        rules, lengths, self.begin, self.starts, self.seq = parts
        self.size = np.concatenate((np.ones(self.vocabulary, np.int64), lengths.astype(np.int64)))
        # expansions of all symbols in one array
        flat = [np.arange(self.vocabulary, dtype=np.uint16)]
        where: list[np.ndarray] = []
        for a, b in rules.reshape(-1, 2).tolist():
            left = where[a - self.vocabulary] if a >= self.vocabulary else flat[0][a : a + 1]
            right = where[b - self.vocabulary] if b >= self.vocabulary else flat[0][b : b + 1]
            where.append(np.concatenate((left, right)))
        self.flat = np.concatenate(flat + where)
        self.first = np.concatenate((np.arange(self.vocabulary), self.vocabulary + np.cumsum(self.size[self.vocabulary :]) - self.size[self.vocabulary :]))

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.first[symbols], self.size[symbols])]

    def all_ids(self) -> np.ndarray:
        return self._expand(self.seq)

    def document(self, i: int, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids start..end of document i; only symbols that reach into them are expanded."""
        symbols = self.seq[int(self.begin[i]) : int(self.begin[i + 1])]
        before = np.concatenate(([0], np.cumsum(self.size[symbols])))
        end = int(before[-1]) if end is None else min(end, int(before[-1]))
        if start >= end:
            return np.zeros(0, np.uint16)
        a = int(np.searchsorted(before, start, "right")) - 1
        b = int(np.searchsorted(before, end, "left"))
        return self._expand(symbols[a:b])[start - int(before[a]) : end - int(before[a])]


_SHARDS = "part int, shard int, first_doc long, last_doc long, n_ids long, docs array<long>, payload binary"


def write_files(docs: DataFrame, tokenizer: str, path: str, end_id: int = 2, shard_ids: int = 1_000_000, part_bytes: int = 16 << 20, vocabulary: int | None = None) -> None:
    """Writes the shards of all documents, in ascending order of doc_id (nulls first), to path."""
    from tokenizers import Tokenizer

    size = vocabulary or Tokenizer.from_file(tokenizer).get_vocab_size()
    slim = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = block_count(text_bytes(docs), part_bytes)
    ordered = slim.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, names, held, n = TaskContext.get().partitionId(), 0, [], [], 0
        tail = np.array([end_id], np.uint16)

        def close() -> pa.RecordBatch:
            starts = np.concatenate(([0], np.cumsum([len(x) for x in held])))
            payload = compress(np.concatenate(held), starts, size)
            known = [x for x in names if x is not None]
            row = ([part], [shard], [min(known, default=None)], [max(known, default=None)], [int(starts[-1])], [list(names)], [payload])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["part", "shard", "first_doc", "last_doc", "n_ids", "docs", "payload"])

        for b in batches:
            ids_of = b["doc_id"].to_pylist()
            for at, off, ids in encode_texts(tokenizer, b["text"]):
                for i in range(len(off) - 1):
                    names.append(ids_of[at + i])
                    held.append(np.concatenate((ids[off[i] : off[i + 1]], tail)))
                    n += len(held[-1])
                    if n >= shard_ids:
                        yield close()
                        shard, names, held, n = shard + 1, [], [], 0
        if held:
            yield close()

    ordered.mapInArrow(run, _SHARDS).write.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, decoded from them.
    Where each shard starts is a sum over narrow rows: within its part, and over the parts."""
    shards = spark.read.schema(_SHARDS).parquet(path)
    narrow = shards.select("part", "shard", "n_ids")
    parts = narrow.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    inner = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begins = narrow.withColumn("own", F.coalesce(F.sum("n_ids").over(inner), F.lit(0))).join(parts, "part").select(
        "part", "shard", (F.col("own") + F.col("before")).alias("shard_start")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, shard, names, payload in zip(b["part"].to_pylist(), b["shard"].to_pylist(), b["docs"].to_pylist(), b["payload"], strict=True):
                s = Shard(payload.as_py())
                ids = s.all_ids().astype("<u4")
                at = s.starts.astype(np.int64)
                crc = [zlib.crc32(ids[at[i] : at[i + 1]].tobytes()) for i in range(s.documents)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([part] * len(names), pa.int32()), "shard": pa.array([shard] * len(names), pa.int32()),
                        "doc_id": pa.array(names, pa.int64()), "inside": pa.array(at[:-1]), "n_tokens": pa.array(np.diff(at)), "ids_crc32": pa.array(crc, pa.int64()),
                    }
                )

    decoded = shards.mapInArrow(run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return decoded.join(begins, ["part", "shard"]).select("doc_id", (F.col("inside") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")


def through_files(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the documents' ids into files of the shared folder and reads them back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_files(docs, tokenizer, path, end_id)
    return read_files(spark, path)
