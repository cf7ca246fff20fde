"""What several operators of this subpackage share: reading tables, the shared folder for
intermediate tables, blocks of documents, and answers from hash buckets to blocks.

Blocks and buckets
------------------
Operators that compare all documents with all documents work in two alternating steps:

* a *block* holds the documents whose id hashes to it (a few MB of text), and reduces them to
  sorted arrays of 64-bit hashes, cut by value range into buckets;
* a *bucket* sorts what all blocks sent it for its range and answers each block with one byte
  per hash, in the order in which the block sent them.

A block sends each hash once whatever the number of its copies inside the block, so that a hash
that a third of all rows share costs its bucket one entry per block, not one per row.
"""

from __future__ import annotations

import gc
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir. Only a local session, whose
    driver and executors are one process, gets a folder of its own where that is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="fernwell-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stash(df: DataFrame, label: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: cuts the lineage, and
    survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    back = spark.read.schema(schema).parquet(path)
    back._stash_path = path
    return back


def discard(*frames: DataFrame) -> None:
    """Deletes tables that stash() wrote and that nothing reads any longer."""
    for df in frames:
        path = getattr(df, "_stash_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Gives memory that the driver no longer uses back to the system: what earlier plans left in the
    heap (broadcasts, metadata of tasks), and what threads that compiled or ran them left in the
    allocator, which otherwise keeps it. Results do not depend on it."""
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    gc.collect()
    jvm.java.lang.System.gc()
    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        asked = (jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", None, None)
        args = array(jvm.java.lang.Object, len(asked))
        for k, x in enumerate(asked):
            args[k] = x
        # through the interface, as the server's class is not open
        connection = jvm.java.lang.Class.forName("javax.management.MBeanServerConnection")
        next(m for m in connection.getMethods() if m.getName() == "invoke").invoke(server, args)
    except Py4JError:  # not in every Java
        pass


#: Rows that go to a Python worker at once: texts are long, and workers share the executor's memory.
ARROW_ROWS = 2000


def bounded_batches(df: DataFrame) -> DataFrame:
    """Bounds the batches that the session sends to Python workers; returns df."""
    key, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    now = int(conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))
    return df


def documents_of(docs: DataFrame) -> DataFrame:
    """doc_id (long) and text as UTF-8 bytes; null text counts as empty. Other columns are left
    out, so that extra columns with any names do no harm."""
    return bounded_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts."""
    row = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()
    return int(row["n"] or 0)


def in_blocks(docs: DataFrame, n_blocks: int) -> DataFrame:
    """Adds the block of each document (doc_id, th: hash of its text), the same in every pass; rows
    without an id, or with one id and several texts, are spread by the text."""
    return docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "th"), F.lit(n_blocks)).cast("int"))


def with_text_hash(docs: DataFrame) -> DataFrame:
    return docs.withColumn("th", F.xxhash64("text"))


def block_count(total_bytes: int, block_bytes: int) -> int:
    return max(1, math.ceil(total_bytes / block_bytes))


# ---------------------------------------------------------------------------------- byte arrays


def column_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (n+1, int64) and bytes of a binary or string column without copying rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
        if isinstance(col, pa.ChunkedArray):
            col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], pa.large_binary())
    large = pa.types.is_large_binary(col.type) or pa.types.is_large_string(col.type)
    kind = np.int64 if large else np.int32
    n = len(col)
    if n == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + n + 1].astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    return off - off[0], data[off[0] : off[-1]]


_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: spreads 64-bit hashes over all their bits."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


#: Modulus of the polynomial hashes, a Mersenne prime, and their two bases. A prime modulus has no
#: strings that agree for every base, as 2^64 has (Thue-Morse words).
PRIME = (1 << 31) - 1
BASES = (1_157_920_891, 1_870_662_173)
_M, _S = np.uint64(PRIME), np.uint64(31)
_rng = np.random.default_rng(20240607)
BYTE_CODES = _rng.integers(1, PRIME, (2, 256), dtype=np.uint64)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, up to one more multiple of it for x under 2^62."""
    return (x & _M) + (x >> _S)


def powers(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each base its powers 0.. and those of its inverse, n of each at least."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS.clear()
        for base in BASES:
            both = []
            for x in (base, pow(base, -1, PRIME)):
                a = np.ones(size, np.uint64)
                have = 1
                while have < size:
                    more = min(have, size - have)
                    a[have : have + more] = a[:more] * np.uint64(pow(x, have, PRIME)) % _M
                    have += more
                both.append(a)
            _POWERS.append((both[0], both[1]))
    return _POWERS


_CHUNK = 1 << 15  # values at once: temporary arrays stay in the processor's cache


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of both polynomial hashes, n+1 values each; sums of up to 2^31 bytes fit."""
    out = []
    for codes, (p, _) in zip(BYTE_CODES, powers(len(data) + 1), strict=True):
        sums = np.zeros(len(data) + 1, np.uint64)
        for k in range(0, len(data), _CHUNK):
            x = codes[data[k : k + _CHUNK]]
            x *= p[k : k + len(x)]
            sums[k + 1 : k + 1 + len(x)] = _fold(x)
        np.cumsum(sums, out=sums)
        out.append(sums)
    return out[0], out[1]


def range_hash(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] for arrays of bounds, equal for equal bytes: 62 bits of two
    polynomial hashes and the length, mixed."""
    inverse = [q for _, q in powers(len(prefix[0]))]
    out = np.empty(len(start), np.uint64)
    for k in range(0, len(start), _CHUNK):
        s, e = start[k : k + _CHUNK], end[k : k + _CHUNK]
        both = []
        for sums, q in zip(prefix, inverse, strict=True):
            x = _fold(_fold(_fold(_fold(sums[e] - sums[s])) * q[s]))
            x = _fold(x)
            x[x == _M] = 0
            both.append(x)
        out[k : k + len(s)] = mix(mix((both[0] << _S) | both[1]) + (e - s).astype(np.uint64))
    return out


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one integer; zeros follow the data."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data) + 1, np.dtype("<u8"), padded, 0, (1,))


_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG_WORD = 64


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of short ranges: their bytes are mixed in, eight at a time; ranges beyond 64 bytes
    go through a library hash."""
    size = end - start
    eight = words_at(data)
    h = mix(size.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    live = np.flatnonzero(size <= _LONG_WORD)
    at = 0
    while len(live):
        left = size[live] - at
        h[live] = mix((h[live] ^ (eight[start[live] + at] & _LOW_BYTES[np.minimum(left, 8)])) * np.uint64(0x9FB21C651E98DF25))
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return h


def word_bounds(data: np.ndarray, off: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of documents with these bounds, and the first word of each
    document (documents + 1). Words are runs of the bytes that are inside, if not stated of those
    other than space and 0x09-0x0D; none goes on into the next document."""
    if inside is None:
        inside = (data > 32) | (data < 9) | ((data > 13) & (data < 32))
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[off] = True
    at = np.flatnonzero(edge)
    live = inside[at[:-1]] if len(data) else np.zeros(0, bool)
    s, e = at[:-1][live], at[1:][live]
    return s, e, np.searchsorted(s, off)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + (upper * np.uint8(32)) if upper.any() else data


def sorted_distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values in order, by sorting."""
    s = np.sort(values)
    return s[runs(s)]


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start of each run of equal values."""
    if len(sorted_values) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals, whose starts ascend and whose ends do too, with those joined that meet or overlap."""
    if not len(starts):
        return starts, ends
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(ends) - 1)]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + n) for each s and n."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep], lengths[keep]
    step = np.ones(total, np.int64)
    step[0] = starts[0]
    at = np.cumsum(lengths)[:-1]
    step[at] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(step)


# ---------------------------------------------------------------------- between blocks and buckets


def planes(values: np.ndarray) -> bytes:
    """Fixed-width integers, first all their lowest bytes, and so on: sorted values compress."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unplanes(blob: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    a = np.frombuffer(blob, np.uint8).reshape(size, -1).T
    return np.ascontiguousarray(a).view(dtype).ravel()


def cut_by_bucket(sorted_hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bounds (n_buckets + 1) of the buckets in sorted 64-bit hashes."""
    edges = [(b << 64) // n_buckets for b in range(1, n_buckets)]
    inner = np.searchsorted(sorted_hashes, np.array(edges, np.uint64)) if edges else []
    return np.concatenate(([0], inner, [len(sorted_hashes)])).astype(np.int64)


Grouped = Callable[[pa.Table], pa.Table]


def bucket_answers(asked: DataFrame, answer: Callable[[list[np.ndarray], list[int]], list[np.ndarray]]) -> DataFrame:
    """asked: (block int, bucket int, payload binary: planes of sorted 64-bit hashes).
    answer: gets the arrays of one bucket and the blocks they are from, in the order of the
    blocks, and returns one uint8 array for each, of its length.
    Returns (block, bucket, payload)."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("block")
        blocks = t["block"].to_pylist()
        arrays = [unplanes(x, np.uint64) for x in t["payload"].to_pylist()]
        out = answer(arrays, blocks)
        return pa.table(
            {
                "block": t["block"].cast(pa.int32()),
                "bucket": t["bucket"].cast(pa.int32()),
                "payload": pa.array([x.tobytes() for x in out], pa.binary()),
            }
        )

    return asked.groupBy("bucket").applyInArrow(run, "block int, bucket int, payload binary")


def counts_in_bucket(arrays: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct hashes of a bucket, their number of arrays, and each array's places among them."""
    if not arrays:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), []
    both = np.concatenate(arrays)
    order = np.argsort(both, kind="stable")
    first = runs(both[order])
    n = np.diff(np.append(first, len(both)))
    place = np.empty(len(both), np.int64)
    place[order] = np.repeat(np.arange(len(first)), n)
    cuts = np.cumsum([len(a) for a in arrays])[:-1]
    return both[order[first]] if len(both) else both, n, np.split(place, cuts)


# ------------------------------------------------------------------------------ connected classes


def components(edges: DataFrame, label: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected edges (a long, b long): (node, component), the component
    being the smallest node in it; only nodes with an edge to another node are returned.

    Alternates large-star and small-star steps, each a partial minimum and a join by node, until
    all edges point at the smallest node of their component. Rounds grow with the logarithm of the
    longest path. Nothing is collected; the edges of each round lie in the shared folder. The joins
    are merges of what the minimum has dealt by node already: broadcasts would pass through the
    driver, several a round, and stay in its memory for a while."""
    e = stash(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        label,
    )
    before = None
    for _ in range(max_rounds):
        # large star: each node points its larger neighbours at its smallest neighbour or itself
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(low.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: each node points its smaller neighbours and itself at the smallest
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low2.hint("merge"), "a")
            .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .unionByName(low2.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        nxt = stash(small, label)
        row = nxt.agg(F.count("*").alias("n"), F.countDistinct("a").alias("d"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        discard(e)
        e = nxt
        now = (row["n"], row["d"], row["h"])
        # done: nothing changes, or each node has one parent and no parent has one
        if now == before or row["n"] == row["d"] and e.join(e.select(F.col("a").alias("c")).hint("merge"), F.col("b") == F.col("c"), "left_semi").isEmpty():
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    found = e.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    out = found.unionByName(roots)
    out._stash_path = e._stash_path
    release(e.sparkSession)
    return out


def batches_of(it: Iterator[pa.RecordBatch], fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Iterator[pa.RecordBatch]:
    for b in it:
        if b.num_rows:
            out = fn(b)
            if out is not None:
                yield out


LONG, BIN = T.LongType(), T.BinaryType()
