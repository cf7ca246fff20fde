"""Sharding by jump consistent hashing.

A row's shard is a function of its key and the number of shards alone: no ring table, no state,
no shuffle to decide it. When a shard is appended, a row either stays or moves to the new shard,
and 1/n of the rows move. Slots (a gapless place within the shard) take one shuffle of narrow rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import mix

#: Multiplier of the linear congruential generator of the published jump hash.
_LCG = np.uint64(2862933555777941757)
_LAW = "key"


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shards (int32) of 64-bit keys. Expected rounds grow with the logarithm of n_shards."""
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    state = mix(keys.astype(np.int64).view(np.uint64))
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = ahead[live]
        s = state[live] * _LCG + np.uint64(1)
        state[live] = s
        span = ((s >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        ahead[live] = ((shard[live] + 1) * (2147483648.0 / span)).astype(np.int64)
        live = live[ahead[live] < n_shards]
    return shard.astype(np.int32)


def assign(df: DataFrame, key: str, counts: dict[str, int]) -> DataFrame:
    """Adds, for each name in counts, the shard of column key among that many shards.

    A null key counts as key -1. Rows with equal keys share a shard. An empty table stays empty.
    Other columns are kept unless they have one of the new names, which are replaced."""
    kept = [c for c in df.columns if c not in counts]
    schema = ", ".join(f"{n} int" for n in counts)

    @F.pandas_udf(f"struct<{schema.replace(' int', ': int')}>")
    def place(k):  # noqa: ANN001, ANN202
        import pandas as pd

        a = k.fillna(-1).to_numpy(np.int64)
        return pd.DataFrame({n: jump_hash(a, c) for n, c in counts.items()})

    got = place(F.col(f"`{key}`").cast("long"))
    # two structs, so that no name of the table can clash with one used here
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), got.alias("placed"))
    return rows.select("row.*", *[F.col(f"placed.{n}").alias(n) for n in counts])


def slots(df: DataFrame, rows_per_bucket: int = 20_000) -> DataFrame:
    """Adds slot, gapless from 0 in each shard of df (doc_id, shard, ...).

    Rows are dealt into buckets by a hash of the id, as many as the table needs; a slot is the rank
    in the bucket plus the rows of the shard in earlier buckets. Only the counts (shards x buckets,
    bounded by rows / rows_per_bucket) are gathered; no shard is ever in one task."""
    n = max(1, -(-df.count() // rows_per_bucket))
    # repeated rows with one id would meet in one bucket, so their content takes part too
    parts = [c for c in ("doc_id", "size", "text_crc32") if c in df.columns]
    at = df.withColumn("_b", F.pmod(F.xxhash64(*parts), F.lit(n)).cast("int"))
    rank = F.row_number().over(Window.partitionBy("shard", "_b").orderBy(*parts)) - 1
    per = at.groupBy("shard", "_b").agg(F.count("*").alias("_n"))
    before = per.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("_b", "_n"))).alias("_l"))
    offsets = before.select(
        "shard",
        F.explode(
            F.expr(
                "transform(_l, (x, i) -> struct(x._b AS _b,"
                " aggregate(slice(_l, 1, i), 0L, (s, y) -> s + y._n) AS _before))"
            )
        ).alias("o"),
    ).select("shard", "o._b", "o._before") if n <= 2000 else per.select(
        "shard", "_b",
        (F.sum("_n").over(Window.partitionBy("shard").orderBy("_b")) - F.col("_n")).alias("_before"),
    )
    return (
        at.withColumn("_r", rank)
        .join(offsets, ["shard", "_b"])
        .withColumn("slot", (F.col("_r") + F.col("_before")).cast("long"))
        .drop("_b", "_r", "_before")
    )


def shard_documents(docs: DataFrame, n_shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    size is the UTF-8 bytes of the text (null: none) plus 1; text_crc32 that of the bytes (null or
    empty: 0). The law is `key`: doc_id and the number of shards alone decide, so that shards are
    near even in rows when ids are many, however large one source or group of copies is."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body).alias("text_crc32"),
    )
    placed = assign(narrow, "doc_id", {"shard": n_shards, "grown_shard": n_shards + 1})
    return slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit(_LAW).alias("law"), "shard", "slot", "grown_shard"
    )


def write_shards(docs: DataFrame, path: str, n_shards: int) -> None:
    """Writes the documents, partitioned by shard, each shard in files of bounded size."""
    taken = {"shard"} & set(docs.columns)
    placed = assign(docs.drop(*taken), "doc_id", {"shard": n_shards})
    placed.write.partitionBy("shard").option("maxRecordsPerFile", 500_000).parquet(path)
