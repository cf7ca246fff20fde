"""Readers and writers of corpus files: JSON lines with three ways to take bad lines, manifests,
folders of JSON documents, graph tables; sinks; merge on key; a paged source as a Python data
source."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PROTOCOLS = (
    "pmcid string, doi string, organoid_type string, species string, source_cell_type string, matrix string, base_media string,"
    " base_media_reporting string, first_author string, year string, journal string, license string, gold_candidate string,"
    " n_signaling_factors int, n_supplements int, n_figure_confirmed int, reagents_grounded int, reagents_total int, grounding_rate double,"
    " extractor string, passaging string, timeline string, assay_endpoints string, publication_type string, is_generation_protocol boolean"
)
REAGENTS = (
    "id bigint, pmcid string, doi string, organoid_type string, kind string, name string, canonical string, role string, value double, unit string,"
    " canonical_unit string, evidence_quote string, grounded int, suspect_unit int, figure_confirmed int"
)


def read_json_lines(spark: SparkSession, path: str, schema: str, bad: str = "fail") -> DataFrame:
    """bad: fail (one bad line ends the query), drop, or keep (in column _bad)."""
    if bad == "keep":
        return spark.read.schema(f"{schema}, _bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return spark.read.schema(schema).option("mode", {"fail": "FAILFAST", "drop": "DROPMALFORMED"}[bad]).json(path)


def count_bad_lines(kept: DataFrame) -> int:
    """Lines that could not be read, of a table read with bad="keep"."""
    return kept.select("_bad", *kept.columns[:1]).where("_bad IS NOT NULL").count()


def read_pools(spark: SparkSession, glob: str) -> DataFrame:
    """Many CSV pools, each row with its pool (the file's name)."""
    df = spark.read.option("header", True).csv(glob)
    named = df.withColumn("pool", F.col("_metadata.file_name"))
    return named.toDF(*[c.lstrip("\ufeff") for c in named.columns])


def pool_counts(pools: DataFrame) -> DataFrame:
    return pools.groupBy("pool").agg(F.count("*").alias("n"))


def read_report(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One stored report, a single JSON document; one row."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def read_vectors(spark: SparkSession, array_path: str, rows_path: str, schema: str) -> DataFrame:
    """A vector index: a .npy matrix and JSON lines, aligned by row. Both are single files and are
    read by one task each; the result is dealt by row."""

    def rows_of(batches):  # noqa: ANN001, ANN202
        import io

        import numpy as np
        import pandas as pd

        for b in batches:
            for blob in b["content"]:
                x = np.load(io.BytesIO(blob), allow_pickle=False)
                for k in range(0, len(x), 10_000):
                    part = x[k : k + 10_000]
                    yield pd.DataFrame({"row": np.arange(k, k + len(part)), "embedding": part.astype(np.float32).tolist()})

    vectors = spark.read.format("binaryFile").load(array_path).select("content").mapInPandas(rows_of, "row long, embedding array<float>")
    lines = spark.read.text(rows_path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("row", "line")).where("trim(line) <> ''")
    return vectors.join(lines.select(F.col("row").cast("long"), F.from_json("line", schema).alias("r")), "row").select("row", "embedding", "r.*")


def cached_lookup(asked: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Answers of a recorded cache; what it does not have is `not_attempted`, as no service is asked."""
    found = cache.withColumn("status", F.lit("cached"))
    return asked.join(found, key, "left").withColumn("status", F.coalesce("status", F.lit("not_attempted")))


def read_manifest(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Delimited text with a header; a byte order mark before the first name is dropped."""
    df = spark.read.option("sep", sep).option("header", True).csv(path)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def read_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON document a file; stem is the file's name without its ending."""
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.withColumn("stem", F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1))


def read_graph(spark: SparkSession, nodes: str, edges: str) -> tuple[DataFrame, DataFrame]:
    n = read_manifest(spark, nodes).where("id IS NOT NULL AND id <> ''").na.fill("")
    e = read_manifest(spark, edges).where("subject <> '' AND object <> ''").na.fill("")
    return n, e


def write_json_lines(df: DataFrame, path: str, quote: str | None = "evidence_quote", cap: int = 500, stages: str | None = None, flags: tuple[str, ...] = ()) -> None:
    """Quotes are cut to a cap; a column of stages is parsed from its JSON text; 0/1 columns become
    booleans."""
    if quote in df.columns:
        df = df.withColumn(quote, F.substring(quote, 1, cap))
    if stages in df.columns:
        df = df.withColumn(stages, F.from_json(stages, "array<struct<name: string, day_start: int, day_end: int>>"))
    for c in flags:
        df = df.withColumn(c, F.col(c).cast("int") == 1)
    df.write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str, **parts: str) -> None:
    """One JSON document: the rows of a small report under `rows`, and more fields as given. A report
    is bounded by its query; it is written by one task."""
    rows = df.agg(F.to_json(F.struct(F.collect_list(F.struct(*df.columns)).alias("rows"), *[F.lit(v).alias(k) for k, v in parts.items()])).alias("value"))
    rows.coalesce(1).write.mode("overwrite").text(path)


def write_slices(df: DataFrame, path: str, columns: list[str], newest: str, key: str, size: int) -> None:
    """CSV slices of a size, newest first: ranks are made within a value of the order and shifted by
    the counts of later ones, so that no task ranks all."""
    per = df.groupBy(newest).agg(F.count("*").alias("_n"))
    before = per.withColumn("_before", F.sum("_n").over(Window.orderBy(F.desc_nulls_last(newest)).rowsBetween(Window.unboundedPreceding, -1)))
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(newest).orderBy(key)))
    placed = ranked.join(before.select(F.col(newest).alias("_k"), "_before"), F.col(newest).eqNullSafe(F.col("_k")))
    slices = placed.withColumn("slice", F.floor((F.coalesce("_before", F.lit(0)) + F.col("_r") - 1) / size).cast("int"))
    slices.select(*columns, "slice").write.mode("overwrite").partitionBy("slice").option("header", True).csv(path)


def append_manifest(df: DataFrame, path: str, columns: list[str], sep: str = "\t") -> None:
    """Adds the rows of a batch to a manifest."""
    df.select(*columns).write.mode("append").option("sep", sep).option("header", True).csv(path)


def load_database(tables: dict[str, DataFrame], path: str, texts: dict[str, tuple[str, ...]] | None = None) -> None:
    """Tables as Parquet and views under their names, and for each table with texts an inverted
    index <name>_words (rowid, word) over its columns."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        back = df.sparkSession.read.parquet(f"{path}/{name}")
        back.createOrReplaceTempView(name)
        if texts and name in texts:
            words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(F.concat_ws(" ", *texts[name])), F.lit("[a-z0-9]+"), F.lit(0))))
            back.select(F.col("id").alias("rowid"), words.alias("word")).write.mode("overwrite").parquet(f"{path}/{name}_words")
            df.sparkSession.read.parquet(f"{path}/{name}_words").createOrReplaceTempView(f"{name}_words")


def export_files(tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Tables as JSON lines, and a manifest (name, n) of what was written."""
    spark = next(iter(tables.values())).sparkSession
    counts = []
    for name, df in tables.items():
        write_json_lines(df, f"{path}/{name}.jsonl")
        counts.append((name, spark.read.text(f"{path}/{name}.jsonl").count()))
    manifest = spark.createDataFrame(counts, "name string, n long")
    manifest.write.mode("overwrite").json(f"{path}/manifest.json")
    return manifest


def write_table(df: DataFrame, path: str, columns: list[str], sep: str = "\t") -> None:
    df.select(*columns).write.mode("overwrite").option("sep", sep).option("header", True).csv(path)


def merge_on_key(prior: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Prior rows whose key was not made again, and the fresh ones."""
    return prior.join(fresh.select(key).distinct(), key, "left_anti").unionByName(fresh)


class PagedSource(DataSource):
    """Pages of rows by a cursor, from recorded pages (option `pages`: a JSON list of lists of
    [id, title]); one partition a page."""

    @classmethod
    def name(cls) -> str:
        return "fernwell_pages"

    def schema(self) -> str:
        return "page int, id string, title string"

    def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
        return _Reader(json.loads(self.options.get("pages", "[]")))


class _Reader(DataSourceReader):
    def __init__(self, pages: list) -> None:
        self.pages = pages

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(len(self.pages))] or [InputPartition(-1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if partition.value >= 0:
            for row in self.pages[partition.value]:
                yield (partition.value, str(row[0]), str(row[1]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
