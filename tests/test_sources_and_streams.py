"""Files, the paged source, text columns, and streams against their batch plans."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from fernwell.functions import text_columns as X
from fernwell.sources import registry as S
from fernwell.streaming import events as E


def test_json_lines(spark, tmp_path):
    p = tmp_path / "r.jsonl"
    p.write_text('{"pmcid": "PMC1", "value": 2.5}\nnot json\n{"pmcid": "PMC2"}\n')
    schema = "pmcid string, value double"
    kept = S.read_json_lines(spark, str(p), schema, "keep").cache()
    assert kept.where("_bad IS NOT NULL").count() == 1
    assert S.read_json_lines(spark, str(p), schema, "drop").select("pmcid").count() in (2, 3)
    try:
        S.read_json_lines(spark, str(p), schema).collect()
        raise AssertionError("a bad line must fail")
    except Exception as e:  # noqa: BLE001
        assert "bad line must fail" not in str(e)


def test_manifest_folder_and_merge(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("﻿pmcid\tyear\nPMC1\t2020\n", encoding="utf-8")
    assert S.read_manifest(spark, str(tmp_path / "m.tsv")).columns == ["pmcid", "year"]
    d = tmp_path / "docs"
    d.mkdir()
    (d / "PMC7.json").write_text(json.dumps({"doi": "x"}))
    assert S.read_folder(spark, str(d), "doi string").collect()[0].stem == "PMC7"
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert {tuple(r) for r in S.merge_on_key(a, b, "k").collect()} == {(1, "a"), (2, "c"), (3, "d")}
    S.write_json_lines(spark.createDataFrame([("q" * 600,)], "evidence_quote string"), str(tmp_path / "out"))
    assert len(spark.read.json(str(tmp_path / "out")).first().evidence_quote) == 500
    S.write_table(a, str(tmp_path / "t"), ["v", "k"])
    assert S.read_manifest(spark, str(tmp_path / "t")).columns == ["v", "k"]


def test_paged_source(spark):
    spark.dataSource.register(S.PagedSource)
    df = spark.read.format("fernwell_pages").option("pages", json.dumps([[["1", "a"], ["2", "b"]], [["3", "c"]]])).load()
    assert {(r.page, r.id) for r in df.collect()} == {(0, "1"), (0, "2"), (1, "3")}


def test_text_columns(spark):
    df = spark.createDataFrame([("µg / ml", 2.5, "add 2.5 uM", "IL-1β"), ("nM", 10.0, "add 110 nM", "α b"), (" IU/mL ", 10.0, "10 of", None)], "u string, v double, q string, n string")
    got = df.select(X.canonical_unit(F.col("u")).alias("u"), X.value_in_quote(F.col("v"), F.col("q")).alias("ok"), X.greek_key(F.col("n")).alias("g"), X.snippet(F.lit("a  b cdef"), 5).alias("s")).collect()
    assert [(r.u, r.ok, r.g, r.s) for r in got] == [("ug/mL", True, "il1beta", "a b …"), ("nM", False, "alphab", "a b …"), ("IU/mL", True, None, "a b …")]
    html = spark.createDataFrame([(1, "<title>T</title><h1>A</h1><p>b <a href=x>c</a></p><script>no</script>"), (2, None)], "page_id long, html string")
    rows = {r.page_id: (r.title, r.n_headings, r.n_links, r.n_text) for r in X.page_sections(html).collect()}
    assert rows == {1: ("T", 1, 1, 3), 2: ("", 0, 0, 0)}
    s = spark.createDataFrame([("k", 0, 5), ("k", 3, 8), ("k", 5, 9)], "key string, start long, end long")
    assert X.greedy_intervals(s).collect()[0].starts == "0,5"


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.sql("SELECT id AS event_id, timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,id * 7) AS ts, id % 3 AS user_id, 'a' AS event_type, 1.0D AS value, '' AS props FROM range(60)")
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    rows.write.parquet(src)
    E.start(E.tumbling(E.read_stream(spark, src, "0 seconds")), out, cp).awaitTermination()
    stream = {(r.start, r.n) for r in spark.read.parquet(out).collect()}
    batch = {(r.start, r.n) for r in E.tumbling(rows).collect()}
    assert stream <= batch and len(batch - stream) <= 1  # the last window is still open
    assert E.sessions(rows, "30 minutes").count() == 3
