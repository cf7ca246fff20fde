"""Windows over the event stream, as batch plans and as Structured Streaming queries.

The plan of a window is one function of a DataFrame, so that a batch and a stream share it; the
stream adds a watermark, state and a checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def tumbling(events: DataFrame, width: str = "1 hour") -> DataFrame:
    w = F.window("ts", width)
    return events.groupBy(w, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("window.start").alias("start"), "event_type", "n", "total"
    )


def sliding(events: DataFrame, width: str = "2 hours", step: str = "1 hour") -> DataFrame:
    return events.groupBy(F.window("ts", width, step)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    return events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(
        "user_id", F.col("session_window.start").alias("start"), "n"
    )


def read_stream(spark: SparkSession, folder: str, late: str = "1 hour") -> DataFrame:
    return spark.readStream.schema(SCHEMA).parquet(folder).withWatermark("ts", late)


def first_seen(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event once, within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def start(plan: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends finished windows to a Parquet sink, once over what is there."""
    return plan.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)


def _seconds(df: DataFrame) -> DataFrame:
    return df.withColumn("start", F.unix_seconds("start"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "m01_tumbling_window": lambda s, d: _seconds(tumbling(_events(s, d))).withColumn("total", F.floor(F.col("total") * 100 + 0.5) / 100),
    "m02_sliding_window": lambda s, d: _seconds(sliding(_events(s, d))),
    "m03_session_window": lambda s, d: _seconds(sessions(_events(s, d))),
}
_AT = "CAST(floor(epoch(ts)) AS BIGINT)"
ORACLE: dict[str, str] = {
    "m01_tumbling_window": f"SELECT {_AT} // 3600 * 3600 AS start, event_type, count(*) AS n, floor(sum(value) * 100 + 0.5) / 100 AS total FROM events GROUP BY 1, 2",
    "m02_sliding_window": f"""SELECT start, count(*) AS n FROM (SELECT {_AT} // 3600 * 3600 AS start FROM events
        UNION ALL SELECT {_AT} // 3600 * 3600 - 3600 FROM events) x GROUP BY start""",
    "m03_session_window": """WITH g AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
        SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events) x)
      SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, count(*) AS n FROM g GROUP BY user_id, s""",
}
