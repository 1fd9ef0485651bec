"""Counts and sums by time over a stream: windows that event time closes, and a count of what came too late for them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.sources.tables import shared_dir

SCHEMA = "start timestamp, kind string, n long, total double"


def windowed(events: DataFrame, width: str, delay: str) -> DataFrame:
    """(start, kind, n, total) of events (at, kind, value) by tumbling windows, for a stream in append mode.

    A window is told once, when the latest time seen is `delay` past its end; rows that come for it after that are dropped and
    counted by Spark. Over a table this gives all windows. Rows without a time belong to none.
    """
    rows = events.where("at is not null").withWatermark("at", delay)
    found = rows.groupBy(F.window("at", width).alias("w"), "kind").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return found.select(F.col("w.start").alias("start"), "kind", "n", "total")


def closed(parts: list[DataFrame], width: str, delay: str) -> tuple[DataFrame, int]:
    """All windows of tables (at, kind, value) that arrive one after the other, and how many rows came too late.

    The source is stopped after each part and resumed from its progress. Behind the last part a row of no kind, a hundred
    years on, closes what is open.
    """
    spark = parts[0].sparkSession
    root = f"{shared_dir(spark).rstrip('/')}/windows-{uuid.uuid4().hex}"
    cols = ["at", "kind", "value"]
    end = spark.range(1).select(F.expr("current_timestamp() + interval 100 years").alias("at"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("double").alias("value"))
    late = 0
    for part in [*parts, end]:
        part.select(*cols).write.mode("append").parquet(f"{root}/source")
        source = spark.readStream.schema("at timestamp, kind string, value double").parquet(f"{root}/source")
        sink = windowed(source, width, delay).writeStream.format("parquet").option("path", f"{root}/windows").option("checkpointLocation", f"{root}/progress")
        query = sink.trigger(availableNow=True).outputMode("append").start()
        query.awaitTermination()
        late += sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    return spark.read.schema(SCHEMA).parquet(f"{root}/windows"), late
