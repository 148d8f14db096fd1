"""5-minute candles from a stream of ticks, an extension: late ticks are waited for, closed windows go out once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotemill.sources import store


def tick_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def candle_stream(ticks: DataFrame, late: str = "10 minutes") -> DataFrame:
    """ticks (ts, event_id, value) -> candles, by tumbling window and watermark."""
    order = F.struct("ts", "event_id")
    price = F.col("value").cast("decimal(18,4)")
    timed = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = timed.groupBy(F.window("ts", "5 minutes")).agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.count("*").alias("volume")
    )
    return out.select(F.col("window.start").alias("ts"), "open", "high", "low", "close", "volume")


def catch_up(candles: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, appended once; a second run adds only what came since."""
    return candles.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_dates(rows: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Every micro-batch replaces the dates it has, so that corrected days can be sent again."""
    return rows.writeStream.foreachBatch(lambda df, _: store.write_dates(df, root)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
