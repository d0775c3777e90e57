"""Bars from a tick stream.

Each micro-batch is one set-based job. Its ticks are folded into per-bucket aggregates with
map-side partial aggregation, so a busy instrument never lands in one task as rows; only these
small aggregates meet the carried-over ones. State is a table with one row per open bucket and one
per series, replaced batch by batch in two alternating folders: batch n reads the folder of n-1 and
overwrites the other, so a batch that is run again after a failure gives the same result.

A bucket closes when a tick at or after its right side has arrived for its series (less the
allowed lateness). Ticks for closed buckets are counted and dropped.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bars import bars_of_pieces, fold, merge
from ..plans.durable import durable
from ..plans.joins import checked_join
from ..schema import BARS, SERIES
from ..session import prepare, scratch_dir
from ..sinks.tables import read_or_empty
from ..sources.ticks import ticks_from_events

_AT = "struct<ddate:date,ts:bigint,db_tsunx:bigint>"
_PARTIAL = (
    "ticker_id long, bar_width_sec int, g long, "
    f"first struct<at:{_AT},mid:double>, last struct<at:{_AT},mid:double>, "
    "h_ double, l_ double, ticks_cnt long, mean double, m2 double"
)
_SERIES_STATE = (
    "ticker_id long, bar_width_sec int, t_first long, t_last long, closed_to long, late long"
)


def event_ticks(
    spark: SparkSession, folder: str, schema, mapping: str = "sparse", files_per_batch: int = 1
) -> DataFrame:
    """Stream of ticks from the event files of a folder."""
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events*.parquet")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
    return ticks_from_events(events, mapping)


def _width_ms():
    return F.col("bar_width_sec").cast("long") * 1000


def _advance(
    ticks: DataFrame, items: DataFrame, open_before: DataFrame, before: DataFrame, lateness_ms: int
) -> tuple[DataFrame, DataFrame]:
    """Buckets (open and newly closed) and series state after one batch."""
    seen = durable(
        ticks.groupBy("ticker_id")
        .agg(F.min("db_tsunx").alias("_min"), F.max("db_tsunx").alias("_max"))
        .join(items, "ticker_id")
        .join(before, SERIES, "left")
        .withColumn("t_first", F.coalesce("t_first", "_min")),
        "stream-series",
    )
    placed = checked_join(
        ticks,
        seen.select(*SERIES, "t_first", "closed_to"),
        ["ticker_id"],
        spread=["db_tsunx", "ts"],
    ).withColumn("_late", F.col("db_tsunx") < F.coalesce("closed_to", "t_first"))
    bucket = F.floor((F.col("db_tsunx") - F.col("t_first")) / _width_ms()) + 1
    fresh = fold(placed.withColumn("g", bucket), [*SERIES, "g", "_late"])
    fresh = durable(fresh, "stream-fresh")
    late = (
        fresh.where("_late").groupBy(*SERIES).agg(F.sum("ticks_cnt").alias("_dropped"))
    )
    newest = F.greatest("t_last", "_max") - F.lit(lateness_ms)
    reached = F.floor((newest - F.col("t_first")) / _width_ms()) * _width_ms() + F.col("t_first")
    after = (
        seen.join(late, SERIES, "left")
        .withColumn("closed_to", F.greatest(F.coalesce("closed_to", "t_first"), reached))
        .select(
            *SERIES,
            "t_first",
            F.greatest("t_last", "_max").alias("t_last"),
            "closed_to",
            (F.coalesce("late", F.lit(0)) + F.coalesce("_dropped", F.lit(0))).alias("late"),
        )
    )
    # Series without ticks in this batch stay as they were.
    after = after.unionByName(before.join(seen, SERIES, "left_anti"))
    in_time = fresh.where(~F.col("_late")).drop("_late")
    buckets = merge(open_before.unionByName(in_time), [*SERIES, "g"])
    return buckets, after


def update(
    ticks: DataFrame, epoch: int, items: DataFrame, folder: str, lateness_ms: int = 0
) -> None:
    """Fold one micro-batch in and write the bars it closes to ``bars/epoch=<n>``."""
    # foreachBatch runs in a cloned session: use the batch's own.
    spark = prepare(ticks.sparkSession)
    old, new = (f"{folder}/state-{(epoch + i) % 2}" for i in (1, 0))
    open_before = _read(spark, f"{old}/open", _PARTIAL, epoch)
    before = _read(spark, f"{old}/series", _SERIES_STATE, epoch)
    buckets, after = _advance(ticks, items, open_before, before, lateness_ms)
    after = durable(after, "stream-after")
    right_side = F.col("t_first") + F.col("g") * _width_ms()
    merged = durable(
        checked_join(
            buckets, after.select(*SERIES, "t_first", "closed_to"), SERIES, spread=["g"]
        ).withColumn("_closed", right_side <= F.col("closed_to")),
        "stream-buckets",
    )
    bars = bars_of_pieces(merged.where("_closed"))
    bars.write.mode("overwrite").parquet(f"{folder}/bars/epoch={epoch}")
    merged.where("not _closed").drop("t_first", "closed_to", "_closed").write.mode(
        "overwrite"
    ).parquet(f"{new}/open")
    after.write.mode("overwrite").parquet(f"{new}/series")


def _read(spark, path, schema, epoch):
    if epoch == 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def start(
    ticks: DataFrame, items: DataFrame, folder: str, lateness_ms: int = 0, **trigger
):
    """Start the stream; ``folder`` keeps its bars, state and progress. Default trigger: work off
    what is there and stop."""
    return (
        ticks.writeStream.option("checkpointLocation", f"{folder}/progress")
        .trigger(**(trigger or {"availableNow": True}))
        .foreachBatch(lambda batch, epoch: update(batch, epoch, items, folder, lateness_ms))
        .start()
    )


def closed_bars(spark: SparkSession, folder: str) -> DataFrame:
    return read_or_empty(spark, f"{folder}/bars", BARS).select(*BARS.names)


def series_state(spark: SparkSession, folder: str, epoch: int) -> DataFrame:
    """Anchor, newest tick, closing point and number of late ticks of each series."""
    return spark.read.schema(_SERIES_STATE).parquet(f"{folder}/state-{epoch % 2}/series")


def stream_to_table(
    spark: SparkSession, ticks: DataFrame, items: DataFrame, lateness_ms: int = 0
) -> DataFrame:
    """Work off a stream in a fresh folder and return its bars."""
    folder = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"
    items = durable(items, "stream-items")
    start(ticks, items, folder, lateness_ms).awaitTermination()
    return closed_bars(spark, folder)
