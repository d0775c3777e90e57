"""Reads of everything that is not ticks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.durable import durable
from ..plans.joins import checked_join
from ..schema import FORM_PROPS, SERIES


def tickers_from_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("c_custkey").alias("ticker_id"),
        F.col("c_name").alias("ticker_code"),
        F.col("c_mktsegment").alias("ticker_first"),
        F.lit("").alias("ticker_seconds"),
    )


def bars_property_for(ticks: DataFrame, widths: list[int]) -> DataFrame:
    """Every instrument that has ticks, at each width; every fifth instrument is disabled."""
    return (
        ticks.select("ticker_id")
        .distinct()
        .select(
            "ticker_id",
            F.explode(F.array(*(F.lit(w) for w in widths))).alias("bar_width_sec"),
            F.when(F.col("ticker_id") % 5 == 0, 0).otherwise(1).alias("is_enabled"),
        )
    )


def enabled_widths(bars_property: DataFrame) -> DataFrame:
    return bars_property.where(F.col("is_enabled") == 1)


def ticker_dictionary(tickers: DataFrame) -> DataFrame:
    return tickers.orderBy("ticker_id")


def bars_for_keys(bars: DataFrame, metas: DataFrame) -> DataFrame:
    """Bars of the listed (ticker_id, bar_width_sec, ddate) keys, in series order."""
    return bars.join(metas, [*SERIES, "ddate"], "left_semi").orderBy(*SERIES, "ddate", "ts_end")


def outcomes_since(outcomes: DataFrame, marks: DataFrame) -> DataFrame:
    """Outcomes after each series' resume mark; a series without a mark is read in full.

    ``marks`` carries ``mark_ddate`` and ``mark_ts`` per series, null where there is none.
    """
    mine = durable(marks.select(*SERIES, "mark_ddate", "mark_ts"), "marks")
    return (
        checked_join(outcomes, mine, SERIES, "left", spread=["ddate", "ts_end", "log_oe"])
        .where(
            F.col("mark_ddate").isNull()
            | F.col("mark_ts").isNull()
            | (
                (F.col("ddate") >= F.col("mark_ddate")) & (F.col("ts_end") > F.col("mark_ts"))
            )
        )
        .select(*outcomes.columns)
    )


def typed_forms(forms: DataFrame, ticker_id: int | None = None, width: int | None = None):
    """Forms with the property map projected to typed columns; a bad number becomes null."""
    if ticker_id is not None:
        forms = forms.where(F.col("ticker_id") == ticker_id)
    if width is not None:
        forms = forms.where(F.col("bar_width_sec") == width)
    plain = [c for c in forms.columns if c != "formprops"]
    return forms.select(
        *plain,
        *(F.col("formprops")[k].try_cast(t).alias(k) for k, t in FORM_PROPS.items()),
    )


def series_keys(table: DataFrame, widths: list[int] | None = None) -> DataFrame:
    """Distinct (ticker_id, bar_width_sec), sorted, for all widths or a few."""
    if widths is not None:
        table = table.where(F.col("bar_width_sec").isin(*widths))
    return table.select(*SERIES).distinct().orderBy(*SERIES)


def ticks_count_days(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("ticker_id", "ddate").agg(F.count(F.lit(1)).alias("ticks_count"))


def ticks_count_total(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("ticker_id").agg(F.count(F.lit(1)).alias("ticks_count"))


def day_and_total_counts(days: DataFrame, totals: DataFrame) -> DataFrame:
    """Day counts next to their instrument's total."""
    return days.join(totals.withColumnRenamed("ticks_count", "ticks_total"), "ticker_id")


def connector_table(
    spark: SparkSession,
    where: str,
    decimals: dict[str, str] | None = None,
    fmt: str = "parquet",
    path: str | None = None,
    **options,
) -> DataFrame:
    """A table of any connector, filtered, with chosen columns cast to a decimal type."""
    table = spark.read.format(fmt).options(**options).load(path).where(where)
    return table.withColumns(
        {name: F.col(name).cast(kind) for name, kind in (decimals or {}).items()}
    )


def libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    return spark.read.format("libsvm").option("numFeatures", str(num_features)).load(path)


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
