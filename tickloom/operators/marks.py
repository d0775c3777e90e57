"""High-water marks of the form build."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import SERIES
from .islands import WAYS


def form_marks(forms: DataFrame) -> DataFrame:
    """Newest day and newest bar end of the stored forms, per series, depth, threshold and way.
    The two maxima are taken independently."""
    return forms.groupBy(*SERIES, "formdeepkoef", "log_oe", "res_type").agg(
        F.max("ddate").alias("max_ddate"), F.max("ts_end").alias("max_ts_end")
    )


def form_resume_marks(
    series: DataFrame, forms: DataFrame, thresholds: list[float], deep: int
) -> DataFrame:
    """Where the form build of each series goes on: the earliest mark over thresholds and ways.

    A threshold without forms is passed over, but a way without any form makes the whole series
    start again: its mark is null.
    """
    per_way = (
        form_marks(
            forms.where(
                (F.col("formdeepkoef") == deep)
                & F.col("log_oe").isin(*[float(t) for t in thresholds])
                & F.col("res_type").isin(*WAYS)
            )
        )
        .groupBy(*SERIES, "res_type")
        .agg(
            F.min_by("max_ddate", F.struct("max_ts_end", "max_ddate")).alias("ddate"),
            F.min("max_ts_end").alias("ts"),
        )
    )
    per_series = per_way.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("ways"),
        F.min_by("ddate", F.struct("ts", "ddate")).alias("ddate"),
        F.min("ts").alias("ts"),
    )
    both = F.col("ways") == len(WAYS)
    return series.join(per_series, SERIES, "left").select(
        *SERIES,
        F.when(both, F.col("ddate")).alias("mark_ddate"),
        F.when(both, F.col("ts")).alias("mark_ts"),
    )
