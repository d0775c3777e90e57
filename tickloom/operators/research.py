"""Research queries over forms and scored forms."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SERIES

# Class of each outcome, and of anything else.
LABELS = {"mx": 1, "mn": 2}
OTHER_LABEL = 3
LABELS_FROM_ZERO = {"mx": 1, "mn": 0}
OTHER_LABEL_FROM_ZERO = 2

FEATURES = ["frmconfpeak", "sps", "sms", "tcvolprofile", "acf_05_bws", "acf_1_bws", "acf_2_bws"]

# The three digits of the price code.
_HUNDREDS = "round(frmconfpeak / 100)"
DIGITS = {
    "f1": _HUNDREDS,
    "f2": f"round((frmconfpeak - {_HUNDREDS} * 100) / 10)",
    "f3": "frmconfpeak % 10",
}


def label_sql(codes: dict[str, int] = LABELS, other: int = OTHER_LABEL) -> str:
    cases = " ".join(f"WHEN '{name}' THEN {code}" for name, code in codes.items())
    return f"CASE res_type {cases} ELSE {other} END"


def labelled_sql(keep: list[str] = FEATURES, **codes) -> str:
    """The select list of ``labelled``, with the label as a whole number."""
    digits = (f"{text} AS {name}" for name, text in DIGITS.items())
    return f"SELECT {', '.join([f'{label_sql(**codes)} AS label', *keep, *digits])}"


def labelled(forms: DataFrame, keep: list[str] = FEATURES, **codes) -> DataFrame:
    """Class label, features, and the three digits of the price code as f1, f2, f3."""
    return forms.select(
        F.expr(label_sql(**codes)).cast("double").alias("label"),
        *keep,
        *(F.expr(text).alias(name) for name, text in DIGITS.items()),
    )


def majority_label(labels: DataFrame) -> DataFrame:
    """The most frequent label of each price code; the smaller label on a tie."""
    code = ["frmconfpeak", "f1", "f2", "f3"]
    best = Window.partitionBy(*code).orderBy(F.desc("cnt"), "label")
    return (
        labels.groupBy("label", *code)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("rn", F.row_number().over(best))
        .where(F.col("rn") == 1)
        .select("label", *code)
    )


def strong_trend(forms: DataFrame, way: str, level: float = 0.9) -> DataFrame:
    """Price codes of one way's forms that rise more than they fall and whose autocorrelation is
    above ``level`` at every lag and strictly decreasing."""
    high = [F.col(c) > level for c in ("acf_05_bws", "acf_1_bws", "acf_2_bws")]
    return (
        forms.where(
            (F.col("sps") > F.col("sms"))
            & (F.col("res_type") == way)
            & high[0]
            & high[1]
            & high[2]
            & (F.col("acf_05_bws") > F.col("acf_1_bws"))
            & (F.col("acf_1_bws") > F.col("acf_2_bws"))
        )
        .groupBy("frmconfpeak")
        .agg(F.sum(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "frmconfpeak")
    )


def counts_by(table: DataFrame, *by: str, order: list, name: str = "forms_cnt") -> DataFrame:
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias(name)).orderBy(*order)


def time_span(forms: DataFrame) -> DataFrame:
    """When each form ends and how many seconds it covers."""
    return forms.select(
        *SERIES,
        "ts_begin",
        "ts_end",
        F.date_format(F.timestamp_millis("ts_end"), "dd-MM-yyyy").alias("ts_end_ddate"),
        ((F.col("ts_end") - F.col("ts_begin")) / 1000).alias("ts_eb_secs"),
    ).orderBy("ts_begin")


def prediction_hits(scored: DataFrame) -> DataFrame:
    """How many scored rows got their own label and how many another one; null, not 0, when there
    are none of a kind."""
    right = F.col("label") == F.col("prediction")
    return scored.agg(
        F.sum(F.when(right, 1)).alias("right_cnt"), F.sum(F.when(~right, 1)).alias("wrong_cnt")
    )


def above_flag(table: DataFrame, column: str, limit: float, out: str = "cntrlparam") -> DataFrame:
    return table.withColumn(out, F.when(F.col(column) > limit, 1).otherwise(0))
