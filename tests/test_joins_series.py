import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tickloom.plans.durable import durable
from tickloom.plans.joins import checked_join, hot_keys, split_hot
from tickloom.plans.series import are_short, numbered, running_total, with_previous


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 0."""
    big = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"), "id"
    )
    small = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    return durable(big, "big"), durable(small, "small")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize(
    "limits", [{}, {"small_rows": 0}, {"small_rows": 0, "hot_rows": 25}, {"at_most": 10**9}]
)
def test_every_path_gives_the_plain_join(skewed, how, limits):
    big, small = skewed
    plain = big.join(small, "k", how)
    checked = checked_join(big, small, ["k"], how, spread=["id"], **limits)
    assert rows_of(checked, *plain.columns) == rows_of(plain, *plain.columns)


def test_hot_key_is_split_and_the_rest_is_not(skewed):
    big, small = skewed
    assert rows_of(hot_keys(big, ["k"], 25), "k", "_parts") == [(0, 9)]
    dealt, copied = split_hot(big, small, ["k"], ["id"], 25)
    largest = dealt.groupBy("k", "_part").count().agg(F.max("count")).first()[0]
    assert largest < 50
    assert copied.where("k = 0").count() == 9
    assert copied.where("k = 1").count() == 1


def test_broadcast_only_below_the_counted_limit(skewed, capsys):
    big, small = skewed
    checked_join(big, small, ["k"], spread=["id"]).explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out


def test_series_columns_cross_slices(spark):
    df = durable(
        spark.range(50).select(
            (F.col("id") % 2).alias("k"),
            F.floor(F.col("id") / 7).alias("s"),
            "id",
            F.lit(1).alias("one"),
        ),
        "series",
    )
    for r in numbered(df, ["k"], "s", [F.col("id")]).collect():
        assert r.seq == r.id // 2
    for r in with_previous(df, ["k"], "s", ["id"], "id", "before").collect():
        assert r.before == (r.id - 2 if r.id >= 2 else None)
    for r in running_total(df, ["k"], "s", ["id"], "one", "total").collect():
        assert r.total == r.id // 2 + 1


def test_whole_series_give_what_slices_give(spark):
    rows = [(k, i // 3, i) for k in (1, 2, None) for i in range(20)] + [(1, None, 99)]
    df = durable(spark.createDataFrame(rows, "k long, s long, id long"), "whole-series")
    assert are_short(df, ["k"], 21) and not are_short(df, ["k"], 20)
    assert are_short(df.limit(0), ["k"], 0)
    for make in (
        lambda whole: numbered(df, ["k"], "s", [F.col("id")], whole=whole),
        lambda whole: with_previous(df, ["k"], "s", ["id"], "id", "out", whole),
        lambda whole: running_total(df, ["k"], "s", ["id"], "id", "out", whole),
    ):
        assert rows_of(make(True), "k", "s", "id", make(True).columns[-1]) == rows_of(
            make(False), "k", "s", "id", make(False).columns[-1]
        )
        assert make(True).schema[-1].dataType == make(False).schema[-1].dataType
