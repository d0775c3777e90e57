import hashlib

import pytest
from conftest import rows_of
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickloom.operators import meta, ml, research, splits
from tickloom.operators.marks import form_resume_marks
from tickloom.plans.durable import durable
from tickloom.schema import FORMS
from tickloom.sinks import tables as sinks
from tickloom.sources import tables


@pytest.fixture(scope="module")
def forms(spark):
    rows = spark.range(120).select(
        (F.col("id") % 4).alias("ticker_id"),
        F.lit("2024-01-01").cast("date").alias("ddate"),
        F.lit(30).alias("bar_width_sec"),
        (F.col("id") * 1000).alias("ts_begin"),
        (F.col("id") * 1000 + 150_500).alias("ts_end"),
        F.lit(0.1).alias("log_oe"),
        F.when(F.col("id") % 3 == 0, "mn").otherwise("mx").alias("res_type"),
        F.lit(6).alias("formdeepkoef"),
        F.create_map(
            F.lit("frmconfpeak"), F.when(F.col("id") % 3 == 0, "131").otherwise("313"),
            F.lit("tickscnt"), F.lit("9"), F.lit("sps"), (F.col("id") % 10 / 10).cast("string"),
            F.lit("sms"), F.lit("0.5"), F.lit("tcvolprofile"), (F.col("id") % 5).cast("string"),
            F.lit("acf_05_bws"), F.lit("0.99"), F.lit("acf_1_bws"), F.lit("0.95"),
            F.lit("acf_2_bws"), F.lit("0.91"),
        ).alias("formprops"),
    )
    return durable(rows.select(*FORMS.names), "forms")


@pytest.fixture(scope="module")
def typed(forms):
    return tables.typed_forms(forms)


def test_join_worksheet(spark):
    left = spark.createDataFrame([(i, "c", "f") for i in (1, 2, 3, 4)], "ticker_id int, a string, b string")
    right = spark.createDataFrame(
        [(2, 25, 1), (3, 55, 1), (2, 33, 1), (3, 66, 1), (1, 30, 0)],
        "ticker_id int, bar_width_sec int, is_enabled int",
    )
    kept = meta.tickers_with_widths(left, right.where("is_enabled = 1"))
    assert rows_of(kept, "ticker_id") == [(2,), (3,)]
    assert rows_of(meta.work_items(left, right), "ticker_id", "bar_width_sec") == [
        (2, 25), (2, 33), (3, 55), (3, 66),
    ]


def test_property_map_is_typed_and_bad_numbers_are_null(spark, forms):
    typed = tables.typed_forms(forms, ticker_id=1, width=30)
    assert dict(typed.dtypes)["frmconfpeak"] == "int" and dict(typed.dtypes)["sps"] == "double"
    bad = forms.withColumn("formprops", F.create_map(F.lit("sps"), F.lit("n/a")))
    assert {(r.sps, r.sms) for r in tables.typed_forms(bad).collect()} == {(None, None)}


def test_labels_and_digits(typed):
    got = {tuple(r) for r in research.labelled(typed).select("label", "f1", "f2", "f3").collect()}
    assert got == {(1.0, 3.0, 1.0, 3), (2.0, 1.0, 3.0, 1)}


def test_trend_predicate(typed):
    # sps > sms for ids ending in 6..9
    want = sum(i % 10 >= 6 and i % 3 != 0 for i in range(120))
    assert rows_of(research.strong_trend(typed, "mx"), "frmconfpeak", "cnt") == [(313, want)]


def test_majority_breaks_ties_by_the_smaller_label(spark):
    labels = spark.createDataFrame(
        [(2.0, 111), (1.0, 111), (2.0, 333), (2.0, 333), (1.0, 333)], "label double, frmconfpeak int"
    ).selectExpr("*", "1 AS f1", "1 AS f2", "1 AS f3")
    assert rows_of(research.majority_label(labels), "frmconfpeak", "label") == [
        (111, 1.0), (333, 2.0),
    ]


def test_prediction_counts_are_null_without_rows(spark):
    scored = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "label double, prediction double")
    assert tuple(research.prediction_hits(scored).first()) == (2, None)


def test_resume_marks_need_both_ways(spark, forms):
    series = forms.select("ticker_id", "bar_width_sec").distinct()
    full = form_resume_marks(series, forms, [0.1, 0.7], 6)
    assert full.where("mark_ts is null").count() == 0
    one_way = form_resume_marks(series, forms.where("res_type = 'mx'"), [0.1], 6)
    assert one_way.where("mark_ts is null").count() == 4
    first = full.where("ticker_id = 0").first()
    newest = forms.where("ticker_id = 0").groupBy("res_type").agg(F.max("ts_end").alias("m"))
    assert first.mark_ts == newest.agg(F.min("m")).first()[0]


def test_time_span_uses_the_calendar_year(forms):
    row = research.time_span(forms).first()
    assert row.ts_end_ddate == "01-01-1970" and row.ts_eb_secs == 150.5


def test_pipelines_learn_a_separable_code(typed, tmp_path):
    model = ml.digits_pipeline([9, 9, 5, 3], 60).fit(typed)
    assert ml.accuracy(model.transform(typed)) > 0.9
    ml.save_model(model, str(tmp_path / "model"))
    again = ml.load_model(str(tmp_path / "model")).transform(typed)
    assert ml.accuracy(again) == ml.accuracy(model.transform(typed))


def test_one_model_scores_every_ticker(spark, typed):
    model = ml.indexed_pipeline([5, 9, 5, 2], 30).fit(typed)
    tickers = spark.range(6).withColumnRenamed("id", "ticker_id")
    got = {r.ticker_id: r for r in ml.accuracy_by_ticker(model, typed, tickers).collect()}
    assert got[5].accuracy is None and got[5].forms_cnt == 0
    assert sum(r.forms_cnt for r in got.values()) == 120


def test_probabilities_and_getprob(spark, typed):
    data = ml.prepared(typed)
    scored = ml.perceptron([9, 5, 3]).fit(data).transform(data)
    wide = ml.with_probabilities(scored)
    assert "features" not in wide.columns
    assert all(0 <= r.p0 <= 1 and r.p0 == round(r.p0, 2) for r in wide.collect())
    ml.register_getprob(spark)
    sinks.publish(scored.withColumn("probability", ml.vector_to_array("probability")), "scored")
    total = spark.sql(
        "SELECT sum(getprob(probability, 0) + getprob(probability, 1) + getprob(probability, 2)) "
        "FROM global_temp.scored"
    ).first()[0]
    assert total == pytest.approx(120)


def test_split_has_exact_shares_however_the_rows_lie(spark, typed):
    def parts(table):
        return [rows_of(p, "ts_end") for p in ml.split(table, [0.5, 0.3, 0.2])]

    one = parts(typed)
    assert [len(p) for p in one] == [60, 36, 24]
    assert parts(typed.repartition(7, "ts_begin")) == one
    by_hash = sorted(
        (hashlib.md5(f"1234|{r.ticker_id}|{r.bar_width_sec}|{r.ts_end}|{r.res_type}".encode()).hexdigest(), r.ts_end)
        for r in typed.collect()
    )
    assert one[0] == sorted((t,) for _, t in by_hash[:60]) and one[2] == sorted((t,) for _, t in by_hash[96:])


def test_split_keeps_equal_keys_together_and_takes_odd_input(spark):
    rows = spark.createDataFrame([(1, None)] * 6 + [(2, "b")] * 4, "k int, v string")
    found = [p.groupBy("k").count().collect() for p in splits.split(rows, [0.5, 0.5], ["k", "v"], 7)]
    assert sorted(tuple(r) for p in found for r in p) == [(1, 6), (2, 4)]
    assert [p.count() for p in splits.split(rows, [1, 0], ["k"], 7)] == [10, 0]
    assert [p.count() for p in splits.split(rows.limit(0), [0.5, 0.5], ["k"], 7)] == [0, 0]
    with pytest.raises(ValueError):
        splits.split(rows, [0.0], ["k"], 7)


def test_a_form_of_an_unseen_class_is_an_error(typed):
    model = ml.logistic_pipeline().fit(typed)
    odd = typed.limit(1).withColumn("res_type", F.lit("xx"))
    for other in (odd, odd.withColumn("res_type", F.lit(None).cast("string"))):
        with pytest.raises((Py4JJavaError, PySparkException)):
            model.transform(other).collect()


def test_string_index_is_by_frequency_then_alphabet(spark):
    df = spark.createDataFrame([(c,) for c in "bbaacccd"], "v string")
    out = ml.indexer("v", "i").fit(df).transform(df).distinct()
    assert rows_of(out, "v", "i") == [("a", 1.0), ("b", 2.0), ("c", 0.0), ("d", 3.0)]


def test_generic_readers(spark, tmp_path, typed):
    path = str(tmp_path / "csv")
    spark.range(5).selectExpr("id", "id * 20000 AS sval").write.csv(path, header=True)
    got = tables.connector_table(
        spark, "id > 1", {"sval": "decimal(38,18)"}, fmt="csv", path=path, header="true"
    )
    assert dict(got.dtypes)["sval"] == "decimal(38,18)"
    flagged = research.above_flag(got, "sval", 65000)
    assert rows_of(flagged, "id", "cntrlparam") == [("2", 0), ("3", 0), ("4", 1)]
    got.createOrReplaceTempView("generic")
    assert tables.catalog_table(spark, "generic").count() == 3
    svm = str(tmp_path / "svm")
    ml.prepared(typed).select("label", "features").write.format("libsvm").save(svm)
    assert tables.libsvm(spark, svm, 9).count() == 120
