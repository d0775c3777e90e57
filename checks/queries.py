"""Every registered query: name -> function of (spark, folder of the Parquet tables).

Like the jobs, a query reads the stage before it as a stored table. Stages are written once per
application and input folder and shared by the queries that start from them.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import bars as bar_ops
from tickloom.operators import daysummary
from tickloom.operators import forms as form_ops
from tickloom.operators import islands as island_ops
from tickloom.operators import marks, meta, ml, research, resume
from tickloom.operators import outcomes as outcome_ops
from tickloom.plans import jobs
from tickloom.plans.durable import durable
from tickloom.schema import FORM_PROPS, FORMS, SERIES
from tickloom.session import prepare, scratch_dir
from tickloom.sinks import tables as sinks
from tickloom.sources import tables
from tickloom.sources import ticks as tick_ops
from tickloom.streaming import bars_stream

from . import sql as S

_stages: dict[tuple, DataFrame] = {}
QUERIES: dict = {}


def register(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(prepare(spark), sf_dir))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


class Inputs:
    """The given tables and the stages derived from them."""

    def __init__(self, spark, sf_dir):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name):
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def stored(self, name, make):
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _stages:
            _stages[key] = durable(make(), name.replace("/", "-"))
        # A fresh read each time: two uses of one DataFrame would share attribute ids.
        return _stages[key].select("*")

    def ticks(self, mapping="sparse"):
        return tick_ops.ticks_from_events(self.table("events"), mapping)

    def tickers(self):
        return tables.tickers_from_customers(self.table("customer"))

    def bars_property(self):
        return tables.bars_property_for(self.ticks(), list(S.WIDTHS))

    def items(self, mapping="sparse", width=S.SPARSE_W):
        return self.ticks(mapping).select("ticker_id").distinct().withColumn(
            "bar_width_sec", F.lit(width)
        )

    def bars(self, mapping="sparse", width=S.SPARSE_W):
        return self.stored(
            f"bars-{mapping}",
            lambda: bar_ops.bars_from_first_tick(
                self.ticks(mapping), self.items(mapping, width)
            ),
        )

    def hits(self, mapping="sparse", width=S.SPARSE_W):
        return self.stored(
            f"hits-{mapping}",
            lambda: outcome_ops.first_hits(self.bars(mapping, width), list(S.PS)),
        )

    def outcomes(self, mapping="sparse", width=S.SPARSE_W):
        return self.stored(
            f"outcomes-{mapping}", lambda: outcome_ops.resolved(self.hits(mapping, width))
        )

    def kept(self, mapping="sparse", width=S.SPARSE_W):
        return self.stored(
            f"kept-{mapping}",
            lambda: island_ops.island_ends(self.outcomes(mapping, width), S.KOEFF),
        )

    def windows(self, mapping="dense", width=S.DENSE_W):
        return self.stored(
            f"windows-{mapping}",
            lambda: form_ops.form_windows(self.kept(mapping, width), S.DEEP),
        )

    def features(self, mapping="dense", width=S.DENSE_W):
        return self.stored(
            f"features-{mapping}",
            lambda: form_ops.window_features(
                self.ticks(mapping), self.windows(mapping, width), S.DEEP, S.LAGS
            ),
        )

    def forms(self, mapping="dense", width=S.DENSE_W):
        """Complete forms in the stored layout."""
        return self.stored(
            f"forms-{mapping}",
            lambda: form_ops.with_prop_map(
                form_ops.complete(
                    form_ops.build_forms(
                        self.ticks(mapping), self.kept(mapping, width), S.DEEP, S.LAGS
                    )
                )
            ),
        )

    def typed(self, mapping="dense", width=S.DENSE_W):
        return tables.typed_forms(self.forms(mapping, width))

    def old_bars(self):
        """Bars over the days up to the split, as an incremental run would find them."""
        return self.stored(
            "old-bars",
            lambda: bar_ops.bars_from_first_tick(
                self.ticks().where(F.col("ddate") <= F.lit(S.SPLIT_DAY).cast("date")),
                self.items(),
            ),
        )

    def points(self):
        return meta.resume_points(
            self.items(), meta.last_bars(self.old_bars()), daysummary.edges(self.tick_days())
        )

    def tick_days(self):
        return self.stored("tick-days", lambda: daysummary.day_summary(self.ticks()))


# --- reads -----------------------------------------------------------------------------------


@register
def ticks_interval(x):
    return tick_ops.ticks_between(x.ticks(), S.BEGIN_MS, S.END_MS)


@register
def ticks_whole_days(x):
    return tick_ops.ticks_for_bars(x.ticks(), x.kept())


@register
def ticks_for_form(x):
    return tick_ops.ticks_for_form(x.ticks("dense"), S.BEGIN_MS, S.END_MS, "2024-01-09")


@register
def bars_of_keys(x):
    """All bars of each series' newest day, by key list."""
    newest = x.bars().groupBy(*SERIES).agg(F.max("ddate").alias("ddate"))
    return tables.bars_for_keys(x.bars(), newest)


@register
def enabled_widths(x):
    return tables.enabled_widths(x.bars_property())


@register
def ticker_dictionary(x):
    return tables.ticker_dictionary(x.tickers())


@register
def tick_counts_day(x):
    return tables.ticks_count_days(x.ticks()).orderBy("ticker_id", "ddate")


@register
def tick_counts_total(x):
    return tables.ticks_count_total(x.ticks()).orderBy("ticker_id")


@register
def tick_counts_joined(x):
    days = tables.ticks_count_days(x.ticks())
    return tables.day_and_total_counts(days, tables.ticks_count_total(x.ticks()))


@register
def ticks_total(x):
    return tables.ticks_count_days(x.ticks()).agg(F.sum("ticks_count").alias("total"))


@register
def counts_stored_twice(x):
    """The stored day summary after three loads that overlap: up to a day, from that day on, again."""
    store = jobs.Store(x.spark, f"{scratch_dir(x.spark)}/counts-{uuid.uuid4().hex}")
    split = F.lit(S.SPLIT_DAY).cast("date")
    early, late = x.ticks().where(F.col("ddate") <= split), x.ticks().where(F.col("ddate") >= split)
    for part in (early, late, early):
        jobs.load_ticks(store, part)
    return jobs.tick_days(store).select("ticker_id", "ddate", "ticks_count", "first_ts", "last_ts")


@register
def form_keys(x):
    return tables.series_keys(x.forms("sparse", S.SPARSE_W))


@register
def connector_flag(x):
    """Generic table read: filter, decimal cast, threshold flag."""
    read = tables.connector_table(
        x.spark,
        "o_totalprice > 0",
        {"o_totalprice": "decimal(38,18)"},
        path=f"{x.sf_dir}/orders.parquet",
    )
    return research.above_flag(read, "o_totalprice", 65000).select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("sval"), "cntrlparam"
    )


@register
def catalog_scan(x):
    x.ticks().createOrReplaceTempView("catalog_ticks")
    return (
        tables.catalog_table(x.spark, "catalog_ticks")
        .groupBy("ddate")
        .agg(F.count(F.lit(1)).alias("cnt"), F.max("ask").alias("max_ask"))
    )


@register
def calendar_days(x):
    """Every calendar day between an instrument's first and last tick day."""
    days = meta.day_range(x.ticks(), ["ticker_id"])
    between = F.sequence("min_ddate", "max_ddate", F.expr("interval 1 day"))
    return days.select("ticker_id", F.explode(between).alias("ddate"))


# --- metadata --------------------------------------------------------------------------------


@register
def first_tick(x):
    return meta.first_ticks(x.ticks())


@register
def last_tick(x):
    return meta.last_ticks(x.ticks())


@register
def last_bar(x):
    return meta.last_bars(x.bars())


@register
def bar_day_range(x):
    return meta.day_range(x.bars())


@register
def outcome_days(x):
    return meta.distinct_days(x.outcomes())


@register
def outcome_key_counts(x):
    return meta.key_counts(x.outcomes())


@register
def tickers_first_tick(x):
    return meta.tickers_with_first_tick(x.tickers(), x.ticks())


@register
def tickers_with_widths(x):
    return meta.tickers_with_widths(x.tickers(), x.bars_property())


@register
def work_items(x):
    return meta.work_items(x.tickers(), x.bars_property())


# --- bars ------------------------------------------------------------------------------------


@register
def bars_ohlc(x):
    return bar_ops.bars_from_first_tick(x.ticks(), x.items())


@register
def bars_ohlc_dense(x):
    return bar_ops.bars_from_first_tick(x.ticks("dense"), x.items("dense", 3600))


@register
def bars_ohlc_multi_width(x):
    items = meta.work_items(x.tickers(), x.bars_property())
    return bar_ops.bars_from_first_tick(x.ticks(), items)


@register
def bars_dates_summary(x):
    return bar_ops.bars_dates_summary(x.bars())


@register
def bars_stored(x):
    """Saved twice through the keyed upsert and read back: the same bars, once each."""
    path = f"{scratch_dir(x.spark)}/bars-stored-{abs(hash(x.sf_dir))}"
    sinks.save_bars(x.bars(), path)
    sinks.save_bars(x.old_bars().join(x.bars(), x.bars().columns, "left_semi"), path)
    return sinks.read_or_empty(x.spark, path, x.bars().schema)


@register
def resume_points(x):
    return x.points()


@register
def read_windows(x):
    return resume.read_windows(x.ticks(), x.points(), S.STEP_MS, x.tick_days()).select(
        *SERIES, "begin_from", "first_read", "read_to"
    )


@register
def bars_resume_step(x):
    return resume.bars_resumed(
        x.ticks(), x.old_bars(), x.items(), S.STEP_MS, x.tick_days()
    )


@register
def bars_chained(x):
    return resume.bars_chained(x.ticks("dense"), x.items("dense", 3600), S.STEP_MS)


@register
def bars_streamed(x):
    return bars_stream.stream_to_table(
        x.spark,
        bars_stream.event_ticks(x.spark, x.sf_dir, x.table("events").schema),
        x.items(),
    )


# --- outcomes --------------------------------------------------------------------------------


@register
def outcomes_first_hit(x):
    return outcome_ops.first_hits(x.bars(), list(S.PS))


@register
def outcomes_first_hit_dense(x):
    return outcome_ops.first_hits(x.bars("dense", S.DENSE_W), list(S.PS), fanout=8)


@register
def outcomes_resolved(x):
    return outcome_ops.resolved(x.hits())


@register
def outcomes_by_type(x):
    return x.hits().groupBy("log_oe", "res_type").agg(F.count(F.lit(1)).alias("cnt"))


@register
def outcomes_resume(x):
    """Bars an incremental outcome run reads after the days up to the split were analysed."""
    done = x.outcomes().where(F.col("ddate") <= F.lit(S.SPLIT_DAY).cast("date"))
    return outcome_ops.bars_to_analyse(x.bars(), done)


@register
def outcomes_two_runs(x):
    """Bars up to the split, a job run, the other bars, a second run: the outcomes of one run."""
    store = jobs.Store(x.spark, f"{scratch_dir(x.spark)}/two-runs-{uuid.uuid4().hex}")
    day = F.lit(S.SPLIT_DAY).cast("date")
    for bars in (x.bars().where(F.col("ddate") <= day), x.bars().where(F.col("ddate") > day)):
        sinks.save_bars(bars, store.path("bars"), store.path("bars_bws_dates"))
        jobs.build_outcomes(store, list(S.PS))
    return store.read("bars_fa")


@register
def outcomes_latest_day(x):
    return outcome_ops.bars_to_analyse(x.bars(), latest_only=True)


@register
def islands(x):
    return island_ops.islands(x.outcomes(), S.KOEFF)


@register
def islands_last(x):
    return island_ops.island_ends(x.outcomes(), S.KOEFF)


# --- forms -----------------------------------------------------------------------------------


@register
def form_ticks(x):
    return form_ops.form_ticks(x.ticks("dense"), x.kept("dense", S.DENSE_W), S.DEEP)


@register
def form_features(x):
    return form_ops.window_features(x.ticks("dense"), x.windows(), S.DEEP, S.LAGS)


def _feature(name, *columns):
    def pick(x):
        return x.features().select(*SERIES, "ts_end", *columns)

    pick.__name__ = name
    register(pick)


_feature("form_counts", "tickscnt", "ts_begin")
_feature("form_conf_peak", "frmconfpeak")
_feature("form_price_peak", "peak_price")
_feature("form_step_mass", "sps", "sms")
_feature("form_volume_profile", "tcvolprofile")
_feature("form_acf", "acf_05_bws", "acf_1_bws", "acf_2_bws")


@register
def forms_complete(x):
    return form_ops.complete(
        form_ops.build_forms(x.ticks("dense"), x.kept("dense", S.DENSE_W), S.DEEP, S.LAGS)
    ).select(*[c for c in FORMS.names if c != "formprops"], *FORM_PROPS)


@register
def forms_sparse(x):
    return form_ops.complete(
        form_ops.build_forms(x.ticks(), x.kept(), S.DEEP, S.LAGS)
    ).select(*[c for c in FORMS.names if c != "formprops"], *FORM_PROPS)


@register
def forms_map(x):
    """The stored property map read back as typed columns."""
    return x.typed()


@register
def forms_two_runs(x):
    """Outcomes up to the split, a job run, the other outcomes, a second run that takes back ends which
    are none any more: the forms of one run."""
    store = jobs.Store(x.spark, f"{scratch_dir(x.spark)}/two-form-runs-{uuid.uuid4().hex}")
    jobs.load_ticks(store, x.ticks("dense"))
    found, day = x.outcomes("dense", S.DENSE_W), F.lit(S.SPLIT_DAY).cast("date")
    for part in (found.where(F.col("ddate") <= day), found.where(F.col("ddate") > day)):
        sinks.save_outcomes(part, store.path("bars_fa"))
        jobs.build_forms(store, list(S.PS), S.DEEP, S.KOEFF, S.LAGS, retract=True)
    return tables.typed_forms(store.read("bars_forms"))


@register
def form_high_water(x):
    return marks.form_marks(x.forms())


def _earlier_forms(x):
    return x.forms().where(F.col("ddate") <= F.lit(S.SPLIT_DAY).cast("date"))


def _marks(x):
    series = x.outcomes("dense", S.DENSE_W).select(*SERIES).distinct()
    return marks.form_resume_marks(series, _earlier_forms(x), list(S.PS), S.DEEP)


@register
def form_resume(x):
    return _marks(x)


@register
def fa_since_mark(x):
    return tables.outcomes_since(x.outcomes("dense", S.DENSE_W), _marks(x))


# --- research --------------------------------------------------------------------------------


@register
def label_digits(x):
    return research.labelled(x.typed())


@register
def label_digits_from_zero(x):
    return research.labelled(
        x.typed(),
        ["frmconfpeak"],
        codes=research.LABELS_FROM_ZERO,
        other=research.OTHER_LABEL_FROM_ZERO,
    )


@register
def majority_label(x):
    return research.majority_label(research.labelled(x.typed(), ["frmconfpeak"]))


@register
def label_counts(x):
    return research.counts_by(
        research.labelled(x.typed()), "label", order=["label"], name="cnt"
    )


@register
def forms_by_ticker(x):
    return research.counts_by(
        x.typed("sparse", S.SPARSE_W), "ticker_id", order=[F.desc("forms_cnt"), "ticker_id"]
    )


@register
def conf_by_type(x):
    return research.counts_by(
        x.typed(), "frmconfpeak", "res_type", order=["frmconfpeak", "res_type"]
    )


@register
def conf_counts(x):
    return research.counts_by(x.typed(), "frmconfpeak", order=["forms_cnt", "frmconfpeak"])


@register
def type_counts_for_code(x):
    code = x.typed().where(F.col("frmconfpeak") == 333)
    return research.counts_by(code, "res_type", order=["res_type"], name="cnt")


def _trends(x, *level):
    both = [
        research.strong_trend(x.typed("sparse", S.SPARSE_W), way, *level).withColumn(
            "res_type", F.lit(way)
        )
        for way in island_ops.WAYS
    ]
    return both[0].unionByName(both[1])


@register
def strong_trend_forms(x):
    return _trends(x)


@register
def falling_trend_forms(x):
    """The same predicate without a floor: autocorrelation falling from lag to lag."""
    return _trends(x, -1.0)


@register
def forms_time_span(x):
    return research.time_span(x.typed())


@register
def forms_union(x):
    """Forms of two mappings in one table, counted through a shared view."""
    both = x.typed().withColumn("src", F.lit("dense")).unionByName(
        x.typed("sparse", S.SPARSE_W).withColumn("src", F.lit("sparse"))
    )
    sinks.publish(both, "forms_union")
    return x.spark.sql(
        "SELECT src, res_type, count(*) AS cnt FROM global_temp.forms_union "
        "GROUP BY src, res_type ORDER BY 1, 2"
    )


def _guessed(x):
    """Forms scored with the majority label of their price code."""
    labels = research.labelled(x.typed(), ["frmconfpeak"])
    guess = research.majority_label(labels).select(
        "frmconfpeak", F.col("label").alias("prediction")
    )
    # At most 28 price codes.
    return labels.join(F.broadcast(guess), "frmconfpeak")


@register
def prediction_hits(x):
    return research.prediction_hits(_guessed(x))


@register
def sql_transform(x):
    return ml.sql_stage().transform(x.typed())


@register
def string_index(x):
    """Label index of every form's price code: most frequent first, ties alphabetical."""
    forms = x.typed().withColumn("code", F.col("frmconfpeak").cast("string"))
    fitted = ml.indexer("code", "code_index").fit(forms)
    return fitted.transform(forms).groupBy("code", "code_index").agg(
        F.count(F.lit(1)).alias("cnt")
    )


# --- ML --------------------------------------------------------------------------------------


SHARES = [0.7, 0.3]


@register
def split_counts(x):
    """Both parts of an exact split: how many forms, and which."""
    parts = ml.split(x.typed(), SHARES)
    named = [p.withColumn("part", F.lit(n)) for n, p in zip(("train", "test"), parts, strict=True)]
    return named[0].unionByName(named[1]).groupBy("part").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.sum("ticker_id").alias("ticker_sum"),
        F.min("ts_end").alias("first_end"),
        F.max("ts_end").alias("last_end"),
    )


def _tested(x):
    train, test = (durable(ml.prepared(p), "ml-data") for p in ml.split(x.typed(), SHARES))
    return ml.perceptron([9, 9, 5, 3]).fit(train).transform(test)


@register
def mlp_accuracy(x):
    right = (F.col("label") == F.col("prediction")).cast("double")
    return _tested(x).agg(F.avg(right).alias("accuracy"), F.count(F.lit(1)).alias("cnt"))


@register
def mlp_test_rows(x):
    """Held-out forms by class, and how many of them got a class and probabilities that add up to 1."""
    total = F.aggregate(ml.vector_to_array("probability"), F.lit(0.0), lambda a, p: a + p)
    return _tested(x).groupBy("label").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count_if(F.col("prediction").isin(0, 1, 2)).alias("scored_cnt"),
        F.count_if(F.abs(total - 1) < 1e-9).alias("whole_cnt"),
    )


@register
def mlp_by_ticker(x):
    forms = x.typed("sparse", S.SPARSE_W)
    model = ml.indexed_pipeline([5, 9, 5, 2]).fit(forms)
    return ml.accuracy_by_ticker(model, forms, x.tickers())


@register
def mlp_ticker_forms(x):
    """Which instruments one model scores, with how many forms."""
    forms = x.typed("sparse", S.SPARSE_W)
    found = ml.accuracy_by_ticker(ml.indexed_pipeline([5, 9, 5, 2], 2).fit(forms), forms, x.tickers())
    return found.select("ticker_id", "forms_cnt", F.col("accuracy").isNotNull().alias("is_scored"))


def _by_digits(x):
    data = ml.assemble(research.labelled(x.typed(), ["frmconfpeak"]), ["f1", "f2", "f3"])
    return ml.perceptron([3, 5, 5, 3]).fit(data).transform(data)


@register
def mlp_probabilities(x):
    return ml.with_probabilities(_by_digits(x))


def _publish_scored(x):
    ml.register_getprob(x.spark)
    sinks.publish(
        _by_digits(x).withColumn("probability", ml.vector_to_array("probability")), "scored_forms"
    )


@register
def mlp_getprob(x):
    _publish_scored(x)
    return x.spark.sql(
        "SELECT frmconfpeak, prediction, getprob(probability, 1) AS p1 "
        "FROM global_temp.scored_forms"
    )


@register
def getprob_totals(x):
    """Probabilities of all classes, added up over the forms of a price code."""
    _publish_scored(x)
    total = " + ".join(f"getprob(probability, {i})" for i in range(3))
    return x.spark.sql(
        f"SELECT frmconfpeak, count(*) AS cnt, round(sum({total}), 6) AS total "
        "FROM global_temp.scored_forms GROUP BY frmconfpeak"
    )


def _saved_and_loaded(x, forms):
    model = ml.logistic_pipeline().fit(forms)
    path = f"{scratch_dir(x.spark)}/logistic-model"
    ml.save_model(model, path)
    return model, ml.load_model(path)


@register
def logreg_scores(x):
    forms = x.typed()
    return (
        _saved_and_loaded(x, forms)[1]
        .transform(forms)
        .groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


@register
def logreg_reloaded(x):
    """Forms by class and its index, and how many of them the model scores alike after saving."""
    forms = x.typed()
    fitted, loaded = _saved_and_loaded(x, forms)
    before = ml.vector_to_array("probability").alias("_before")
    scored = loaded.transform(fitted.transform(forms).select(*forms.columns, before))
    return scored.groupBy("res_type", "label").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count_if(ml.vector_to_array("probability") == F.col("_before")).alias("same_cnt"),
    )


@register
def results_stored(x):
    """Forms with the majority label of their price code as a stored result table, written twice."""
    path = f"{scratch_dir(x.spark)}/results-{uuid.uuid4().hex}"
    scored = _guessed(x)
    sinks.save_result(scored, path, replace=False)
    sinks.save_result(scored, path)
    return (
        x.spark.read.parquet(path)
        .groupBy("frmconfpeak", "label", "prediction")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


@register
def libsvm_features(x):
    """Forms written in libsvm format and read back: range and zeros of each element."""
    path = f"{scratch_dir(x.spark)}/libsvm-{uuid.uuid4().hex}"
    ml.prepared(x.typed()).select("label", "features").write.format("libsvm").save(path)
    read = tables.libsvm(x.spark, path, len(ml.FEATURE_COLUMNS))
    return (
        read.select("label", F.posexplode(ml.vector_to_array("features")).alias("element", "value"))
        .groupBy("label", "element")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.min("value").alias("smallest"),
            F.max("value").alias("largest"),
            F.count_if(F.col("value") == 0).alias("zeros"),
        )
    )


@register
def forms_limited(x):
    """The ten longest forms."""
    span = F.col("ts_end") - F.col("ts_begin")
    key = [*SERIES, "ts_end", "log_oe", "res_type"]
    return (
        x.typed()
        .select(*key, span.alias("span_ms"))
        .orderBy(F.desc("span_ms"), *key)
        .limit(10)
    )


@register
def sampled_form(x):
    return x.typed().sample(False, 0.5, ml.SEED).limit(1)
