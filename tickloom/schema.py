"""Table schemas and the keys rows are upserted on."""

from pyspark.sql import types as T


def _struct(**cols):
    return T.StructType([T.StructField(name, kind, True) for name, kind in cols.items()])


TICKS = _struct(
    ticker_id=T.LongType(),
    ddate=T.DateType(),
    ts=T.LongType(),
    db_tsunx=T.LongType(),
    ask=T.DoubleType(),
    bid=T.DoubleType(),
)

TICKS_DAYS = _struct(
    ticker_id=T.LongType(),
    ddate=T.DateType(),
    ticks_count=T.LongType(),
    first_ts=T.LongType(),
    last_ts=T.LongType(),
    min_tsunx=T.LongType(),
    max_tsunx=T.LongType(),
)

PENDING_DAYS = _struct(ddate=T.DateType())

TICKERS = _struct(
    ticker_id=T.LongType(),
    ticker_code=T.StringType(),
    ticker_first=T.StringType(),
    ticker_seconds=T.StringType(),
)

BARS_PROPERTY = _struct(
    ticker_id=T.LongType(),
    bar_width_sec=T.IntegerType(),
    is_enabled=T.IntegerType(),
)

BARS = _struct(
    ticker_id=T.LongType(),
    ddate=T.DateType(),
    bar_width_sec=T.IntegerType(),
    ts_begin=T.LongType(),
    ts_end=T.LongType(),
    o=T.DoubleType(),
    h=T.DoubleType(),
    l=T.DoubleType(),
    c=T.DoubleType(),
    h_body=T.DoubleType(),
    h_shad=T.DoubleType(),
    btype=T.StringType(),
    ticks_cnt=T.IntegerType(),
    disp=T.DoubleType(),
    log_co=T.DoubleType(),
)

BARS_DATES = _struct(
    ticker_id=T.LongType(),
    bar_width_sec=T.IntegerType(),
    ddate=T.DateType(),
    curr_ts=T.LongType(),
    cnt=T.LongType(),
    ts_end_min=T.LongType(),
    ts_end_max=T.LongType(),
)

OUTCOMES = _struct(
    ticker_id=T.LongType(),
    ddate=T.DateType(),
    bar_width_sec=T.IntegerType(),
    ts_end=T.LongType(),
    c=T.DoubleType(),
    log_oe=T.DoubleType(),
    ts_end_res=T.LongType(),
    dursec_res=T.IntegerType(),
    ddate_res=T.DateType(),
    c_res=T.DoubleType(),
    res_type=T.StringType(),
)

OPEN_SEARCHES = _struct(
    ticker_id=T.LongType(),
    ddate=T.DateType(),
    bar_width_sec=T.IntegerType(),
    ts_end=T.LongType(),
    c=T.DoubleType(),
    log_oe=T.DoubleType(),
    up=T.DoubleType(),
    down=T.DoubleType(),
)

OPEN_RUNS = _struct(run=T.LongType())

FORMS = _struct(
    ticker_id=T.LongType(),
    ddate=T.DateType(),
    bar_width_sec=T.IntegerType(),
    ts_begin=T.LongType(),
    ts_end=T.LongType(),
    log_oe=T.DoubleType(),
    res_type=T.StringType(),
    formdeepkoef=T.IntegerType(),
    formprops=T.MapType(T.StringType(), T.StringType()),
)

RESULT = _struct(
    label=T.DoubleType(),
    frmconfpeak=T.IntegerType(),
    prediction=T.DoubleType(),
    p0=T.DoubleType(),
    p1=T.DoubleType(),
)

SERIES = ["ticker_id", "bar_width_sec"]

KEYS = {
    "ticks": ["ticker_id", "ddate", "ts", "db_tsunx"],
    "bars": ["ticker_id", "ddate", "bar_width_sec", "ts_end"],
    "bars_fa": ["ticker_id", "ddate", "bar_width_sec", "log_oe", "ts_end"],
    "bars_forms": [
        "ticker_id",
        "ddate",
        "bar_width_sec",
        "ts_begin",
        "ts_end",
        "log_oe",
        "res_type",
    ],
}

# Keys of the form property map, with the type each one is read as.
FORM_PROPS = {
    "tickscnt": "int",
    "frmconfpeak": "int",
    "sps": "double",
    "sms": "double",
    "tcvolprofile": "int",
    "acf_05_bws": "double",
    "acf_1_bws": "double",
    "acf_2_bws": "double",
}
