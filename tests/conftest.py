import datetime as dt
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from tickloom.schema import TICKS  # noqa: E402
from tickloom.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def day_of(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.UTC).date()


@pytest.fixture(scope="session")
def make_ticks(spark):
    """Ticks from (ticker, ms, ask[, bid[, ts]]) rows; bid defaults to the ask, ts to the ms."""

    def make(rows):
        full = []
        for ticker, ms, ask, *rest in rows:
            bid = rest[0] if rest else ask
            ts = rest[1] if len(rest) > 1 else ms
            full.append((ticker, day_of(ms), ts, ms, float(ask), float(bid)))
        return spark.createDataFrame(full, TICKS)

    return make


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
