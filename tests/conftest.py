import datetime as dt

import pytest

from fundlake.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", master="local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('checkpoints')}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def day():
    return lambda text: dt.date.fromisoformat(text)


@pytest.fixture(scope="session")
def prices(spark, day):
    """A price table from ``code -> {day: price}`` or ``code -> (first day, [prices])``."""
    def make(series):
        rows = []
        for code, spec in series.items():
            if isinstance(spec, dict):
                rows += [(code, day(d), float(v)) for d, v in spec.items()]
            else:
                first, values = day(spec[0]), spec[1]
                rows += [(code, first + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "amfi_code BIGINT, date DATE, nav DOUBLE")
    return make


def by_key(df, key="amfi_code"):
    return {row[key]: row for row in df.collect()}
