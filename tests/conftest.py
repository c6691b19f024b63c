import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quire.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = builder("local[4]", "quire-tests").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """Evaluates a column function on one value."""
    from pyspark.sql import functions as F

    def run(f, *values, types="string"):
        names = [f"c{k}" for k in range(len(values))]
        kinds = [types] * len(values) if isinstance(types, str) else types
        df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} {t}" for n, t in zip(names, kinds)))
        return df.select(f(*[F.col(n) for n in names]).alias("out")).first().out

    return run


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
