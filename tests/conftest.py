import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillcast.session import build_session

    folder = tmp_path_factory.mktemp("shared")
    session = build_session("tests", 8, **{"spark.checkpoint.dir": str(folder), "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make a DataFrame from tuples; ISO text in DATE columns is converted."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def make(data, schema):
        wanted = T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL") else spark.createDataFrame([], schema).schema
        loose = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType) for f in wanted])
        df = spark.createDataFrame(data, loose)
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])

    return make


def listed(df, *order):
    found = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return found
