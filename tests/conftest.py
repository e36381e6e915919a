from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillmart.session import local_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8",
        "tillmart-tests",
        **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from a DDL schema and rows of text, cast to the schema's types."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def make(ddl, *values):
        schema = T.StructType.fromDDL(ddl)
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        data = [tuple(None if v is None else str(v) for v in row) for row in values]
        return spark.createDataFrame(data, text).select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        )

    return make
