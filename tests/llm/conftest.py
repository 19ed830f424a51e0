import pandas as pd
import pytest


@pytest.fixture
def frame(spark):
    """A DataFrame of `rows` with a schema in DDL."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def pdf_of():
    def get(df) -> pd.DataFrame:
        return df.toPandas()

    return get
