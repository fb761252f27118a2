import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def rows(df):
    """The rows as a sorted list of tuples of text, by column name."""
    cols = sorted(df.columns)
    return sorted(tuple("" if v is None else repr(float(v)) if isinstance(v, float) else str(v) for v in (r[c] for c in cols)) for r in df.toPandas().astype(object).where(lambda x: x.notna(), None).to_dict("records"))


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(SMALL):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{f}'")

    def run(sql):
        import pandas as pd

        df = con.sql(sql).df().astype(object)
        df = df.where(df.notna(), None)
        cols = sorted(df.columns)
        value = lambda v: "" if v is None or (not isinstance(v, (str, list)) and pd.isna(v)) else repr(float(v)) if isinstance(v, float) else str(v)
        return sorted(tuple(value(v) for v in (r[c] for c in cols)) for r in df.to_dict("records"))

    return run
