"""Order-insensitive comparison of a Spark result with DuckDB's."""

import os

import duckdb
import pandas as pd


def connect(folder):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            path = os.path.join(folder, name)
            source = f"{path}/*.parquet" if os.path.isdir(path) else path
            connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{source}'")
    return connection


def text(value):
    if value is None or (pd.api.types.is_scalar(value) and pd.isna(value)):
        return "NULL"
    if isinstance(value, float) and value.is_integer():
        return str(int(value))
    return str(value)


def canonical(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(text(value) for value in row) for row in frame.itertuples(index=False, name=None))


def assert_same(spark_frame, duck_frame):
    assert sorted(spark_frame.columns) == sorted(duck_frame.columns)
    left, right = canonical(spark_frame), canonical(duck_frame)
    assert len(left) == len(right)
    different = [pair for pair in zip(left, right) if pair[0] != pair[1]]
    assert not different, different[:5]
