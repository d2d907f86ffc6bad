"""Order-free comparison of a Spark result with a DuckDB result."""

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = []
    for record in frame.itertuples(index=False, name=None):
        row = []
        for value in record:
            if value is None or value is pd.NaT or (isinstance(value, float) and pd.isna(value)):
                row.append(None)
            elif hasattr(value, "isoformat"):
                row.append(value.isoformat()[:10])
            elif hasattr(value, "item"):
                row.append(value.item())
            else:
                row.append(value)
        rows.append(tuple(row))
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def _kind(dtype) -> str:
    return "datetime" if str(dtype).startswith("datetime") else str(dtype)


def differences(spark_df, con, sql):
    """Empty list when both results agree in columns, kinds of type and all values."""
    left, right = spark_df.toPandas(), con.execute(sql).df()
    problems = []
    if sorted(left.columns) != sorted(right.columns):
        return [f"columns {sorted(left.columns)} != {sorted(right.columns)}"]
    for c in left.columns:
        a, b = _kind(left[c].dtype), _kind(right[c].dtype)
        if a != b and {a, b} not in ({"object", "str"}, {"object", "datetime"}):
            problems.append(f"type of {c}: {a} != {b}")
    if len(left) != len(right):
        return [*problems, f"rows {len(left)} != {len(right)}"]
    a, b = _plain(left), _plain(right)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} of {len(a)} rows differ, first {bad[0]}")
    return problems
