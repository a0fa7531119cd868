"""Runs registered queries against their SQL counterparts. Usage: compare.py SF_DIR [query ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES.split():
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, every value as a text that tells integers, doubles and times apart."""
    out = pd.DataFrame(index=df.index)
    for c in sorted(df.columns):
        col = df[c]
        if str(col.dtype).startswith("datetime"):
            text = col.astype("datetime64[us]").astype(str)
        else:
            text = col.map(lambda v: "NULL" if v is None or v != v else repr(v.item() if hasattr(v, "item") else v))
        out[c] = text.where(col.notna(), "NULL")
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def type_names(spark_df) -> dict[str, str]:
    same = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
            "timestamp_ntz": "TIMESTAMP", "date": "DATE"}
    return {c: same.get(t, t) for c, t in spark_df.dtypes}


def compare(spark, con, fn, sql: str | None, sf_dir: str) -> str:
    """Empty text when equal, else the first difference."""
    df = fn(spark, sf_dir)
    got = df.toPandas()
    if sql is None:
        return "" if len(got) else "no rows"
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, [str(t) for t in rel.types], strict=True))
    got_types = type_names(df)
    if want_types != got_types:
        return f"types: {sorted(set(got_types.items()) ^ set(want_types.items()))}"
    want = rel.df()
    if len(got) != len(want):
        return f"rows: {len(got)} against {len(want)}"
    a, b = normal(got), normal(want)
    for c in a.columns:
        bad = a[c] != b[c]
        if bad.any():
            i = bad.idxmax()
            return f"column {c}, {int(bad.sum())} rows: {a.loc[i].to_dict()} against {b.loc[i].to_dict()}"
    return ""


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(e.queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", os.environ.get("SESSION_TZ", "UTC"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = duck(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, e.queries()[name], e.oracle_sql().get(name), sf_dir)
        except Exception as error:  # a failing query is reported, the others still run
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        kind = "sql" if name in e.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name} [{kind}] {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main())
