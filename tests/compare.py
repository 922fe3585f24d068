"""Run registered queries next to their SQL checks and compare the rows."""

import glob
import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def oracle(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]

    def plain(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return None
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, float):
            return round(value, 9) + 0.0
        return value

    rows = [tuple(plain(v) for v in row) for row in frame.astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    left, right = canonical(ours), canonical(theirs)
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main(sf_dir: str, names: list[str]) -> None:
    from txnwatch.plans.catalog import ORACLE_SQL, QUERIES
    from txnwatch.session import get_session

    spark = get_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle(sf_dir)
    for name in names or QUERIES:
        began = time.time()
        try:
            ours = QUERIES[name](spark, sf_dir).toPandas()
            took = time.time() - began
            verdict = "rows only"
            if name in ORACLE_SQL:
                verdict = difference(ours, con.execute(ORACLE_SQL[name]).fetchdf()) or "equal"
        except Exception as error:  # noqa: BLE001 - a report, not a handler
            took, ours, verdict = time.time() - began, [], f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {took:6.2f}s {len(ours):7d} rows  {verdict}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
