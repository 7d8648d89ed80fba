"""Run registered queries beside their SQL twins: python tests/compare.py SF_DIR [name ...]"""

import datetime
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 9)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(spark_df, con, sql):
    """None if equal, else a short report."""
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    wanted = normal(columns, relation.fetchall())
    got = normal(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} <> {sorted(columns)}"
    if got == wanted:
        return None if got else "no rows"
    only_got = [r for r in got if r not in set(wanted)][:3]
    only_wanted = [r for r in wanted if r not in set(got)][:3]
    return f"rows {len(got)} <> {len(wanted)}\n  spark only {only_got}\n  sql only   {only_wanted}"


def main():
    import __spark_entry__ as entry
    from taxaflow.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", **{
        "spark.master": "local[8]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    checks, bad = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            frame = function(spark, sf_dir)
            report = differences(frame, con, checks[name]) if name in checks else f"unchecked, {frame.count()} rows"
        except Exception as error:  # noqa: BLE001
            report = f"{type(error).__name__}: {str(error)[:1500]}"
        if report and not report.startswith("unchecked"):
            bad += 1
        print(f"{name:28s} {time.time() - began:6.2f}s {report or 'ok'}", flush=True)
    print("failures", bad)


if __name__ == "__main__":
    main()
