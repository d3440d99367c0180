"""Compare queries with their DuckDB equivalents. ``python -m tests.compare SF_DIR [NAME...]``"""

import sys

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(x):
    if x is None or x != x:
        return "null"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, float):
        return f"{x:.9g}"
    return f"{x:.9g}" if type(x).__name__ == "Decimal" else str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in data)


def differences(spark, con, sf_dir, run, sql):
    df = run(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want = rows([c[0] for c in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} {want[0]}"
    if got[1] == want[1]:
        return None
    a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    return f"rows {len(got[1])} {len(want[1])}; only here {sorted(a)[:3]}; only there {sorted(b)[:3]}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(sys.argv[1]), 0
    oracles, all_queries = e.oracle_sql(), e.queries()
    for name in sys.argv[2:] or sorted(oracles):
        try:
            found = differences(spark, con, sys.argv[1], all_queries[name], oracles[name])
        except Exception as x:
            found = f"{type(x).__name__} {str(x)[:700]}"
        if found:
            bad += 1
            print(name, found, flush=True)
    print(f"{bad} differ of {len(sys.argv[2:] or oracles)}")
