"""Run registered queries beside their SQL and compare the rows.

    python tests/compare.py SF_DIR [name ...]
"""

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, bool) or value is None:
        return value
    return value if isinstance(value, (int, str)) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(spark, connection, name, query, sql, sf_dir):
    """None if both sides agree, else a short account of how they differ."""
    df = query(spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    theirs = _rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}"
    if ours == theirs:
        return None
    only_ours = [row for row in ours if row not in set(theirs)][:3]
    only_theirs = [row for row in theirs if row not in set(ours)][:3]
    return f"rows {len(ours)} / {len(theirs)}\n    spark only {str(only_ours)[:1500]}\n    sql only   {str(only_theirs)[:1500]}"


def main(sf_dir, names):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in sql:
                problem = differences(spark, connection, name, query, sql[name], sf_dir)
            else:
                problem = f"no SQL, {query(spark, sf_dir).count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:400]} ... {str(error)[-1800:]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'DIFF'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{bad} to look at")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
