"""Compare a registered query with its SQL counterpart, value by value."""

import datetime
import math

import duckdb

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def plain(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    number = float(value)
    # Sums of exponentials reach sizes where the order of addition moves the last digit.
    return float(f"{number:.12g}") if abs(number) > 1e9 else round(number, 6) + 0.0


def ordered(columns, rows):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(plain(row[i]) for i in places) for row in rows]
    return [columns[i] for i in places], sorted(shown, key=repr)


def spark_result(df):
    return ordered(df.columns, [tuple(row) for row in df.collect()])


def sql_result(con, text):
    done = con.execute(text)
    columns = [item[0] for item in done.description]
    return ordered(columns, done.fetchall())


def differences(df, con, text):
    """Empty when the two results agree; otherwise a short description."""
    left_columns, left = spark_result(df)
    right_columns, right = sql_result(con, text)
    if left_columns != right_columns:
        return f"columns {left_columns} vs {right_columns}"
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}; e.g. {left[:2]} vs {right[:2]}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(wrong)} of {len(left)} rows differ, e.g. {wrong[:2]}" if wrong else ""
