"""One unit holds a third of all rows: every result stays exact."""

import duckdb
import pytest
from oracle import TABLES, connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as entry
from fleetlife.operators import trajectory
from fleetlife.sources import events

SOURCE = "/root/testdata/sf0.01"
SQL = entry.oracle_sql()
# These read other tables.
ELSEWHERE = {"cycle_violations", "cycle_profile"}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The tables with a third of the events moved to one user."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    for table in TABLES:
        columns = "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 41 ELSE user_id END AS user_id)" if table == "events" else "*"
        duckdb.sql(f"COPY (SELECT {columns} FROM '{SOURCE}/{table}.parquet') TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture(scope="module")
def con(skewed):
    return connect(skewed)


@pytest.mark.parametrize("name", sorted(set(SQL) - ELSEWHERE))
def test_a_hot_unit_changes_no_result(spark, con, skewed, name):
    assert differences(entry.queries()[name](spark, skewed), con, SQL[name]) == ""


def test_a_heavy_group_is_numbered_in_slices(spark, skewed):
    plain = events.telemetry(spark, skewed)
    sliced = events.telemetry(spark, skewed, heavy_rows=200)
    assert plain.exceptAll(sliced).count() == 0 and sliced.count() == plain.count()
    assert "__slice" in sliced._jdf.queryExecution().optimizedPlan().toString()


def test_no_task_gets_the_hot_unit_whole(spark, skewed):
    rows = events.telemetry(spark, skewed)
    blocked = trajectory.to_blocks(rows, 19, block_rows=256, contiguous=True)
    sizes = blocked.groupBy("subset", "unit_id", trajectory.BLOCK).agg(F.count(F.lit(1)).alias("n"))
    assert sizes.agg(F.max("n")).first()[0] == 256 + 19
    assert rows.groupBy("unit_id").count().agg(F.max("count")).first()[0] > 3000
