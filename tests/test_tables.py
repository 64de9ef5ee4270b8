"""Runs appear in the processed table as a whole or not at all."""

import pytest
from pyspark.sql import functions as F

from fleetlife.sources import tables

COLUMNS = "unit_id int, cycle int, split string, sensor_2 double"
ROWS = [(unit, cycle, "train" if unit < 3 else "test", float(unit * cycle)) for unit in (1, 2, 3) for cycle in (1, 2, 3, 4)]


def held(df):
    return sorted((r["run_id"], r["split"], r["unit_id"], r["cycle"], r["sensor_2"]) for r in df.collect())


def expected(run_id, rows=ROWS):
    return sorted((run_id, split, unit, cycle, x) for unit, cycle, split, x in rows)


class Killed(Exception):
    pass


def killed(*_):
    raise Killed


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "processed")


@pytest.mark.parametrize("files", [None, 3])
def test_an_attempt_that_breaks_before_its_manifest_is_never_read(spark, frame, path, monkeypatch, files):
    rows = frame(ROWS, COLUMNS)
    with monkeypatch.context() as broken, pytest.raises(Killed):
        broken.setattr(tables, "_commit", killed)
        tables.write_processed(rows, path, "r1", files)
    assert spark.read.parquet(path).count() == len(ROWS)
    assert held(tables.read_processed(spark, path)) == held(tables.read_processed(spark, path, run_id="r1")) == []
    tables.write_processed(rows, path, "r1", files)
    assert held(tables.read_processed(spark, path)) == held(tables.read_processed(spark, path, run_id="r1")) == expected("r1")
    commits = {(r["subset"], r["split"]): r["rows"] for r in tables.read_commits(spark, path).collect()}
    assert commits == {("FD001", "train"): 8, ("FD001", "test"): 4}


def test_a_write_that_breaks_between_its_parts_leaves_nothing_to_read(spark, frame, path):
    """One part's rows fail while the other part's are written; the retry is whole."""
    rows = frame(ROWS, COLUMNS)
    failing = rows.withColumn("sensor_2", F.when(F.col("split") == "test", F.raise_error(F.lit("lost"))).otherwise(F.col("sensor_2")).cast("double"))
    tables.write_processed(rows, path, "007", files=2)
    with pytest.raises(Exception, match="lost"):
        tables.write_processed(failing, path, "r1", files=2)
    assert held(tables.read_processed(spark, path)) == expected("007")
    tables.write_processed(rows, path, "r1", files=2)
    assert held(tables.read_processed(spark, path)) == expected("007") + expected("r1")


def test_the_attempt_committed_last_counts(spark, frame, path):
    """Also where it has fewer parts than the one before."""
    tables.write_processed(frame(ROWS, COLUMNS), path, "r1")
    before = tables.read_processed(spark, path, run_id="r1")
    fewer = [row for row in ROWS if row[2] == "train"]
    tables.write_processed(frame(fewer, COLUMNS), path, "r1")
    assert held(tables.read_processed(spark, path, run_id="r1")) == expected("r1", fewer)
    assert held(tables.read_processed(spark, path)) == expected("r1", fewer)
    assert held(before) == expected("r1")


def test_values_prune_folders_and_runs_may_differ_in_columns(spark, frame, path):
    tables.write_processed(frame(ROWS, COLUMNS), path, "0012")
    tables.write_processed(frame(ROWS, COLUMNS).withColumn("sensor_2_lag_1", F.lit(1.0)), path, "r2")
    assert held(tables.read_processed(spark, path, "FD001", "0012", "test")) == [r for r in expected("0012") if r[1] == "test"]
    assert "sensor_2_lag_1" in tables.read_processed(spark, path, run_id="r2").columns
    assert "sensor_2_lag_1" not in tables.read_processed(spark, path, run_id="0012").columns
    plan = tables.read_processed(spark, path, split="test")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_a_run_without_rows_has_nothing_to_commit(spark, frame, path):
    tables.write_processed(frame(ROWS, COLUMNS), path, "r1")
    tables.write_processed(frame(ROWS, COLUMNS).where("cycle > 9"), path, "r2")
    assert held(tables.read_processed(spark, path)) == expected("r1")
    assert held(tables.read_processed(spark, path, run_id="r2")) == []
