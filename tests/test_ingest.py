import pytest

from fleetlife.operators import quality
from fleetlife.schema import MEASUREMENTS, TELEMETRY, TERMINAL_COLUMN
from fleetlife.sources import requests, telemetry_text


def line(unit, cycle, **values):
    numbers = [values.get(name, float(i)) for i, name in enumerate(MEASUREMENTS, start=1)]
    return " ".join([str(unit), str(cycle), *(str(n) for n in numbers)])


def telemetry(spark, rows):
    """26-column rows with 1.0 everywhere unless stated."""
    made = [("FD001", unit, cycle, *(values.get(name, 1.0) for name in MEASUREMENTS)) for unit, cycle, values in rows]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TELEMETRY.fields)
    return spark.createDataFrame(made, f"subset string, {fields}")


def test_lines_are_parsed_by_position(spark, tmp_path):
    good = line(1, 1) + " 99 98"
    text = "\n".join([f"\t {good}  ", "", "   ", line(1, 2)[:20], line("1.0", 3), line(2, 1, sensor_4="oops"), line(2, 2)])
    (tmp_path / "train_FD001.txt").write_text(text + "\n")
    rows, rejected = telemetry_text.scan_telemetry(spark, [str(tmp_path / "train_FD001.txt")])
    found = sorted((r["subset"], r["unit_id"], r["cycle"], r["setting_1"], r["sensor_21"]) for r in rows.collect())
    assert found == [("FD001", 1, 1, 1.0, 24.0), ("FD001", 2, 2, 1.0, 24.0)]
    assert sorted(r["tokens"] for r in rejected.collect())[1:] == [26, 26]
    assert rows.columns == ["subset", *TELEMETRY.fieldNames()]


def test_terminal_lines_are_numbered_per_file(spark, tmp_path):
    (tmp_path / "RUL_FD001.txt").write_text(" 25  \n\n10\n")
    (tmp_path / "RUL_FD002.txt").write_text("".join(f"{i}\n" for i in range(500)))
    rows, rejected = telemetry_text.scan_terminal_rul(spark, [str(tmp_path / f"RUL_FD00{i}.txt") for i in (1, 2)])
    found = sorted(tuple(r) for r in rows.collect())
    assert found[:2] == [("FD001", 1, 25), ("FD001", 2, 10)]
    assert found[2:] == [("FD002", i + 1, i) for i in range(500)]
    assert rejected.count() == 0


def test_terminal_lines_are_numbered_across_splits_of_a_file(spark, tmp_path):
    path = tmp_path / "RUL_FD003.txt"
    path.write_text("".join(f"{i}\n" for i in range(2000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows, _ = telemetry_text.scan_terminal_rul(spark, [str(path)])
        assert sorted((r["unit_id"], r[TERMINAL_COLUMN]) for r in rows.collect()) == [(i + 1, i) for i in range(2000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("text, reason", [("5\n-1\n", "negative"), ("5\nnot-a-number\n", "not an integer"), ("5 10\n", "more than one value")])
def test_bad_terminal_lines_are_rejected(spark, tmp_path, text, reason):
    (tmp_path / "RUL_FD001.txt").write_text(text)
    _, rejected = telemetry_text.scan_terminal_rul(spark, [str(tmp_path / "RUL_FD001.txt")])
    assert [r["reason"] for r in rejected.collect()] == [reason]


def test_subsets_are_normalised():
    assert telemetry_text.normalise_subsets("fd002") == ["FD002"]
    assert telemetry_text.normalise_subsets("all") == ["FD001", "FD002", "FD003", "FD004"]
    with pytest.raises(ValueError, match="unsupported"):
        telemetry_text.normalise_subsets(["FD001", "FD009"])


def test_missing_files_are_listed(spark, tmp_path):
    (tmp_path / "train_FD001.txt").write_text("x")
    absent = telemetry_text.missing_inputs(spark, str(tmp_path), ["FD001"])
    assert [path.rsplit("/", 1)[1] for path in absent] == ["test_FD001.txt", "RUL_FD001.txt"]


@pytest.mark.parametrize(
    "rows, check",
    [
        ([(1, 1, {"setting_1": None}), (1, 2, {"setting_2": float("nan")})], "missing-value"),
        ([(1, 1, {}), (1, 1, {})], "cycle-sequence"),
        ([(1, 1, {}), (1, 1, {"sensor_2": 5.0})], "cycle-sequence"),
        ([(1, 1, {"setting_1": float("inf")})], "finite-value"),
        ([(1, 1, {"sensor_9": float("-inf")})], "finite-value"),
        ([(1, 1, {}), (1, 2, {}), (1, 4, {})], "cycle-sequence"),
        ([(1, 2, {}), (1, 3, {})], "cycle-sequence"),
    ],
)
def test_broken_telemetry_is_reported(spark, rows, check):
    found = quality.telemetry_violations(telemetry(spark, rows))
    assert {r["check"] for r in found.collect()} == {check}
    with pytest.raises(ValueError, match=check):
        quality.raise_if_any(found, "histories")


def test_clean_telemetry_passes(spark):
    quality.raise_if_any(quality.telemetry_violations(telemetry(spark, [(1, 2, {}), (1, 1, {}), (2, 1, {})])), "histories")


def test_schema_is_guarded(spark):
    rows = telemetry(spark, [(1, 1, {})])
    with pytest.raises(ValueError, match="missing columns"):
        quality.require_columns(rows.drop("sensor_7"))
    with pytest.raises(ValueError, match="non-numeric"):
        quality.require_columns(rows.withColumn("sensor_7", rows["sensor_7"].cast("string")))


def test_empty_subsets_are_found(spark):
    assert quality.empty_subsets(telemetry(spark, [(1, 1, {})]), ["FD001", "FD002"]) == ["FD002"]


def test_requests(spark):
    import json

    seen = dict.fromkeys(MEASUREMENTS, 2.0)

    def body(subset="fd004", units=(1, 1), **changes):
        observations = [{"unit_id": unit, "cycle": 98 + i, **seen, **changes} for i, unit in enumerate(units)]
        return json.dumps({"subset_id": subset, "model_type": "random_forest", "observations": observations})

    incomplete = json.loads(body())
    del incomplete["observations"][0]["sensor_21"]
    bodies = {
        "good": body(),
        "two": body(units=(1, 2)),
        "zero": body(units=(0, 0)),
        "empty": body(units=()),
        "fleet": body(subset="FD009"),
        "text": "not json",
        "hole": json.dumps(incomplete),
    }
    rows, rejected = requests.parse_requests(spark.createDataFrame(list(bodies.items()), "request_id string, body string"))
    assert sorted((r["request_id"], r["subset"], r["unit_id"], r["cycle"]) for r in rows.collect()) == [
        ("good", "FD004", 1, 98),
        ("good", "FD004", 1, 99),
    ]
    assert {r["request_id"]: r["reason"] for r in rejected.collect()} == {
        "two": "more than one unit",
        "zero": "incomplete observation",
        "empty": "no observations",
        "fleet": "unsupported subset",
        "text": "unreadable request",
        "hole": "incomplete observation",
    }
