import pytest
from pyspark.sql import functions as F

from fleetlife.operators import labels, quality, split
from fleetlife.schema import TERMINAL_COLUMN


def cycles(lengths):
    return [(unit, cycle) for unit, n in lengths.items() for cycle in range(1, n + 1)]


def rul_by_unit(df):
    found = {}
    for row in df.orderBy("unit_id", "cycle").collect():
        found.setdefault(row["unit_id"], []).append(row["RUL"])
    return found


@pytest.mark.parametrize("lengths, expected", [({9: 1}, {9: [0]}), ({5: 2, 11: 6, 12: 7}, {5: [1, 0], 11: [5, 4, 3, 2, 1, 0], 12: [6, 5, 4, 3, 2, 1, 0]})])
def test_complete_histories(frame, lengths, expected):
    labelled = labels.label_complete(frame(cycles(lengths), "unit_id int, cycle int"))
    assert rul_by_unit(labelled) == expected
    assert labelled.schema["RUL"].dataType.simpleString() == "int"


@pytest.mark.parametrize(
    "lengths, terminal, expected",
    [({9: 1}, {9: 0}, {9: [0]}), ({5: 2, 11: 4}, {5: 31, 11: 7}, {5: [32, 31], 11: [10, 9, 8, 7]})],
)
def test_truncated_histories(frame, lengths, terminal, expected):
    official = frame(list(terminal.items()), f"unit_id int, {TERMINAL_COLUMN} int")
    labelled = labels.label_truncated(frame(cycles(lengths), "unit_id int, cycle int"), official)
    assert rul_by_unit(labelled) == expected
    assert labelled.columns == ["subset", "unit_id", "cycle", "RUL"]
    assert labels.terminal_disagreements(labelled, official).count() == 0
    assert labels.label_step_violations(labelled).count() == 0


def test_each_unit_needs_one_official_record(frame):
    rows = frame(cycles({1: 2, 2: 3}), "unit_id int, cycle int")
    columns = f"unit_id int, {TERMINAL_COLUMN} int"
    with pytest.raises(Exception, match="no official record for unit FD001 2"):
        labels.label_truncated(rows, frame([(1, 4)], columns)).collect()
    with pytest.raises(Exception, match="several official records for unit FD001 2"):
        labels.label_truncated(rows, frame([(1, 4), (2, 5), (2, 6)], columns)).collect()


@pytest.mark.parametrize("units, official", [((1, 2, 3), (1, 2)), ((1, 2), (1, 2, 3)), ((1, 3), (1, 2))])
def test_unit_mismatch(frame, units, official):
    test = frame([(u, 1) for u in units], "unit_id int, cycle int")
    terminal = frame([(u, 5) for u in official], f"unit_id int, {TERMINAL_COLUMN} int")
    found = {(r["unit_id"], r["side"]) for r in quality.unit_mismatch(test, terminal).collect()}
    assert found == {(u, "missing") for u in set(official) - set(units)} | {(u, "extra") for u in set(units) - set(official)}
    with pytest.raises(ValueError, match="unit-"):
        quality.raise_if_any(quality.terminal_violations(test, terminal), "terminal RUL")


def test_terminal_values_are_checked(frame):
    test = frame([(1, 1), (2, 1)], "unit_id int, cycle int")
    terminal = frame([(1, -3), (2, None), (4, 1)], f"unit_id int, {TERMINAL_COLUMN} int")
    found = {r["check"] for r in quality.terminal_violations(test, terminal).collect()}
    assert found == {"terminal-negative", "terminal-null", "terminal-numbering", "unit-missing"}
    with pytest.raises(ValueError, match="already contain"):
        quality.terminal_violations(test.withColumn("RUL", F.lit(1)), terminal)


def histories(frame, n, c=3):
    rows = [(u, k, c - k, 100.0 * u + k) for u in range(1, n + 1) for k in range(1, c + 1)]
    return frame(rows, "unit_id int, cycle int, RUL int, measurement double")


def units(df):
    return {r["unit_id"] for r in df.select("unit_id").distinct().collect()}


def test_split_is_disjoint_complete_and_conserves_rows(frame):
    df = histories(frame, 10)
    train, validation = split.split_by_unit(df, 0.3, 42)
    assert split.shared_units(train, validation).count() == 0
    assert split.lost_rows(df, train, validation).count() == 0
    assert len(units(validation)) == 3


def test_split_ignores_partitioning(frame):
    df = histories(frame, 30)
    chosen = [units(split.split_by_unit(part, 0.2, 17)[1]) for part in (df, df.repartition(4))]
    assert chosen[0] == chosen[1] and len(chosen[0]) == 6


def test_split_depends_on_the_seed(frame):
    df = histories(frame, 50, 1)
    assert units(split.split_by_unit(df, 0.2, 1)[1]) != units(split.split_by_unit(df, 0.2, 2)[1])


def test_split_takes_the_smallest_hashes(frame):
    df = histories(frame, 100, 1)
    # The twenty smallest seeded hashes of the ids 1 to 100.
    expected = {92, 47, 94, 60, 43, 51, 63, 86, 15, 99, 82, 30, 91, 78, 38, 97, 17, 62, 95, 52}
    assert units(split.split_by_unit(df)[1]) == expected


def test_split_thresholds_equal_a_full_sort(frame):
    df = histories(frame, 3000, 1)
    for fraction in (0.0001, 0.37, 0.9999):
        wanted = max(1, min(2999, int(3000 * fraction + 0.5)))
        order = df.select("unit_id").orderBy(F.xxhash64("unit_id", F.lit(5)), "unit_id").limit(wanted)
        assert units(split.split_by_unit(df, fraction, 5)[1]) == units(order)


def test_subsets_are_split_separately(spark, frame):
    both = frame([(u, 1) for u in range(1, 11)], "unit_id int, cycle int").unionByName(
        frame([(u, 1) for u in range(1, 21)], "unit_id int, cycle int", "FD002")
    )
    flagged = split.flag_validation(both, 0.2, 42).where(split.FLAG)
    assert {r["subset"]: r["n_units"] for r in split.part_counts(flagged, "subset").collect()} == {"FD001": 2, "FD002": 4}


@pytest.mark.parametrize("fraction", [0, 1, -0.1, 1.1])
def test_bad_fractions_are_rejected(frame, fraction):
    with pytest.raises(ValueError, match="fraction"):
        split.split_by_unit(histories(frame, 4), fraction)


def test_one_unit_cannot_be_split(frame):
    with pytest.raises(ValueError, match="two units"):
        split.split_by_unit(histories(frame, 1))
