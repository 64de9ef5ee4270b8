"""Lag, difference, rolling, trend and smoothed features.

All families share one window spec per block, hence one shuffle and one sort.
Frames count rows, not cycles. The same code serves training and batch scoring.
"""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetlife.cluster import BROADCAST_BYTES, estimated_bytes, settle, stored
from fleetlife.operators.trajectory import BLOCK, BLOCK_ROWS, OWN, block_window, own_rows, to_blocks
from fleetlife.schema import EWMA_ALPHA, LAGS, ROLLING_WINDOWS, UNIT

# exp(600) stays far inside the range of a double.
MAX_EXPONENT = 600.0
NEGLIGIBLE = 1e-17
RANK = "__rank"
# Blocks whose smoothing is composed in one task.
FAN = 1024


def ewma_memory(alpha: float) -> int:
    """Rows after which the weight of older values is below double precision."""
    return 1 + math.ceil(math.log(NEGLIGIBLE) / math.log1p(-alpha))


def reach(lags=LAGS, windows=ROLLING_WINDOWS, alpha: float | None = EWMA_ALPHA) -> int:
    """Rows before a row that its features read."""
    weighted = alpha is not None and alpha < 1.0
    return max([0, *lags, *(k - 1 for k in windows), ewma_memory(alpha) if weighted else 0])


def smooths_beside(alpha: float, lead_in: int) -> bool:
    """Whether the growing weights stay in range over blocks of at least twice ``lead_in`` rows."""
    return 3 * lead_in * -math.log1p(-alpha) <= MAX_EXPONENT


def ewma_block_rows(alpha: float, lead_in: int, block_rows: int = BLOCK_ROWS) -> int:
    """Block length for which the growing weights cannot overflow."""
    rate = -math.log1p(-alpha)
    size = max(2 * lead_in, min(block_rows, int(MAX_EXPONENT / rate) - lead_in))
    if (size + lead_in) * rate > MAX_EXPONENT:
        raise ValueError(f"alpha={alpha} is too close to 1 for frames of {lead_in} rows; use 1")
    return size


def feature_names(sensors, lags=LAGS, windows=ROLLING_WINDOWS, ewma=True) -> list[str]:
    names = []
    for s in sensors:
        names += [f"{s}_{kind}_{k}" for k in lags for kind in ("lag", "diff")]
        names += [f"{s}_rolling_{kind}_{k}" for k in windows for kind in ("mean", "std", "slope")]
        names += [f"{s}_ewma"] if ewma else []
    return names


def reject_collisions(df: DataFrame, names) -> None:
    taken = sorted(set(names) & set(df.columns))
    if taken:
        raise ValueError(f"feature columns already exist: {', '.join(taken)}")


def temporal_features(
    df: DataFrame,
    sensors,
    lags=LAGS,
    windows=ROLLING_WINDOWS,
    alpha: float | None = EWMA_ALPHA,
    keys=UNIT,
    contiguous=False,
    block_rows: int = BLOCK_ROWS,
    complete=False,
) -> DataFrame:
    """Append the chosen feature families; empty ``lags`` / ``windows`` or a null
    ``alpha`` leave a family out.

    The smoothed value is y(1) = x(1), y(t) = alpha x(t) + (1 - alpha) y(t-1). Within
    a block it is a running sum of x weighted by (1 - alpha)^-rank, scaled back by
    (1 - alpha)^rank: one pass, no arrays. A later block starts ``ewma_memory`` rows
    early, so what it leaves out is below double precision.

    Frames are put together from spans of doubled length, so their cost grows with the logarithm of the window. Where frames are so wide that
    their blocks are too long for the weights, smoothing is a pass of its own. A null reading counts in no frame: statistics are
    over the readings there are, and smoothing goes from one reading to the next over any distance.
    With ``complete``, the caller vouches that a sensor has a reading in every row of a unit (the
    validated case) or in none, which saves the counts and gives the same numbers up to rounding.
    """
    if alpha is not None and not 0.0 < alpha <= 1.0:
        raise ValueError("alpha must lie in (0, 1]")
    sensors, lags, windows = list(sensors), list(lags), list(windows)
    names = feature_names(sensors, lags, windows, alpha is not None)
    reject_collisions(df, names)
    weighted = alpha is not None and alpha < 1.0
    lead_in = reach(lags, windows, alpha if complete else None)
    if weighted and (lags or windows) and not smooths_beside(alpha, lead_in):
        framed = temporal_features(df, sensors, lags, windows, None, keys, contiguous, block_rows, complete)
        return temporal_features(framed, sensors, (), (), alpha, keys, contiguous, block_rows, complete).select(*df.columns, *names)
    if weighted:
        block_rows = ewma_block_rows(alpha, lead_in, block_rows)

    blocked = to_blocks(df, lead_in, keys, block_rows, contiguous)
    if complete:
        return complete_features(blocked, sensors, lags, windows, alpha, keys).select(*df.columns, *names)
    w = block_window(keys)
    out, made = _shifts_and_frames(blocked, w, sensors, lags, windows, complete)
    if weighted:
        nth = {s: f"`__nth_{s}`" for s in sensors}
        out = _weighted_sums(_counted(out, w, sensors), w, sensors, nth, alpha, [f"{alpha!r}D"] * len(sensors))
        before = _before_blocks(df.select(*keys, "cycle", *sensors), sensors, alpha, keys, block_rows, lead_in, contiguous)
        # Past the bound the blocks' own partitioning serves: only the table of blocks is shuffled.
        small = estimated_bytes(before) <= BROADCAST_BYTES
        out = out.join(F.broadcast(before) if small else before, [*keys, BLOCK], "left")
        # Without a reading so far the value before the block stands; the first of all starts from itself.
        kept = {s: f"power({1.0 - alpha!r}D, {nth[s]})" for s in sensors}
        made += [
            f"if({nth[s]} = 0, `__before_{s}`, `__y_{s}` * {kept[s]} / {1.0 - alpha!r}D + {kept[s]} * coalesce(`__before_{s}`, `__first_{s}`)) AS `{s}_ewma`"
            for s in sensors
        ]
    elif alpha is not None:
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        out = out.select("*", *(F.last(s, ignorenulls=True).over(upto).alias(f"__held_{s}") for s in sensors))
        made += [f"`__held_{s}` AS `{s}_ewma`" for s in sensors]
    return own_rows(out.selectExpr(*_columns(blocked), *made)).select(*df.columns, *names)


def complete_features(blocked: DataFrame, sensors, lags=LAGS, windows=ROLLING_WINDOWS, alpha: float | None = EWMA_ALPHA, keys=UNIT) -> DataFrame:
    """Features of rows in blocks that are led in by ``reach`` rows or more, and short enough for the weights.

    A sensor has a reading in every row of a unit or in none.
    """
    w = block_window(keys)
    out, made = _shifts_and_frames(blocked, w, sensors, lags, windows, True)
    if alpha is not None and alpha < 1.0:
        nth = dict.fromkeys(sensors, RANK)
        out = _weighted_sums(out, w, sensors, nth, alpha, [f"if({RANK} = 1, 1D, {alpha!r}D)"] * len(sensors))
        made += [f"`__y_{s}` * power({1.0 - alpha!r}D, {RANK} - 1) AS `{s}_ewma`" for s in sensors]
    elif alpha is not None:
        made += [f"`{s}` AS `{s}_ewma`" for s in sensors]
    return own_rows(out.selectExpr(*_columns(blocked), *made))


def _shifts_and_frames(blocked: DataFrame, w, sensors, lags, windows, complete):
    """``blocked`` with rows ranked per block and what lags and windows need, and the expressions of their features."""
    out = blocked.withColumn(RANK, F.row_number().over(w))
    if lags:
        shifted = [F.lag(s, k).over(w).alias(f"__{s}_{k}") for k in lags for s in sensors]
        out = out.select("*", *shifted).selectExpr(*_columns(out), *_lag_features(sensors, lags))
    if windows:
        out = _frames(out, w, sensors, windows, complete)
    made = [f"`{s}_{kind}_{k}`" for s in sensors for k in lags for kind in ("lag", "diff")]
    made += [f"`{s}_rolling_{kind}_{k}`" for s in sensors for k in windows for kind in ("mean", "std", "slope")]
    return out, made


def _counted(out: DataFrame, w, sensors) -> DataFrame:
    """``__nth_s``: readings of a sensor so far among the block's own rows."""
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    return out.select("*", *(F.count(F.when(F.col(OWN), F.col(s))).over(running).alias(f"__nth_{s}") for s in sensors))


def _weighted_sums(out: DataFrame, w, sensors, nth, alpha, shares) -> DataFrame:
    """``__y_s``: running sums of readings with weights that grow by 1 / (1 - alpha) a reading."""
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    # Copied rows in front of a block have no count of their own and add nothing.
    weights = [f"if({nth[s]} = 0, NULL, `{s}` * {share} * power({1.0 - alpha!r}D, 1 - {nth[s]})) AS `__w_{s}`" for s, share in zip(sensors, shares, strict=True)]
    return out.selectExpr("*", *weights).select("*", *(F.sum(f"__w_{s}").over(running).alias(f"__y_{s}") for s in sensors))


def _before_blocks(rows: DataFrame, sensors, alpha: float, keys, block_rows: int, lead_in: int, contiguous: bool) -> DataFrame:
    """(keys, block, __before_s, __first_s): the smoothed value that each block starts from, and its first reading.

    A block with m readings turns a value y into (1 - alpha)^m y + offset. Starting from the unit's first
    reading, the maps of all earlier blocks are composed, in groups of FAN blocks and groups of such groups,
    so a unit of any length is spread over tasks. Null before the first reading of a unit.
    """
    decay = 1.0 - alpha
    w = block_window(keys)
    blocked = to_blocks(rows, 0, keys, max(block_rows, 2 * lead_in), contiguous)
    nth = {s: f"`__nth_{s}`" for s in sensors}
    sums = _weighted_sums(_counted(blocked, w, sensors), w, sensors, nth, alpha, [f"{alpha!r}D"] * len(sensors))
    made = []
    for i, s in enumerate(sensors):
        m = F.max(f"__nth_{s}").cast("double")
        made.append(m.alias(f"m_{i}"))
        made.append(F.coalesce(F.max_by(f"__y_{s}", f"__nth_{s}") * F.pow(F.lit(decay), m - 1), F.lit(0.0)).alias(f"o_{i}"))
        made.append(F.min_by(F.col(s), F.when(F.col(s).isNotNull(), F.col(f"__nth_{s}"))).cast("double").alias(f"f_{i}"))
    blocks = stored(sums.groupBy(*keys, F.col(BLOCK).cast("long").alias("place")).agg(*made))
    last = blocks.agg(F.max("place")).first()[0] or 0
    found = _composed(blocks, keys, len(sensors), decay, last)
    columns = [F.col("place").cast("int").alias(BLOCK)]
    for i, s in enumerate(sensors):
        columns.append(F.when(F.col(f"pm_{i}") > 0, F.col(f"po_{i}") + F.pow(F.lit(decay), F.col(f"pm_{i}")) * F.col(f"pf_{i}")).alias(f"__before_{s}"))
        columns.append(F.col(f"f_{i}").alias(f"__first_{s}"))
    return settle(found.select(*keys, *columns))


def _composed(blocks: DataFrame, keys, count: int, decay: float, last: int) -> DataFrame:
    """``blocks`` (keys, place, m_i, o_i, f_i) with the composition pm_i, po_i, pf_i of all earlier places of the key.

    Places of a group are composed in spans of doubled length, as frames are; units of one block need no step.
    """
    names = [f"{kind}{i}" for i in range(count) for kind in ("m_", "o_", "f_")]
    rows = blocks.withColumn("group", F.expr(f"place div {FAN}"))
    w = Window.partitionBy(*keys, "group").orderBy("place")
    nothing = {"m": F.lit(0.0), "o": F.lit(0.0), "f": F.lit(None).cast("double")}

    def earlier(prefix, n):
        return {name: F.lag(f"{prefix}{name}", n).over(w) for name in names}

    def after(first, then, i):
        """Map ``first`` and, after it, ``then``."""
        (am, ao, af), (bm, bo, bf) = ([side(f"{kind}_{i}") for kind in "mof"] for side in (first, then))
        return {f"m_{i}": am + bm, f"o_{i}": bo + F.pow(F.lit(decay), bm) * ao, f"f_{i}": F.coalesce(af, bf)}

    if last == 0:
        rows = rows.select("*", *(nothing[name[0]].alias(f"p{name}") for name in names))
    else:
        lagged = earlier("", 1)
        rows = rows.select("*", *(F.coalesce(lagged[name], nothing[name[0]]).alias(f"p{name}") for name in names))
        length = 1
        while length < min(FAN, last + 1):
            lagged = earlier("p", length)
            rows = rows.select("*", *(F.coalesce(lagged[name], nothing[name[0]]).alias(f"e{name}") for name in names))
            joined = {}
            for i in range(count):
                joined |= after(lambda n: F.col(f"e{n}"), lambda n: F.col(f"p{n}"), i)
            rows = rows.select(*keys, "place", "group", *names, *(joined[name].alias(f"p{name}") for name in names))
            length *= 2
    if last >= FAN:
        rows = stored(rows)
        whole = {}
        for i in range(count):
            whole |= after(lambda n: F.col(f"p{n}"), F.col, i)
        ends = F.max_by(F.struct(*(whole[name].alias(name) for name in names)), "place").alias("whole")
        totals = rows.groupBy(*keys, "group").agg(ends).select(*keys, F.col("group").alias("place"), "whole.*")
        outer = _composed(totals, keys, count, decay, last // FAN)
        outer = outer.select(*keys, F.col("place").alias("group"), *(F.col(f"p{name}").alias(f"q{name}") for name in names))
        rows = rows.join(outer, [*keys, "group"])
        joined = {}
        for i in range(count):
            joined |= after(lambda n: F.col(f"q{n}"), lambda n: F.col(f"p{n}"), i)
        rows = rows.select(*keys, "place", *names, *(joined[name].alias(f"p{name}") for name in names))
    # What no number came of counts as not there.
    numbers = (F.nanvl(name, F.lit(None).cast("double")).alias(name) for kind in ("", "p") for name in (kind + own for own in names))
    return rows.select(*keys, "place", *numbers)


def _columns(df: DataFrame) -> list[str]:
    return [f"`{name}`" for name in df.columns]


def _lag_features(sensors, lags) -> list[str]:
    made = [f"`__{s}_{k}` AS `{s}_lag_{k}`" for s in sensors for k in lags]
    return made + [f"`{s}` - `__{s}_{k}` AS `{s}_diff_{k}`" for s in sensors for k in lags]


def _span_of_row(sensors, complete) -> str:
    """A span of one row as a struct. A span holds readings (n), their mean and squared deviation (x, xx), the same of
    the cycles (c, cc), and the joint deviation (xc); with ``complete``, readings and cycles are one set for all sensors.
    Means of no readings are null."""
    shared = [("1D", "CAST(cycle AS DOUBLE)")] if complete else [(f"if(`{s}` IS NULL, 0D, 1D)", f"if(`{s}` IS NULL, NULL, CAST(cycle AS DOUBLE))") for s in sensors]
    fields = [f"'n{g}', {n}, 'c{g}', {c}, 'cc{g}', 0D" for g, (n, c) in enumerate(shared)]
    fields += [f"'x{i}', CAST(`{s}` AS DOUBLE), 'xx{i}', 0D, 'xc{i}', 0D" for i, s in enumerate(sensors)]
    return f"named_struct({', '.join(fields)})"


def _joined_spans(late: str, early: str, count: int, complete) -> str:
    """Two neighbouring spans as one, by pairwise updates of centred moments: no large sums are subtracted.

    ``early`` is null where it would begin before the unit, and adds nothing there.
    """

    def fallen(name):
        return f"coalesce(`{early}`.{name}, 0D)"

    def share(g):
        return f"if(`{late}`.n{g} + {fallen(f'n{g}')} > 0D, {fallen(f'n{g}')} / (`{late}`.n{g} + {fallen(f'n{g}')}), 0D)"

    def distance(name):
        return f"coalesce(`{early}`.{name} - `{late}`.{name}, 0D)"

    def mean(name, g):
        return f"coalesce(`{late}`.{name} + {distance(name)} * {share(g)}, `{early}`.{name})"

    def spread(name, a, b, g):
        return f"`{late}`.{name} + {fallen(name)} + {distance(a)} * {distance(b)} * `{late}`.n{g} * {share(g)}"

    fields = []
    for g in range(1 if complete else count):
        fields += [f"'n{g}', `{late}`.n{g} + {fallen(f'n{g}')}", f"'c{g}', {mean(f'c{g}', g)}", f"'cc{g}', {spread(f'cc{g}', f'c{g}', f'c{g}', g)}"]
    for i in range(count):
        g = 0 if complete else i
        fields += [f"'x{i}', {mean(f'x{i}', g)}", f"'xx{i}', {spread(f'xx{i}', f'x{i}', f'x{i}', g)}", f"'xc{i}', {spread(f'xc{i}', f'x{i}', f'c{g}', g)}"]
    return f"named_struct({', '.join(fields)})"


def _frames(out: DataFrame, w, sensors, windows, complete) -> DataFrame:
    """Rolling statistics of all windows, from spans of 1, 2, 4, ... rows that end at each row.

    A span of twice the length joins a row's span with the span that ends as many rows earlier. A frame is the
    spans of the binary digits of its length, shortest first, each read as far back as the frame has grown.
    """
    columns, count = _columns(out), len(sensors)
    windows = sorted(set(windows))
    out = out.selectExpr(*columns, f"{_span_of_row(sensors, complete)} AS __span")
    grown = dict.fromkeys(windows, 0)
    length = 1
    while True:
        due = [k for k in windows if k & length]
        doubled = length * 2 <= windows[-1]
        offsets = sorted({grown[k] for k in due if grown[k]} | ({length} if doubled else set()))
        out = out.select("*", *(F.lag("__span", n).over(w).alias(f"__span_{n}") for n in offsets))
        kept = [f"`__frame_{k}`" for k in windows if grown[k] and k not in due]
        for k in due:
            joined = _joined_spans(f"__frame_{k}", f"__span_{grown[k]}", count, complete) if grown[k] else "__span"
            kept.append(f"{joined} AS `__frame_{k}`")
            grown[k] += length
        if not doubled:
            break
        out = out.selectExpr(*columns, *kept, f"{_joined_spans('__span', f'__span_{length}', count, complete)} AS __span")
        length *= 2
    out = out.selectExpr(*columns, *kept)
    made = []
    for k in windows:
        for i, s in enumerate(sensors):
            g = 0 if complete else i
            frame = f"`__frame_{k}`"
            known = f"{frame}.n{g} > 1 AND {frame}.x{i} IS NOT NULL"
            made.append(f"{frame}.x{i} AS `{s}_rolling_mean_{k}`")
            made.append(f"if({known}, sqrt({frame}.xx{i} / ({frame}.n{g} - 1)), NULL) AS `{s}_rolling_std_{k}`")
            made.append(f"if({known}, {frame}.xc{i} / {frame}.cc{g}, NULL) AS `{s}_rolling_slope_{k}`")
    return out.selectExpr(*columns, *made)


def lag_difference(df: DataFrame, sensors, lags=LAGS, **options) -> DataFrame:
    return temporal_features(df, sensors, lags, (), None, **options)


def rolling_features(df: DataFrame, sensors, windows=ROLLING_WINDOWS, **options) -> DataFrame:
    return temporal_features(df, sensors, (), windows, None, **options)


def ewma_features(df: DataFrame, sensors, alpha=EWMA_ALPHA, **options) -> DataFrame:
    return temporal_features(df, sensors, (), (), alpha, **options)
