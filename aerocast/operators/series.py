"""Row-based lag, lead and rolling features over per-city series.

Lag and lead count rows, not hours. A city may be very long, and one city may hold a large
share of all rows, so a window over the whole city would put that share into one task.
Instead a series is cut into time blocks and every window runs per (city, block); with
hourly keys a 30-day block has at most 720 rows. Sources with more rows per hour pass a finer
width (``1d``, ``1h``, ``1m``, ``1s``): the result is the same for every width. Only the few rows next
to a block border need rows of other blocks. Those rows form a small border table (a handful per block),
which is ordered per city, and what each block needs from its neighbours is joined back on
(city, block). The wide rows are shuffled once, by (city, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.contract import (
    HAZARD,
    HORIZON,
    LAG_STEPS,
    LAGGED,
    ROLL_ROWS,
    ROLLED,
    TARGET,
    require_columns,
)
from aerocast.functions.calendar import calendar_columns
from aerocast.functions.labels import hazard_flag

# Width of a time block: days, or one hour, minute or second.
BLOCK = "30d"


def block_id(ts: Column, width: str = BLOCK) -> Column:
    """Number of the time block of a zone-free timestamp; grows with time."""
    day = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    if width.endswith("d"):
        return F.floor(day / F.lit(int(width[:-1])))
    hours = day * 24 + F.hour(ts)
    minutes = hours * 60 + F.minute(ts)
    return {"1h": hours, "1m": minutes, "1s": minutes * 60 + F.second(ts).cast("int")}[width]


# Window clauses. Expressions below are SQL text: one parse per column instead of many calls.
IN_BLOCK = "(PARTITION BY city, _block ORDER BY datetime)"
IN_CITY = "(PARTITION BY city ORDER BY datetime)"


def _case(arms: list[tuple[str, str]], default: str = "NULL") -> str:
    return "CASE " + " ".join(f"WHEN {when} THEN {then}" for when, then in arms) + f" ELSE {default} END"


WHOLE_BLOCK = IN_BLOCK.replace(")", " ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
# Rows of the block that follow: one count a block and a number a row, in the pass that looks back and ahead too.
ROWS_AFTER = f"CAST(count(1) OVER {WHOLE_BLOCK} - row_number() OVER {IN_BLOCK} AS INT)"


def _back(column: str, k: int) -> str:
    """Value k rows back: inside the block, or from the carried rows before the block."""
    carried = [(f"_pos = {pos}", f"`_prev_{column}_{k - pos + 1}`") for pos in range(1, k + 1)]
    return _case(carried, f"lag(`{column}`, {k}) OVER {IN_BLOCK}")


def _ahead(column: str, k: int) -> str:
    """Value k rows ahead: inside the block, or from the carried rows after the block."""
    carried = [(f"_after = {after}", f"`_next_{column}_{k - after}`") for after in range(k)]
    return _case(carried, f"lead(`{column}`, {k}) OVER {IN_BLOCK}")


def _named(parts: dict[str, str]) -> list[str]:
    return [f"{expression} AS `{name}`" for name, expression in parts.items()]


def _with_block(df: DataFrame, block: str) -> DataFrame:
    # The null filter is stated here, not left to be inferred from the join on one side only:
    # with equal plans below, both readers of the rows share one shuffle.
    numbered = df.withColumn("_block", block_id(F.col("datetime"), block))
    return numbered.filter("city IS NOT NULL AND _block IS NOT NULL")


def _in_order(df: DataFrame, wanted) -> list[str]:
    """Wanted columns in the order of the frame: readers of the same columns then share a shuffle."""
    return [f"`{c}`" for c in df.columns if c in set(wanted)]


def _gather(carried: DataFrame, names) -> DataFrame:
    """One context row per (city, block) from columns that are set on one row each."""
    return carried.groupBy("city", "_block").agg(*[F.expr(f"max(`{n}`) AS `{n}`") for n in names])


def _join_context(rows: DataFrame, context: DataFrame, how: str) -> DataFrame:
    # The context is a few rows' worth per block and spread over the same keys, so a hash
    # table of one partition of it is small, and the order of the wide rows is kept.
    return rows.join(context.hint("shuffle_hash"), ["city", "_block"], how)


def row_shifts(df: DataFrame, shifts: dict[str, tuple[str, int]], block: str = BLOCK) -> DataFrame:
    """Add columns taken from other rows of the same city, in time order.

    ``shifts`` maps a new name to (column, rows); rows > 0 looks back, rows < 0 looks ahead.
    (city, datetime) must be unique; rows without either are dropped.
    """
    require_columns(df, ["city", "datetime"] + [c for c, _ in shifts.values()])
    kept = [f"`{c}`" for c in df.columns]
    back, ahead = {}, {}
    for c, k in shifts.values():
        reach = back if k > 0 else ahead
        reach[c] = max(reach.get(c, 0), abs(k))
    far_back, far_ahead = max(back.values(), default=0), max(ahead.values(), default=0)

    rows = _with_block(df, block)
    marked = rows.selectExpr(
        *_in_order(rows, ["city", "_block", "datetime", *back, *ahead]),
        f"row_number() OVER {IN_BLOCK} AS _pos",
        f"{ROWS_AFTER} AS _after",
    )
    border = marked.filter(f"_pos <= {max(far_ahead, 1)} OR _after < {max(far_back, 1)}")
    # Neighbouring border rows are neighbours in the series on both sides of every border.
    carried = {
        f"_prev_{c}_{k}": f"CASE WHEN _pos = 1 THEN lag(`{c}`, {k}) OVER {IN_CITY} END"
        for c, n in back.items()
        for k in range(1, n + 1)
    }
    carried |= {
        f"_next_{c}_{k}": f"CASE WHEN _after = 0 THEN lead(`{c}`, {k}) OVER {IN_CITY} END"
        for c, n in ahead.items()
        for k in range(1, n + 1)
    }
    context = _gather(border.selectExpr("city", "_block", *_named(carried)), carried)

    placed = rows.selectExpr("*", f"row_number() OVER {IN_BLOCK} AS _pos", f"{ROWS_AFTER} AS _after")
    added = {name: _back(c, k) if k > 0 else _ahead(c, -k) for name, (c, k) in shifts.items()}
    return _join_context(placed, context, "left").selectExpr(*kept, *_named(added))


def add_calendar(df: DataFrame) -> DataFrame:
    """hour, dayofweek (Monday = 0), month, is_weekend."""
    return df.withColumns(calendar_columns(F.col("datetime")))


def add_future_target(df: DataFrame, horizon: int = HORIZON, block: str = BLOCK) -> DataFrame:
    """Level ``horizon`` rows ahead and its hazard flag; rows without a target are dropped."""
    require_columns(df, ["city", "datetime", "main_aqi"])
    shifted = row_shifts(df, {TARGET: ("main_aqi", -horizon)}, block).filter(F.col(TARGET).isNotNull())
    return shifted.withColumn(HAZARD, hazard_flag(F.col(TARGET)))


def _lag_spec(columns) -> dict[str, tuple[str, int]]:
    return {f"{c}_lag_{k}": (c, k) for c in columns for k in range(1, LAG_STEPS + 1)}


def add_lags(df: DataFrame, columns=tuple(LAGGED), block: str = BLOCK) -> DataFrame:
    """Lags 1..3 of the given columns that exist; rows at the start keep nulls."""
    spec = _lag_spec([c for c in columns if c in df.columns])
    return row_shifts(df, spec, block) if spec else df


def mean_of(parts: list[str]) -> str:
    """Mean of the non-null parts, oldest first; null if there are none."""
    total = " + ".join(f"coalesce({p}, 0D)" for p in parts)
    count = " + ".join(f"CAST({p} IS NOT NULL AS INT)" for p in parts)
    return f"CASE WHEN {count} > 0 THEN ({total}) / ({count}) END"


def add_rolling(df: DataFrame, columns=tuple(ROLLED), window: int = ROLL_ROWS, block: str = BLOCK) -> DataFrame:
    """Mean of the last ``window`` rows including the current one, over at least one value."""
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    shifted = row_shifts(df, {f"_r_{c}_{k}": (c, k) for c in columns for k in range(1, window)}, block)
    means = {
        f"{c}_roll{window}_mean": mean_of([f"`_r_{c}_{k}`" for k in range(window - 1, 0, -1)] + [f"`{c}`"])
        for c in columns
    }
    return shifted.selectExpr(*[f"`{c}`" for c in df.columns], *_named(means))


def forecast_features(df: DataFrame, horizon: int = HORIZON, block: str = BLOCK) -> DataFrame:
    """Target, calendar, lag and rolling features in one pass over the readings.

    The order of steps matters: the target is taken first, rows without one are dropped, and
    lags and means then count the remaining rows only. Rows with a missing engineered value
    are dropped at the end.
    """
    require_columns(df, ["city", "datetime", "main_aqi"])
    lagged = [c for c in LAGGED if c in df.columns]
    rolled = [c for c in ROLLED if c in df.columns]
    rows = _with_block(df, block)
    ahead = [f"{ROWS_AFTER} AS _after", f"lead(main_aqi, {horizon}) OVER {IN_BLOCK} AS {TARGET}"]

    # Border table: the first and last rows of a block, and the last rows whose target is
    # known inside the block. After the per-city pass every row here has its target.
    upto = IN_BLOCK.replace(")", " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    sure = f"CAST(_after >= {horizon} AND {TARGET} IS NOT NULL AS INT)"
    border = (
        rows.selectExpr(*_in_order(rows, ["city", "_block", "datetime", *lagged]), f"row_number() OVER {IN_BLOCK} AS _pos", *ahead)
        .selectExpr("*", f"{sure} AS _sure", f"sum({sure}) OVER {WHOLE_BLOCK} - sum({sure}) OVER {upto} AS _sure_after")
        .filter(f"_pos <= {horizon} OR _after < {horizon} OR (_sure = 1 AND _sure_after < {LAG_STEPS})")
    )
    resolved = f"CASE WHEN _after < {horizon} THEN lead(main_aqi, {horizon}) OVER {IN_CITY} ELSE {TARGET} END"
    known = border.selectExpr("city", "_block", "datetime", *lagged, "_after", f"{resolved} AS {TARGET}").filter(
        F.col(TARGET).isNotNull()
    )
    opens = f"NOT (lag(_block) OVER {IN_CITY} <=> _block)"
    carried = {f"_tail_{a}": f"CASE WHEN _after = {a} THEN {TARGET} END" for a in range(horizon)}
    carried |= {
        f"_prev_{c}_{k}": f"CASE WHEN {opens} THEN lag({c}, {k}) OVER {IN_CITY} END"
        for c in lagged
        for k in range(1, LAG_STEPS + 1)
    }
    context = _gather(known.selectExpr("city", "_block", *_named(carried)), carried)

    columns = [f"`{c}`" for c in df.columns]
    prevs = [n for n in carried if n.startswith("_prev_")]
    target = _case([(f"_after = {a}", f"_tail_{a}") for a in range(horizon)], TARGET)
    kept = (
        _join_context(rows.selectExpr("*", *ahead), context, "inner")
        .selectExpr(*columns, "_block", *prevs, f"{target} AS {TARGET}")
        .filter(F.col(TARGET).isNotNull())
        .selectExpr("*", f"row_number() OVER {IN_BLOCK} AS _pos")
    )
    lags = {f"{c}_lag_{k}": _back(c, k) for c in lagged for k in range(1, LAG_STEPS + 1)}
    means = {
        f"{c}_roll{ROLL_ROWS}_mean": mean_of([f"{c}_lag_{k}" for k in range(ROLL_ROWS - 1, 0, -1)] + [c])
        for c in rolled
    }
    lagging = kept.selectExpr(*columns, TARGET, *_named(lags))
    derived = [
        hazard_flag(F.col(TARGET)).alias(HAZARD),
        *[c.alias(n) for n, c in calendar_columns(F.col("datetime")).items()],
    ]
    built = lagging.select(*df.columns, TARGET, *derived, *lags, *[F.expr(e) for e in _named(means)])
    return built.dropna(subset=[*lags, *means])


def build_features(df: DataFrame, block: str = BLOCK) -> DataFrame:
    """Calendar, lag and rolling features for a frame that already carries its targets."""
    require_columns(df, ["datetime", "city", TARGET, HAZARD])
    spec = _lag_spec([c for c in LAGGED if c in df.columns])
    shifted = row_shifts(add_calendar(df), spec, block) if spec else add_calendar(df)
    rolled = [c for c in ROLLED if c in df.columns]
    means = {
        f"{c}_roll{ROLL_ROWS}_mean": mean_of([f"{c}_lag_{k}" for k in range(ROLL_ROWS - 1, 0, -1)] + [c])
        for c in rolled
    }
    return shifted.selectExpr("*", *_named(means)).dropna(subset=[*spec, *means])
