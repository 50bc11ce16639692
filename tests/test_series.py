"""Row-based shifts and features against a walk over plain lists, on hand-made and random series."""

import math

import numpy as np
import pandas as pd
import pytest

from aerocast.contract import ENGINEERED, LAGGED, ROLLED, ContractError
from aerocast.operators import series


def random_series(seed: int, cities: int = 4, hours: int = 300, null_share: float = 0.15) -> pd.DataFrame:
    """Series with gaps of many lengths, missing values, and cities of very different length."""
    rng = np.random.default_rng(seed)
    parts = []
    for i in range(cities):
        n = [1, 5, hours, hours * 2][i % 4]
        steps = rng.choice([1, 1, 1, 2, 30, 500], size=n)
        at = pd.Timestamp("2023-11-20") + pd.to_timedelta(np.cumsum(steps), unit="h")
        frame = pd.DataFrame({"city": f"c{i}", "datetime": at})
        for c, top in (("main_aqi", 5), ("components_pm2_5", 200), ("components_pm10", 300)):
            values = np.round(rng.uniform(1, top, n), 3)
            values[rng.random(n) < null_share] = np.nan
            frame[c] = values
        parts.append(frame)
    return pd.concat(parts, ignore_index=True).sample(frac=1, random_state=seed)


def by_city(df: pd.DataFrame) -> dict[str, list[dict]]:
    """Readings of each city as plain rows in time order, missing values as None."""
    out: dict[str, list[dict]] = {}
    for row in sorted(df.to_dict("records"), key=lambda r: (r["city"], r["datetime"])):
        clean = {k: None if isinstance(v, float) and math.isnan(v) else v for k, v in row.items()}
        out.setdefault(row["city"], []).append(clean)
    return out


def at(rows: list[dict], place: int, name: str):
    return rows[place][name] if 0 <= place < len(rows) else None


def targeted(df: pd.DataFrame, horizon: int = 3) -> dict[str, list[dict]]:
    out = {}
    for city, rows in by_city(df).items():
        found = [{**row, "main_aqi_t_plus_h": at(rows, i + horizon, "main_aqi")} for i, row in enumerate(rows)]
        out[city] = [{**r, "hazard_t_plus_h": int(r["main_aqi_t_plus_h"] >= 4)} for r in found if r["main_aqi_t_plus_h"] is not None]
    return out


def lagged(rows: list[dict], place: int) -> dict:
    return {f"{c}_lag_{k}": at(rows, place - k, c) for c in LAGGED for k in (1, 2, 3)}


def rolled(rows: list[dict], place: int) -> dict:
    out = {}
    for c in ROLLED:
        near = [v for v in (at(rows, place - k, c) for k in (0, 1, 2)) if v is not None]
        out[f"{c}_roll3_mean"] = math.fsum(near) / len(near) if near else None
    return out


def walk(series_of: dict[str, list[dict]], *added) -> pd.DataFrame:
    """Every row with what the given functions find around its place."""
    rows = [{**row, **{k: v for f in added for k, v in f(rows, i).items()}} for rows in series_of.values() for i, row in enumerate(rows)]
    return pd.DataFrame(rows)


def calendar(rows: list[dict], place: int) -> dict:
    when = rows[place]["datetime"]
    day = when.weekday()
    return {"hour": when.hour, "dayofweek": day, "month": when.month, "is_weekend": int(day in (5, 6))}


def expected_targets(df: pd.DataFrame, horizon: int = 3) -> pd.DataFrame:
    return walk(targeted(df, horizon))


def expected_features(df: pd.DataFrame, horizon: int = 3) -> pd.DataFrame:
    found = walk(targeted(df, horizon), calendar, lagged, rolled)
    return found[[all(pd.notna(r[c]) for c in ENGINEERED) for r in found.to_dict("records")]]


def to_spark(spark, df: pd.DataFrame):
    rows = [
        tuple(None if isinstance(v, float) and np.isnan(v) else v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r)
        for r in df.itertuples(index=False, name=None)
    ]
    kinds = {"city": "string", "datetime": "timestamp_ntz"}
    return spark.createDataFrame(rows, ", ".join(f"{c} {kinds.get(c, 'double')}" for c in df.columns)).repartition(5)


def assert_same(got, expected: pd.DataFrame):
    left = got.toPandas()[expected.columns].sort_values(["city", "datetime"]).reset_index(drop=True)
    right = expected.sort_values(["city", "datetime"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(left, right, check_dtype=False, rtol=1e-9)


@pytest.mark.parametrize("block", ["30d", "1d", "1h"])
@pytest.mark.parametrize("seed", [1, 2])
def test_features_match_the_walk(spark, block, seed):
    data = random_series(seed)
    assert_same(series.forecast_features(to_spark(spark, data), block=block), expected_features(data))


@pytest.mark.parametrize("null_share", [0.0, 0.6])
def test_features_with_few_or_many_nulls(spark, null_share):
    data = random_series(7, null_share=null_share)
    assert_same(series.forecast_features(to_spark(spark, data), block="1d"), expected_features(data))


@pytest.mark.parametrize("horizon", [1, 2, 5])
def test_other_horizons(spark, horizon):
    data = random_series(3)
    assert_same(series.forecast_features(to_spark(spark, data), horizon, "1d"), expected_features(data, horizon))


def test_target_then_features_equals_one_pass(spark):
    data = to_spark(spark, random_series(4))
    one = series.forecast_features(data, block="1d")
    two = series.build_features(series.add_future_target(data, block="1d"), block="1d").select(one.columns)
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


@pytest.mark.parametrize("block", ["30d", "1d", "1h"])
def test_single_operators(spark, block):
    data = random_series(6)
    frame = to_spark(spark, data)
    assert_same(series.add_future_target(frame, block=block), expected_targets(data))
    assert_same(series.add_lags(frame, block=block), walk(by_city(data), lagged))
    assert_same(series.add_rolling(frame, block=block), walk(by_city(data), rolled))


def test_shifts_in_both_directions(spark):
    data = random_series(8)
    got = series.row_shifts(to_spark(spark, data), {"was": ("main_aqi", 2), "will": ("components_pm10", -4)}, "1d")
    want = walk(by_city(data), lambda rows, i: {"was": at(rows, i - 2, "main_aqi"), "will": at(rows, i + 4, "components_pm10")})
    assert_same(got, want)


def test_lag_counts_rows_not_hours(spark):
    data = pd.DataFrame(
        {
            "city": "a",
            "datetime": pd.to_datetime(["2024-01-01 00:00", "2024-01-01 01:00", "2024-03-05 07:00", "2024-03-05 08:00"]),
            "main_aqi": [1.0, 2.0, 3.0, 4.0],
        }
    )
    got = series.add_future_target(to_spark(spark, data)).collect()
    assert [(r["main_aqi"], r["main_aqi_t_plus_h"], r["hazard_t_plus_h"]) for r in got] == [(1.0, 4.0, 1)]


def test_row_count_without_nulls(spark):
    data = random_series(9, null_share=0.0)
    expected = sum(max(0, n - 6) for n in data.groupby("city").size())
    assert series.forecast_features(to_spark(spark, data)).count() == expected


def test_required_columns(spark):
    with pytest.raises(ContractError):
        series.add_future_target(spark.createDataFrame([("a",)], "city string"))
    with pytest.raises(ContractError):
        series.build_features(spark.createDataFrame([("a",)], "city string"))


def test_dense_series_in_fine_blocks(spark):
    """A city with bursts of one row per second beside hourly cities: any width gives one result."""
    burst = pd.DataFrame({"datetime": pd.Timestamp("2024-01-01 23:30") + pd.to_timedelta(np.arange(4000), unit="s")})
    quiet = pd.DataFrame({"datetime": pd.Timestamp("2024-02-20") + pd.to_timedelta(np.arange(50), unit="h")})
    dense = pd.concat([burst, quiet]).assign(city="dense")
    rng = np.random.default_rng(0)
    for c in ("main_aqi", "components_pm2_5", "components_pm10"):
        dense[c] = np.where(rng.random(len(dense)) < 0.1, np.nan, np.round(rng.uniform(1, 5, len(dense)), 2))
    data = pd.concat([random_series(11), dense], ignore_index=True)
    frame = to_spark(spark, data)
    for width in ("1m", "1s"):
        assert_same(series.forecast_features(frame, block=width), expected_features(data))
    assert_same(series.add_future_target(frame, block="1m"), expected_targets(data))
    rows = series._with_block(frame, "1m").groupBy("city", "_block").count()
    assert rows.agg({"count": "max"}).first()[0] <= 60
