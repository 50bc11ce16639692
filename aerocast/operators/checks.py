"""Data-quality rules. Every check is one aggregation that yields a violations table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.contract import (
    AQI_HIGH,
    AQI_LOW,
    FEATURES,
    HAZARD,
    REQUIRED_RAW,
    TARGET,
    ContractError,
    feature_columns,
    missing_columns,
    require_columns,
)
from aerocast.functions.labels import present


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(check, violations): rows that break each rule; a rule that is null counts as broken."""
    one = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    cells = [F.struct(F.lit(n).alias("check"), F.col(f"`{n}`").alias("violations")) for n in rules]
    return one.select(F.inline(F.array(*cells)))


def enforce(report: DataFrame, what: str) -> None:
    """Raise if any rule is broken. The report has one row per rule."""
    broken = {r["check"]: r["violations"] for r in report.filter("violations > 0").collect()}
    if broken:
        raise ContractError(f"{what} failed: {broken}")


def _filled(column: str, dtype: str) -> Column:
    value = F.col(column)
    return (present(value) if dtype in ("double", "float") else value).isNotNull()


def _no_nulls(df: DataFrame, columns: list[str]) -> dict[str, Column]:
    kinds = dict(df.dtypes)
    return {f"null:{c}": _filled(c, kinds[c]) for c in columns}


def level_in_range(column: str, low: float = AQI_LOW, high: float = AQI_HIGH) -> Column:
    return F.col(column).between(F.lit(low), F.lit(high))


def raw_report(df: DataFrame) -> DataFrame:
    """Required columns without nulls and a level within 1..5."""
    require_columns(df, REQUIRED_RAW, "raw data")
    rules = _no_nulls(df, REQUIRED_RAW)
    rules["range:main_aqi"] = level_in_range("main_aqi")
    return violations(df, rules)


def feature_report(df: DataFrame) -> DataFrame:
    """No nulls in any feature, target within 1..5, labels 0 or 1."""
    require_columns(df, [TARGET, HAZARD], "training frame")
    rules = _no_nulls(df, feature_columns(df))
    rules[f"range:{TARGET}"] = level_in_range(TARGET)
    rules[f"label:{HAZARD}"] = F.col(HAZARD).isin(0, 1)
    return violations(df, rules)


def integrity_report(df: DataFrame) -> DataFrame:
    """Raw rules, plus the label rule where the label is present."""
    require_columns(df, REQUIRED_RAW, "sample")
    rules = _no_nulls(df, REQUIRED_RAW)
    rules["range:main_aqi"] = level_in_range("main_aqi")
    if HAZARD in df.columns:
        rules[f"label:{HAZARD}"] = F.col(HAZARD).isin(0, 1)
    return violations(df, rules)


def prediction_report(df: DataFrame, column: str = "prediction", low: float = AQI_LOW, high: float = AQI_HIGH) -> DataFrame:
    """No missing prediction, and every one within the bounds."""
    value = present(F.col(column).cast("double"))
    return violations(df, {"missing": value.isNotNull(), "range": value.isNull() | value.between(low, high)})


def check_raw(df: DataFrame) -> None:
    enforce(raw_report(df), "raw data check")


def check_features(df: DataFrame) -> None:
    enforce(feature_report(df), "feature check")


def check_integrity(df: DataFrame) -> None:
    enforce(integrity_report(df), "integrity check")


def check_predictions(df: DataFrame, column: str = "prediction", low: float = AQI_LOW, high: float = AQI_HIGH) -> None:
    enforce(prediction_report(df, column, low, high), "prediction check")


def check_serving_contract(df: DataFrame) -> None:
    """All 33 model inputs present; the error lists the missing ones."""
    missing = missing_columns(df, FEATURES)
    if missing:
        raise ContractError(f"rows lack {len(missing)} model inputs: {missing}")
