"""Scalar label rules on air-quality levels.

Three level-to-text maps exist on purpose; they disagree with each other and each is kept
under its own name. All rounding is half-to-even (``bround``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerocast.contract import HAZARD_FROM

# --- Fixed values: severity texts by rounded level 1..5. ---
SEVERITY_BY_LEVEL = [
    "Good",
    "Moderate",
    "Unhealthy for sensitive groups",
    "Unhealthy",
    "Very Unhealthy / Hazardous",
]
# --- Fixed values: severity texts by model bucket 0..3. ---
SEVERITY_BY_BUCKET = ["Good", "Moderate", "Unhealthy for sensitive groups", "Unhealthy"]
# --- Fixed values: display category by upper bound of the level. ---
CATEGORY_UP_TO = [(1, "Good"), (2, "Fair"), (3, "Moderate"), (4, "Poor")]
CATEGORY_ABOVE = "Very Poor"
UNKNOWN = "Unknown"

# --- Fixed values: the two hazard spellings. ---
HAZARD_TEXT = ("Hazardous", "Safe / Moderate")
HAZARD_CLASS_TEXT = ("hazardous", "safe/moderate")

# --- Fixed values: trend wording and its dead band. ---
TREND_BAND = 0.2
TREND_SAME = "Similar to current conditions."
TREND_WORSE = "Air quality is expected to worsen."
TREND_BETTER = "Air quality is expected to improve slightly."


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null (greatest/least alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def present(value: Column) -> Column:
    """NaN and infinities count as missing, so that null is the only missing marker."""
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def rounded_level(aqi: Column) -> Column:
    """Level rounded half-to-even and limited to 1..5, as an integer; null if missing."""
    return clip(F.bround(present(aqi.cast("double"))), 1.0, 5.0).cast("int")


def _is_hazardous(aqi: Column) -> Column:
    """Spark sorts NaN above all numbers, so the comparison alone would call it hazardous."""
    return (aqi >= F.lit(HAZARD_FROM)) & ~F.isnan(aqi.cast("double"))


def hazard_flag(aqi: Column) -> Column:
    """1 when the level is hazardous, else 0; a missing level gives null, NaN is not hazardous."""
    return _is_hazardous(aqi).cast("int")


def hazard_text(aqi: Column) -> Column:
    """Hazard wording from a predicted level."""
    return F.when(_is_hazardous(aqi), F.lit(HAZARD_TEXT[0])).otherwise(F.lit(HAZARD_TEXT[1]))


def hazard_class_text(label: Column) -> Column:
    """Hazard wording from a predicted class."""
    return F.when(label == 1, F.lit(HAZARD_CLASS_TEXT[0])).otherwise(F.lit(HAZARD_CLASS_TEXT[1]))


def severity_bucket(aqi: Column) -> Column:
    """Severity bucket 0..3: levels 4 and 5 share bucket 3, a missing level is bucket 2."""
    level = rounded_level(aqi)
    return F.when(level.isNull(), 2).otherwise(F.least(level - 1, F.lit(3))).cast("int")


def _pick(texts: list[str], index: Column) -> Column:
    """The text at a 1-based position, or the unknown text outside the list."""
    within = index.between(1, len(texts))
    return F.when(within, F.element_at(F.array(*[F.lit(t) for t in texts]), index)).otherwise(F.lit(UNKNOWN))


def severity_label(aqi: Column) -> Column:
    return _pick(SEVERITY_BY_LEVEL, rounded_level(aqi))


def bucket_label(bucket: Column) -> Column:
    return _pick(SEVERITY_BY_BUCKET, bucket.cast("int") + 1)


def aqi_category(aqi: Column) -> Column:
    """Display category by upper bounds, without rounding."""
    value = aqi.cast("double")
    out = F.when(value.isNull(), F.lit(UNKNOWN))
    for bound, text in CATEGORY_UP_TO:
        out = out.when(value <= F.lit(float(bound)), F.lit(text))
    return out.otherwise(F.lit(CATEGORY_ABOVE))


def trend_note(predicted: Column, current: Column) -> Column:
    """Wording for the change from now to the forecast; null without a current level."""
    change = predicted - present(current.cast("double"))
    return (
        F.when(change.isNull(), F.lit(None).cast("string"))
        .when(F.abs(change) < TREND_BAND, F.lit(TREND_SAME))
        .when(change > 0, F.lit(TREND_WORSE))
        .otherwise(F.lit(TREND_BETTER))
    )
