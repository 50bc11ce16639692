"""The advice record that accompanies a forecast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerocast.functions.labels import bucket_label, present, severity_label, trend_note

# --- Fixed values: advice wording for hazardous air. ---
HAZARD_ADVICE = {
    "headline": "Air quality is hazardous in the next {h} hours.",
    "summary": "Limit outdoor exposure. Sensitive groups should remain indoors and use masks if going outside.",
    "general": [
        "Avoid outdoor exercise; prefer indoor activities.",
        "Keep windows closed during peak pollution.",
        "Use an air purifier if available.",
        "Wear a well-fitted mask (e.g., N95) if you must go outside.",
    ],
    "sensitive": [
        "Children, elderly, pregnant women: stay indoors as much as possible.",
        "People with heart or lung disease: keep medication handy and monitor symptoms.",
        "Consult a doctor if breathing becomes difficult or if symptoms worsen.",
    ],
}
# --- Fixed values: advice wording for acceptable air. ---
CALM_ADVICE = {
    "headline": "Air quality is acceptable in the next {h} hours.",
    "summary": "Outdoor activity is generally fine. Stay aware if you are sensitive to pollution.",
    "general": [
        "Normal outdoor activities are okay.",
        "Keep hydrated and prefer less congested areas for exercise.",
        "Monitor updates if conditions change.",
    ],
    "sensitive": [
        "Sensitive groups: consider shorter outdoor stays if you notice irritation.",
        "Keep rescue inhalers or required medication nearby if advised by your doctor.",
        "Avoid busy roads during rush hours to reduce exposure.",
    ],
}


def _texts(items: list[str]) -> Column:
    return F.array(*[F.lit(t) for t in items])


def advice_record(
    predicted: Column,
    hazard: Column,
    current: Column | None = None,
    model_bucket: Column | None = None,
    model_name: str | None = None,
    horizon: int = 3,
) -> Column:
    """Struct with severity, headline, summary, two action lists and provenance.

    ``hazard`` is the hazard text; any text that contains "hazard" counts as hazardous.
    The severity comes from ``model_bucket`` where a model supplied one, else from the rule.
    """
    now = present(current.cast("double")) if current is not None else F.lit(None).cast("double")
    bucket = model_bucket if model_bucket is not None else F.lit(None).cast("int")
    danger = F.coalesce(F.lower(hazard).contains("hazard"), F.lit(False))

    def choose(part):
        return F.when(danger, part(HAZARD_ADVICE)).otherwise(part(CALM_ADVICE))

    return F.struct(
        F.when(bucket.isNotNull(), bucket_label(bucket)).otherwise(severity_label(predicted)).alias("severity_bucket"),
        choose(lambda a: F.lit(a["headline"].format(h=horizon))).alias("headline"),
        F.concat_ws(" ", choose(lambda a: F.lit(a["summary"])), trend_note(predicted, now)).alias("summary"),
        choose(lambda a: _texts(a["general"])).alias("actions_general"),
        choose(lambda a: _texts(a["sensitive"])).alias("actions_sensitive_groups"),
        F.struct(
            F.lit(horizon).alias("horizon_hours"),
            predicted.cast("double").alias("predicted_aqi"),
            now.alias("current_aqi"),
            F.lit(model_name).cast("string").alias("recommender_model"),
        ).alias("based_on"),
    )
