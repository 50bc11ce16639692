"""Spark ML pipelines for the level, hazard and severity models."""

from __future__ import annotations

import math
from functools import lru_cache

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import (
    ElementwiseProduct,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.contract import HAZARD, MEASURES, SEED, TARGET, feature_columns, require_columns
from aerocast.functions.labels import severity_bucket
from aerocast.models.compiled import Compiled, apply_compiled, compile_model, fits
from aerocast.operators.ordered import percentiles

TREES = 300
# MLlib needs a bound on the depth; 12 is deep enough for the forests' quality to level off.
DEPTH = 12
BINS = 64
SEVERITY = "severity_t_plus_h"


def impute_values(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact median per numeric column and the most frequent city.

    One value per column comes to the driver. A column without values is filled with 0.
    """
    numeric = [c for c in columns if c != "city"]
    found = percentiles(df, numeric, {"mid": 0.5}).collect() if numeric else []
    fill = {**dict.fromkeys(numeric, 0.0), **{r["feature"]: float(r["mid"]) for r in found}}
    if "city" in columns:
        named = df.filter(F.col("city").isNotNull()).groupBy("city").agg(F.count("*").alias("n"))
        top = named.orderBy(F.desc("n"), "city").first()
        fill["city"] = top["city"] if top else ""
    return fill


def _fill_statement(columns: list[str], fill: dict) -> str:
    """Projection that fills missing inputs; kept in the pipeline, so it is stored with it."""

    def part(c: str) -> str:
        if c == "city":
            text = str(fill[c]).replace("\\", "\\\\").replace("'", "\\'")
            return f"coalesce(cast(`{c}` as string), '{text}') AS `_in_{c}`"
        return f"coalesce(nanvl(cast(`{c}` as double), null), {float(fill[c])!r}D) AS `_in_{c}`"

    return f"SELECT *, {', '.join(part(c) for c in columns)} FROM __THIS__"


def preprocessor(df: DataFrame, columns: list[str]) -> list:
    """Stages from raw inputs to one feature vector.

    Numeric inputs: median fill, then standardised by the population deviation. City: most
    frequent fill, then one-hot, where an unseen city becomes all zeros.
    """
    require_columns(df, columns, "training frame")
    numeric = [c for c in columns if c != "city"]
    stages = [SQLTransformer(statement=_fill_statement(columns, impute_values(df, columns)))]
    parts = []
    if numeric:
        stages += [
            VectorAssembler(inputCols=[f"_in_{c}" for c in numeric], outputCol="_numeric"),
            StandardScaler(inputCol="_numeric", outputCol="_sample_scaled", withMean=True, withStd=True),
            ElementwiseProduct(
                scalingVec=Vectors.dense([population_factor(df.count())] * len(numeric)),
                inputCol="_sample_scaled",
                outputCol="_scaled",
            ),
        ]
        parts.append("_scaled")
    if "city" in columns:
        stages += [
            StringIndexer(inputCol="_in_city", outputCol="_city_index", handleInvalid="keep", stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCol="_city_index", outputCol="_city", dropLast=True),
        ]
        parts.append("_city")
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def population_factor(rows: int) -> float:
    """Factor from the sample-deviation scaling to the population-deviation scaling."""
    return math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0


def fit_preprocessor(df: DataFrame, columns: list[str]) -> PipelineModel:
    return Pipeline(stages=preprocessor(df, columns)).fit(df)


def _fit(df: DataFrame, prepared: PipelineModel, estimator) -> PipelineModel:
    """Fit an estimator behind shared, already fitted input stages."""
    fitted = estimator.fit(prepared.transform(df))
    return PipelineModel(stages=[*prepared.stages, fitted])


def train_regressor(
    df: DataFrame, columns: list[str], prepared=None, trees: int = TREES, depth: int = DEPTH, label: str = TARGET, bootstrap: bool = True
):
    """Random forest for the level; every split looks at all inputs.

    Without ``bootstrap`` every tree sees the table as it is, so one tree is the plain regression tree.
    """
    forest = RandomForestRegressor(
        labelCol=label, featuresCol="features", predictionCol="aqi_3h", numTrees=trees, maxDepth=depth,
        maxBins=BINS, featureSubsetStrategy="all", bootstrap=bootstrap, seed=SEED,
    )
    return _fit(df, prepared or fit_preprocessor(df, columns), forest)


def with_class_weight(df: DataFrame, label: str = HAZARD) -> DataFrame:
    """Attach balanced weights n / (k * n_class); one count per class comes to the driver."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    total, classes = sum(counts.values()), len(counts)
    weight = F.lit(None).cast("double")
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, F.lit(total / (classes * n))).otherwise(weight)
    return df.withColumn("_weight", weight)


def train_classifier(
    df: DataFrame, columns: list[str], prepared=None, trees: int = TREES, depth: int = DEPTH, balanced: bool = True,
    bootstrap: bool = True, subset: str = "sqrt",
):
    """Random forest for the hazard class, by default with balanced class weights.

    ``subset`` says how many inputs a split looks at; with all of them and without ``bootstrap``, one tree is
    the plain classification tree.
    """
    forest = RandomForestClassifier(
        labelCol=HAZARD, featuresCol="features", predictionCol="hazard_class", probabilityCol="hazard_probability",
        rawPredictionCol="hazard_raw", numTrees=trees, maxDepth=depth, maxBins=BINS,
        featureSubsetStrategy=subset, bootstrap=bootstrap, seed=SEED,
    )
    if balanced:
        df, forest = with_class_weight(df), forest.setWeightCol("_weight")
    return _fit(df, prepared or fit_preprocessor(df, columns), forest)


def train_recommender(df: DataFrame, columns: list[str], prepared=None, depth: int = DEPTH):
    """Decision tree for the severity bucket of the target."""
    labelled = df.withColumn(SEVERITY, severity_bucket(F.col(TARGET)))
    tree = DecisionTreeClassifier(
        labelCol=SEVERITY, featuresCol="features", predictionCol="severity_model", probabilityCol="severity_probability",
        rawPredictionCol="severity_raw", maxDepth=depth, maxBins=BINS, seed=SEED,
    )
    return _fit(labelled, prepared or fit_preprocessor(df, columns), tree)


def train_current_level(df: DataFrame, trees: int = 200, depth: int = DEPTH):
    """Baseline for the current level from the measures and the city, without any history."""
    columns = [c for c in MEASURES if c != "main_aqi" and c in df.columns] + ["city"]
    return train_regressor(df, columns, trees=trees, depth=depth, label="main_aqi")


def train_all(df: DataFrame, trees: int = TREES, depth: int = DEPTH) -> dict[str, PipelineModel]:
    """The three models on shared input stages."""
    columns = feature_columns(df)
    prepared = fit_preprocessor(df, columns)
    return {
        "regressor": train_regressor(df, columns, prepared, trees, depth),
        "classifier": train_classifier(df, columns, prepared, trees, depth),
        "recommender": train_recommender(df, columns, prepared, depth),
    }


# What each model adds: its own output columns as published columns.
def _published(role: str) -> dict:
    chance = vector_to_array(F.col("hazard_probability"))
    return {
        "regressor": {"aqi_3h": F.col("aqi_3h")},
        "classifier": {
            "hazard_class": F.col("hazard_class").cast("int"),
            "hazard_prob": F.try_element_at(chance, F.lit(2)),
        },
        "recommender": {"severity_model": F.col("severity_model").cast("int")},
    }[role]


@lru_cache(maxsize=16)
def _compiled(spark: SparkSession, model: PipelineModel, role: str) -> Compiled | None:
    return compile_model(spark, model, role) if fits(model.stages[-1]) else None


def score(df: DataFrame, models: dict[str, PipelineModel], native: bool = True) -> DataFrame:
    """Add what the given models predict: aqi_3h, hazard_class and hazard_prob, severity_model.

    Small models run as column expressions (see ``models.compiled``), larger ones, or all of them without ``native``,
    as the fitted pipelines; the predictions are the same. Models trained together share their input stages
    (stage ids survive storage), so a pipeline's inputs are prepared once for all of them.
    """
    keep, added, out, ready = list(df.columns), {}, df, None
    small = {role: _compiled(df.sparkSession, model, role) for role, model in models.items()} if native else {}
    for role, model in models.items():
        published = _published(role)
        if small.get(role):
            out, ready = apply_compiled(out.select(*keep, *added), small[role]), None
        else:
            inputs, head = model.stages[:-1], model.stages[-1]
            if ready != [s.uid for s in inputs]:
                out = PipelineModel(stages=inputs).transform(out.select(*keep, *added))
                ready = [s.uid for s in inputs]
            done = head.transform(out)
            out = done.select(*out.columns, *[c.alias(n) for n, c in published.items()])
        added |= published
    return out.select(*keep, *added)
