"""Fitted trees and forests as plain column expressions.

A fitted pipeline of ``models.training`` is a handful of numbers: fill values, scaling, city codes, thresholds and leaf
values. Written as nested cases they are one expression per tree over the raw inputs, which Spark runs
inside generated code, without vectors or model objects, and any other SQL engine can run as it stands
(``as_sql``). Inputs are scaled by the same operations in the same order as in the pipeline, and trees are summed in
their order, so predictions are equal to the pipeline's.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocast.session import scratch_path

#: Decisions of a whole model and of one tree up to which ``score`` prefers expressions: with more, the generated
#: methods no longer become machine code, and the library's own walk over nodes is faster.
LARGEST, LARGEST_TREE = 1200, 130
#: A nested node: (input, limit, left, right), or the values of a leaf.
Node = tuple[int, float, "Node", "Node"] | list[float]


@dataclass(frozen=True)
class Compiled:
    """A fitted model. ``inputs`` are expressions over filled inputs, in the order that nodes count them."""

    role: str
    single: bool
    filled: dict[str, str]
    inputs: list[str]
    trees: list[Node] = field(repr=False)

    @property
    def classes(self) -> int:
        node = self.trees[0]
        while isinstance(node, tuple):
            node = node[2]
        return len(node)


def _number(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def fits(head) -> bool:
    """Whether a fitted model is a tree or forest small enough for expressions."""
    if not hasattr(head, "trees") and not hasattr(head, "numNodes"):
        return False
    each = [t.numNodes // 2 for t in (head.trees if hasattr(head, "trees") else [head])]
    return sum(each) <= LARGEST and max(each) <= LARGEST_TREE


def _nested(rows: dict[int, dict], single: bool, role: str) -> Node:
    """The tree of stored nodes; children follow their parent in number, so leaves are built first."""
    built: dict[int, Node] = {}
    for i in sorted(rows, reverse=True):
        row = rows[i]
        if row["leftChild"] < 0:
            stats = row["impurityStats"]
            total = sum(stats) or 1.0
            # Trees of a forest vote with class shares; a single tree is asked for its class weights.
            built[i] = [row["prediction"]] if role == "regressor" else stats if single else [s / total for s in stats]
            continue
        split, left, right = row["split"], built[row["leftChild"]], built[row["rightChild"]]
        limit = split["leftCategoriesOrThreshold"][0]
        if split["numCategories"] >= 0:
            # City codes are 0 or 1, and the split names the one that goes left.
            left, right = (left, right) if limit == 0.0 else (right, left)
            limit = 0.5
        built[i] = (split["featureIndex"], limit, left, right)
    return built[0]


def _inputs(model: PipelineModel, fill: dict) -> tuple[dict[str, str], list[str]]:
    """Filled columns, and the entries of the feature vector over them."""
    filled, vector = {}, []
    stages = {type(s).__name__: s for s in reversed(model.stages[:-1])}
    if "StandardScalerModel" in stages:
        scaler = stages["StandardScalerModel"]
        names = [c.removeprefix("_in_") for c in next(s for s in model.stages if type(s).__name__ == "VectorAssembler").getInputCols()]
        for name, mean, deviation, factor in zip(names, scaler.mean, scaler.std, stages["ElementwiseProduct"].getScalingVec()):
            value = f"CAST({name} AS DOUBLE)"
            filled[f"_in_{name}"] = f"coalesce(CASE WHEN isnan({value}) THEN NULL ELSE {value} END, {_number(fill[name])})"
            scale = 1.0 / deviation if deviation else 0.0
            vector.append(f"(_in_{name} - {_number(mean)}) * {_number(scale)} * {_number(factor)}")
    if "StringIndexerModel" in stages:
        city = _text(fill["city"])
        filled["_in_city"] = f"coalesce(CAST(city AS STRING), {city})"
        for label in stages["StringIndexerModel"].labels:
            vector.append(f"CASE WHEN _in_city = {_text(label)} THEN {_number(1)} ELSE {_number(0)} END")
    return filled, vector


def compile_model(spark: SparkSession, model: PipelineModel, role: str) -> Compiled:
    """Numbers of a fitted pipeline. The nodes of the model come to the driver, as they do for MLlib; no rows do."""
    head = model.stages[-1]
    path = scratch_path(spark, "tree-nodes")
    head.write().save(path)
    stored = spark.read.parquet(f"{path}/data")
    single = "nodeData" not in stored.columns
    nodes = stored.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData")) if single else stored
    trees: dict[int, dict[int, dict]] = {}
    for tree, node in nodes.select("treeID", "nodeData").collect():
        trees.setdefault(tree, {})[node["id"]] = node.asDict(recursive=True)
    filled, vector = _inputs(model, fill_values(spark, model))
    return Compiled(role, single, filled, vector, [_nested(trees[i], single, role) for i in sorted(trees)])


def fill_values(spark: SparkSession, model: PipelineModel) -> dict:
    """What the pipeline puts in place of missing inputs, read off its fill statement by filling an empty row."""
    filler, names = model.stages[0], fill_columns(model)
    empty = spark.createDataFrame([(None,) * len(names)], ", ".join(f"`{c}` {'string' if c == 'city' else 'double'}" for c in names))
    row = filler.transform(empty).first()
    return {c: row[f"_in_{c}"] for c in names}


def fill_columns(model: PipelineModel) -> list[str]:
    """Raw inputs of the pipeline."""
    numeric = [s for s in model.stages if type(s).__name__ == "VectorAssembler" and s.getOutputCol() == "_numeric"]
    names = [c.removeprefix("_in_") for s in numeric for c in s.getInputCols()]
    return names + ["city"] * any(type(s).__name__ == "StringIndexerModel" for s in model.stages)


def _leaf(node: Node, leaves: list[list[float]]) -> str:
    """The number of the leaf that a row comes to; ``leaves`` gathers their values in this order."""
    if isinstance(node, list):
        leaves.append(node)
        return str(len(leaves) - 1)
    i, limit, left, right = node
    return f"CASE WHEN _tree_x{i} <= {_number(limit)} THEN {_leaf(left, leaves)} ELSE {_leaf(right, leaves)} END"


def _value(leaf: str, values: list[float], portable: bool) -> str:
    """The value of a leaf: an array look-up, or a case where the text has to run elsewhere."""
    if portable:
        return f"CASE {leaf} {' '.join(f'WHEN {i} THEN {_number(v)}' for i, v in enumerate(values))} END"
    return f"element_at(array({', '.join(map(_number, values))}), 1 + {leaf})"


def _used(node: Node) -> set[int]:
    return set() if isinstance(node, list) else {node[0]} | _used(node[2]) | _used(node[3])


def steps(model: Compiled, portable: bool = False) -> list[dict[str, str]]:
    """Columns added one projection after the other, the last being what the model publishes."""
    used = sorted(set().union(*map(_used, model.trees)))
    inputs = {f"_tree_x{i}": model.inputs[i] for i in used}
    names = {c for i in used for c in model.filled if c in model.inputs[i]}
    # A leaf is asked for in several columns, so that Spark works it out once, in a method for each tree.
    found = []
    for tree in model.trees:
        leaves: list[list[float]] = []
        found.append((_leaf(tree, leaves), leaves))
    votes = {
        f"_tree_v{k}": " + ".join([_number(0), *[_value(leaf, [v[k] for v in leaves], portable) for leaf, leaves in found]])
        for k in range(model.classes)
    }
    votes["_tree_n"] = " + ".join(f"CASE WHEN {leaf} >= 0 THEN 1 ELSE 0 END" for leaf, _ in found)
    if model.role == "regressor":
        published = {"aqi_3h": "_tree_v0 / _tree_n"}
    else:
        sums = [f"_tree_v{k}" for k in range(model.classes)]
        best = f"greatest({', '.join(sums)})" if len(sums) > 1 else "_tree_v0"
        # The first of equal classes wins.
        arms = " ".join(f"WHEN _tree_v{k} = {best} THEN {k}" for k in range(model.classes))
        chosen = f"CAST(CASE {arms} END AS INT)"
        if model.role == "recommender":
            published = {"severity_model": chosen}
        else:
            share = f"_tree_v1 / ({' + '.join(sums)})" if model.classes > 1 else "CAST(NULL AS DOUBLE)"
            published = {"hazard_class": chosen, "hazard_prob": share}
    return [{n: model.filled[n] for n in model.filled if n in names}, inputs, votes, published]


def apply_compiled(df: DataFrame, model: Compiled) -> DataFrame:
    """Add what the model publishes to ``df``, whose own columns stay as they are."""
    out, kept = df, [f"`{c}`" for c in df.columns]
    *inner, published = steps(model)
    for columns in inner:
        out = out.selectExpr("*", *[f"{expression} AS {name}" for name, expression in columns.items()])
    return out.selectExpr(*kept, *[f"{expression} AS {name}" for name, expression in published.items()])


def as_sql(model: Compiled, source: str, keep: list[str]) -> str:
    """The same as a query over the table or subquery ``source``, for Spark or any engine with CASE and CAST."""
    *inner, published = steps(model, portable=True)
    text = source
    for columns in inner:
        added = "".join(f", {expression} AS {name}" for name, expression in columns.items())
        text = f"(SELECT *{added} FROM {text}) AS t"
    return f"SELECT {', '.join([*keep, *[f'{e} AS {n}' for n, e in published.items()]])} FROM {text}"
