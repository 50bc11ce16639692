"""Small tables with everything that an operator must bear."""

from __future__ import annotations

LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
BASE = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega"
TEXTS = [
    None,
    "",
    "   \n\t ",
    "one",
    "one two three four",
    BASE,
    BASE,
    BASE + " extra",
    "Start " + BASE + " again " + BASE,
    LONG,
    LONG + " tail",
    "naïve café ÉCOLE 東京 \U0001f600   nbsp",
    "A" * 3000,
    "IDIOT! you idiot, (idiot) moron",
    "!!! $$$ ### 12345",
    "la " * 500,
]
#: Columns whose names operators might use themselves.
EXTRA = {c: "x" for c in ("score", "shard", "node", "bucket", "length", "start", "spans", "label", "_id", "row", "kept", "n_chars")}


def documents(spark, texts=TEXTS, repeat_rows=True):
    """Ids in order, one null id, repeated whole rows, null sources, clashing extra columns."""
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}") for i, t in enumerate(texts)]
    rows.append((None, "a text without an id", None, None))
    if repeat_rows:
        rows += [rows[5], rows[5]]
    names = ", ".join(f"`{c}` string" for c in EXTRA)
    values = tuple(EXTRA.values())
    schema = f"doc_id long, text string, lang string, source string, {names}"
    return spark.createDataFrame([(*r, *values) for r in rows], schema).repartition(4)


def empty_documents(spark):
    return documents(spark).limit(0)


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string, id string")
