"""Repeatable samples: the same rows for the same seed, however the data is partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocast.contract import SEED, require_columns

#: Hexadecimal digits of a hash, and how many of them one pass counts by.
KEY_DIGITS, PREFIX_DIGITS = 32, 4
#: Rows of one prefix that may be put in order together.
CUT_ROWS = 100_000


def sample_key(seed: int = SEED) -> Column:
    """Hash of (seed, city, time); orders rows at random but repeatably."""
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("datetime"))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("city"), micros.cast("string")))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The n earliest rows by (city, datetime)."""
    return df.orderBy("city", "datetime").limit(n)


def sample_rows(df: DataFrame, n: int = 200, seed: int = SEED) -> DataFrame:
    """A small seeded sample of n rows (a bounded top-n per partition, then merged)."""
    require_columns(df, ["city", "datetime"])
    return df.orderBy(sample_key(seed), "city", "datetime").limit(n)


def balanced_sample(df: DataFrame, label: str, seed: int = SEED, most: int = CUT_ROWS) -> DataFrame:
    """As many rows of every label as the rarest label has: those with the smallest hashes.

    Hashes are counted by their first digits, which gives the prefix where each label's share ends; a prefix that
    still holds more than ``most`` rows is counted again by its next digits. Rows below the prefix are then taken by a
    plain filter, and only the rows of the last prefix are put in order. The driver sees counts (at most 65,536
    for each label and pass), no rows. ``df`` is read once per pass, so it must be stored or repeatable.
    """
    require_columns(df, ["city", "datetime", label])
    keyed = df.filter(F.col(label).isNotNull()).withColumn("_key", sample_key(seed))
    counts = _prefix_counts(keyed, label, {})
    if not counts:
        return df.limit(0)
    # Per label: the prefix that the share ends in, the rows wanted of it, the rows it holds.
    smallest = min(sum(n for _, n in found) for found in counts.values())
    cuts = {value: _cut(found, smallest) for value, found in counts.items()}
    while True:
        wide = {value: cut[0] for value, cut in cuts.items() if cut[2] > most and len(cut[0]) < KEY_DIGITS}
        if not wide:
            break
        again = _prefix_counts(keyed, label, wide)
        cuts |= {value: _cut(again[value], cuts[value][1]) for value in wide}
    sure, last = F.lit(False), F.lit(False)
    wanted = F.lit(None).cast("bigint")
    for value, (prefix, n, _) in cuts.items():
        mine, digits = F.col(label) == F.lit(value), F.substring("_key", 1, len(prefix))
        sure, last = sure | (mine & (digits < prefix)), last | (mine & (digits == prefix))
        wanted = F.when(mine, F.lit(n)).otherwise(wanted)
    rank = f"row_number() OVER (PARTITION BY `{label}` ORDER BY _key, city, datetime) AS _rank"
    cut = keyed.filter(last).selectExpr("*", rank).filter(F.col("_rank") <= wanted)
    return keyed.filter(sure).select(*df.columns).unionAll(cut.select(*df.columns))


def _prefix_counts(keyed: DataFrame, label: str, inside: dict) -> dict:
    """Rows by label and the next digits of the hash, in order; only below the prefixes of ``inside``, if any."""
    digits, chosen = F.lit(PREFIX_DIGITS), F.lit(not inside)
    for value, prefix in inside.items():
        mine = F.col(label) == F.lit(value)
        digits = F.when(mine, F.lit(len(prefix) + PREFIX_DIGITS)).otherwise(digits)
        chosen = chosen | (mine & F.col("_key").startswith(prefix))
    counted = keyed.filter(chosen).groupBy(label, F.substring("_key", F.lit(1), digits).alias("_prefix")).count()
    found: dict = {}
    for value, prefix, n in sorted(counted.collect(), key=lambda r: r[1]):
        found.setdefault(value, []).append((prefix, n))
    return found


def _cut(found: list[tuple[str, int]], wanted: int) -> tuple[str, int, int]:
    """The prefix in which the first ``wanted`` rows end, how many of them it gives, and how many it holds."""
    for prefix, n in found:
        if wanted <= n:
            return prefix, wanted, n
        wanted -= n
    raise ValueError("fewer rows than wanted")
