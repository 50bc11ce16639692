"""Streams over landed files, compared with the same work in batch."""

import pytest
from pyspark.sql import functions as F

from aerocast.models.training import score, train_all
from aerocast.operators.readings import first_per_key
from aerocast.operators.scoring import cold_start_features, prediction_records
from aerocast.operators.series import add_lags, add_rolling, forecast_features
from aerocast.session import materialise
from aerocast.sources.synthetic import synthetic_readings
from aerocast.streaming import blocks, jobs


@pytest.fixture
def landed(spark, tmp_path):
    rows = synthetic_readings(spark, 90).withColumn("row_order", F.xxhash64("city", "datetime"))
    rows.unionAll(rows.limit(20)).repartition(4).write.parquet(f"{tmp_path}/landed")
    return f"{tmp_path}/landed", rows


@pytest.fixture
def files_of_one_key_each(spark, tmp_path):
    """Three days, a file per day, with repeats of the day before; smaller orders come from other files too."""
    import os

    rows = synthetic_readings(spark, 90).withColumn("row_order", F.xxhash64("city", "datetime").bitwiseAND(F.lit(2**40)))
    worse = rows.withColumns({"main_aqi": F.lit(-1.0), "row_order": F.col("row_order") + 1})
    better = rows.withColumns({"main_aqi": F.lit(9.0), "row_order": F.col("row_order") - 1}).filter("city = 'Lahore'")
    path, names = f"{tmp_path}/days", []
    os.makedirs(path)
    for i, frame in enumerate((worse, rows.filter("city <> 'Karachi'"), better.unionAll(rows))):
        frame.coalesce(1).write.parquet(f"{tmp_path}/part{i}")
        made = next(f for f in os.listdir(f"{tmp_path}/part{i}") if f.endswith(".parquet"))
        os.rename(f"{tmp_path}/part{i}/{made}", f"{path}/{i}.parquet")
        names.append(f"{path}/{i}.parquet")
    return path, names


@pytest.mark.parametrize("newest_first", [False, True])
def test_unique_rows_do_not_depend_on_batches(spark, files_of_one_key_each, tmp_path, newest_first):
    import os

    path, names = files_of_one_key_each
    for age, name in enumerate(reversed(names) if newest_first else names):
        os.utime(name, (1_700_000_000 + age, 1_700_000_000 + age))
    whole = spark.read.parquet(path)
    want = first_per_key(whole)
    for per_batch in (1, 3):
        out = jobs.run_unique(jobs.file_stream(spark, path, whole.schema, per_batch), f"{tmp_path}/w{per_batch}{newest_first}")
        got = jobs.read_unique(spark, out).select(want.columns)
        assert got.count() == 90 and got.exceptAll(want).isEmpty()


def test_restart_adds_only_new_files(spark, landed, tmp_path):
    path, rows = landed
    work = f"{tmp_path}/again"
    for expected in (90, 90, 120):
        if expected == 120:
            later = rows.withColumn("datetime", F.col("datetime") + F.expr("INTERVAL 10 DAYS"))
            later.filter("city = 'Lahore'").write.mode("append").parquet(path)
        out = jobs.run_unique(jobs.file_stream(spark, path, rows.schema), work)
        assert jobs.read_unique(spark, out).count() == expected


def days_in_files(spark, tmp_path, rows, name, order_of_days):
    """One file per day of ``rows``, to arrive in the given order."""
    import os

    os.makedirs(f"{tmp_path}/{name}")
    for age, day in enumerate(order_of_days):
        part = f"{tmp_path}/{name}-{age}"
        rows.filter(F.dayofyear("datetime") == day).coalesce(1).write.parquet(part)
        made = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = f"{tmp_path}/{name}/{age}.parquet"
        os.rename(f"{part}/{made}", target)
        os.utime(target, (1_700_000_000 + age, 1_700_000_000 + age))
    return f"{tmp_path}/{name}"


@pytest.mark.parametrize("arrival", ["in order", "late"])
def test_true_lags_for_any_split_into_files(spark, tmp_path, arrival):
    """Gaps of days and a row now and then: history reaches over blocks that hold too few rows."""
    rows = synthetic_readings(spark, 400).withColumn("row_order", F.xxhash64("city", "datetime").bitwiseAND(F.lit(2**40)))
    sparse = rows.filter("city <> 'Lahore' OR hour(datetime) = 7").filter("dayofyear(datetime) NOT IN (3, 4)")
    sparse = materialise(sparse, "sparse")
    days = sorted(r[0] for r in sparse.select(F.dayofyear("datetime")).distinct().collect())
    mixed = days[1::2][::-1] + days[::2] if arrival == "late" else days
    path = days_in_files(spark, tmp_path, sparse, "history", mixed)
    stream = jobs.file_stream(spark, path, sparse.schema, 1)
    out = jobs.run_unique(stream, f"{tmp_path}/work", shape=lambda df: df, history=True)
    got = jobs.read_shaped(spark, out)
    plain = add_rolling(add_lags(sparse.drop("row_order")))
    assert got.count() == plain.count() and got.select(plain.columns).exceptAll(plain).isEmpty()
    # Rows that have a target and a whole history have the features that models are trained on.
    trained = forecast_features(sparse.drop("row_order"))
    shared = [c for c in got.columns if c in trained.columns]
    assert "main_aqi_lag_3" in shared and trained.select(shared).exceptAll(got.select(shared)).isEmpty()


def test_a_batch_reads_what_it_touches(spark, tmp_path):
    """What a batch reads of earlier ones stays the same however many there were."""
    rows = materialise(synthetic_readings(spark, 24 * 16).withColumn("row_order", F.monotonically_increasing_id()), "days")
    days = sorted(r[0] for r in rows.select(F.dayofyear("datetime")).distinct().collect())
    path = days_in_files(spark, tmp_path, rows, "flat", days + days[:1])
    seen = []
    real = blocks.block_paths

    def watched(spark, out, chosen, until):
        found = real(spark, out, chosen, until)
        seen.append(len(found))
        return found

    blocks.block_paths = watched
    try:
        out = jobs.run_unique(jobs.file_stream(spark, path, rows.schema, 1), f"{tmp_path}/work")
    finally:
        blocks.block_paths = real
    assert max(seen) <= 1 and jobs.read_unique(spark, out).count() == rows.select("city", "datetime").distinct().count()
    assert all(len(blocks.versions(spark, out, b, 10**6)) <= 2 for b in blocks.all_blocks(spark, out))


def test_counters(spark, landed, tmp_path):
    path, rows = landed
    log = jobs.file_stream(spark, path, rows.schema, 1).select("city", (F.col("components_co") > 420).alias("ok"))
    jobs.run_to_end(jobs.snapshot_to_files(jobs.counter_stream(log), f"{tmp_path}/out", f"{tmp_path}/ck"))
    got = jobs.latest_snapshot(spark, f"{tmp_path}/out")
    batch = jobs.counter_stream(spark.read.parquet(path).select("city", (F.col("components_co") > 420).alias("ok")))
    assert got.select(batch.columns).exceptAll(batch).isEmpty() and got.count() == 3


@pytest.mark.ml
def test_stream_scores_like_batch(spark, landed, tmp_path):
    path, rows = landed
    models = train_all(forecast_features(synthetic_readings(spark, 300)), 3, 3)
    stream = jobs.file_stream(spark, path, rows.schema)
    out = jobs.run_unique(stream, f"{tmp_path}/scored", shape=jobs.score_rows(models, "stored/tree"))
    got = jobs.read_shaped(spark, out)
    batch = prediction_records(score(cold_start_features(rows), models))
    assert got.count() == 90
    assert got.select("record.city", "record.prediction.*").exceptAll(batch.select("city", "prediction.*")).isEmpty()
    assert got.select("record.recommendations.based_on.recommender_model").distinct().first()[0] == "stored/tree"
