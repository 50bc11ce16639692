"""Raw files in, unified tables out."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocast.contract import FEATURES, MEASURES, ContractError, require_columns
from aerocast.operators.checks import check_serving_contract
from aerocast.operators.readings import (
    ROW_ORDER,
    align_columns,
    before_cutoff,
    city_name,
    clean_readings,
    numeric_measures,
    parse_datetime,
    standard_headers,
    with_city,
)
from aerocast.session import materialise

# Bits of a row's place inside its file; files may have up to 16 TB.
PLACE_BITS = 44


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def first_existing(spark: SparkSession, candidates: list[str]) -> str:
    """The first path that exists, e.g. the full data set, else a sample."""
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these sources exists: {candidates}")


def read_text_table(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV with a header, every column as text; types are enforced later, by name.

    Files read together must share one header; a file that differs fails instead of being
    read by position.
    """
    return spark.read.option("header", True).option("enforceSchema", False).csv(paths)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """CSV by suffix, Parquet otherwise, with the place of every row in the source.

    ``row_order`` counts files in the order of their names, then rows: by their number in a
    Parquet file, and by byte offset plus position in a CSV split. A source that was landed
    before has the column already.
    """
    scan = read_text_table(spark, path) if path.endswith(".csv") else spark.read.parquet(path)
    if ROW_ORDER in scan.columns:
        return scan
    return _with_places(scan, path.endswith(".csv"))


def _file_names(scan: DataFrame) -> list[str]:
    """Files of a scan in the order of their names, as its metadata writes them."""
    return sorted(re.sub(r"^(\w+):///", r"\1:/", f) for f in scan.inputFiles())


def _with_places(scan: DataFrame, text: bool, first: int = 0) -> DataFrame:
    """``row_order`` for a scan whose files are numbered from ``first`` on."""
    # A split has fewer rows than bytes, so the sum stays below the offset of the next one.
    split = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    inside = split if text else F.col("_metadata.row_index")
    placed = scan.select("*", F.col("_metadata.file_path").alias("_file"), inside.alias("_inside"))
    numbers = scan.sparkSession.createDataFrame(list(enumerate(_file_names(scan), first)), "_number long, _file string")
    order = F.shiftleft("_number", PLACE_BITS) + F.col("_inside")
    return placed.join(numbers, "_file").select(*[f"`{c}`" for c in scan.columns], order.alias(ROW_ORDER))


def column_names(spark: SparkSession, path: str) -> list[str]:
    """Column names of a Parquet table, from its footer."""
    return spark.read.parquet(path).schema.names


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the data files directly inside a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    files = [str(f.getPath().toString()) for f in found if f.isFile()]
    return [f for f in files if not f.rsplit("/", 1)[-1].startswith(("_", "."))]


def read_city_files(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Stack the CSV data of several cities and tag every row with its city.

    ``files`` maps a city to its file or folder. Cities with the same header are read by one
    scan and tagged by file name; other headers make further scans, and columns a city lacks
    are null.
    """
    headers: dict[tuple, dict[str, str]] = {}
    paths: dict[str, str] = {}
    for city, path in files.items():
        parts = data_files(spark, path) if path_exists(spark, path) else []
        if not parts:
            raise FileNotFoundError(f"city {city} has no file: {path}")
        header = tuple(read_text_table(spark, parts[0]).columns)
        for part in parts:
            name = part.rsplit("/", 1)[-1]
            if name in paths:
                raise ContractError(f"city files must have distinct names: {name}")
            paths[name] = part
            headers.setdefault(header, {})[name] = city

    out = None
    for header, group in headers.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        scan = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        raw = scan.csv([paths[name] for name in group])
        tag = F.create_map(*[F.lit(x) for pair in group.items() for x in pair])
        part = standard_headers(raw.withColumn("city", tag[F.col("_metadata.file_name")]))
        require_columns(part, ["datetime"], f"files of {sorted(set(group.values()))}")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def unify_training(spark: SparkSession, files: dict[str, str], cutoff: str | None = None) -> DataFrame:
    """All city files as one typed table, up to the cutoff, city in model form."""
    rows = numeric_measures(parse_datetime(read_city_files(spark, files)))
    rows = rows.withColumn("city", city_name(F.col("city")))
    return before_cutoff(rows, cutoff) if cutoff else before_cutoff(rows)


def unify_test(spark: SparkSession, files: dict[str, str], reference: str | None = None) -> DataFrame:
    """All city files with exactly the columns of a reference table (or of the files)."""
    raw = read_city_files(spark, files)
    expected = None
    if reference and path_exists(spark, reference):
        expected = [c for c in column_names(spark, reference) if c != "city"]
    rows = align_columns(raw, expected or [c for c in raw.columns if c != "city"], "test files")
    rows = numeric_measures(parse_datetime(rows))
    return rows.withColumn("city", city_name(F.col("city")))


def load_readings(spark: SparkSession, candidates: list[str]) -> DataFrame:
    """Unique, typed readings from the first source that exists: of several rows of a key the first."""
    return clean_readings(read_any(spark, first_existing(spark, candidates)))


def load_features(spark: SparkSession, path: str) -> DataFrame:
    """A stored feature table; rows without a time are dropped."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"feature table not found at {path}; build it first")
    return parse_datetime(spark.read.parquet(path))


def land(df: DataFrame, path: str) -> str:
    """Write raw rows under a stable path; a place in the source is a column like any other."""
    df.write.mode("overwrite").parquet(path)
    return path


def land_first(spark: SparkSession, candidates: list[str], path: str) -> str:
    """Land the best available source, so that later steps have one stable input."""
    return land(read_any(spark, first_existing(spark, candidates)), path)


def land_more(spark: SparkSession, sources: list[str], path: str) -> list[str]:
    """Land the files of ``sources`` that are not landed yet, beside those that are; gives the new files.

    Sources are files, or folders looked at anew each time, CSV or Parquet but not both. Every landing is a folder of
    its own and numbers its files on from the one before, so ``row_order`` grows and a row landed earlier stays the
    first of its key. A landing counts once its files are in the log; one that broke off is written again.
    """
    log = read_landing_log(spark, path)
    known = {r["file"] for r in log}
    found = [f for source in sources for f in data_files(spark, source)]
    new = sorted({f for f in found if f not in known})
    if not new:
        return []
    number = max((r["landing"] for r in log), default=-1) + 1
    text = new[0].endswith(".csv")
    scan = read_text_table(spark, new) if text else spark.read.parquet(*new)
    _with_places(scan, text, len(known)).write.mode("overwrite").parquet(f"{path}/landing={number}")
    entries = spark.createDataFrame([(f, number) for f in new], "file string, landing long")
    entries.coalesce(1).write.mode("append").parquet(f"{path}/_log")
    return new


def read_landing_log(spark: SparkSession, path: str) -> list:
    """(file, landing) of everything landed: one row per source file."""
    return spark.read.parquet(f"{path}/_log").collect() if path_exists(spark, f"{path}/_log") else []


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """All complete landings with their ``row_order``; columns that a landing lacks are null."""
    numbers = sorted({r["landing"] for r in read_landing_log(spark, path)})
    if not numbers:
        raise FileNotFoundError(f"nothing landed at {path}")
    return spark.read.option("mergeSchema", True).parquet(*[f"{path}/landing={n}" for n in numbers])


def load_landed(spark: SparkSession, path: str) -> DataFrame:
    """Unique, typed readings of all landings: of several rows of a key the one landed first."""
    return clean_readings(read_landed(spark, path))


def write_by_month(df: DataFrame, path: str, root: str | None = None) -> str:
    """Parquet in one folder per month, ordered by city and time inside.

    Rows are spread by ranges of (month, city, time): tasks are even however uneven the
    cities are, a file holds few cities, so a city filter skips most row groups, and the
    number of folders does not grow with the number of cities. The ranges are sampled from the
    rows, so these are stored first: their plan runs once, not once more for the sample.
    """
    laid = materialise(df, "unordered", root).withColumn("month_part", F.date_format("datetime", "yyyy-MM"))
    order = ["month_part", "city", "datetime"]
    ranged = laid.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("overwrite").partitionBy("month_part").parquet(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_feature_csv(spark: SparkSession, path: str) -> DataFrame:
    """Feature rows for batch scoring; the file must carry all model inputs."""
    raw = standard_headers(read_text_table(spark, path))
    check_serving_contract(raw)
    named = raw.select(*FEATURES).withColumn("city", city_name(F.col("city")))
    return numeric_measures(named, ("city",))


def read_readings_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Readings already in contract form, with text times."""
    text = numeric_measures(parse_datetime(standard_headers(with_city(read_text_table(spark, paths)))))
    fields: list[Column] = [F.col("city"), F.col("datetime")]
    fields += [F.col(c) for c in MEASURES if c in text.columns]
    return text.select(*fields)

