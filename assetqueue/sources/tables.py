"""Sources and sinks."""

from __future__ import annotations

import json
from dataclasses import asdict
from typing import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from assetqueue.schemas import empty_string_to_null, nan_to_null


def _reader(spark: SparkSession, schema: T.StructType | None, fmt: str):
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true").option("mode", "PERMISSIVE")
    return r.format(fmt)


def read_required(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """A table that must exist. Spark raises PATH_NOT_FOUND when it is missing.

    CSV is read with the explicit schema (never inferred); parquet keeps its own
    schema and is only pruned to the schema's columns when one is given.
    """
    if fmt == "parquet":
        df = spark.read.parquet(path)
        if schema is not None:
            present = [f.name for f in schema.fields if f.name in df.columns]
            df = df.select(*present)
        return normalised(df)
    return normalised(_reader(spark, schema, fmt).load(path))


def read_quarantined(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """S1 for CSV: (rows that fit the schema, records that do not).

    A record is malformed if it has too few or too many fields or a value that is not of its column's type;
    it goes to the second table (file, record) whole. Each table is one filtered scan. All fields are
    parsed whatever is selected: which records are malformed must not hang on the query.
    """
    raw = "_corrupt_record"
    while raw in schema.fieldNames():
        raw = "_" + raw
    full = T.StructType([*schema.fields, T.StructField(raw, T.StringType())])
    df = (_reader(spark, full, "csv").option("columnNameOfCorruptRecord", raw).option("columnPruning", "false").load(path)
          .withColumn("__file", F.input_file_name()))
    # always true: it names every column, as a value that is not asked for is not parsed and cannot be found wrong
    read = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in schema.fieldNames()])) >= 0
    bad = df.where(F.col(raw).isNotNull() & read).select(F.col("__file").alias("file"), F.col(raw).alias("record"))
    return normalised(df.where(F.col(raw).isNull() & read).select(*schema.fieldNames())), bad


def normalised(df: DataFrame) -> DataFrame:
    """NaN and "" become NULL: absent values have one form in every check and expression."""
    return empty_string_to_null(nan_to_null(df), [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])


def read_optional(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A missing table reads as an empty table of the given schema."""
    try:
        return read_required(spark, path, schema, fmt)
    except AnalysisException as e:  # PATH_NOT_FOUND
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def lenient_date(c) -> F.Column:
    """Malformed -> NULL (pandas errors='coerce'); accepts dates and timestamps."""
    c = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.try_to_timestamp(c.cast("string")))


def lenient_timestamp(c) -> F.Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c.cast("string")).cast("timestamp_ntz")


def parse_dates(df: DataFrame, dates: Iterable[str] = (), timestamps: Iterable[str] = ()) -> DataFrame:
    """S3: parse string date/time columns leniently (NULL on malformed input).

    Columns that already have a date/timestamp type are left alone.
    """
    types = dict(df.dtypes)
    out = df
    for c in dates:
        if c in types and types[c] == "string":
            out = out.withColumn(c, lenient_date(c))
    for c in timestamps:
        if c in types and types[c] == "string":
            out = out.withColumn(c, lenient_timestamp(c))
    return out


class UnparseableDates(ValueError):
    pass


def require_parsed(df: DataFrame, col: str) -> DataFrame:
    """Strict parse - one aggregate; raise if any value did not parse."""
    n_bad = df.agg(F.count_if(F.col(col).isNull()).alias("n")).first()["n"]
    if n_bad:
        raise UnparseableDates(f"Found {n_bad} unparseable values in {col}")
    return df


def drop_invalid_dates(df: DataFrame, col: str = "date", check_empty: bool = True) -> DataFrame:
    """Keep rows whose date parsed; fail if none are left."""
    out = df.filter(F.col(col).isNotNull())
    if check_empty and out.isEmpty():
        raise ValueError(f"{col}: no valid dates")
    return out


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Iterable[str] = (),
                mode: str = "overwrite") -> None:
    """Table sink (parquet by default; CSV with header for hand-off).

    With ``partition_by``, overwriting replaces the partitions that ``df`` has rows of and leaves all others.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """A flat key/value report as a one-row JSON table with typed columns."""
    spark.createDataFrame([Row(**report)]).coalesce(1).write.mode("overwrite").json(path)


def stamp_results(df: DataFrame, snapshot_date, horizon: int, model: str, ranking: str,
                  run_ts=None) -> DataFrame:
    """Tag a result table with its run key; store partitioned by the key columns."""
    sd = F.col(snapshot_date) if isinstance(snapshot_date, str) else snapshot_date if isinstance(snapshot_date, Column) else F.lit(snapshot_date)
    return df.select(
        "*",
        sd.cast("date").alias("snapshot_date"),
        F.lit(int(horizon)).alias("horizon"),
        F.lit(model).alias("model"),
        F.lit(ranking).alias("ranking"),
        (F.current_timestamp() if run_ts is None else F.col(run_ts) if isinstance(run_ts, str) else run_ts if isinstance(run_ts, Column)
         else F.lit(run_ts)).alias("run_ts"),
    ).withColumn("stamp", F.format_string("%s_%dd_%s_%s", F.date_format("snapshot_date", "yyyy-MM-dd"),
                                           F.col("horizon"), F.col("model"), F.col("ranking")))


def latest_results(stamped: DataFrame, keys=("horizon", "model", "ranking")) -> DataFrame:
    """The latest run per (horizon, model, ranking): rows with the max run_ts.

    One aggregate over the (small) run keys, then a semi-join; on a table
    partitioned by snapshot_date the scan prunes to those partitions.
    """
    latest = stamped.groupBy(*keys).agg(F.max("run_ts").alias("run_ts"))
    return stamped.join(latest, [*keys, "run_ts"], "left_semi")


def save_model(spark: SparkSession, model, preprocessor, path: str) -> None:
    """A calibrated model and its preprocessor under ``path``.

    ``base`` and ``calibrator`` are MLlib's own model folders; ``manifest`` is a
    one-row JSON table with the calibration's kind, the preprocessor's parameters
    and, for boosted trees, the trees.
    """
    from assetqueue.operators.boosting import BoostedTrees

    trees = isinstance(model.model, BoostedTrees)
    if not trees:
        model.model.write().overwrite().save(f"{path}/base")
    if model.calibrator is not None:
        model.calibrator.write().overwrite().save(f"{path}/calibrator")
    report = {"kind": model.kind, "preprocessor": json.dumps(asdict(preprocessor))}
    write_report(spark, report | ({"trees": model.model.to_json()} if trees else {}), f"{path}/manifest")


def load_model(spark: SparkSession, path: str):
    """(calibrated model, preprocessor) as saved; MLlib's metadata name the class of each part."""
    from assetqueue.operators.boosting import BoostedTrees
    from assetqueue.operators.features import Preprocessor
    from assetqueue.operators.models import Calibrated

    manifest = spark.read.json(f"{path}/manifest").first()
    parts = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(manifest["preprocessor"]).items()}
    load = lambda p: DefaultParamsReader.loadParamsInstance(p, spark)
    calibrator = load(f"{path}/calibrator") if manifest["kind"] != "none" else None
    trees = manifest["trees"] if "trees" in manifest else None
    base = BoostedTrees.from_json(trees) if trees else load(f"{path}/base")
    return Calibrated(base, calibrator, manifest["kind"]), Preprocessor(**parts)


def load_models(spark: SparkSession, paths: dict):
    """({key: (model, preprocessor)}, {key: why}) - unreadable ones are skipped and reported."""
    out, skipped = {}, {}
    for key, p in paths.items():
        try:
            out[key] = load_model(spark, p)
        except (AnalysisException, Py4JJavaError, ValueError, KeyError, TypeError, AttributeError) as e:
            skipped[key] = f"{type(e).__name__}: {str(e).splitlines()[0]}"
    return out, skipped
