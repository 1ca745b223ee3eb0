"""Table readers / writers and result sinks.

Reads pick the format from the extension (csv / json / parquet, any case);
JSON accepts both JSON Lines and one pretty-printed array (with or without a schema).
Writes produce a directory of part files (the Spark way); an explicit format
wins over the extension.  Model and metric sinks write into shared storage.
"""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("csv", "json", "parquet")

PANEL_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("month", T.DateType()),
        T.StructField("current_month_transactions", T.LongType()),
        T.StructField("current_month_revenue", T.DoubleType()),
        T.StructField("total_tickets", T.LongType()),
        T.StructField("escalated_tickets", T.LongType()),
        T.StructField("late_payments", T.LongType()),
        T.StructField("enabled_channels", T.StringType()),
        T.StructField("self_service_percentage", T.DoubleType()),
        T.StructField("last_touchbase_date", T.TimestampNTZType()),
        T.StructField("average_resolution_time_hours", T.DoubleType()),
        T.StructField("churned", T.IntegerType()),
    ]
)


def _format_of(path: str) -> str:
    ext = os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".")
    if ext not in FORMATS:
        raise ValueError(f"Unsupported file format: .{ext} (use csv, json or parquet)")
    return ext


def _is_json_array(spark: SparkSession, path: str) -> bool:
    """Whether the first non-blank line of a JSON file opens an array (JSON Lines open an object)."""
    first = spark.read.text(path).where(F.trim("value") != "").first()
    return first is not None and first[0].lstrip().startswith("[")


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder; ValueError where its files have different ones."""
    files = spark.read.format("text").option("wholetext", False).load(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = files.where("at = 0").groupBy("file").agg(F.first("value").alias("value")).select("value").distinct().limit(2).collect()
    if not first:
        return []
    if len(first) > 1:
        raise ValueError(f"the files of {path} have different headers")
    return [c.strip() for c in next(csv.reader([first[0][0].lstrip("\ufeff")]))]


_REJECT = "_corrupt_row"


def _csv_by_name(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    names = csv_header(spark, path)
    kinds = {f.name: f.dataType for f in schema}
    if names and (lacking := [c for c in kinds if c not in names]):
        raise ValueError(f"columns missing in {path}: {', '.join(lacking)}")
    # the file's own order, with the types of the schema; columns that it does not name stay text and are pruned
    there = T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in names] or list(schema))
    if mode == "PERMISSIVE":
        there = there.add(_REJECT, T.StringType())
    rows = spark.read.schema(there).option("header", True).option("enforceSchema", True).option("mode", mode).option(
        "columnNameOfCorruptRecord", _REJECT).option("columnPruning", False).csv(path)  # a short row is only seen whole
    return rows.select(*kinds, *([_REJECT] if mode == "PERMISSIVE" else []))


def load_with_rejects(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects) of a CSV: rows with a malformed value, too few or too many fields are returned as ``row`` (their
    text) and leave the good ones.  The file is read once, into the shared scratch folder."""
    from panelcast.session import materialize

    both = materialize(_csv_by_name(spark, path, schema, "PERMISSIVE"), "csv-rows")
    return both.where(F.col(_REJECT).isNull()).drop(_REJECT), both.where(F.col(_REJECT).isNotNull()).select(F.col(_REJECT).alias("row"))


def load_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str | None = None,
    json_layout: str = "auto",
) -> DataFrame:
    """Read csv (header) / json / parquet chosen by extension; missing path -> FileNotFoundError.

    CSV columns are matched to ``schema`` by the names in the header, in any order; columns beyond it are not read,
    missing ones and malformed values raise (``load_with_rejects`` sets such rows apart).
    JSON is ``json_layout`` "lines" (splittable) or "array" (one array in a file, which Spark
    reads in one task); "auto" looks at the first non-blank character.  Malformed JSON raises."""
    fmt = (fmt or _format_of(path)).lower()
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        raise FileNotFoundError(path)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is not None:
            return _csv_by_name(spark, path, schema)
        return reader.option("header", True).option("inferSchema", True).csv(path)
    if fmt == "json":
        if json_layout not in ("auto", "lines", "array"):
            raise ValueError(f"unknown JSON layout {json_layout!r}")
        array = json_layout == "array" or json_layout == "auto" and _is_json_array(spark, path)
        return reader.option("mode", "FAILFAST").option("multiLine", array).json(path)
    return reader.parquet(path)


def save_table(df: DataFrame, path: str, output_format: str | None = None, mode: str = "overwrite") -> str:
    """Write as csv (header) / json (lines) / parquet; explicit format wins over the extension."""
    fmt = (output_format or _format_of(path)).lower()
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported output format: {fmt}")
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)
    return path


def save_json_array(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write every part file as one JSON array, a row on each line (streamed: no partition is held)."""
    import pyarrow as pa

    def lines(batches):
        before = "["
        for b in batches:
            out = []
            for row in b.column(0).to_pylist():
                out.append(before if before == "[" else before + ",")
                before = row
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
        if before != "[":
            yield pa.RecordBatch.from_arrays([pa.array([before, "]"], pa.string())], names=["value"])

    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    rows.mapInArrow(lines, "value string").write.mode(mode).text(path)
    return path


def load_panel(spark: SparkSession, path: str) -> DataFrame:
    """Canonical panel with the explicit schema (no inference)."""
    fmt = _format_of(path)
    if fmt == "parquet":
        return load_table(spark, path)
    return load_table(spark, path, schema=PANEL_SCHEMA)


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def save_metrics(metrics: DataFrame, path: str) -> str:
    """Metrics table (one row per model) -> JSON lines."""
    metrics.coalesce(1).write.mode("overwrite").json(path)
    return path


save_thresholds = save_metrics  # optimal threshold per model: the same sink


def save_predictions(pred: DataFrame, path: str, original: DataFrame | None = None, fmt: str = "csv") -> str:
    """ids + predictions, or every original column + predictions (keyed join, never positional)."""
    out = pred
    if original is not None:
        extra = [c for c in pred.columns if c not in ("account_id", "month")]
        out = original.join(pred.select("account_id", "month", *extra), ["account_id", "month"], "inner")
    return save_table(out, path, fmt)


def export_segments(segments: DataFrame, path: str) -> str:
    """One folder per segment (name lower-cased, spaces -> '_'), columns account_id, score, tier."""
    out = segments.select(
        F.regexp_replace(F.lower("segment"), " ", "_").alias("segment_name"),
        "account_id",
        "churn_risk_score",
        "risk_tier",
    )
    out.write.mode("overwrite").partitionBy("segment_name").option("header", True).csv(path)
    return path
