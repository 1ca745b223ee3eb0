"""Named segments: predicates saved as versioned rows on shared storage, evaluated in one pass over the data.

Every save or removal appends one row (name, version, predicate, when, removed) to a parquet
folder, so nothing is rewritten and old versions stay readable; the definition in force is the
latest version of a name.  A predicate is checked by Spark's analyser against the table before it
is stored.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Definitions in force that one pass evaluates (each is an expression of the plan).
MAX_DEFINITIONS = 1000
SCHEMA = "name string, version bigint, predicate string, saved_at timestamp_ntz, removed boolean"


class SegmentStore:
    """The definitions under ``path``, a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def history(self) -> DataFrame:
        """All versions of all names: ``name, version, predicate, saved_at, removed``."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def in_force(self) -> DataFrame:
        """``name, version, predicate``: each name's latest version, unless that removed it.  Of two rows that writers
        gave one version at the same time, the one saved later counts."""
        newest = Window.partitionBy("name").orderBy(F.desc("version"), F.desc("saved_at"), "predicate")
        rows = self.history().withColumn("_nth", F.row_number().over(newest)).where("_nth = 1 AND NOT removed")
        return rows.select("name", "version", "predicate")

    def _append(self, name: str, predicate: str | None, removed: bool) -> int:
        last = self.history().where(F.col("name") == name).agg(F.max("version")).first()[0] or 0
        row = (name, last + 1, predicate, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), removed)
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return last + 1

    def save(self, name: str, predicate: str, table: DataFrame) -> int:
        """Store a definition (a new version where the name exists) and return its version.  ValueError for an empty name
        or a predicate that is no boolean expression over the rows of ``table``; then nothing is stored."""
        if not name or not name.strip():
            raise ValueError("a segment needs a name")
        check(predicate, table)
        return self._append(name, predicate, False)

    def remove(self, name: str) -> int:
        """End a definition; its versions stay in the history.  KeyError where none is in force."""
        if self.in_force().where(F.col("name") == name).isEmpty():
            raise KeyError(name)
        return self._append(name, None, True)

    def members(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """``segment, version`` and the columns ``keep`` of every row in every segment in force; a row may be in several or
        none, and a predicate that is null does not hold.  All definitions are evaluated in one pass over ``rows``."""
        found = self.in_force().orderBy("name").limit(MAX_DEFINITIONS + 1).collect()
        if len(found) > MAX_DEFINITIONS:
            raise ValueError(f"more than {MAX_DEFINITIONS} segments")
        if not found:
            return rows.select(F.lit("").alias("segment"), F.lit(0).cast("bigint").alias("version"), *keep).where("false")
        hits = [F.when(F.coalesce(F.expr(r.predicate), F.lit(False)), F.struct(F.lit(r.name).alias("segment"), F.lit(r.version).alias("version"))) for r in found]
        return rows.select(F.explode(F.array_compact(F.array(*hits))).alias("_s"), *keep).select("_s.segment", "_s.version", *keep)


def check(predicate: str, table: DataFrame) -> None:
    """ValueError unless ``predicate`` is a boolean expression over one row of ``table``."""
    try:
        kind = table.select(F.expr(predicate).alias("p")).schema["p"].dataType.simpleString()
        table.where(F.expr(predicate)).schema  # refuses aggregates, windows and generators
    except (AnalysisException, ParseException) as e:
        raise ValueError(f"not a predicate over the table: {predicate!r}") from e
    if kind != "boolean":
        raise ValueError(f"not a predicate (its type is {kind}): {predicate!r}")
