"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from panelcast.session import delete_path, importable_on_workers, materialize, scratch_path, scratch_root

__all__ = [
    "bounded_batches", "delete_path", "importable_on_workers", "map_batches", "materialize", "pack_scratch", "scratch_path",
    "scratch_root", "table", "text_pieces",
]

#: Rows of one Arrow batch handed to Python; texts are long, so the default of 10,000 is too many.
ROWS_PER_BATCH = 500
#: Characters of text that one Python step works on at a time.
CHARS_PER_STEP = 1 << 22


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Prepare the session for Arrow functions of this package: a lower batch size where it is larger
    (bounded worker memory), and workers that can import the package."""
    importable_on_workers(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[dict]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` where ``fn`` turns a record batch into dicts of column -> values."""
    bounded_batches(df.sparkSession)
    spark_schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for out in fn(batch):
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c := out[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for f in arrow],
                    schema=arrow,
                )

    return df.mapInArrow(run, spark_schema)


def text_pieces(texts: list, step: int = CHARS_PER_STEP) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of a list of texts holding about ``step`` characters each (at least one text)."""
    i = total = 0
    for j, t in enumerate(texts):
        total += len(t)
        if total >= step:
            yield i, j + 1
            i, total = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def pack_scratch(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write a table of large values once to the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_remainder(id_col: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (a null id: as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


def looked_up(rows: DataFrame, lookup: DataFrame, key: str, weight: str, how: str = "left") -> DataFrame:
    """``rows`` joined with a one-row-per-key ``lookup`` without a hot key in one task.

    ``weight`` is the column of ``lookup`` with the number of ``rows`` of each key.  A
    key with over a thousandth of all rows is hot; there can be at most a thousand of
    those, so they are broadcast.  All other keys go through an ordinary join, in which
    no key has more than a thousandth of the rows.  ``weight`` is dropped.
    """
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    hot = lookup.where(F.col(weight) > total / 1000).drop(weight)
    rest = lookup.where(F.col(weight) <= total / 1000).drop(weight)
    hot_keys = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key, "inner").unionByName(
        rows.join(hot_keys, key, "left_anti").join(rest, key, how)
    )


def connected_components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """Smallest node reachable from every node of an undirected edge list (long nodes).

    Alternating large-star and small-star rounds: every round reads the edges written by
    the one before (shared scratch folder, so no lineage grows and a lost executor costs
    one round), aggregates with map-side combining and stops when the edges stay the same.
    Returns ``node, root`` for all nodes of proper edges.
    """
    spark = edges.sparkSession
    e = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    path = scratch_path(spark, name)
    e.write.parquet(path)
    state = None
    while True:
        e = spark.read.schema("u bigint, v bigint").parquet(path)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("m", "u"))
        large = looked_up(both, low, "u", "n", "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        mid = scratch_path(spark, name)
        large.write.parquet(mid)
        large = spark.read.schema("u bigint, v bigint").parquet(mid)
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = looked_up(large, low, "u", "n", "inner").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*").where("u != v").distinct()
        new = scratch_path(spark, name)
        small.write.parquet(new)
        delete_path(spark, mid)
        delete_path(spark, path)
        path = new


class Memo(dict):
    """Values of keys seen, in two generations: once ``limit`` keys are in, they become the old
    generation and the one before goes; a key that is used again moves to the new one.  Frequent
    keys stay, and at most about twice ``limit`` keys of at most ``chars`` characters are held."""

    def __init__(self, limit: int, chars: int = 48):
        super().__init__()
        self.limit, self.chars, self.old = limit, chars, {}

    def __missing__(self, key):
        value = self[key] = self.old[key]
        return value

    def unseen(self, keys: set) -> list:
        """The keys without a value; call before a step's lookups, it also ages the table."""
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()
        return [k for k in keys if k not in self and k not in self.old]

    def forget_long(self, keys: list) -> None:
        for k in keys:
            if len(k) > self.chars:
                self.pop(k, None)


def in_steps(batches: Iterable[pa.RecordBatch], column: int, size: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The batches joined to steps of about ``size`` bytes of a text column (larger only by one batch)."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.column(column).nbytes
        if n >= size:
            yield from _joined(held)
            held, n = [], 0
    if held:
        yield from _joined(held)


def _joined(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if len(held) == 1:
        yield held[0]
    else:
        yield pa.concat_batches(held)


def split_words(texts: pa.Array):
    """Texts cut at every single space: (code of each part, the distinct parts, first part of each text and the end)."""
    import pyarrow.compute as pc

    parts = pc.split_pattern(texts, " ")
    flat = parts.flatten().dictionary_encode()
    offsets = parts.offsets.to_numpy()
    return flat.indices.to_numpy(), flat.dictionary.to_pylist(), offsets - offsets[0]


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


_WORKER_STATE: dict = {}


def worker_state(key, make: Callable):
    """``make()``, kept for a Python worker's later tasks.  Only the latest key is kept: a worker serves many
    jobs, and the tables of one operator must not stay in memory while the next one fills its own."""
    if key not in _WORKER_STATE:
        _WORKER_STATE.clear()
        _WORKER_STATE[key] = make()
    return _WORKER_STATE[key]
