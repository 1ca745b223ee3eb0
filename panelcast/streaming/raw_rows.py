"""Scoring of raw panel rows as they arrive (Structured Streaming with state).

Raw rows become features inside the stream.  For every account the state store keeps the last
rows that a window can still reach, the first month, the largest number of channels, and the rows
that wait for the watermark.  Accounts share a state by the hash of their key (``BUCKETS``), as every call
on a state costs milliseconds whatever it holds.  A row is released when the watermark has passed its month, in order of
month, with the rows before it; the window features are then expressions over that short array, so
everything behind the state is one JVM-side projection and the sink stays exactly-once.

Late rows: a row that arrives out of order but before the watermark passes its month takes its right place.
A row at or before the watermark, or not after the account's last released month, is dropped (the former
are counted in the query's progress).  Of rows with equal account and month the first to arrive counts.
Rows without a month are dropped; months start in 1970.  The last months wait until later rows arrive;
``punctuation`` gives a row that lets them go.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from panelcast.functions.expressions import CHANNELS, PANEL_METRICS, q
from panelcast.operators.features import COMPARISON_METRICS, WINDOWS, _dbl, channel_exprs, feature_names, fill_numeric
from panelcast.session import importable_on_workers

#: Rows of an account that the window features of its newest row read.
REACH = max(n for _, n, _ in WINDOWS)
#: How far out of order rows may arrive (a Spark interval).
DELAY = "155 days"

#: States that accounts are dealt to.  It holds for the life of a checkpoint; a state is read and written as a whole, so
#: for many more than a thousand accounts a state take more.
BUCKETS = 1 << 13

_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_CHANNELS = " + ".join(f"CAST(coalesce(contains(enabled_channels, '{ch}'), false) AS INT)" for ch in CHANNELS)


def _advance(held: list, came, mark: int) -> list[tuple]:
    """An account's ``held`` (first month, most channels, last rows, rows that wait) takes the rows that came and gives up those
    that the watermark lets go: (what came before each and itself, first month, most channels so far)."""
    first, widest, done, waiting = held
    taken, after = {r[0] for r in waiting}, done[-1][0] if done else None
    for at, channels, row in came:
        if at not in taken and (after is None or at > after):
            taken.add(at)
            waiting.append([at, channels, row])
    out = []
    for at, channels, row in sorted(r for r in waiting if r[0] <= mark):
        first, widest = at if first is None else first, max(widest, channels)
        done = [*done[1 - REACH :], [at, row]]
        out.append(("[" + ",".join(r for _, r in done) + "]", first, widest))
    held[:] = first, widest, done, [r for r in waiting if r[0] > mark]
    return out


def _release(key, frames, state: GroupState):
    """New rows of one account (or its time-out) -> the rows that the watermark lets go, with what came before them."""
    held = json.loads(state.get[0]) if state.exists else [None, 0, [], []]
    came = (r for f in frames for r in zip(*(f[c].tolist() for c in ("_at", "_channels", "_row"))))
    out = [(key[0], *r) for r in _advance(held, came, state.getCurrentWatermarkMs())]
    state.update((json.dumps(held),))
    if held[3]:
        state.setTimeoutTimestamp(min(r[0] for r in held[3]))
    yield pd.DataFrame(out, columns=["_key", "_recent", "_first", "_widest"])


def _release_shared(key, frames, state: GroupState):
    """The same for all accounts of a shared state."""
    accounts, came = json.loads(state.get[0]) if state.exists else {}, {}
    for f in frames:
        for account, *row in zip(*(f[c].tolist() for c in ("_key", "_at", "_channels", "_row"))):
            if account is not None:
                came.setdefault(account, []).append(row)
    mark, out, nearest = state.getCurrentWatermarkMs(), [], None
    for account in {**accounts, **came}:
        held = accounts.setdefault(account, [None, 0, [], []])
        if account in came or held[3]:
            out += [(account, *r) for r in _advance(held, came.get(account, ()), mark)]
        if held[3]:
            nearest = min([r[0] for r in held[3]] + ([] if nearest is None else [nearest]))
    state.update((json.dumps(accounts),))
    if nearest is not None:
        state.setTimeoutTimestamp(nearest)
    if out:
        yield pd.DataFrame(out, columns=["_key", "_recent", "_first", "_widest"])


def recent_rows(stream: DataFrame, key: str = "account_id", period: str = "month", delay: str = DELAY, buckets: int | None = BUCKETS) -> DataFrame:
    """Stream of raw rows -> ``_recent`` (array of the account's last rows, the released one last), ``_first``
    (its first month), ``_widest`` (its largest number of channels so far); one row for each released row.  Accounts share
    ``buckets`` states; with None, for batches that bring few rows of few accounts, each has its own."""
    importable_on_workers(stream.sparkSession)
    at = F.col(period).cast("timestamp")
    rows = (
        stream.where(F.col(period).isNotNull())
        .select(F.col(key).cast("string").alias("_key"), F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets or 1)).cast("int").alias("_bucket"),
                at.alias("_time"), F.unix_millis(at).alias("_at"),
                F.expr(_CHANNELS).alias("_channels"), F.to_json(F.struct(*[q(c) for c in stream.columns]), _JSON).alias("_row"))
        .withWatermark("_time", delay)
    )
    released = rows.groupBy("_bucket" if buckets else "_key").applyInPandasWithState(
        _release_shared if buckets else _release, "_key string, _recent string, _first bigint, _widest int", "held string", "append", GroupStateTimeout.EventTimeTimeout)
    return released.where(F.col("_key").isNotNull()).select(
        F.from_json("_recent", T.ArrayType(stream.schema), _JSON).alias("_recent"),
        F.timestamp_millis("_first").alias("_first"), "_widest")


def _windows(metric: str, offset: float) -> list[str]:
    """The features of one metric over the array ``_recent`` (values as in ``features.rolling_exprs``)."""
    m, here, out = q(metric), f"get(_recent, size(_recent) - 1).{q(metric)}", []
    before = lambda k: f"get(_recent, size(_recent) - {1 + k}).{m}"
    for name, n, least in WINDOWS:
        seen = f"filter(slice(_recent.{m}, greatest(size(_recent) - {n - 1}, 1), {n}), x -> x IS NOT NULL)"
        total = f"aggregate({seen}, 0D, (a, x) -> a + x)"
        ok, mean = f"size({seen}) >= {least}", f"{total} / size({seen})"
        spread = f"aggregate(transform({seen}, x -> power(x - {mean}, 2)), 0D, (a, x) -> a + x)"
        out += [
            f"CASE WHEN {ok} THEN {total} END AS {q(f'{metric}_{name}_sum')}",
            f"CASE WHEN {ok} THEN try_divide({total}, size({seen})) END AS {q(f'{metric}_{name}_avg')}",
            f"CAST(CASE WHEN {ok} THEN array_max({seen}) END AS DOUBLE) AS {q(f'{metric}_{name}_max')}",
            f"CAST(CASE WHEN {ok} THEN array_min({seen}) END AS DOUBLE) AS {q(f'{metric}_{name}_min')}",
            f"try_divide({here}, CASE WHEN {ok} THEN try_divide({total}, size({seen})) END + {_dbl(offset)}) AS {q(f'{metric}_trend_{name}')}",
            f"CASE WHEN size({seen}) >= {max(2, least)} THEN sqrt(try_divide({spread}, size({seen}) - 1)) END AS {q(f'{metric}_volatility_{name}')}",
        ]
    change = lambda k: f"try_divide({before(k)} - {before(k + 1)}, {before(k + 1)})"
    out += [f"{change(0)} AS {q(metric + '_percent_change')}", f"{change(0)} - {change(1)} AS {q(metric + '_acceleration')}"]
    if metric in COMPARISON_METRICS:
        two = f"CASE WHEN coalesce({before(1)}, {before(2)}) IS NOT NULL THEN coalesce({before(1)}, 0) + coalesce({before(2)}, 0) END"
        out += [f"{here} AS {q(metric + '_30d')}", f"try_divide({here}, {two} + 1) AS {q(metric + '_recent_vs_historical')}"]
    return out


def features_of_recent(recent: DataFrame, period: str = "month", fill: bool = True) -> DataFrame:
    """The whole feature table (columns of ``features.generate_features``) of released rows, without a window or a shuffle."""
    raw = recent.schema["_recent"].dataType.elementType.names
    p = q(period)
    counts = f"transform(slice(_recent.enabled_channels, greatest(size(_recent) - 2, 1), 3), enabled_channels -> {_CHANNELS})"
    rows = recent.selectExpr("*", "inline(slice(_recent, -1, 1))").selectExpr("*", *channel_exprs()).selectExpr(
        "*", f"CAST({_CHANNELS} AS INT) AS number_of_channels",
        f"aggregate({counts}, 0D, (a, x) -> a + x) / least(size(_recent), 3) AS number_of_channels_avg_90d")
    out = rows.selectExpr(
        "*",
        f"CAST(floor(timestampdiff(MICROSECOND, CAST(last_touchbase_date AS TIMESTAMP_NTZ), CAST({p} AS TIMESTAMP_NTZ))"
        f" / 86400000000) AS BIGINT) AS days_since_last_contact",
        f"CAST((year({p}) - year(_first)) * 12 + (month({p}) - month(_first)) AS BIGINT) AS account_age_months",
        *[e for metric, offset in PANEL_METRICS for e in _windows(metric, offset)],
        "try_divide(number_of_channels, number_of_channels_avg_90d + 0.01D) AS channel_trend",
        "_widest AS max_channels_ever", "_widest - number_of_channels AS channels_dropped",
    ).selectExpr(*[q(c) for c in [*raw, *feature_names()]])
    return fill_numeric(out) if fill else out


def punctuation(spark: SparkSession, schema: T.StructType, after, key: str = "account_id", period: str = "month") -> DataFrame:
    """One row without an account whose month ``after`` moves the watermark; it is never released."""
    return spark.createDataFrame([tuple(after if f.name == period else None for f in schema.fields)],
                                 T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]))


def run_raw_stream(spark: SparkSession, source_dir: str, base_dir: str, schema: T.StructType, score, delay: str = DELAY) -> str:
    """Process the raw rows that have arrived in ``source_dir`` and stop; returns the sink folder.

    ``score`` maps the feature table to the rows written.  Progress and state lie below ``base_dir`` (shared storage): another
    call, also after a failure, goes on where the last one stopped."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    done = (
        score(features_of_recent(recent_rows(src, delay=delay)))
        .writeStream.format("parquet").option("path", f"{base_dir}/sink").option("checkpointLocation", f"{base_dir}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start()
    )
    done.awaitTermination()
    return f"{base_dir}/sink"
