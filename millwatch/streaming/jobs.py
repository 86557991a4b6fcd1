"""Structured Streaming jobs that give the results of the batch operators."""

from __future__ import annotations

import pickle
import threading
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millwatch.operators import stream_rules as D
from millwatch.operators.alerts import COOLDOWN_SECONDS
from millwatch.session import ship

ROWS_AT_ONCE = 20_000


def with_event_time(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Give the stream a watermark; times without a zone are taken in the session zone."""
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)


# --- stateful z-score -------------------------------------------------------------


def recent_statistics(past: np.ndarray, new: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and population deviation of the last ``window`` values up to each new one."""
    series = np.concatenate([np.full(window - 1, np.nan), past[-(window - 1):] if window > 1 else past[:0], new])
    series = series[len(series) - len(new) - window + 1:]
    return statistics_at(series, np.arange(window - 1, len(series)), np.full(len(series), window), window)


def statistics_at(series: np.ndarray, places: np.ndarray, rank: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and population deviation of the last ``window`` values up to some places of series laid end to end.

    ``rank`` gives how many values of its own series stand before each value.
    """
    frames = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(window - 1, np.nan), series]), window)
    counts, means, spreads = [], [], []
    for start in range(0, len(places), ROWS_AT_ONCE):
        at = places[start:start + ROWS_AT_ONCE]
        part = frames[at]
        part[np.arange(window - 1, -1, -1) > rank[at, None]] = np.nan
        n = np.count_nonzero(~np.isnan(part), axis=1)
        mean = np.nansum(part, axis=1) / n
        spread = np.sqrt(np.nansum((part - mean[:, None]) ** 2, axis=1) / n)
        counts.append(n), means.append(mean), spreads.append(spread)
    return np.concatenate(counts), np.concatenate(means), np.concatenate(spreads)


#: The state store that ``transformWithStateInPandas`` needs; it keeps state on disk.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows of a key that arrive in more than one part are put aside by slices of so many microseconds.
SLICE_US = 60_000_000
#: Keys are dealt into so many lots, each with one state: a call per lot costs milliseconds, one per key would too.
LOTS = 2048
#: Rows of a lot that are held at once; of a lot with more, time slices.
LOT_ROWS = 250_000
LOT_SLICES = 256
_LOT = "_lot"


class ZScores(StatefulProcessor):
    """Per key: the last ``window`` values as a list, rows put aside by time as a map, the last time seen as a value.

    The rows of a key in a micro-batch come in parts of bounded size and in no order. A single part is put in
    order and scored. Of several, all are put aside by time slice as they come, and the slices are
    scored one after the other: memory holds a part or a slice, never a key's whole micro-batch.
    """

    def __init__(self, order: list[str], window: int, threshold: float, min_count: int, cold_start: str, idle_ms: int, ttl_ms: int) -> None:
        self.order, self.window, self.threshold, self.min_count, self.cold_start = order, window, threshold, min_count, cold_start
        self.idle_ms, self.ttl_ms = idle_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lifetime = {"ttlDurationMs": self.ttl_ms} if self.ttl_ms else {}
        self.values = handle.getListState("values", "value double", **lifetime)
        self.aside = handle.getMapState("aside", "slice long, part int", "rows binary")
        if self.idle_ms:
            self.seen = handle.getValueState("seen", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        past = np.array([v[0] for v in self.values.get()], dtype="float64")
        last, first, slices = None, next(rows), {}
        for part, more in enumerate(rows):
            if first is not None:
                self._put(first, -1, slices)
                first = None
            self._put(more, part, slices)
        parts = [first] if first is not None else (self._take(s, slices[s]) for s in sorted(slices))
        for one in parts:
            scored, past = self._scored(one.sort_values(self.order, kind="stable"), past)
            last = scored["timestamp"].iloc[-1]
            yield scored
        self.values.put([(float(v),) for v in past])
        if self.idle_ms:
            ms = max(int(last.timestamp() * 1000), timerValues.getCurrentWatermarkInMs())
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.seen.update((ms,))
            self.handle.registerTimer(ms + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists() and self.seen.get()[0] + self.idle_ms <= expiredTimerInfo.getExpiryTimeInMs():
            self.values.clear()
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass

    def _put(self, rows: pd.DataFrame, part: int, slices: dict[int, list[int]], width: int = SLICE_US) -> None:
        """Rows aside in the state, by slice of their time."""
        at = rows[self.order[0]].to_numpy().astype("datetime64[us]").astype("int64") // width
        for s in np.unique(at):
            self.aside.updateValue((int(s), part), (pickle.dumps(rows[at == s]),))
            slices.setdefault(int(s), []).append(part)

    def _take(self, s: int, parts: list[int]) -> pd.DataFrame:
        found = []
        for part in parts:
            found.append(pickle.loads(self.aside.getValue((s, part))[0]))
            self.aside.removeKey((s, part))
        return pd.concat(found)

    def _scored(self, rows: pd.DataFrame, past: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
        values = rows["value"].to_numpy(dtype="float64")
        return self._judged(rows, values, *recent_statistics(past, values, self.window)), np.concatenate([past, values])[-self.window:]

    def _judged(self, rows: pd.DataFrame, values: np.ndarray, n: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> pd.DataFrame:
        with np.errstate(divide="ignore", invalid="ignore"):
            warm = np.where(spread > 0, np.abs(values - mean) / spread, 0.0)
        early = np.abs(values) if self.cold_start == "unit" else np.zeros(len(values))
        z = np.where(n >= self.min_count, warm, early)
        flagged = z > self.threshold
        return rows.assign(z_score=z, is_anomaly=flagged, anomaly_confidence=np.where(flagged, np.minimum(z / self.threshold, 1.0), 0.0))


class ZScoreLots(ZScores):
    """``ZScores`` over lots of keys: the last values of a lot's keys are one state, and its rows are scored together.

    A lot's rows in a micro-batch are held up to ``at_once`` rows. Of a larger lot, rows are put aside by time slices
    whose width is cut from the first rows held, and the slices are scored one after the other.
    """

    def __init__(self, keys: list[str], order: list[str], window: int, threshold: float, min_count: int, cold_start: str, at_once: int = LOT_ROWS) -> None:
        super().__init__(order, window, threshold, min_count, cold_start, 0, 0)
        self.keys, self.at_once = keys, at_once

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", "packed binary")
        self.aside = handle.getMapState("aside", "slice long, part int", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        past, held, size, slices, width = self._unpacked(), [], 0, {}, None
        for part, more in enumerate(rows):
            held.append(more)
            size += len(more)
            if size > self.at_once:
                width = width or self._width(held)
                self._put(pd.concat(held), part, slices, width)
                held, size = [], 0
        if slices and held:
            self._put(pd.concat(held), part + 1, slices, width)
        parts = (self._take(s, slices[s]) for s in sorted(slices)) if slices else [pd.concat(held)]
        for one in parts:
            scored, past = self._scored(one.sort_values(self.order, kind="stable", na_position="first"), past)
            yield scored
        self._pack(past)

    def _width(self, held: list[pd.DataFrame]) -> int:
        times = pd.concat([rows[self.order[0]] for rows in held])
        span = (times.max() - times.min()) / pd.Timedelta(microseconds=1)
        return max(int(span / LOT_SLICES), 1) if span == span else SLICE_US

    def _scored(self, rows: pd.DataFrame, past: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Rows in order with their scores, and the last values of each key in order."""
        both = pd.concat([past, rows[[*self.keys, "value"]]], ignore_index=True) if len(past) else rows[[*self.keys, "value"]]
        number = both.groupby(self.keys, sort=False, dropna=False).ngroup().to_numpy()
        at = np.argsort(number, kind="stable")  # what is past stays before what is new
        sizes = np.bincount(number)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        values = both["value"].to_numpy(dtype="float64")[at]
        new = np.flatnonzero(at >= len(past))
        scored = self._judged(rows.iloc[at[new] - len(past)], values[new], *statistics_at(values, new, rank, self.window))
        return scored, both.iloc[at[np.repeat(sizes, sizes) - rank < self.window]]

    def _pack(self, past: pd.DataFrame) -> None:
        """The state of the lot: a row per key with the list of its last values."""
        first = np.flatnonzero(~past.duplicated(self.keys).to_numpy())
        lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(past)], "int32"), pa.array(past["value"].to_numpy(dtype="float64")))
        packed = pa.Table.from_pandas(past[self.keys].iloc[first], preserve_index=False).append_column("value", lists)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, packed.schema) as out:
            out.write_table(packed)
        self.recent.update((sink.getvalue().to_pybytes(),))

    def _unpacked(self) -> pd.DataFrame:
        if not self.recent.exists():
            return pd.DataFrame(columns=[*self.keys, "value"])
        packed = pa.ipc.open_stream(bytes(self.recent.get()[0])).read_all()
        lists = packed.column("value").combine_chunks()
        keys = packed.select(self.keys).to_pandas()
        return keys.iloc[np.repeat(np.arange(len(keys)), lists.value_lengths().to_numpy())].assign(value=lists.flatten().to_numpy())


def stream_zscore(
    df: DataFrame,
    keys: Sequence[str] = D.READING_KEY,
    order: Sequence[str] = D.READING_ORDER,
    window: int = D.Z_WINDOW,
    threshold: float = D.Z_THRESHOLD,
    min_count: int = D.Z_MIN_COUNT,
    cold_start: str = "unit",
    idle: str | None = None,
    ttl: str | None = None,
) -> DataFrame:
    """``zscore_anomaly`` on a stream: each key keeps its last values as state.

    Rows of one key are put in order inside a micro-batch and the state carries across
    them. ``idle`` (needs a watermark) forgets a key that stays silent that long in event time, by a
    timer; ``ttl`` forgets values that long after they were last written, by the clock: such a stream goes on with
    micro-batches until it is stopped, whatever its trigger. One of them at most.
    Both forget by key, so they keep a state per key; without them keys share a state by lots, which takes
    far less time with many keys. A checkpoint goes on with the form it was begun in.
    Sets the session's state store to the one that this needs.
    """
    if idle and ttl:
        raise ValueError("either idle or ttl")
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    shape = T.StructType([*df.schema.fields, T.StructField("z_score", T.DoubleType()),
                          T.StructField("is_anomaly", T.BooleanType()), T.StructField("anomaly_confidence", T.DoubleType())])
    idle_ms, ttl_ms = (int(pd.Timedelta(t).total_seconds() * 1000) if t else 0 for t in (idle, ttl))
    rows = D.complete(df, list(keys))
    ship(df.sparkSession)
    if not (idle or ttl):
        lots = rows.withColumn(_LOT, F.pmod(F.xxhash64(*keys), F.lit(LOTS)).cast("int")).groupBy(_LOT)
        return lots.transformWithStateInPandas(ZScoreLots(list(keys), list(order), window, threshold, min_count, cold_start), shape, "Append", "None")
    processor = ZScores(list(order), window, threshold, min_count, cold_start, idle_ms, ttl_ms)
    return rows.groupBy(*keys).transformWithStateInPandas(processor, shape, "Append", "EventTime" if idle else "ProcessingTime")


# --- alert cool-down --------------------------------------------------------------


def stream_cooldown(alerts: DataFrame, scope: Sequence[str] = ("rule",), order: Sequence[str] = ("timestamp", "alert_id"),
                    seconds: int = COOLDOWN_SECONDS) -> DataFrame:
    """``cooldown`` on a stream: the time of the last firing of each scope is the state."""
    order, gap = list(order), np.timedelta64(seconds, "s")

    def keep(_key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values(order, kind="stable")
        times = rows[order[0]].to_numpy().astype("datetime64[us]")
        earliest = np.datetime64(state.get[0], "us") + gap if state.exists else times[0]
        picked, i = [], int(np.searchsorted(times, earliest, side="left"))
        while i < len(times):
            picked.append(i)
            i = int(np.searchsorted(times, times[i] + gap, side="left"))
        if picked:
            state.update((int(times[picked[-1]].astype("int64")),))
        yield rows.iloc[picked]

    return alerts.groupBy(*scope).applyInPandasWithState(
        keep, alerts.schema, "last_us long", "append", GroupStateTimeout.NoTimeout)


# --- windows and sessions ---------------------------------------------------------


def stream_sessions(df: DataFrame, gap: str, keys: Sequence[str] = ("equipment_id",)) -> DataFrame:
    """Operating sessions by event time; a session is final once the watermark passes it."""
    return df.groupBy(*keys, F.session_window("timestamp", gap).alias("s")).agg(
        F.min("timestamp").alias("session_start"), F.max("timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("readings"), F.sum("value").alias("total"),
    ).drop("s")


class LateRows(StreamingQueryListener):
    """Counts rows that came after the watermark and so were left out, of every micro-batch of every query.

    A query only remembers its last hundred micro-batches; this adds up all from the time it is
    registered, under the query's id, which a restart from the same checkpoint keeps.
    """

    def __init__(self) -> None:
        self.totals: Counter[str] = Counter()
        self.batches: Counter[str] = Counter()
        self.ended: set[str] = set()
        self.told = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.told:
            progress = event.progress
            self.totals[str(progress.id)] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            self.batches[str(progress.id)] += 1

    def onQueryTerminated(self, event) -> None:
        with self.told:
            self.ended.add(str(event.runId))
            self.told.notify_all()

    def total(self, query: StreamingQuery, seconds: float = 60.0) -> int:
        """Late rows of the query so far; of one that has ended, once its last events have come in."""
        with self.told:
            if not query.isActive and not self.told.wait_for(lambda: str(query.runId) in self.ended, seconds):
                raise TimeoutError("the end of the query has not been told")
            return self.totals[str(query.id)]


def count_late_rows(spark: SparkSession) -> LateRows:
    """Register a counter before queries start; ``spark.streams.removeListener`` takes it off."""
    counter = LateRows()
    spark.streams.addListener(counter)
    return counter


# --- the alert job ----------------------------------------------------------------


def write_once(df: DataFrame, path: str, batch_id: int) -> None:
    """Write a micro-batch under its number; a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def alert_job(readings: DataFrame, path: str, checkpoint: str, window: str = "1 day",
              confidence: float = D.ALERT_CONFIDENCE, health: float = D.ALERT_HEALTH, **trigger) -> StreamingQuery:
    """Readings to alerts: stateful z-scores, then health and alerts per micro-batch."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()  # read twice: without this the stateful step would run twice
        try:
            scored = D.multisensor_health(kept, window)
            alerts = D.stream_alerts(scored, confidence, health, data=["reading_id", "sensor_type", "value", "z_score"])
            write_once(alerts, path, batch_id)
        finally:
            kept.unpersist()

    return for_each_batch(stream_zscore(readings), handle, checkpoint, **trigger)


def for_each_batch(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Run a function on every micro-batch; by default all input there is, then stop."""
    return (
        df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def to_parquet(df: DataFrame, path: str, checkpoint: str, partitions: Sequence[str] = (), **trigger) -> StreamingQuery:
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partitions:
        writer = writer.partitionBy(*partitions)
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def threshold_job(envelopes: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Encoded envelopes to typed, judged and stored readings, partitioned by date."""
    from millwatch.sources.lake import date_parts
    from millwatch.sources.readings import decode_envelopes

    judged = D.threshold_health(decode_envelopes(envelopes)).drop("metadata")
    return to_parquet(date_parts(judged), path, checkpoint, ["year", "month", "day"], **trigger)


def score_stream(df: DataFrame, model) -> DataFrame:
    """Model predictions on a stream; the confidence is the model's own probability."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df)
    if "probability" in out.columns:
        out = out.withColumn("confidence", F.array_max(vector_to_array("probability")))
    return out


def await_done(query: StreamingQuery, seconds: float | None = 600.0) -> StreamingQuery:
    """Wait for a bounded run (``None``: as long as it takes); an unfinished or failed one raises."""
    if not query.awaitTermination(None if seconds is None else int(seconds)) and seconds is not None:
        query.stop()
        raise TimeoutError(f"stream not done after {seconds} s")
    return query
