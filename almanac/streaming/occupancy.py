"""Ward occupancy and waiting times from a stream of patient events.

Events: `event_id, visit_id, ward, kind (arrive | admit | discharge), ts`. The source is read
once, into an archive that gets every event; the stateful run reads the archive. There an
event that is repeated counts once, and an event that comes more than ten minutes after the
newest one of an earlier batch is dropped and counted (`late_events`).

State holds the first times of each open visit, dealt to buckets by visit, so a hot ward costs no more
than any other; a timer ends a visit half a day after its last event. Each batch stores what it changed: the new
events of a visit by kind, and the visit's times as they are now. A retried batch overwrites
its own folder, so sums over all batches count every event once.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

WATERMARK = "10 minutes"
# Time without events after which a visit's state is dropped.
IDLE_MS = 12 * 3600 * 1000
# State rows the open visits are dealt to, whatever their wards; a run keeps the number it started with.
BUCKETS = 256
KINDS = ("arrive", "admit", "discharge")
_CHANGES = (
    "visit_id string, ward string, arrivals bigint, admissions bigint, discharges bigint, "
    "arrived_us bigint, admitted_us bigint, closed boolean"
)
_STORES = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _first(kind: str) -> Column:
    return F.min(F.when(F.col("kind") == kind, F.col("ts")))


def _state(arrivals: Column, admissions: Column, discharges: Column) -> list[Column]:
    return [
        arrivals.alias("arrivals"),
        admissions.alias("admissions"),
        discharges.alias("discharges"),
        (admissions - discharges).alias("occupancy"),
        (arrivals - admissions).alias("waiting"),
    ]


def ward_counts(events: DataFrame) -> DataFrame:
    """Arrivals, admissions, discharges and the resulting state per ward."""
    return events.groupBy("ward").agg(*_state(*[F.count_if(F.col("kind") == k) for k in KINDS]))


def visit_times(events: DataFrame) -> DataFrame:
    """First arrival and admission per visit and day; a visit over midnight has two rows."""
    return events.groupBy(F.window("ts", "1 day").alias("day"), "visit_id", "ward").agg(
        _first("arrive").alias("arrived"), _first("admit").alias("admitted")
    )


def _merged(visits: DataFrame) -> DataFrame:
    return visits.groupBy("visit_id", "ward").agg(
        F.min("arrived").alias("arrived"), F.min("admitted").alias("admitted")
    )


def waits(visits: DataFrame) -> DataFrame:
    """Seconds from first arrival to first admission per visit, the rows of a visit merged."""
    seconds = F.timestamp_diff("SECOND", "arrived", "admitted")
    return _merged(visits).where("admitted >= arrived").select("visit_id", "ward", seconds.alias("wait_seconds"))


def admitted_first(visits: DataFrame) -> DataFrame:
    """Visits per ward that have no waiting time because they were admitted before they arrived."""
    odd = _merged(visits).where("admitted < arrived")
    return odd.groupBy("ward").agg(F.count(F.lit(1)).alias("visits_admitted_first"))


class VisitStates(StatefulProcessor):
    """The open visits of one bucket, kept as one Arrow table; a visit ends when nothing has come for `IDLE_MS`.

    One call handles all new events of the bucket, as a call per visit would cost far more
    than its work. A timer stands at the end of the visit that is idle longest.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._visits = handle.getValueState("visits", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = _summed(pd.concat([_summed(_by_kind(frame)) for frame in rows]))
        both = new if not self._visits.exists() else pd.concat([self._open(), new])
        kept = _summed(both[_KEY + _TIMES])
        self._keep(kept)
        yield _changes(new[_KEY + list(KINDS)].merge(kept, on=_KEY), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        visits = self._open()
        ended = visits["last"] // 1000 + IDLE_MS <= timerValues.getCurrentWatermarkInMs()
        self._keep(visits[~ended])
        yield _changes(visits[ended].assign(**dict.fromkeys(KINDS, 0)), True)

    def close(self) -> None:
        pass

    def _open(self) -> pd.DataFrame:
        return pa.ipc.open_stream(self._visits.get()[0]).read_pandas()

    def _keep(self, visits: pd.DataFrame) -> None:
        for timer in list(self._handle.listTimers()):
            self._handle.deleteTimer(timer)
        if visits.empty:
            self._visits.clear()
            return
        table = pa.Table.from_pandas(visits, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        self._visits.update((sink.getvalue().to_pybytes(),))
        self._handle.registerTimer(int(visits["last"].min()) // 1000 + IDLE_MS)


_KEY = ["visit_id", "ward"]
_TIMES = ["arrived", "admitted", "last"]


def _by_kind(frame: pd.DataFrame) -> pd.DataFrame:
    """A column per kind with ones, and the times of arrivals and admissions (microseconds, exact as doubles)."""
    at, kind = frame["us"].astype("float64"), frame["kind"]
    marks = {k: (kind == k).astype("int64") for k in KINDS}
    times = {"arrived": at.where(kind == "arrive"), "admitted": at.where(kind == "admit"), "last": at}
    return frame[_KEY].assign(**marks, **times)


def _summed(frame: pd.DataFrame) -> pd.DataFrame:
    """One row per visit and ward: counts added, first arrival and admission, last event."""
    how = {**dict.fromkeys(KINDS, "sum"), "arrived": "min", "admitted": "min", "last": "max"}
    how = {c: how[c] for c in frame.columns if c in how}
    return frame.groupby(_KEY, dropna=False, sort=False).agg(how).reset_index()


def _changes(visits: pd.DataFrame, closed: bool) -> pd.DataFrame:
    # plain Python texts, None for null: what the transfer to Spark takes in any mix
    out = pd.DataFrame({c: pd.Series([v if isinstance(v, str) else None for v in visits[c]], dtype=object) for c in _KEY})
    visits = visits.reset_index(drop=True)
    out[["arrivals", "admissions", "discharges"]] = visits[list(KINDS)]
    out["arrived_us"], out["admitted_us"] = visits["arrived"].astype("Int64"), visits["admitted"].astype("Int64")
    out["closed"] = closed
    return out


def visit_changes(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """What each batch of an event stream changes, a row per visit: new events by kind, and times so far.

    An event without an id counts once per visit, kind and time.
    """
    ident = F.coalesce("event_id", F.concat_ws("\n", F.lit(""), "visit_id", "ward", "kind", F.col("ts").cast("string")))
    once = (
        events.withColumn("event_id", ident)
        .withWatermark("ts", WATERMARK)
        .dropDuplicatesWithinWatermark(["event_id"])
        .withColumns({"us": F.unix_micros("ts"), "bucket": F.pmod(F.xxhash64("visit_id", "ward"), F.lit(buckets))})
    )
    changes = once.groupBy("bucket").transformWithStateInPandas(
        VisitStates(), outputStructType=_CHANGES, outputMode="Append", timeMode="EventTime"
    )
    times = {c: F.timestamp_micros(f"{c}_us") for c in ("arrived", "admitted")}
    return changes.withColumns(times).drop("arrived_us", "admitted_us")


class LateCounter(StreamingQueryListener):
    """Sums what every progress event of every run says was dropped by the watermark."""

    def __init__(self) -> None:
        self._dropped: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        with self._lock:
            run_id = str(progress.runId)
            self._dropped[run_id] = self._dropped.get(run_id, 0) + dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def total(self, run_id: str, seconds: float = 60) -> int:
        """The sum of a run that has ended; its last events may still be on their way."""
        if not self._end(run_id).wait(seconds):
            raise TimeoutError(f"no end of run {run_id} reported")
        with self._lock:
            return self._dropped.get(run_id, 0)


_COUNTERS: dict[int, LateCounter] = {}


def _counter(spark: SparkSession) -> LateCounter:
    """The listener of a session's context, added once."""
    key = id(spark.sparkContext)
    if key not in _COUNTERS:
        _COUNTERS[key] = LateCounter()
        spark.streams.addListener(_COUNTERS[key])
    return _COUNTERS[key]


def start_occupancy(
    spark: SparkSession, events: DataFrame, out: str, checkpoint: str
) -> list[StreamingQuery]:
    """Archive the events of a stream that are new, then start the stateful run over the archive.

    Returns both runs. Each stops when its input is used up; started again with the same
    folders they go on where they stopped.
    """
    _counter(spark)
    archive = (
        events.withColumn("day", F.to_date("ts"))
        .writeStream.partitionBy("day").format("parquet")
        .option("path", f"{out}/archive")
        .option("checkpointLocation", f"{checkpoint}/archive")
        .trigger(availableNow=True)
        .start()
    )
    archive.awaitTermination()

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/visits/batch={batch_id}")

    archived = spark.readStream.schema(f"{_ddl(events)}, day date").parquet(f"{out}/archive").drop("day")
    before = spark.conf.get(_STORES)
    spark.conf.set(_STORES, _ROCKS)  # state with timers needs it; a run keeps the setting it starts with
    try:
        visits = (
            visit_changes(archived)
            .writeStream.outputMode("append")
            .foreachBatch(store)
            .option("checkpointLocation", f"{checkpoint}/visits")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(_STORES, before)
    return [archive, visits]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def current_wards(spark: SparkSession, out: str) -> DataFrame:
    """The state of each ward after all stored batches."""
    changes = spark.read.parquet(f"{out}/visits").groupBy("ward")
    return changes.agg(*_state(F.sum("arrivals"), F.sum("admissions"), F.sum("discharges")))


def current_waits(spark: SparkSession, out: str) -> DataFrame:
    """Waiting times; minima only ever fall, so the smallest stored time of a visit is the newest."""
    return waits(spark.read.parquet(f"{out}/visits"))


def ward_report(spark: SparkSession, out: str) -> DataFrame:
    """Current state per ward with the mean waiting time of admitted visits."""
    mean = current_waits(spark, out).groupBy("ward").agg(
        F.count(F.lit(1)).alias("visits_admitted"), F.avg("wait_seconds").alias("mean_wait_seconds")
    )
    return current_wards(spark, out).join(mean, "ward", "left")


def late_events(run: StreamingQuery) -> int:
    """Events of a finished run of this session that came after the watermark, over all its batches."""
    return _COUNTERS[id(SparkSession.active().sparkContext)].total(str(run.runId))
