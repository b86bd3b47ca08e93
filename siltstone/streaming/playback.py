"""Playback events: parse JSON, keep alerts, append them, and send digests per two-minute window.

The transformations take and return DataFrames and work on a stream and on a batch alike; the functions at
the end start streaming queries. Kafka and a folder of text files both deliver a `value` column.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.dates import RUN_ZONE, run_date
from ..sources.schemas import PLAYBACK_EVENTS, required_columns

# What counts as an alert, the window length, and the wire format of timestamps.
ERROR_EVENT = "error"
BUFFER_LIMIT_MS = 4000
ALERT_WINDOW = "2 minutes"
# Messages a window's alerts are dealt to.
DIGEST_PARTS = 8
WINDOW_MS = 120_000
# When a message came in, where the source tells: the broker's time, or that of its file.
ARRIVED = "arrived"
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"

REQUIRED = tuple(required_columns(PLAYBACK_EVENTS))

# A message has the table's columns but the ingestion date.
_WIRE_SCHEMA = T.StructType([f for f in PLAYBACK_EVENTS if f.name != "run_date"]).add("_corrupt_record", T.StringType())
# The parser must see fields that may be missing, or it would drop the whole message.
_WIRE_SCHEMA = T.StructType([T.StructField(f.name, f.dataType) for f in _WIRE_SCHEMA])


# ---- transformations -------------------------------------------------------------------------------


def to_messages(events: DataFrame) -> DataFrame:
    """Each row as one JSON message in `value`."""
    row = F.struct(*events.columns)
    return events.select(F.to_json(row, {"timestampNTZFormat": TIMESTAMP_PATTERN}).alias("value"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Message bytes or text to columns, with `is_valid`: false for malformed JSON, a field of the wrong
    type, or a missing required field. The raw message is kept in `value`."""
    text = F.col("value").cast("string")
    options = {"timestampNTZFormat": TIMESTAMP_PATTERN, "mode": "PERMISSIVE"}
    # A generator, so that the filters on validity do not repeat the parse (see `operators.frames`).
    kept = [F.col(c) for c in (ARRIVED,) if c in messages.columns]
    parsed = messages.select(text.alias("value"), *kept).select(
        "value", *kept, F.inline_outer(F.array(F.from_json("value", _WIRE_SCHEMA, options)))
    )
    valid = F.col("_corrupt_record").isNull()
    for name in REQUIRED:
        valid = valid & F.col(name).isNotNull()
    return parsed.withColumn("is_valid", valid).drop("_corrupt_record")


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_valid").drop("value", "is_valid")


def malformed_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where("not is_valid").select("value")


def is_alert(event_type: Column, buffer_ms: Column) -> Column:
    """An error, or buffering beyond the limit; a missing buffer time counts as 0."""
    is_error = F.coalesce(event_type == ERROR_EVENT, F.lit(False))
    return is_error | (F.coalesce(buffer_ms.cast("bigint"), F.lit(0)) > BUFFER_LIMIT_MS)


def playback_alerts(events: DataFrame, instant: Column | None = None) -> DataFrame:
    """Alert rows with their ingestion date: the Jakarta date of `instant`, by default the current time."""
    alerts = events.where(is_alert(F.col("event_type"), F.col("buffer_duration_ms")))
    return alerts.withColumn("run_date", run_date(instant))


def alert_windows(alerts: DataFrame, time_column: str = "event_timestamp", delay: str | None = None) -> DataFrame:
    """Number of alerts per non-empty tumbling window; set `delay` (the allowed lateness) on a stream.

    On a stream a window's count comes when it closes, and alerts that come later give a further row of their window:
    a window's rows add up to the count that a batch gives.
    """
    if delay is not None:
        return closed_windows(alerts, time_column, delay, parts=1, listed=False).select("window_start", "window_end", "n_alerts")
    windows = alerts.groupBy(F.window(time_column, ALERT_WINDOW).alias("w")).agg(F.count(F.lit(1)).alias("n_alerts"))
    return windows.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"),
        "n_alerts",
    )


# The text of a digest's lines and headline.
def _line() -> Column:
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("None"))

    return F.concat(
        F.lit("- User "),
        shown("user_id"),
        F.lit(" Movie "),
        shown("movie_id"),
        F.lit(" Event "),
        shown("event_type"),
        F.lit(" Buffer "),
        F.coalesce(F.col("buffer_duration_ms"), F.lit(0)).cast("string"),
        F.lit("ms\n"),
    )


def _headline(window_end: Column, total: Column) -> Column:
    local = F.convert_timezone(F.lit("UTC"), F.lit(RUN_ZONE), window_end.cast("timestamp_ntz"))
    sent = F.substring(local.cast("string"), 1, 19)
    return F.concat(F.lit("⚠️ "), sent, F.lit(" - "), total.cast("string"), F.lit(" alerts\n"))


def _part(parts: int) -> Column:
    """Message of a window that an alert goes to: by its number, or by its line where it has none."""
    number = F.coalesce(F.col("event_id").cast("bigint"), F.crc32(F.col("line").cast("binary")))
    return F.pmod(number, F.lit(parts).cast("bigint"))


def alert_digest(alerts: DataFrame, time_column: str = "event_timestamp", parts: int = DIGEST_PARTS) -> DataFrame:
    """Messages per non-empty window that list its alerts in order of time.

    Alerts are dealt to `parts` messages by their event number, the same way in every window, whatever its size; a
    part without alerts gives no message, and each headline counts its own message's alerts. Equal lines are
    counted before they are shuffled.
    """
    lines = alerts.select(F.window(time_column, ALERT_WINDOW).alias("w"), F.col(time_column).alias("at"), "event_id", _line().alias("line"))
    lines = lines.withColumn("part", _part(parts))
    counted = lines.groupBy("w", "part", "at", "event_id", "line").agg(F.count(F.lit(1)).alias("n"))
    ordered = F.sort_array(F.collect_list(F.struct("at", "event_id", "line", "n")))
    body = F.array_join(F.transform(ordered, lambda x: F.repeat(x["line"], x["n"].cast("int"))), "")
    grouped = counted.groupBy("w", "part").agg(F.sum("n").alias("total"), body.alias("body"))
    return grouped.select(
        F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        (F.col("part") + 1).alias("part"),
        F.concat(_headline(F.col("w.end"), F.col("total")), F.col("body")).alias("message"),
    )


# ---- windows that a stream closes ------------------------------------------------------------------

_CLOSED = "start_ms long, part long, late boolean, n_alerts long, body string"
_HELD = "n long, at array<long>, event_id array<long>, line array<string>"


def _window_state(listed: bool) -> Callable:
    """One (window, part): holds its alerts until the watermark passes the window's end, then gives one row.

    Alerts that find their window closed give a row of their own at once.
    """

    def held_rows(frames: Iterator[pd.DataFrame]) -> tuple[int, list[tuple]]:
        n, rows = 0, []
        for frame in frames:
            there = frame[frame["line"].notna()]
            n += len(there)
            if listed:
                numbers = (None if pd.isna(x) else int(x) for x in there["event_id"])
                rows += zip((int(x) for x in there["at"]), numbers, there["line"], strict=True)
        return n, rows

    def row(key: tuple, late: bool, n: int, rows: list[tuple]) -> pd.DataFrame:
        ordered = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2].encode()))
        return pd.DataFrame({"start_ms": [key[0]], "part": [key[1]], "late": [late], "n_alerts": [n], "body": ["".join(r[2] for r in ordered)]})

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        key = tuple(int(k) for k in key)
        old = state.get if state.exists else None
        n, rows = (old[0], list(zip(*old[1:], strict=True))) if old else (0, [])
        if state.hasTimedOut:
            state.remove()
            yield row(key, False, n, rows)
            return
        more, new = held_rows(frames)
        if not more:
            return
        n, rows, end = n + more, rows + new, key[0] + WINDOW_MS
        if state.getCurrentWatermarkMs() >= end:
            if old:
                state.remove()
            yield row(key, old is None, n, rows)
            return
        columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], []]
        state.update((n, *columns))
        state.setTimeoutTimestamp(end)

    return step


def closed_windows(
    alerts: DataFrame, time_column: str = "event_timestamp", delay: str = "0 seconds", parts: int = DIGEST_PARTS, listed: bool = True
) -> DataFrame:
    """window_start, window_end, part, late, n_alerts, body: one row per non-empty (window, part) of a stream, however its
    micro-batches fall, given out when the watermark (the latest time seen less `delay`) passes the window's end.

    What arrives for a window after that gives a further row with `late`, one per micro-batch, so no alert is lost.
    Spark leaves out rows behind the watermark at a stateful operator's input; so each alert is sent twice, as a tick that
    moves the watermark and as a row without a time of its own. What a window holds is in the state store: a restart in
    mid-window goes on with it.
    """
    at = F.col(time_column).cast("timestamp")
    lines = alerts.select(at.alias("moment"), "event_id", _line().alias("line")).where("moment is not null").withColumn("part", _part(parts))
    start = F.unix_millis(F.window("moment", ALERT_WINDOW)["start"])
    rows = lines.select(start.alias("start_ms"), "part", F.unix_micros("moment").alias("at"), "event_id", "line", "moment")
    empty = {"at": "bigint", "event_id": "bigint", "line": "string"}
    tick = F.struct("moment", *(F.lit(None).cast(t).alias(c) for c, t in empty.items()))
    alert = F.struct(F.lit(None).cast("timestamp").alias("moment"), *(F.col(c).cast(t).alias(c) for c, t in empty.items()))
    both = rows.select("start_ms", "part", F.explode(F.array(tick, alert)).alias("x")).select("start_ms", "part", "x.*")
    found = (
        both.withWatermark("moment", delay)
        .groupBy("start_ms", "part")
        .applyInPandasWithState(_window_state(listed), _CLOSED, _HELD, "append", GroupStateTimeout.EventTimeTimeout)
    )
    begins = F.timestamp_millis("start_ms")
    return found.select(
        begins.cast("timestamp_ntz").alias("window_start"),
        F.timestamp_millis(F.col("start_ms") + WINDOW_MS).cast("timestamp_ntz").alias("window_end"),
        (F.col("part") + 1).alias("part"), "late", "n_alerts", "body",
    )


def window_messages(windows: DataFrame) -> DataFrame:
    """window_start, part, late, message of closed windows."""
    message = F.concat(_headline(F.col("window_end"), F.col("n_alerts")), F.col("body"))
    return windows.select("window_start", "part", "late", message.alias("message"))


# ---- messages that come again ----------------------------------------------------------------------

# How an alert came: for the first time, again, or for a time so long ago that the ids of then are forgotten.
FIRST, AGAIN, OLD = "first", "again", "old"
_SLOT_MS = 600_000


def _delivery_state(keep_ms: int) -> Callable:
    """One (time slot, bucket of ids): holds the ids it has seen until the watermark passes the slot's end by `keep_ms`."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        ends = int(key[0]) + _SLOT_MS + keep_ms
        forgotten = state.getCurrentWatermarkMs() >= ends
        seen = set(state.get[0]) if state.exists else set()
        size = len(seen)
        for frame in frames:
            there = frame[frame["payload"].notna()]
            said = []
            for number in there["number"]:
                if forgotten:
                    said.append(OLD)
                    continue
                said.append(AGAIN if int(number) in seen else FIRST)
                seen.add(int(number))
            yield pd.DataFrame({"payload": there["payload"].tolist(), "delivery": said}, dtype="object")
        if not forgotten and len(seen) > size:
            state.update((sorted(seen),))
            state.setTimeoutTimestamp(ends)

    return step


def deliveries(alerts: DataFrame, time_column: str = "event_timestamp", keep: str = "1 hour", buckets: int = 64) -> DataFrame:
    """The alerts of a stream with `delivery`: `first`, `again` for an event number that came before with the same time slot, or
    `old` where the watermark has passed the slot by `keep`, so that its numbers are no longer known. No row is dropped.

    A topic may deliver a message twice; the number and the time of an event are the same each time. Numbers are held per
    slot of ten minutes and bucket, in the state store, for `keep` of event time. An alert without a number or a time cannot be
    told from others and counts as first.
    """
    at = F.col(time_column).cast("timestamp")
    known = F.col("event_id").isNotNull() & at.isNotNull()
    rows = alerts.select(at.alias("moment"), F.col("event_id").cast("bigint").alias("number"), F.to_json(F.struct(*alerts.columns)).alias("payload"), known.alias("known"))
    slot = F.floor(F.unix_millis("moment") / _SLOT_MS) * _SLOT_MS
    keyed = rows.where("known").select(slot.cast("bigint").alias("slot"), F.pmod(F.xxhash64("number"), F.lit(buckets).cast("bigint")).alias("bucket"), "moment", "number", "payload")
    # As for windows: a tick moves the watermark, the row itself has no time and is never left out as late.
    tick = F.struct("moment", F.lit(None).cast("bigint").alias("number"), F.lit(None).cast("string").alias("payload"))
    alert = F.struct(F.lit(None).cast("timestamp").alias("moment"), "number", "payload")
    both = keyed.select("slot", "bucket", F.explode(F.array(tick, alert)).alias("x")).select("slot", "bucket", "x.*")
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    told = (
        both.withWatermark("moment", "0 seconds")
        .groupBy("slot", "bucket")
        .applyInPandasWithState(_delivery_state(keep_ms), "payload string, delivery string", "ids array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    )
    unknown = rows.where("not known").select("payload", F.lit(FIRST).alias("delivery"))
    return told.unionByName(unknown).select(F.from_json("payload", alerts.schema).alias("x"), "delivery").select("x.*", "delivery")


def start_alerts_once(messages: DataFrame, path: str, checkpoint: str, keep: str = "1 hour", drain: bool = False) -> StreamingQuery:
    """Append alerts to Parquet by delivery and ingestion date: `delivery=first` has every alert once, however often its message came."""
    writer = (
        deliveries(alert_rows(messages).drop(ARRIVED), keep=keep)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("delivery", "run_date")
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


# ---- queries ---------------------------------------------------------------------------------------


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of messages from a folder of text files, one message a line, with the time of their file."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value", F.col("_metadata.file_modification_time").alias(ARRIVED))


def read_kafka(spark: SparkSession, servers: str, topic: str, max_messages: int | None = None) -> DataFrame:
    """Stream of messages from Kafka; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if max_messages is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_messages)
    return reader.load().select("value", F.col("timestamp").alias(ARRIVED))


def alert_rows(messages: DataFrame) -> DataFrame:
    """Alerts among messages, with their ingestion date and, where the source tells it, their time of arrival."""
    return playback_alerts(valid_events(parse_messages(messages)))


def start_alert_table(messages: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Append alerts to Parquet, partitioned by ingestion date.

    With `drain`, process what is there in bounded batches and stop: the pull-and-acknowledge mode, the
    checkpoint being the acknowledgement.
    """
    writer = (
        alert_rows(messages).drop(ARRIVED)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("run_date")
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def start_quarantine(messages: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Append malformed messages, as they came, to text files."""
    writer = (
        malformed_messages(parse_messages(messages))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_digests(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    parts: int = DIGEST_PARTS,
    every: str = ALERT_WINDOW,
    drain: bool = False,
    time_column: str = "event_timestamp",
    delay: str = "0 seconds",
) -> StreamingQuery:
    """Write one message per window and part when the window closes, and a follow-up for alerts that come later.

    Windows are of `time_column`: when an event happened, or `ARRIVED`, when its message came in. A window that is still
    open at the end of a drain stays in the checkpoint's state and is closed by a later run. A batch that is run again
    overwrites its own folder, which carries the stream's id, so a digest is not written twice and a stream with a new checkpoint
    does not touch an earlier one's.
    """
    windows = closed_windows(alert_rows(messages), time_column, delay, parts)

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            window_messages(batch)
            .withColumn("stream", F.lit(_stream_id(batch.sparkSession, checkpoint)))
            .withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("stream", "batch_id")
            .parquet(path)
        )

    writer = windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)).start()
