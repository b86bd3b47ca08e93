from __future__ import annotations

import datetime as dt
import json
import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from support import values

from siltstone.streaming import playback

START = dt.datetime(2024, 1, 1)


def event(number: int, seconds: int, kind: str = "error", buffer_ms: int | None = 10) -> dict:
    return {
        "event_id": number,
        "session_id": 1,
        "user_id": number % 7,
        "movie_id": 5,
        "event_type": kind,
        "event_timestamp": str(START + dt.timedelta(seconds=seconds)),
        "buffer_duration_ms": buffer_ms,
    }


def write_messages(folder, name: str, events: list) -> None:
    folder.mkdir(exist_ok=True)
    lines = [e if isinstance(e, str) else json.dumps(e) for e in events]
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.mark.parametrize(
    ("kind", "buffer_ms", "expected"),
    [
        ("error", None, True),
        ("error", 0, True),
        ("buffer", 4000, False),
        ("buffer", 4001, True),
        ("start", None, False),
        (None, 5000, True),
        (None, None, False),
    ],
)
def test_alert_rule(spark, kind, buffer_ms, expected):
    row = spark.createDataFrame([(kind, buffer_ms)], "k string, b long")
    assert row.select(playback.is_alert(F.col("k"), F.col("b"))).first()[0] is expected


def test_parse_sorts_out_malformed(spark):
    missing = {k: v for k, v in event(3, 0).items() if k != "user_id"}
    lines = [json.dumps(event(1, 0)), "{broken", json.dumps(event(2, 0) | {"user_id": "abc"}), json.dumps(missing)]
    parsed = playback.parse_messages(spark.createDataFrame([(x.encode(),) for x in lines], "value binary"))
    good = playback.valid_events(parsed).collect()
    assert [(r["event_id"], r["event_timestamp"]) for r in good] == [(1, START)]
    assert values(playback.malformed_messages(parsed)) == sorted([(x,) for x in lines[1:]], key=repr)


def line_by_hand(e: dict) -> str:
    shown = (e.get(k) if e.get(k) is not None else "None" for k in ("user_id", "movie_id", "event_type"))
    return "- User {} Movie {} Event {} Buffer {}ms\n".format(*shown, e["buffer_duration_ms"] or 0)


def digest_by_hand(events: list[dict], parts: int = playback.DIGEST_PARTS) -> dict:
    windows = defaultdict(list)
    for e in events:
        at = dt.datetime.fromisoformat(e["event_timestamp"])
        windows[at - dt.timedelta(seconds=(at - START).total_seconds() % 120), e["event_id"] % parts + 1].append((at, e))
    out = {}
    for (start, part), rows in windows.items():
        sent = start + dt.timedelta(minutes=2, hours=7)
        lines = [line_by_hand(e) for _, e in sorted(rows, key=lambda r: (r[0], r[1]["event_id"]))]
        out[start, part] = f"⚠️ {sent} - {len(rows)} alerts\n" + "".join(lines)
    return out


def lines_of(messages) -> list[str]:
    return sorted(line for m in messages for line in m.splitlines()[1:])


def frame(spark, events):
    return playback.valid_events(
        playback.parse_messages(spark.createDataFrame([(json.dumps(e),) for e in events], "value string"))
    )


@pytest.mark.parametrize("parts", [1, 3, playback.DIGEST_PARTS])
def test_digest_matches_brute_force(spark, parts):
    events = [event(n, 17 * n) for n in range(60)] + [event(7, 17 * 7)] + [event(n, n % 100) for n in range(100, 2000)]
    got = {(r["window_start"], r["part"]): r["message"] for r in playback.alert_digest(frame(spark, events), parts=parts).collect()}
    assert got == digest_by_hand(events, parts)


def test_digest_lists_alerts_with_missing_fields(spark):
    rows = frame(spark, [event(1, 0)]).withColumns({"user_id": F.lit(None).cast("long"), "event_type": F.lit(None).cast("string")})
    message = playback.alert_digest(rows).first()["message"]
    assert message.endswith(" - 1 alerts\n- User None Movie 5 Event None Buffer 10ms\n")


def test_alert_table_stream_and_quarantine(spark, tmp_path):
    source = tmp_path / "in"
    events = [event(1, 0), event(2, 1, "start"), event(3, 2, "buffer", 4500), "not json", event(4, 3)]
    write_messages(source, "a.json", events)
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")

    def drain():
        stream = playback.read_message_files(spark, str(source), max_files=1)
        playback.start_alert_table(stream, out, str(tmp_path / "c1"), drain=True).awaitTermination(120)
        playback.start_quarantine(stream, bad, str(tmp_path / "c2"), drain=True).awaitTermination(120)

    drain()
    rows = spark.read.parquet(out)
    assert values(rows, "event_id") == [(1,), (3,), (4,)]
    assert rows.where("run_date is null").count() == 0
    assert values(spark.read.text(bad)) == [("not json",)]
    # A second pull reads only what is new: the checkpoint acknowledged the rest.
    write_messages(source, "b.json", [event(5, 4)])
    drain()
    assert values(spark.read.parquet(out), "event_id") == [(1,), (3,), (4,), (5,)]


def stepwise(spark, tmp_path, batches, max_files=1, **options):
    """Messages per window and part after each run over one more file, every run a restart from the checkpoint."""
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "c")
    for k, events in enumerate(batches):
        write_messages(source, f"{k:03}.json", events)
        os.utime(source / f"{k:03}.json", (1_700_000_000 + k, 1_700_000_000 + k))
        stream = playback.read_message_files(spark, str(source), max_files=max_files)
        playback.start_digests(stream, out, checkpoint, drain=True, **options).awaitTermination(120)
        yield spark.read.parquet(out) if any((tmp_path / "out").rglob("*.parquet")) else spark.createDataFrame([], "window_start timestamp_ntz, part long, message string, late boolean")


def messages_of(rows) -> dict:
    found = {(r["window_start"], r["part"]): r["message"] for r in rows}
    assert len(found) == len(rows)  # one list per window and part
    return found


LAST = event(9_999, 100_000)  # moves the clock past every window before it


@pytest.mark.parametrize("cut", [11, 50])
def test_stream_equals_batch_however_batches_fall(spark, tmp_path, cut):
    """Ordered alerts, cut anywhere, with a restart after every batch: one list per window, that of the batch."""
    events = [event(n, 13 * n) for n in range(50)]
    batches = [events[k : k + cut] for k in range(0, len(events), cut)] + [[LAST]]
    *_, final = stepwise(spark, tmp_path, batches)
    assert messages_of(final.collect()) == digest_by_hand(events)
    batch = playback.alert_digest(frame(spark, events))
    assert messages_of(final.collect()) == {(r["window_start"], r["part"]): r["message"] for r in batch.collect()}


def test_open_windows_wait_in_the_state(spark, tmp_path):
    events = [event(n, 10 * n) for n in range(10)]  # all in the first window
    half, rest, closed = stepwise(spark, tmp_path, [events[:5], events[5:], [LAST]])
    assert half.count() == rest.count() == 0
    assert messages_of(closed.collect()) == digest_by_hand(events)


def test_late_alerts_come_in_a_follow_up(spark, tmp_path):
    """No alert is lost or told twice, whatever its time."""
    first = [event(n, 17 * n) for n in range(30)]
    late = [event(1001, 5), event(1003, 6), event(1009, 130)]
    whole = [*first, *late, event(1, 17)]
    *_, final = stepwise(spark, tmp_path, [first, [LAST], [*late, event(1, 17)], [event(5000, 200_000)]])
    rows = final.where(F.col("window_start") < F.lit(START + dt.timedelta(seconds=90_000))).collect()
    assert lines_of(r["message"] for r in rows) == sorted(line_by_hand(e).rstrip() for e in whole)
    assert messages_of([r for r in rows if not r["late"]]) == digest_by_hand(first)
    assert messages_of([r for r in rows if r["late"]]) == digest_by_hand([*late, event(1, 17)])


def test_lateness_allowed_keeps_windows_open(spark, tmp_path):
    first, late = [event(n, 17 * n) for n in range(30)], [event(1001, 5)]
    *_, final = stepwise(spark, tmp_path, [first, late, [LAST], [event(5000, 200_000)]], delay="1 hour")
    rows = final.where(F.col("window_start") < F.lit(START + dt.timedelta(seconds=90_000))).collect()
    assert messages_of(rows) == digest_by_hand(first + late)


def test_windows_of_arrival(spark, tmp_path):
    """By the time a message came in, order and age of the events do not matter."""
    events = [event(n, (n * 7919) % 50_000) for n in range(12)]
    runs = list(stepwise(spark, tmp_path, [events[:6], events[6:]], time_column=playback.ARRIVED, parts=1))
    assert runs[-1].count() == 0
    source = tmp_path / "in"
    write_messages(source, "z.json", [LAST])
    os.utime(source / "z.json", (1_700_001_000, 1_700_001_000))
    stream = playback.read_message_files(spark, str(source), max_files=1)
    playback.start_digests(stream, str(tmp_path / "out"), str(tmp_path / "c"), drain=True, time_column=playback.ARRIVED, parts=1).awaitTermination(120)
    (row,) = spark.read.parquet(str(tmp_path / "out")).collect()
    assert not row["late"] and " - 12 alerts" in row["message"]
    assert lines_of([row["message"]]) == sorted(line_by_hand(e).rstrip() for e in events)


def test_second_stream_leaves_the_first_ones_digests(spark, tmp_path):
    """Two checkpoints number their batches alike; their folders differ."""
    events = [event(n, 10 * n) for n in range(30)]
    for name in ("a", "b"):
        source = tmp_path / name
        write_messages(source, "0.json", events)
        write_messages(source, "1.json", [LAST])
        stream = playback.read_message_files(spark, str(source), max_files=1)
        playback.start_digests(stream, str(tmp_path / "out"), str(tmp_path / f"c{name}"), drain=True).awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.select("stream").distinct().count() == 2
    assert lines_of(r["message"] for r in rows.collect()) == sorted([line_by_hand(e).rstrip() for e in events] * 2)


def test_alerts_without_number_are_dealt_by_their_line(spark):
    rows = frame(spark, [event(n, 1) for n in range(40)]).withColumn("event_id", F.lit(None).cast("long")).withColumn("user_id", F.monotonically_increasing_id())
    found = playback.alert_digest(rows).collect()
    assert len(found) > 1
    assert sum(len(r["message"].splitlines()) - 1 for r in found) == 40


def test_window_counts_on_a_stream(spark, tmp_path):
    """Counts of closed windows, and of late alerts as further rows, add up to the batch's."""
    source = tmp_path / "in"
    events = [event(n, 50 * n) for n in range(10)]
    write_messages(source, "a.json", events)
    write_messages(source, "b.json", [LAST])
    write_messages(source, "c.json", [event(98, 7)])
    for k, name in enumerate("abc"):
        os.utime(source / f"{name}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    alerts = playback.alert_rows(playback.read_message_files(spark, str(source), max_files=1))
    query = (
        playback.alert_windows(alerts, delay="0 seconds")
        .writeStream.outputMode("append")
        .format("memory")
        .queryName("window_counts")
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(120)
    got = spark.table("window_counts").groupBy("window_start", "window_end").agg(F.sum("n_alerts").alias("n_alerts"))
    batch = playback.alert_windows(playback.playback_alerts(frame(spark, [*events, event(98, 7)])))
    assert values(got, *batch.columns) == values(batch)
    assert spark.table("window_counts").count() == batch.count() + 1


def delivered(spark, tmp_path, batches, **options):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for k, events in enumerate(batches):
        write_messages(source, f"{k:03}.json", events)
        os.utime(source / f"{k:03}.json", (1_700_000_000 + k, 1_700_000_000 + k))
        stream = playback.read_message_files(spark, str(source), max_files=1)
        playback.start_alerts_once(stream, out, str(tmp_path / "c"), drain=True, **options).awaitTermination(120)
    return spark.read.parquet(out)


def test_a_topic_played_twice_gives_every_alert_once(spark, tmp_path):
    """Also within a batch, with a restart in between, and with the values the alert table has."""
    events = [event(n, 11 * n) for n in range(60)] + [event(61, 5, "buffer", None), event(62, 9, "buffer", 5000)]
    batches = [events[:30] + events[:3], events[30:] + events, [event(n, 11 * n) for n in range(20, 40)]]
    rows = delivered(spark, tmp_path, batches)
    alerts = [e for e in events if e["event_id"] != 61]
    came = sum(e["event_id"] != 61 for batch in batches for e in batch)
    first = rows.where("delivery = 'first'").drop("delivery", "run_date")
    assert values(first) == values(frame(spark, alerts).select(*first.columns))
    assert rows.where("delivery = 'again'").count() == came - len(alerts)
    assert rows.where("delivery = 'old'").count() == 0


def test_forgotten_numbers_go_to_their_own_output(spark, tmp_path):
    events = [event(n, 11 * n) for n in range(10)]
    rows = delivered(spark, tmp_path, [events, [event(500, 40_000)], events[:4], [event(501, 90_000)]], keep="10 minutes")
    assert rows.groupBy("delivery").count().orderBy("delivery").collect() == [("first", 12), ("old", 4)]


def test_events_of_one_number_and_another_time_are_others(spark, tmp_path):
    rows = delivered(spark, tmp_path, [[event(1, 0), event(1, 1200), event(1, 0)]])
    assert {r["delivery"]: r["count"] for r in rows.groupBy("delivery").count().collect()} == {"first": 2, "again": 1}
