"""Streaming operators on file streams."""

import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wearlake.sources import readers
from wearlake.streaming import ingest


class Feed:
    """A folder read as a stream; each call of ``drain`` runs what has come since the last."""

    def __init__(self, spark, folder, build, schema, mode="append"):
        self.spark, self.folder, self.build, self.schema, self.mode = spark, folder, build, schema, mode
        (folder / "in").mkdir(parents=True)
        self.seen, self.n = [], 0

    def put(self, rows):
        self.n += 1
        (self.folder / "in" / f"{self.n:03d}.json").write_text("\n".join(json.dumps(r) for r in rows))
        time.sleep(0.02)

    def drain(self):
        made = []
        stream = self.build(self.spark.readStream.schema(self.schema).json(str(self.folder / "in")))
        writer = stream.writeStream.foreachBatch(lambda batch, _: made.extend(batch.collect())).outputMode(self.mode).option(
            "checkpointLocation", str(self.folder / "state")
        )
        query = writer.trigger(availableNow=True).start()
        assert query.awaitTermination(120)
        self.seen += made
        return made


def files(session, chunk, roles, minute=0):
    return [
        {
            "session_id": session, "chunk_index": chunk, "role": r, "path": "p",
            "received": f"2024-01-01T00:{minute:02d}:00Z",
        } for r in roles
    ]


def test_complete_chunks_are_exact(spark, tmp_path):
    feed = Feed(spark, tmp_path, ingest.complete_chunks, ingest.FILE)
    feed.put(files("a", 1, ingest.ROLES[:4]) + files("a", 1, ["thumbnail", "video"]) + files("b", 1, ingest.ROLES))
    assert [(r["session_id"], r["chunk_index"]) for r in feed.drain()] == [("b", 1)]
    feed.put(files("a", 1, ["meta"], 1) + files("b", 1, ["video"], 1))
    got = feed.drain()
    assert [(r["session_id"], r["chunk_index"]) for r in got] == [("a", 1)]
    feed.put(files("a", 1, ingest.ROLES, 2))
    assert feed.drain() == []


def test_queue_takes_each_chunk_once(spark, tmp_path):
    feed = Feed(spark, tmp_path, ingest.queued, ingest.FILE)
    feed.put(files("a", 1, ["x", "y"]) + files("a", 2, ["x"]))
    assert sorted(r["chunk_index"] for r in feed.drain()) == [1, 2]
    feed.put(files("a", 2, ["x"]) + files("a", 3, ["x"]))
    assert [r["chunk_index"] for r in feed.drain()] == [3]


def test_counters_and_latest(spark, tmp_path):
    feed = Feed(spark, tmp_path / "a", ingest.session_counters, ingest.FILE, "update")
    feed.put(files("a", 1, ["x"]) + files("a", 1, ["x"]))
    feed.drain()
    feed.put(files("a", 7, ["x"]))
    assert [tuple(r) for r in feed.drain()] == [("a", 3, 7)]
    fixes = Feed(
        spark, tmp_path / "b", ingest.latest_fix, "session_id string, timestamp double, lat double, lon double",
        "update",
    )
    fixes.put(
        [
            {"session_id": "a", "timestamp": 2.0, "lat": 1.0, "lon": 2.0},
            {"session_id": "a", "timestamp": 1.0, "lat": 9.0, "lon": 9.0},
        ]
    )
    assert [(r["fix"]["lat"], r["timestamp"]) for r in fixes.drain()] == [(1.0, 2.0)]


def test_tumbling_windows_close_with_the_watermark(spark, tmp_path):
    feed = Feed(spark, tmp_path, lambda s: ingest.tumbling(s, "ts", "v"), "session_id string, ts timestamp, v double")
    row = lambda second, v: {"session_id": "a", "ts": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}Z", "v": v}
    feed.put([row(1, 1.0), row(29, 3.0), row(31, 5.0)])
    feed.drain()
    feed.put([row(119, 0.0)])
    feed.drain()
    feed.put([row(5, 100.0), row(121, 0.0)])  # late: its window is closed
    feed.drain()
    assert [(r["n"], r["mean"]) for r in sorted(feed.seen, key=lambda r: r["start"])][:2] == [(2, 2.0), (1, 5.0)]


def test_sentences_pair_once(spark, tmp_path):
    lines = [
        "$GPRMC,1,A,1258.2,N,07735.4,E,10.0,90.0,x*00", "$GPRMC,2,A,1258.2,N,07735.4,E,20.0,91.0,x*00",
        "$GPGGA,2,1258.2,N,07735.4,E,1,7,1.0,900.5,M*00", "$GPRMC,3,V,1258.2,N,07735.4,E,20.0,91.0,x*00",
        "$GPGGA,3,1258.2,N,07735.4,E,1,8,1.0,901.5,M*00",
    ]
    parse = lambda s: ingest.pair_sentences(readers.parse_nmea(s))
    feed = Feed(spark, tmp_path, parse, "session_id string, seq long, line string")
    feed.put([{"session_id": "a", "seq": k, "line": x} for k, x in enumerate(lines)])
    got = feed.drain()
    assert len(got) == 1 and abs(
        got[0]["speed_kmh"] - 37.04
    ) < 1e-9 and got[0]["alt"] == 900.5 and got[0]["utc"] == "2" and abs(got[0]["lat"] - 12.97) < 1e-9
    feed.put([{"session_id": "a", "seq": 9, "line": "$GPRMC,9,A,1258.2,S,07735.4,W,1.0,1.0,x*00"}])
    got = feed.drain()  # pairs with the position report held since the first batch
    assert [(r["utc"], r["alt"]) for r in got] == [("9", 901.5)] and got[0]["lat"] < 0 and got[0]["lon"] < 0


def test_closing(spark, tmp_path):
    feed = Feed(spark, tmp_path, ingest.closing, "session_id string, kind string, received timestamp")
    row = lambda s, kind: {"session_id": s, "kind": kind, "received": "2024-01-01T00:00:00Z"}
    feed.put([row("a", "chunk"), row("a", "finalize"), row("a", "finalize"), row("b", "chunk")])
    assert [r["session_id"] for r in feed.drain()] == ["a"]
    feed.put([row("a", "finalize"), row("b", "finalize")])
    assert [r["session_id"] for r in feed.drain()] == ["b"]


def test_retries_wait_and_stop():
    waits, calls = [], []
    assert not ingest.with_retries(lambda: calls.append(1) or False, wait=lambda s: waits.append(s))
    assert waits == [2.0, 4.0, 8.0] and len(calls) == 3
    assert ingest.with_retries(lambda: True, wait=lambda s: pytest.fail("no wait"))
    tries = iter([RuntimeError, None])

    def work():
        if next(tries):
            raise RuntimeError

    assert ingest.with_retries(work, wait=lambda s: None)
    assert not ingest.with_retries(lambda: False, wait=lambda s: True)


def test_batches_replay_after_a_failure(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"session_id": "a", "chunk_index": 1}')
    stream = ingest.landed(spark, str(folder))
    state, got, fail = str(tmp_path / "state"), [], [4]

    def sink(batch, number):
        if fail[0]:
            fail[0] -= 1
            raise RuntimeError("down")
        got.extend(r["chunk_index"] for r in batch.collect())

    query = ingest.run_batches(stream, sink, state, wait=lambda s: None, once=True)
    with pytest.raises(Exception, match="failed 3 times"):
        query.awaitTermination(120)
    assert got == [] and fail == [1]
    ingest.run_batches(stream, sink, state, wait=lambda s: None, once=True).awaitTermination(120)
    assert got == [1]


def test_simulated_stream(spark, tmp_path):
    stream = ingest.simulated_imu(spark, 50)
    assert stream.isStreaming and set(stream.columns) == {
        "timestamp", "seq", "accel_x", "accel_y", "accel_z", "gyro_x", "gyro_y", "gyro_z"
    }


def test_uploads_of_a_small_queue(spark):
    q = spark.createDataFrame(
        [("a", 1, "pending"), ("a", 2, "uploading"), ("a", 3, "done"), ("a", 4, "failed")],
        "session_id string, chunk_index int, status string",
    )
    more = ingest.enqueue(
        q, spark.createDataFrame([("a", 4), ("a", 5), ("a", 5)], "session_id string, chunk_index int")
    )
    assert {r["chunk_index"]: r["status"] for r in more.collect()} == {
        1: "pending", 2: "uploading", 3: "done", 4: "failed", 5: "pending"
    }
    told = spark.createDataFrame(
        pd.DataFrame(
            {"session_id": "a", "chunk_index": [1, 2, 3, 5], "started": True, "ok": [True, False, False, None]}
        ),
        "session_id string, chunk_index int, started boolean, ok boolean",
    )
    after = ingest.settle(more, told)
    assert {r["chunk_index"]: r["status"] for r in after.collect()} == {
        1: "done", 2: "failed", 3: "done", 4: "failed", 5: "uploading"
    }
    assert [
        r["chunk_index"] for r in ingest.unfinished(after).collect()
    ] == [5] and ingest.pending_count(after).first()["queued"] == 0
    assert tuple(ingest.upload_stats(after).first())[1:] == (0, 2, 2)
    assert after.filter(F.col("status") == "uploading").count() == 1


def record(chunk, kind, attempt, second, session="a"):
    return {"session_id": session, "chunk_index": chunk, "kind": kind, "attempt": attempt, "at": f"2024-01-01T00:{int(second) // 60:02d}:{second % 60:06.3f}Z"}


def told(found):
    """(chunk, attempt, status, second) of transitions."""
    return sorted((r["chunk_index"], r["attempt"], r["status"], r["at"].minute * 60 + r["at"].second + r["at"].microsecond / 1e6) for r in found if r["chunk_index"] < 90)


RECORDS = [
    record(1, "queued", 0, 0), record(1, "ok", 1, 1),
    record(2, "queued", 0, 0), record(2, "error", 1, 1), record(2, "ok", 2, 4),
    record(3, "queued", 0, 0), record(3, "error", 1, 1), record(3, "error", 2, 4), record(3, "error", 3, 9),
    record(3, "ok", 3, 12),  # of an attempt that is over
    record(3, "queued", 0, 20), record(1, "queued", 0, 21),  # known: nothing
    record(4, "queued", 0, 5),  # nothing is heard of it
    record(5, "ok", 1, 6),  # never queued
]
WANT = [
    (1, 1, "done", 1), (1, 1, "uploading", 0), (2, 1, "uploading", 0), (2, 2, "done", 4), (2, 2, "uploading", 3),
    (3, 1, "uploading", 0), (3, 2, "uploading", 3), (3, 3, "failed", 17), (3, 3, "uploading", 8),
    (4, 1, "uploading", 5), (4, 2, "uploading", 37), (4, 3, "failed", 109), (4, 3, "uploading", 71),
]


def test_uploads_in_a_batch(spark):
    from wearlake.streaming import uploads

    rows = pd.DataFrame(RECORDS + [record(1, "nonsense", 1, 0.5)])
    rows["at"] = pd.to_datetime(rows["at"]).dt.tz_localize(None)
    df = spark.createDataFrame(rows, uploads.RECORD)
    assert told(uploads.settled(df.unionByName(df), patience=30.0).collect()) == WANT
    last = {r.chunk_index: (r.status, r.attempt) for r in uploads.latest_status(uploads.settled(df, patience=30.0)).collect()}
    assert last == {1: ("done", 1), 2: ("done", 2), 3: ("failed", 3), 4: ("failed", 3)}


@pytest.mark.parametrize("cuts", [(), (3, 5, 8, 10), tuple(range(1, 14))])
def test_a_replay_of_uploads_equals_the_batch(spark, tmp_path, cuts):
    """However the stream is cut, each part in a query started anew: the same transitions, each once."""
    from wearlake.streaming import uploads

    feed = Feed(spark, tmp_path, lambda s: uploads.uploads(s, late="30 seconds", patience=30.0), uploads.RECORD)
    ends = [0, *cuts, len(RECORDS)]
    by_time = sorted(RECORDS, key=lambda r: r["at"])
    for a, b in zip(ends, ends[1:]):
        feed.put(by_time[a:b])
        feed.drain()
    for minute in (3, 4, 5):  # later records of another chunk carry the watermark on
        feed.put([record(99, "queued", 0, minute * 60)])
        feed.drain()
    assert told(feed.seen) == WANT


def test_ended_uploads_are_forgotten_in_time(spark, tmp_path):
    from wearlake.streaming import uploads

    feed = Feed(spark, tmp_path, lambda s: uploads.uploads(s, late="1 second", keep=60.0), uploads.RECORD)
    feed.put([record(1, "queued", 0, 0), record(1, "ok", 1, 1)])
    feed.drain()
    feed.put([record(1, "queued", 0, 30)])
    feed.drain()
    feed.put([record(99, "queued", 0, 100)])
    feed.drain()
    feed.put([record(1, "queued", 0, 130)])
    feed.drain()
    assert [(n, s) for _, n, s, _ in told(feed.seen)] == [(1, "done"), (1, "uploading"), (1, "uploading")]


def test_a_batch_is_appended_once(spark, tmp_path, monkeypatch):
    """Two samples of one time stay, a replay adds nothing, half a batch doesn't count and is mended by the replay."""
    from wearlake.sources import writers

    path = f"{tmp_path}/imu"
    one = spark.createDataFrame([(1.0, 5.0), (1.0, 6.0), (2.0, 7.0)], "timestamp double, accel_x double")
    assert writers.append_batch(one, path, 0) and not writers.append_batch(one, path, 0)
    two = spark.createDataFrame([(3.0, 8.0)], "timestamp double, accel_x double")
    two.write.parquet(f"{path}/data/batch=1")  # the crash came before the log
    rows = lambda: sorted((r.timestamp, r.accel_x) for r in writers.read_appended(spark, path).collect())
    assert rows() == [(1.0, 5.0), (1.0, 6.0), (2.0, 7.0)]
    assert writers.append_batch(two, path, 1) and rows()[-1] == (3.0, 8.0) and len(rows()) == 4
    monkeypatch.setattr(spark.__class__, "read", property(lambda self: pytest.fail("the history is read")))
    assert writers.append_batch(two, path, 2)
