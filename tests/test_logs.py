"""Log batches as the writer's own loop makes them, in one go and as a stream."""

import json
import random
import time

from moothall.streaming import logs


def loop(events, limit):
    out, held, size = [], [], 0
    for t, m in sorted(events):
        held.append((t, m))
        size += len(m.encode()) + logs.EXTRA
        if size >= limit:
            out.append(held)
            held, size = [], 0
    return [*out, held] if held else out


def test_batches_are_those_of_the_loop(spark):
    r = random.Random(1)
    streams = {"many": [(r.randrange(500), "é" * r.randrange(0, 60)) for _ in range(2500)], "same": [(7, "x")] * 300, "large": [(i, "y" * (5000 if i % 7 == 0 else 3)) for i in range(60)], "one": [(1, "z")], "exact": [(i, "w" * (100 - logs.EXTRA)) for i in range(50)]}
    rows = [(s, t, m) for s, events in streams.items() for t, m in events]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "stream string, timestamp long, message string").repartition(5)
    for limit in (100, 6000):
        got = {}
        for x in logs.flushed(df, limit).collect():
            got.setdefault(x["stream"], {}).setdefault(x["batch"], []).append((x["timestamp"], x["message"]))
        for s, events in streams.items():
            want = loop(events, limit)
            assert sorted(got[s]) == list(range(len(want)))
            assert [sorted(got[s][i]) for i in range(len(want))] == [sorted(b) for b in want], (s, limit)
    assert logs.flushed(df.where("false")).collect() == []


def test_a_stream_is_written_when_full_or_after_a_while(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source = tmp_path / "in"
    source.mkdir()

    def put(n, rows):
        part = tmp_path / f"{n}.json"
        part.write_text("\n".join(json.dumps(dict(zip(("stream", "timestamp", "message"), r))) for r in rows))
        part.rename(source / f"{n}.json")

    stream = spark.readStream.schema("stream string, timestamp long, message string").json(str(source))
    put(1, [("a", i, "m" * 74) for i in range(25)] + [("b", 1, "few")])
    query = logs.flushes(stream, limit=1000, wait=300).writeStream.format("memory").queryName("flushes").outputMode("append").trigger(processingTime="200 milliseconds").option("checkpointLocation", str(tmp_path / "state")).start()
    try:
        read = lambda: [tuple(r) for r in spark.sql("SELECT stream, batch, timestamp FROM flushes").collect()]
        deadline = time.monotonic() + 90
        while len(read()) < 26 and time.monotonic() < deadline:
            time.sleep(0.3)
        put(2, [("a", 100 + i, "m" * 74) for i in range(10)])
        while len(read()) < 36 and time.monotonic() < deadline:
            time.sleep(0.3)
        rows = read()
    finally:
        query.stop()
    count = {}
    for s, b, _ in rows:
        count[s, b] = count.get((s, b), 0) + 1
    # ten events of a hundred bytes fill a batch; what is left is written after a while, and so is the other stream's
    assert count == {("a", 0): 10, ("a", 1): 10, ("a", 2): 5, ("b", 0): 1, ("a", 3): 10}
    assert sorted(t for s, _, t in rows if s == "a") == [*range(25), *range(100, 110)]


def test_latest_passes_a_key_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    rows = [("A", "2024-01-01T00:00:00"), ("A", "2024-01-01T05:00:00"), ("B", "2024-01-01T01:00:00")]
    (source / "1.json").write_text("\n".join(json.dumps({"council": c, "at": t}) for c, t in rows))
    stream = spark.readStream.schema("council string, at timestamp").json(str(source))
    query = logs.latest(stream, "council", "at").writeStream.format("memory").queryName("latest_runs").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start()
    query.awaitTermination(120)
    assert sorted(r["council"] for r in spark.table("latest_runs").collect()) == ["A", "B"]
