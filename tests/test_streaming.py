from __future__ import annotations

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.operators.dedup import eager_dedup
from millrace.operators.table import history, read_table
from millrace.streaming import feed as streams
from millrace.streaming import marks as marking

HOUR = 3600.0
START = 1_700_000_000.0


def message(key, created, arrival, value=0):
    return {
        "event": "message_received", "message_id": key, "sequence_id": 1, "partition_id": 0,
        "created_at": START + created, "arrival_ts": START + created, "arrival_index": arrival, "value": value,
        "zipcode": "01234",
    }


class Feed:
    """A folder to which micro-batches are added as files."""

    def __init__(self, folder):
        self.folder, self.count = folder, 0
        folder.mkdir()

    def add(self, *messages):
        self.count += 1
        lines = "".join(json.dumps(m) + "\n" for m in messages)
        target = self.folder / f"{self.count:03d}.jsonl"
        target.write_text(lines)
        # Files are taken in order of age.
        os.utime(target, (1_700_000_000 + self.count, 1_700_000_000 + self.count))

    def stream(self, spark):
        return streams.read_message_stream(spark, str(self.folder), files_per_batch=1)


@pytest.fixture
def source(tmp_path):
    return Feed(tmp_path / "in")


@pytest.fixture
def run(spark, source, tmp_path):
    """Process what is available; a second call restarts from the checkpoint."""

    def go(shape):
        sink, state = str(tmp_path / "out"), str(tmp_path / "state")
        query = streams.append_available(shape(source.stream(spark)), sink, state)
        return query, [r[0] for r in rows(spark.read.parquet(sink), "arrival_index")]

    return go


@pytest.mark.parametrize("salts", [1, 8])
def test_exact_filter_survives_restart(source, run, salts):
    def shape(stream):
        return streams.drop_seen(stream, salts=salts)

    source.add(message("a", 0, 1), message("b", 0, 2))
    source.add(message("a", 0, 3), message("c", 9 * HOUR, 4))
    _, kept = run(shape)
    assert kept == [1, 2, 4]
    source.add(message("b", 20 * HOUR, 5), message("d", 0, 6), message("d", 0, 6))
    _, kept = run(shape)
    assert kept == [1, 2, 4, 6]


@pytest.mark.parametrize("salts", [1, 8])
def test_bounded_filter_and_its_two_limits(source, run, salts):
    source.add(message("a", 0 * HOUR, 1), message("a", 0 * HOUR, 1))
    source.add(message("b", 10 * HOUR, 2))
    source.add(message("c", 10 * HOUR, 3), message("b", 10 * HOUR, 4))
    source.add(message("late", 1 * HOUR, 5), message("a", 0 * HOUR, 6))  # behind the watermark
    source.add(message("a", 12 * HOUR, 7))  # returns after its state has expired
    query, kept = run(lambda s: streams.drop_seen_within(s, "1 hour", salts=salts))
    assert kept == [1, 2, 3, 7]
    assert streams.late_rows(query) == 2


def test_hot_key_passes_the_salted_step_a_few_times(source, run):
    source.add(*[message("hot", 0, i) for i in range(500)], message("b", 0, 900))
    query, kept = run(streams.drop_seen)
    assert len(kept) == 2 and 900 in kept
    # The last stateful step of the plan saw one row per salt of the hot key.
    first, second = sorted(
        sum(p["stateOperators"][i]["numRowsTotal"] for p in query.recentProgress) for i in (0, 1)
    )
    assert first == 2 and 2 < second <= streams.SALTS + 1


def test_first_arrivals_to_table(spark, source, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    source.add(message("a", 0, 3), message("a", 0, 2), message(None, 0, 1))
    source.add(message("a", 0, 4), message("b", 0, 6), message("b", 0, 5), message(None, 0, 7))
    for _ in range(2):
        streams.first_arrival_stream(source.stream(spark), table, state)
        assert [r[0] for r in rows(read_table(spark, table), "arrival_index")] == [1, 2, 5]
    source.add(message("c", 0, 8), message("b", 0, 9))
    streams.first_arrival_stream(source.stream(spark), table, state)
    assert [r[0] for r in rows(read_table(spark, table), "arrival_index")] == [1, 2, 5, 8]


def test_first_arrivals_by_date(spark, source, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    nowhen = dict(message("n", 0, 7), created_at=None)
    source.add(message("a", 0, 1), message("b", 0, 2), nowhen)
    source.add(message("a", 0, 3), message("a", 48 * HOUR, 4), message("c", 0, 5), dict(nowhen, arrival_index=8))
    streams.first_arrival_stream(source.stream(spark), table, state, by_date=True)
    found = read_table(spark, table)
    assert [r[0] for r in rows(found, "arrival_index")] == [1, 2, 4, 5, 7]
    assert found.select("partition_date").distinct().count() == 3


@pytest.mark.parametrize("fold", [1, 32])
def test_first_arrivals_with_marks(spark, source, tmp_path, monkeypatch, fold):
    """Marks name every key that the table holds; only buckets that may hold a key are opened."""
    monkeypatch.setattr(marking, "FOLD_BATCHES", fold)
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    marks = marking.Marks.sized(str(tmp_path / "marks"), 10_000)
    names = [f"k{n}" for n in range(40)]
    source.add(*[message(n, 0, k) for k, n in enumerate(names)], message(None, 0, 90))
    source.add(*[message(f"n{n}", 0, 100 + n) for n in range(30)])
    source.add(message("k7", 0, 200), message(None, 0, 201), message("n3", 0, 202), message("x", 0, 203))
    source.add(message("k7", 0, 300), message("x", 0, 301))
    for _ in range(2):  # the second call restarts from the checkpoint and finds nothing
        streams.first_arrival_stream(source.stream(spark), table, state, marks=marks)
    expected = [*range(40), 90, *range(100, 130), 203]
    assert sorted(r[0] for r in rows(read_table(spark, table), "arrival_index")) == expected
    found = {r["batch_id"]: r for r in marks.report(spark).collect()}
    assert [(found[b]["keys"], found[b]["new_keys"]) for b in (1, 2, 3)] == [(30, 30), (4, 1), (2, 0)]
    # None of the new keys is taken for an old one in this sparse filter, so nothing is opened for them.
    assert found[1]["buckets_opened"] <= 2 < found[1]["buckets_touched"]
    assert found[2]["maybe_seen"] >= 3 and found[3]["maybe_seen"] == 2
    bases = [p.name for p in (tmp_path / "marks").iterdir() if p.name.startswith("base-")]
    assert bool(bases) == (fold == 1)


def test_marks_are_made_anew_after_other_writers(spark, source, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    marks = marking.Marks(str(tmp_path / "marks"))
    source.add(message("a", 0, 1))
    streams.first_arrival_stream(source.stream(spark), table, state, marks=marks)
    other = read_table(spark, table).withColumn("message_id", F.lit("b"))
    streams.write_table(other.withColumn("composite_hash", streams.composite_key(list(marks.keys))), table, bucket_by=list(marks.keys))
    source.add(message("b", 0, 2), message("a", 0, 3), message("c", 0, 4))
    streams.first_arrival_stream(source.stream(spark), table, state, marks=marks)
    assert rows(read_table(spark, table), "message_id") == [("a",), ("b",), ("c",)]
    with pytest.raises(ValueError):
        streams.first_arrival_stream(source.stream(spark), table, state, marks=marks, by_date=True)


def test_replayed_batch_is_not_written_twice(spark, source, tmp_path):
    table = str(tmp_path / "table")
    source.add(message("a", 0, 1))
    writes = []
    stream = source.stream(spark)

    def write(batch, writer, batch_id, found):
        writes.append(batch_id)
        streams.write_table(batch, table, writer=writer, batch_id=batch_id)

    # A new checkpoint folder of the same name replays batch 0, as after a crash before its commit.
    state = tmp_path / "state"
    streams._each_batch(stream, table, str(state), write)
    state.rename(tmp_path / "old-state")
    streams._each_batch(source.stream(spark), table, str(state), write)
    assert writes == [0] and read_table(spark, table).count() == 1


def test_upsert_stream(spark, source, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    source.add(message("a", 2, 1, value=1), message("b", 1, 2, value=2))
    source.add(message("a", 1, 3, value=3), message("b", 1, 4, value=4))
    streams.upsert_stream(source.stream(spark), table, state)
    assert rows(read_table(spark, table), "message_id", "value") == [("a", 1), ("b", 4)]
    assert rows(history(spark, table), "batch_id") == [(0,), (1,)]


def test_stream_keeps_the_keys_of_the_batch_form(spark, feed, tmp_path):
    folder = str(tmp_path / "feed")
    feed.select("message_id", "sequence_id", "partition_id").repartition(5).write.json(folder)
    stream = streams.read_message_stream(spark, folder, feed.select("message_id", "sequence_id", "partition_id").schema)
    sink = str(tmp_path / "out")
    streams.append_available(streams.drop_seen(stream), sink, str(tmp_path / "state"))
    assert rows(spark.read.parquet(sink), "composite_hash") == rows(eager_dedup(feed), "composite_hash")


def test_arrival_stamps(spark, source, tmp_path):
    source.add(message("a", 0, None), message("b", 0, None))
    source.add(message("c", 0, None))
    received = spark.read.schema(streams.MESSAGE).json(str(source.folder)).drop("arrival_ts", "arrival_index")
    stamped = streams.with_arrival(received)
    assert stamped.filter(F.col("arrival_ts") < 1.6e9).isEmpty()
    numbered = streams.with_arrival_index(stamped)
    assert [r["message_id"] for r in numbered.orderBy("arrival_index").collect()] == ["a", "b", "c"]
    assert rows(numbered, "arrival_index") == [(1,), (2,), (3,)]
    live = streams.with_arrival(source.stream(spark).drop("arrival_ts", "arrival_index"))
    streams.append_available(live, str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_equal_redeliveries_get_different_salts(spark, source, run):
    for _ in range(12):
        source.add(message("a", 0, 1))
    salted = lambda stream: streams._with_salt(stream, ["message_id", "sequence_id", "partition_id"], 64)
    seen = set()

    def keep(batch, _):
        seen.update(r[0] for r in batch.select(streams.SALT).collect())

    query = salted(source.stream(spark)).writeStream.foreachBatch(keep).trigger(availableNow=True).start()
    query.awaitTermination()
    assert len(seen) > 4
    assert run(streams.drop_seen)[1] == [1]


def test_batches_without_news_commit_nothing(spark, source, tmp_path):
    table, state = str(tmp_path / "table"), str(tmp_path / "state")
    for key in ("a", "b", "a"):
        source.add(message(key, 0, 1))
    streams.first_arrival_stream(source.stream(spark), table, state)
    assert rows(read_table(spark, table), "message_id") == [("a",), ("b",)]
    assert history(spark, table).count() == 2
