"""ST1/ST2 state: one answer per request whatever is delivered again, late fragments counted, state dropped."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inferframe.plans.q_streams import _run
from inferframe.session import shared_dir
from inferframe.streaming import assemble as A

CHUNK = "request_id long, seq long, content string, finish_reason string, ts timestamp"
CALL = "request_id long, seq long, tool_index long, tool_id string, tool_name string, tool_args string, ts timestamp"


def stream(spark, schema, batches, make, mode="append"):
    """Each batch lands as one file and is one micro-batch; returns {batch_id: rows}."""
    src, log, ck = (shared_dir(spark, f"t-state-{x}") for x in ("src", "log", "ck"))

    def append(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    for rows in batches:  # one run each: the watermark moves between them
        df = spark.createDataFrame([(*r[:-1], str(r[-1])) for r in rows], schema.replace("ts timestamp", "ts string"))
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(src)
        res = make(spark.readStream.schema(schema).parquet(src))
        _run(res.writeStream.foreachBatch(append).option("checkpointLocation", ck).outputMode(mode))
    return spark.read.parquet(log)


def at(minute, hour=0, day=1):
    return f"2024-01-{day:02d} {hour:02d}:{minute:02d}:00"


def test_redelivery_after_the_answer_gives_one_row_and_is_counted(spark):
    out = stream(spark, CHUNK, [
        [(7, 0, "a", None, at(0)), (7, 2, "c", "stop", at(0)), (8, 0, "x", None, at(0))],
        [(7, 1, "b", None, at(1)), (7, 1, "b", None, at(1))],
        [(7, 1, "b", None, at(1)), (7, 0, "a", None, at(1)), (8, 1, "y", None, at(2))],
        [(99, 0, "z", None, at(0, day=2))],
        [(99, 1, "z", None, at(0, day=3))],
    ], lambda s: A.stream_content_events(s, watermark="1 hour", ttl_ms=3_600_000))
    rows = [(r.request_id, r.event, r.content, r.n_chunks, r.complete, r.n_late) for r in out.collect() if r.request_id != 99]
    assert sorted(rows, key=str) == [
        (7, "late", None, None, None, 2), (7, "message", "abc", 3, True, None), (8, "message", "xy", 2, False, None)]


def test_an_incomplete_answer_is_final_too(spark):
    out = stream(spark, CHUNK, [
        [(1, 0, "a", None, at(0))],
        [(99, 0, "z", None, at(30, hour=3))],  # the watermark passes the fragment's hour
        [(1, 1, "b", "stop", at(0, hour=3))],  # not late for the watermark, but the request was answered
        [(99, 1, "z", None, at(0, day=9))], [(99, 2, "z", None, at(0, day=10))],
    ], lambda s: A.stream_content_events(s, watermark="1 hour", ttl_ms=3_600_000))
    rows = [(r.event, r.content, r.complete, r.n_late) for r in out.filter("request_id = 1").collect()]
    assert sorted(rows, key=str) == [("late", None, None, 1), ("message", "a", False, None)]


def test_fragments_behind_the_watermark_are_dropped(spark):
    out = stream(spark, CHUNK, [
        [(1, 0, "a", "stop", at(0))], [(99, 0, "z", None, at(0, day=9))], [(99, 1, "z", None, at(0, day=10))],
        [(1, 0, "a", "stop", at(0))], [(99, 2, "z", None, at(0, day=20))],
    ], lambda s: A.stream_assemble_content(s, watermark="1 hour", ttl_ms=3_600_000))
    assert [(r.content, r.complete) for r in out.filter("request_id = 1").collect()] == [("a", True)]


def test_changed_calls_come_once_a_batch_and_redeliveries_change_nothing(spark):
    out = stream(spark, CALL, [
        [(1, 0, 0, "c1", "f", "{", at(0)), (1, 2, 0, None, None, "}", at(0)), (1, 0, 1, "c2", "g", "[]", at(0))],
        [(1, 0, 0, "c1", "f", "{", at(1)), (1, 1, 0, None, None, "x", at(1))],
        [(1, 1, 0, None, None, "x", at(1)), (1, 0, 1, "c2", "g", "[]", at(1))],
    ], lambda s: A.stream_assemble_tool_calls(s), mode="update")
    rows = sorted((r.tool_index, r.n_fragments, r.arguments, r.tool_id, r.tool_name) for r in out.collect())
    assert rows == [(0, 2, "{}", "c1", "f"), (0, 3, "{x}", "c1", "f"), (1, 1, "[]", "c2", "g")]


@pytest.mark.parametrize("seed", range(20))
def test_runs_of_fragments(seed):
    rng = np.random.default_rng(seed)
    starts, ends, seen = np.zeros(0, np.int64), np.zeros(0, np.int64), set()
    for _ in range(6):
        seq = rng.integers(0, 30, int(rng.integers(1, 12)))
        starts, ends, fresh = A.merge_runs(starts, ends, seq)
        new = seq[fresh].tolist()
        assert len(set(new)) == len(new) and set(new) == set(seq.tolist()) - seen
        seen |= set(new)
        assert {x for a, b in zip(starts, ends) for x in range(a, b + 1)} == seen
        assert (starts[1:] > ends[:-1] + 1).all()


class Store:
    """The state of one group of calls, with its round trips counted."""

    def __init__(self):
        self.map, self.timers, self.trips = {}, set(), 0

    def getMapState(self, *_):
        return self

    def iterator(self):
        self.trips += 1
        return iter(list(self.map.items()))

    def updateValue(self, key, value):
        self.trips += 1
        self.map[key] = value

    def removeKey(self, key):
        self.trips += 1
        del self.map[key]

    def registerTimer(self, at_ms):
        self.trips += 1
        self.timers.add(at_ms)


class Time:
    def __init__(self, watermark):
        self.getCurrentWatermarkInMs = lambda: watermark


def calls_frame(rows):
    import pandas as pd

    return pd.DataFrame([(hash((r, i, n)) % 50, r, i, n, q, t, tid, name, ms) for r, i, n, q, t, tid, name, ms in rows],
                        columns=["hash", "request_id", "tool_index", "nulls", "seq", "tool_args", "tool_id", "tool_name", "ts_ms"])


def test_calls_of_a_batch_share_their_access_to_the_state():
    store = Store()
    p = A._ToolCalls(1000)
    p.init(store)
    for batch in range(3):
        frame = calls_frame([(c, 0, 0, batch, "x", None, None, 10) for c in range(2000)])
        out = [r for f in p.handleInputRows((0,), iter([frame]), Time(0)) for r in f.itertuples(index=False)]
        assert len(out) == 2000 and {(r.arguments, r.n_fragments) for r in out} == {("x" * (batch + 1), batch + 1)}
    assert store.trips <= 9


@pytest.mark.parametrize("seed", range(12))
def test_groups_of_calls_equal_a_state_for_each_call(seed, monkeypatch):
    monkeypatch.setattr(A, "MERGE", 3)
    monkeypatch.setattr(A, "COLUMNS", 256 if seed % 2 else 0)
    rng, ttl, store, model, watermark = np.random.default_rng(seed), 60, Store(), {}, 0
    p = A._ToolCalls(ttl)
    p.init(store)
    for batch in range(40):
        rows = []
        for _ in range(int(rng.integers(0, 12))):
            ids = (int(rng.integers(0, 4)), int(rng.integers(0, 3)), int(rng.integers(0, 2)))
            q = int(rng.integers(0, 6))
            rows.append((*ids, q, None if q == 5 else f"<{batch // 8}.{q}>", f"c{batch}" if q < 2 else None, "f" if q == 0 else None,
                         watermark + 1 + int(rng.integers(0, 80))))
        want = {}
        for ids in {r[:3] for r in rows}:
            mine = [r for r in rows if r[:3] == ids]
            c = model.get(ids)
            if c is None or c["last"] + ttl <= watermark:
                c = {"text": {}, "last": 0, "id": (None, None), "name": (None, None)}
            fresh = {}
            for r in mine:
                if r[3] not in c["text"]:
                    fresh.setdefault(r[3], r[4] or "")
            for k, at in (("id", 5), ("name", 6)):
                better = [(r[3], r[at]) for r in mine if r[at] is not None and (c[k][0] is None or r[3] < c[k][0])]
                c[k] = min(better, default=c[k])
            c["last"] = max(c["last"], *(r[7] for r in mine))
            c["text"] |= fresh
            model[ids] = c
            if fresh:
                want[ids] = (c["id"][1], c["name"][1], "".join(c["text"][q] for q in sorted(c["text"])), len(c["text"]))
        frame = calls_frame(rows)
        got = [r for f in (p.handleInputRows((0,), iter([frame]), Time(watermark)) if rows else ()) for r in f.itertuples(index=False, name=None)]
        assert {r[:3]: r[3:] for r in got} == want and len(got) == len(want)
        for at in sorted(t for t in store.timers if t <= watermark):
            store.timers.discard(at)
            assert not list(p.handleExpiredTimer((0,), Time(watermark), None))
        watermark += int(rng.integers(0, 25))
    assert store.map
    for at in sorted(store.timers):
        assert not list(p.handleExpiredTimer((0,), Time(10_000), None))
    assert not store.map  # nothing outlives its calls


def test_a_message_is_kept_as_one_packed_value():
    from pyspark.sql import Row

    class Value(Store):
        value = None

        def getValueState(self, *_):
            return self

        getListState = getValueState

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

        def clear(self):
            self.value = None

    store = Value()
    p = A._Messages(1000)
    p.init(store)

    def rows(seqs):
        return [Row(request_id=1, seq=q, content=f"<{q}>", finish_reason="stop" if q == 299 else None, ts_ms=10) for q in seqs]

    assert not list(p.handleInputRows((1,), rows(range(299, 0, -1)), Time(0)))
    assert [type(x) for x in store.value] == [bytes]
    (out,) = p.handleInputRows((1,), rows([0, 5]), Time(0))
    assert (out.content, out.n_chunks, out.complete) == ("".join(f"<{q}>" for q in range(300)), 300, True)
    assert not list(p.handleInputRows((1,), rows([7]), Time(0)))
    (late,) = p.handleExpiredTimer((1,), Time(5000), type("Info", (), {"getExpiryTimeInMs": lambda self: 5000})())
    assert (late.event, late.n_late) == ("late", 1)
