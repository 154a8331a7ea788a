"""ST1's grouped state: the same answers as a state for each request, with few accesses to the state store."""

import numpy as np
import pandas as pd
import pytest

from inferframe.streaming import assemble as A
from tests.test_stream_state import CHUNK, Time, at, stream


class Store:
    """The state of one group of requests, with its round trips counted."""

    def __init__(self):
        self.maps, self.timers, self.trips, self.read = {}, set(), 0, 0

    def getMapState(self, name, *_):
        store, data = self, self.maps.setdefault(name, {})

        class Map:
            def iterator(self):
                store.trips += 1
                return iter(list(data.items()))

            def getValue(self, key):
                store.trips += 1
                store.read += len(data[key][0])
                return data[key]

            def updateValue(self, key, value):
                store.trips += 1
                assert [type(x) for x in value] == [bytes]
                data[key] = value

            def removeKey(self, key):
                store.trips += 1
                del data[key]

        return Map()

    def registerTimer(self, at_ms):
        self.trips += 1
        self.timers.add(at_ms)

    def fire(self, p, watermark, key=(0,)):
        out = []
        for t in sorted(t for t in self.timers if t <= watermark):
            self.timers.discard(t)
            out += frames(p.handleExpiredTimer(key, Time(watermark), None))
        return out


def processor(store, ttl):
    p = A._MessageGroups(ttl)
    p.init(store)
    return p


def frames(found):
    return [tuple(None if pd.isna(x) else x for x in r) for f in found for r in f[list(A.EVENT_OUT.names)].astype(object).itertuples(index=False, name=None)]


def give(p, rows, watermark=0, key=(0,)):
    frame = pd.DataFrame(rows, columns=["request_id", "seq", "content", "finish", "ts_ms"])
    half = len(frame) // 2
    return frames(p.handleInputRows(key, iter([f for f in (frame[:half], frame[half:]) if len(f)]), Time(watermark)))


@pytest.mark.parametrize("seed", range(16))
def test_groups_of_requests_equal_a_state_for_each(seed, monkeypatch):
    monkeypatch.setattr(A, "MERGE", int(2 + seed % 4))
    monkeypatch.setattr(A, "PART_BYTES", [1, 100, 1000][seed % 3])
    rng, ttl, store, model, watermark = np.random.default_rng(seed), 40, Store(), {}, 0
    p = processor(store, ttl)
    events, lengths = [], {}
    for batch in range(80):
        rows = []
        for _ in range(int(rng.integers(0, 25))):
            i = int(rng.integers(0, 8))
            n = lengths.setdefault(i, 40 if i == 6 else int(rng.integers(0, 9)))
            q = int(rng.integers(-1 if i == 7 else 0, n + 2))
            rows.append((i, q, "" if q == 3 else f"<{batch}.{q}.{len(rows)}>", q == n, watermark + int(rng.integers(0, 60))))
        want = []
        for i in {r[0] for r in rows}:
            mine = [r for r in rows if r[0] == i]
            m = model.setdefault(i, {"text": {}, "fin": None, "last": 0, "answered": False, "late": 0})
            if m["answered"]:
                m["late"] += len(mine)
                continue
            for r in mine:
                m["text"].setdefault(r[1], r[2])
                if r[3]:
                    m["fin"] = r[1] if m["fin"] is None else min(m["fin"], r[1])
                m["last"] = max(m["last"], r[4])
            if m["fin"] is not None and min(m["text"]) <= 0 and all(q in m["text"] for q in range(min(m["text"]), m["fin"] + 1)):
                want.append((i, "message", "".join(m["text"][q] for q in sorted(m["text"]) if q <= m["fin"]), m["fin"] + 1, True, None))
                m["answered"] = True
        got = give(p, rows, watermark) if rows else []
        assert sorted(got) == sorted(want)
        over = []
        for i in [i for i, m in model.items() if m["last"] + ttl <= watermark]:
            m = model[i]
            if m["answered"]:
                del model[i]
                if m["late"]:
                    over.append((i, "late", None, None, None, m["late"]))
            else:
                over.append((i, "message", "".join(m["text"][q] for q in sorted(m["text"])), len(m["text"]), False, None))
                m["answered"], m["last"] = True, max(m["last"], watermark)
        ended = store.fire(p, watermark)
        assert sorted(ended, key=str) == sorted(over, key=str)
        events += [(e[1], e[4]) for e in got + ended]
        watermark += int(rng.integers(0, 30)) + (150 if batch % 9 == 8 else 0)
    assert {("message", True), ("message", False), ("late", None)} <= set(events)
    for w in (10_000, 20_000):
        store.fire(p, w)
    assert not any(store.maps.values())  # nothing outlives its requests


def test_requests_of_a_batch_share_their_access_to_the_state():
    store = Store()
    p = processor(store, 1000)
    assert not give(p, [(i, q, f"<{i}.{q}>", q == 9, 10) for i in range(300) for q in range(10) if q != 4])
    out = give(p, [(i, 4, f"<{i}.4>", False, 10) for i in range(300)])
    assert sorted(out) == [(i, "message", "".join(f"<{i}.{q}>" for q in range(10)), 10, True, None) for i in range(300)]
    assert not give(p, [(i, 4, "again", False, 10) for i in range(300)])
    assert store.trips <= 15 and not store.maps["parts"]


def test_a_request_that_waits_is_not_read_in_every_batch():
    store = Store()
    p = processor(store, 1000)
    for q in range(199, 0, -1):  # the end comes first
        assert not give(p, [(1, q, "x" * 100, q == 199, 10)])
    assert not store.read
    ((_, _, text, n, whole, _),) = give(p, [(1, 0, "y", False, 10)])
    assert (text, n, whole) == ("y" + "x" * 19_900, 200, True)
    assert not store.maps["parts"]


def test_a_fragment_without_place_or_time_is_an_error():
    for row in [(1, None, "a", False, 1), (1, 0, "a", False, None)]:
        with pytest.raises(ValueError, match="without seq or ts"):
            give(processor(Store(), 10), [row])


@pytest.mark.parametrize("grouped", [True, False])
def test_both_forms_answer_alike(spark, grouped):
    hour, null = 3_600_000, None
    out = stream(spark, CHUNK, [
        [(null, 1, "n", "stop", at(0)), (-5, 0, "min", "stop", at(0)), (2, 0, null, null, at(0)), (2, 1, "b", "stop", at(0)), (4, 1, "q", null, at(0))],
        [(null, 0, "m", null, at(0)), (-5, 0, "min", "stop", at(0)), (0, 0, "zero", "stop", at(0)), (0, 5, "past the end", null, at(0))],
        [(99, 0, "z", null, at(0, day=2))], [(99, 1, "z", null, at(0, day=3))], [(99, 2, "z", null, at(0, day=5))], [(99, 3, "z", null, at(0, day=7))],
    ], lambda s: A.stream_content_events(s, watermark="1 hour", ttl_ms=hour, grouped=grouped))
    rows = [tuple(r) for r in out.select("request_id", "event", "content", "n_chunks", "complete", "n_late")
            .filter("request_id is null or request_id <> 99").collect()]
    assert sorted(rows, key=str) == sorted([
        (null, "message", "mn", 2, True, null), (-5, "message", "min", 1, True, null), (2, "message", "b", 2, True, null), (0, "message", "zero", 1, True, null),
        (-5, "late", null, null, null, 1), (4, "message", "q", 1, False, null)], key=str)
