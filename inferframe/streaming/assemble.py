"""ST1/ST2: assemble streamed fragments in Structured Streaming.

* ``stream_assemble_content`` (ST1) answers each request once. ``stream_content_events`` is the same stream with the
  counts of late fragments. A request is emitted as soon as the finish fragment and every fragment before it (dense
  ``seq``) have arrived, however long the pauses between them, or as incomplete when the watermark passes its last
  fragment plus ``ttl``. Then the fragments go and a mark stays: fragments that are
  delivered again, or come too late, are dropped and counted. The mark goes when the watermark passes the
  last fragment plus ``ttl`` once more; by then the watermark itself keeps re-deliveries out.
  Groups of requests share their state: an index with a row per request and micro-batch, and the fragments in packed parts that
  are written once and read when a request may be whole. ``grouped=False`` gives each request a state of its own: a book
  (which fragments are there, as runs of ``seq``; where the message ends; the latest fragments) and a list to which
  fragments are moved in large pieces. It costs round trips per request and is for streams of few, long requests.
* ``stream_assemble_content_sessions`` is the built-in form for streams without reliable finish
  markers: a request's stream ends with an inactivity gap (``session_window``), so a longer pause
  splits a message.
* ``stream_assemble_tool_calls`` (ST2) keeps the fragments per (request, tool index). Calls are short and many, so groups of
  them share their state, which is read and written in packed pieces. Every micro-batch emits
  the changed calls; the sink keeps the latest row per call. A call ends when the watermark passes its last
  fragment plus ``ttl``.
* ``stream_tool_call_snapshots`` (ST2, built-in operators only) is an aggregation in update mode; its state
  lasts as long as the query, so it is for streams that end (backfills, ``availableNow``).

The stateful forms need the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

EVENT_OUT = T.StructType([
    T.StructField("request_id", T.LongType()), T.StructField("event", T.StringType()),
    T.StructField("content", T.StringType()), T.StructField("n_chunks", T.LongType()),
    T.StructField("complete", T.BooleanType()), T.StructField("n_late", T.LongType()),
])
SHARD_OUT = T.StructType([
    T.StructField("request_id", T.LongType()), T.StructField("tool_index", T.LongType()), T.StructField("nulls", T.IntegerType()),
    T.StructField("tool_id", T.StringType()), T.StructField("tool_name", T.StringType()),
    T.StructField("arguments", T.StringType()), T.StructField("n_fragments", T.LongType()),
])


def merge_runs(starts: np.ndarray, ends: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Add fragments ``seq`` to the sorted runs [start, end]: (starts, ends, fresh), where ``fresh`` marks the first
    delivery of each fragment that no run held."""
    fresh = np.zeros(len(seq), bool)
    fresh[np.unique(seq, return_index=True)[1]] = True
    at = np.searchsorted(starts, seq, side="right") - 1
    if len(starts):
        fresh &= (at < 0) | (seq > ends[at])
    if not fresh.any():
        return starts, ends, fresh
    s, e = np.concatenate([starts, seq[fresh]]), np.concatenate([ends, seq[fresh]])
    order = np.argsort(s)
    s, e = s[order], e[order]
    head = np.ones(len(s), bool)
    head[1:] = s[1:] != e[:-1] + 1
    first = np.flatnonzero(head)
    return s[first], e[np.append(first[1:], len(s)) - 1], fresh


#: characters of text kept in the book itself; beyond, they go to the list
INLINE_CHARS = 32_768


class _Fragments(StatefulProcessor):
    """State of ST1: the ``book`` of a key, with the fragments not yet moved to the list of ``parts``, and one
    timer, moved lazily. Every access to state costs a round trip, so a short message is one value; a long one
    is appended to the list in pieces of ``INLINE_CHARS``, each written once."""

    #: starts and ends of the runs, last_ms, seq and text of the fragments held, whether others were spilled. The book is packed:
    #: arrays in state are converted element by element on either side
    NEW = ([], [], 0, [], [], False)

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.book = handle.getValueState("book", "packed binary")
        self.parts = handle.getListState("parts", "seq bigint, content string")

    def close(self) -> None:
        pass

    def read(self) -> tuple | None:
        stored = self.book.get()
        return pickle.loads(stored[0]) if stored else None

    def write(self, *book) -> None:
        self.book.update((pickle.dumps(book),))

    def append(self, known: tuple, rows: list[Row], column: str) -> tuple[tuple, bool]:
        """(the shared part of the book with the new fragments, whether there was one)."""
        starts, ends, last, held, text, spilled = known
        starts, ends, fresh = merge_runs(np.asarray(starts, np.int64), np.asarray(ends, np.int64), np.array([r.seq for r in rows], np.int64))
        new = [r for r, f in zip(rows, fresh.tolist()) if f]
        held, text = [*held, *(r.seq for r in new)], [*text, *(r[column] or "" for r in new)]
        if sum(map(len, text)) > INLINE_CHARS:
            self.parts.appendList(list(zip(held, text)))
            held, text, spilled = [], [], True
        return (starts.tolist(), ends.tolist(), max(last, *(r.ts_ms for r in rows)), held, text, spilled), bool(new)

    def text(self, known: tuple, upto: int | None = None) -> str:
        held = [*zip(known[3], known[4]), *(self.parts.get() if known[5] else ())]
        return "".join(t for q, t in sorted(held) if upto is None or q <= upto)

    def forget(self, known: tuple) -> None:
        if known[5]:
            self.parts.clear()

    def wake(self, at_ms: int, timers) -> None:
        self.handle.registerTimer(max(at_ms, timers.getCurrentWatermarkInMs() + 1))


class _Messages(_Fragments):
    """The book goes on with finish (the least seq that ends the message), emitted and the number of late fragments."""

    @staticmethod
    def row(key, event: str, content=None, n=None, complete=None, late=None) -> Row:
        return Row(request_id=key[0], event=event, content=content, n_chunks=n, complete=complete, n_late=late)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows = list(rows)
        stored = self.read()
        known, (finish, emitted, late) = (stored[:6], stored[6:]) if stored else (self.NEW, (None, False, 0))
        if emitted:
            self.write(*known, finish, True, late + len(rows))
            return
        known, _ = self.append(known, rows, "content")
        finish = min([r.seq for r in rows if r.finish_reason is not None] + ([] if finish is None else [finish]), default=None)
        if stored is None:
            self.wake(known[2] + self.ttl_ms, timerValues)
        if finish is not None and known[0] and known[0][0] <= 0 and known[1][0] >= finish:
            content = self.text(known, finish)
            self.forget(known)
            self.write([], [], known[2], [], [], False, finish, True, 0)
            yield self.row(key, "message", content, finish + 1, True)
        else:
            self.write(*known, finish, False, 0)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.read()
        known, (finish, emitted, late) = stored[:6], stored[6:]
        due = known[2] + self.ttl_ms
        if expiredTimerInfo.getExpiryTimeInMs() < due:
            self.wake(due, timerValues)
        elif emitted:
            self.book.clear()
            if late:
                yield self.row(key, "late", late=late)
        else:
            content, n = self.text(known), sum(e - s + 1 for s, e in zip(*known[:2]))
            self.forget(known)
            last = max(known[2], timerValues.getCurrentWatermarkInMs())
            self.write([], [], last, [], [], False, finish, True, 0)
            self.wake(last + self.ttl_ms, timerValues)
            yield self.row(key, "message", content, n, False)


def _timed(chunks: DataFrame, watermark: str) -> DataFrame:
    return (chunks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
            .withColumn("ts_ms", (F.unix_micros("ts") / 1000).cast("bigint")))


#: groups of requests or calls that share their state. A group that a batch touches costs a few round trips to the state store,
#: however many requests or calls of it the batch holds, and one look through the group's ids
SHARDS = 1024
#: small pieces of a group's state that are merged when there are as many, and the bytes up to which a piece is small
MERGE, SMALL = 16, 4 << 20
#: bytes of fragments in one part of a group's state
PART_BYTES = 128 << 10

PART = pa.schema([("request_id", pa.int64()), ("seq", pa.int64()), ("content", pa.large_string())])
INDEX = np.dtype([("request_id", "i8"), ("kind", "i1"), ("part", "i8"), ("n", "i8"), ("finish", "i8"), ("last_ms", "i8")])
#: kinds of index rows: ``n`` fragments in a part; the mark of an answered request; ``n`` late fragments of it; the end of all
#: rows before, as a mark is too
KEPT, MARK, LATE, GONE = range(4)
#: finish of a request without one, and the time of rows that tell none
NEVER, LONG_AGO = np.iinfo(np.int64).max, np.iinfo(np.int64).min


def index_rows(ids: np.ndarray, kind: int, part=-1, n=0, finish=NEVER, last_ms=LONG_AGO) -> np.ndarray:
    rows = np.empty(len(ids), INDEX)
    for c, v in zip(INDEX.names, (ids, kind, part, n, finish, last_ms)):
        rows[c] = v
    return rows


def live_rows(rows: np.ndarray) -> np.ndarray:
    """The rows of an index, oldest first, that no later mark or end has replaced."""
    ids, at = np.unique(rows["request_id"], return_inverse=True)
    ends = np.flatnonzero((rows["kind"] == MARK) | (rows["kind"] == GONE))
    start = np.zeros(len(ids), np.int64)
    np.maximum.at(start, at[ends], ends)
    return rows[(np.arange(len(rows)) >= start[at]) & (rows["kind"] != GONE)]


class _Known:
    """What an index of live rows tells of each request, in order of their ids: ``n`` fragments held, or late ones if it is
    answered; finish and last_ms."""

    def __init__(self, rows: np.ndarray):
        self.ids, at = np.unique(rows["request_id"], return_inverse=True)
        self.n = np.zeros(len(self.ids), np.int64)
        self.finish, self.last_ms = np.full(len(self.ids), NEVER), np.full(len(self.ids), LONG_AGO)
        self.answered = np.zeros(len(self.ids), bool)
        np.add.at(self.n, at, rows["n"])
        np.minimum.at(self.finish, at, rows["finish"])
        np.maximum.at(self.last_ms, at, rows["last_ms"])
        self.answered[at[rows["kind"] == MARK]] = True

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each id is known, where)."""
        if not len(self.ids):
            return np.zeros(len(ids), bool), np.zeros(len(ids), np.int64)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        return self.ids[at] == ids, at


def first_deliveries(rows: pa.Table) -> pa.Table:
    """Fragments in order of request and seq, each as it came first."""
    ids, seq = rows["request_id"].to_numpy(), rows["seq"].to_numpy()
    order = np.lexsort((seq, ids))  # stable
    ids, seq = ids[order], seq[order]
    first = np.ones(len(order), bool)
    first[1:] = (ids[1:] != ids[:-1]) | (seq[1:] != seq[:-1])
    return rows.take(pa.array(order[first]))


def heads(ids: np.ndarray) -> np.ndarray:
    """Where the rows of each request begin, in rows in order of requests."""
    return np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)


def joined(content: pa.ChunkedArray, counts: np.ndarray) -> list[str]:
    """The texts of as many fragments each as ``counts`` tells."""
    offsets = pa.array(np.append(0, np.cumsum(counts)), pa.int64())
    flat = pa.concat_arrays(content.chunks) if content.num_chunks else pa.array([], content.type)
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, flat), pa.scalar("", pa.large_string())).to_pylist()


class _MessageGroups(StatefulProcessor):
    """State of ST1 for a group of requests: the fragments in packed parts of about ``PART_BYTES``, in order of requests, and an
    index of them, written in one piece a micro-batch. A request's parts are read when it may be whole, that is, when it has
    more fragments than the seq of its finish. What was delivered twice shows then and is dropped, so
    it is read again only after further re-deliveries. A part goes when no request has fragments in it any more.
    The group's timer is at the earliest time that one of its requests or marks ends."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getMapState("index", "number bigint", "rows binary")
        self.parts = handle.getMapState("parts", "number bigint", "rows binary")

    def close(self) -> None:
        pass

    def load(self) -> tuple[list[int], np.ndarray]:
        """(numbers of the index's pieces, its live rows)."""
        pieces = sorted((k[0], bytes(v[0])) for k, v in self.index.iterator())
        rows = np.frombuffer(b"".join(b for _, b in pieces), INDEX)
        return [n for n, _ in pieces], live_rows(rows)

    def save(self, numbers: list[int], held: np.ndarray, changes: list[np.ndarray]) -> np.ndarray:
        """Add changes to the index and drop parts without live rows; returns the live rows."""
        now = live_rows(np.concatenate([held, *changes]))
        for n in np.setdiff1d(held["part"][held["kind"] == KEPT], now["part"]).tolist():
            self.parts.removeKey((n,))
        if len(numbers) + 1 < MERGE and len(now):
            self.index.updateValue((max(numbers, default=-1) + 1,), (np.concatenate(changes).tobytes(),))
            return now
        for n in numbers:
            self.index.removeKey((n,))
        late = now[now["kind"] == LATE]
        ids, at = np.unique(late["request_id"], return_inverse=True)
        now = np.concatenate([now[now["kind"] != LATE], index_rows(ids, LATE, n=np.bincount(at, late["n"], len(ids)).astype(np.int64))])
        if len(now):
            self.index.updateValue((0,), (now.tobytes(),))
        return now

    def store(self, rows: pa.Table, number: int, finish: np.ndarray, last_ms: np.ndarray) -> np.ndarray:
        """Write fragments, in order of requests, to new parts; returns their index rows. finish and last_ms are given per request."""
        ids = rows["request_id"].to_numpy()
        size = np.cumsum(pc.binary_length(rows["content"]).to_numpy() + 16)
        at = np.repeat(np.arange(len(finish)), np.diff(np.append(heads(ids), len(ids))))
        part = number + np.append(0, size[:-1]) // PART_BYTES
        cuts = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (part[1:] != part[:-1])))
        for start, end in zip(starts := heads(part), [*starts[1:], len(part)]):
            piece = rows.slice(start, end - start).combine_chunks().to_batches()[0]
            self.parts.updateValue((int(part[start]),), (piece.serialize().to_pybytes(),))
        return index_rows(ids[cuts], KEPT, part[cuts], np.diff(np.append(cuts, len(ids))), finish[at[cuts]], last_ms[at[cuts]])

    def fragments(self, held: np.ndarray, ids: np.ndarray) -> list[pa.RecordBatch]:
        """The fragments held of some requests, oldest part first. A part may still have others of them that were replaced."""
        rows = held[(held["kind"] == KEPT) & np.isin(held["request_id"], ids)]
        out = []
        for n in np.unique(rows["part"]).tolist():
            part = pa.ipc.read_record_batch(pa.py_buffer(bytes(self.parts.getValue((n,))[0])), PART)
            out.append(part.filter(pa.array(np.isin(part["request_id"].to_numpy(), rows["request_id"][rows["part"] == n]))))
        return out

    def wake(self, last_ms: np.ndarray, watermark: int) -> None:
        if len(last_ms):
            self.handle.registerTimer(max(int(last_ms.min()) + self.ttl_ms, watermark + 1))

    @staticmethod
    def frame(key, ids: np.ndarray, event: str, content=None, n=None, complete=None, late=None) -> pd.DataFrame:
        shown = ids if key[0] >= 0 else None  # the group of requests without an id
        return pd.DataFrame({"request_id": shown, "event": event, "content": content, "n_chunks": n, "complete": complete, "n_late": late},
                            index=range(len(ids)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark, (numbers, held) = timerValues.getCurrentWatermarkInMs(), self.load()
        pdf = pd.concat(rows, ignore_index=True)
        if pdf[["seq", "ts_ms"]].isna().to_numpy().any():
            raise ValueError("a fragment without seq or ts")
        ids, at = np.unique(pdf["request_id"].to_numpy(), return_inverse=True)
        finish, last_ms = np.full(len(ids), NEVER), np.full(len(ids), LONG_AGO)
        ends = pdf["finish"].to_numpy(bool)
        np.minimum.at(finish, at[ends], pdf["seq"].to_numpy()[ends])
        np.maximum.at(last_ms, at, pdf["ts_ms"].to_numpy())
        new = first_deliveries(pa.table([pa.array(pdf[f.name], f.type) for f in PART], schema=PART))
        n = np.bincount(np.searchsorted(ids, new["request_id"].to_numpy()), minlength=len(ids))

        known = _Known(held)
        there, pos = known.find(ids)
        late = there.copy()
        late[there] = known.answered[pos[there]]
        more = there & ~late
        total, until, latest = n.copy(), finish.copy(), last_ms.copy()
        total[more] += known.n[pos[more]]
        until[more] = np.minimum(until[more], known.finish[pos[more]])
        latest[more] = np.maximum(latest[more], known.last_ms[pos[more]])
        full = ~late & (until != NEVER) & (total > until)
        kept = ~late & ~full

        changes = [index_rows(ids[late], LATE, n=np.bincount(at, minlength=len(ids))[late])]
        number = int(held["part"].max(initial=-1)) + 1
        mine = np.searchsorted(ids, new["request_id"].to_numpy())
        wait, wait_finish, wait_last = [new.filter(pa.array(kept[mine]))], [finish[kept]], [last_ms[kept]]
        if full.any():
            some, end = ids[full], until[full]
            every = pa.Table.from_batches([*self.fragments(held, some), *new.filter(pa.array(full[mine])).to_batches()], PART)
            every = first_deliveries(every)
            every_ids, seq = every["request_id"].to_numpy(), every["seq"].to_numpy()
            starts = heads(every_ids)
            of = np.searchsorted(some, every_ids)
            upto = seq <= end[of]
            count = np.add.reduceat(upto.astype(np.int64), starts)
            whole = (seq[starts] <= 0) & (count == end - seq[starts] + 1)
            changes += [index_rows(some[~whole], GONE), index_rows(some[whole], MARK, last_ms=latest[full][whole])]
            if whole.any():
                content = joined(every["content"].filter(pa.array(upto & whole[of])), count[whole])
                yield self.frame(key, some[whole], "message", content, end[whole] + 1, True)
            wait.append(every.filter(pa.array(~whole[of])))
            wait_finish.append(end[~whole])
            wait_last.append(latest[full][~whole])
        for table, table_finish, table_last in zip(wait, wait_finish, wait_last):
            if table.num_rows:
                changes.append(self.store(table, number, table_finish, table_last))
                number = int(changes[-1]["part"].max()) + 1
        self.save(numbers, held, changes)
        self.wake(latest[~late], watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, (numbers, held) = timerValues.getCurrentWatermarkInMs(), self.load()
        known = _Known(held)
        due = known.last_ms + self.ttl_ms <= watermark
        gone, over = due & known.answered, due & ~known.answered
        if due.any():
            ids = known.ids[over]
            if len(ids):
                every = first_deliveries(pa.Table.from_batches(self.fragments(held, ids), PART))
                count = np.diff(np.append(heads(every["request_id"].to_numpy()), every.num_rows))
                yield self.frame(key, ids, "message", joined(every["content"], count), count, False)
            told = gone & (known.n > 0)
            if told.any():
                yield self.frame(key, known.ids[told], "late", late=known.n[told])
            held = self.save(numbers, held, [index_rows(known.ids[gone], GONE), index_rows(ids, MARK, last_ms=np.maximum(known.last_ms[over], watermark))])
        self.wake(_Known(held).last_ms, watermark)


def stream_content_events(chunks: DataFrame, *, watermark: str = "10 minutes", ttl_ms: int = 3_600_000, grouped: bool = True) -> DataFrame:
    """ST1 over a streaming frame ``(request_id, seq, content, finish_reason, ts)``: one row with ``event = 'message'``
    per request (content, n_chunks, complete) and, where fragments came after it, one with ``event = 'late'``
    and their number ``n_late`` when the request's mark goes."""
    src = _timed(chunks, watermark)
    if not grouped:
        src = src.select("request_id", "seq", "content", "finish_reason", "ts_ms", "ts")  # each cell costs
        return src.groupBy("request_id").transformWithState(
            _Messages(ttl_ms), EVENT_OUT, "Append", "EventTime")
    src = src.select(
        F.when(F.col("request_id").isNull(), -1).otherwise(F.pmod(F.hash("request_id"), F.lit(SHARDS))).alias("shard"),
        F.coalesce("request_id", F.lit(0)).cast("bigint").alias("request_id"), "seq", F.coalesce("content", F.lit("")).alias("content"),
        F.col("finish_reason").isNotNull().alias("finish"), "ts_ms", "ts")
    return src.groupBy("shard").transformWithStateInPandas(_MessageGroups(ttl_ms), EVENT_OUT, "Append", "EventTime")


def stream_assemble_content(chunks: DataFrame, *, watermark: str = "10 minutes",
                            ttl_ms: int = 3_600_000, grouped: bool = True) -> DataFrame:
    """ST1: one row ``(request_id, content, n_chunks, complete)`` per request."""
    return stream_content_events(chunks, watermark=watermark, ttl_ms=ttl_ms, grouped=grouped).filter(F.col("event") == "message") \
        .select("request_id", "content", "n_chunks", "complete")


def stream_assemble_content_sessions(chunks: DataFrame, *, gap: str = "5 minutes",
                                     watermark: str = "1 hour") -> DataFrame:
    """ST1 with a session window per request (JVM only, no Python state processor).

    Output ``(request_id, content, n_chunks, complete, session_start, session_end)``;
    ``content`` holds the fragments up to the finish marker (all, if none arrived)."""
    src = chunks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", watermark)
    # a set of (seq, content): a re-sent fragment (at-least-once delivery) counts once,
    # without a separate de-duplication operator and its state
    agg = src.groupBy("request_id", F.session_window("ts", gap).alias("w")).agg(
        F.collect_set(F.struct("seq", "content")).alias("_f"),
        F.min(F.when(F.col("finish_reason").isNotNull(), F.col("seq"))).alias("_fin"))
    frags = F.array_sort("_f")
    kept = F.when(F.col("_fin").isNull(), frags).otherwise(
        F.filter(frags, lambda x: x["seq"] <= F.col("_fin")))
    return (agg.withColumn("_k", kept)
            .select("request_id",
                    F.array_join(F.transform("_k", lambda x: x["content"]), "").alias("content"),
                    F.size("_k").cast("bigint").alias("n_chunks"),
                    F.coalesce(F.size("_k") == F.col("_fin") + 1, F.lit(False)).alias("complete"),
                    F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end")))


#: rows of a group in a batch from which its new calls are taken as columns; fewer are quicker one by one
COLUMNS = 256

PIECE = pa.schema([("hash", pa.int64()), ("request_id", pa.int64()), ("tool_index", pa.int64()), ("nulls", pa.int8()),
                   ("seq", pa.int64()), ("fragment", pa.bool_()), ("tool_args", pa.string()), ("tool_id", pa.string()),
                   ("tool_name", pa.string()), ("ts_ms", pa.int64()), ("life", pa.int64())])


#: where these columns lie in a row of a piece
SEQ, FRAGMENT, ARGS, TOLD, TS, LIFE = 4, 5, 6, (7, 8), 9, 10


class _Call:
    """A call in one micro-batch: the rows known of it, and its new ones."""

    __slots__ = ("known", "rows")

    def __init__(self) -> None:
        self.known, self.rows = [], []

    def forget(self, before_ms: int) -> None:
        """Leave the rows of the call's latest life, if it lasts."""
        if self.known:
            life = max(r[LIFE] for r in self.known)
            self.known = [r for r in self.known if r[LIFE] == life]
            if max(r[TS] for r in self.known) <= before_ms:
                self.known = []

    def add(self, number: int) -> list[list]:
        """The new rows to keep: first deliveries, and those that move the call's end or tell its id or name earlier."""
        seqs, life, last, told = set(), number, None, (None, None)
        if self.known:
            seqs, life, last = {r[SEQ] for r in self.known if r[FRAGMENT]}, self.known[0][LIFE], max(r[TS] for r in self.known)
            told = [min((r[SEQ] for r in self.known if r[c] is not None), default=None) for c in TOLD]
        kept = []
        for r in self.rows:
            r[FRAGMENT], r[LIFE] = r[SEQ] not in seqs, life
            seqs.add(r[SEQ])
            for c, q in zip(TOLD, told):
                if q is not None and r[SEQ] >= q:
                    r[c] = None
            if r[FRAGMENT] or last is None or r[TS] > last or r[TOLD[0]] is not None or r[TOLD[1]] is not None:
                kept.append(r)
        return kept

    @staticmethod
    def result(rows: list[list]) -> tuple:
        text = sorted((r[SEQ], r[ARGS] or "") for r in rows if r[FRAGMENT])
        told = (min(((r[SEQ], r[c]) for r in rows if r[c] is not None), default=(None, None))[1] for c in TOLD)
        return *told, "".join(t for _, t in text), len(text)


class _ToolCalls(StatefulProcessor):
    """State of a group of calls: the fragments themselves, one packed piece a micro-batch. A call's rows are found by
    the hash of its ids, only those of the batch's calls are unpacked. A piece goes when the watermark passes the last fragment
    of all its calls plus ``ttl``; rows of calls that have gone on since move to a new piece. A call whose own time has
    passed is not continued (``life``: the piece in which the call began), whether its rows still lie there or not."""

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = handle.getMapState("pieces", "number bigint", "until_ms bigint, rows binary")

    def close(self) -> None:
        pass

    def load(self) -> dict[int, tuple[int, pa.RecordBatch]]:
        return {k[0]: (v[0], pa.ipc.read_record_batch(pa.py_buffer(bytes(v[1])), PIECE)) for k, v in self.pieces.iterator()}

    def store(self, number: int, until: int, rows: pa.RecordBatch, watermark: int) -> None:
        until = max(until, watermark + 1)
        self.pieces.updateValue((number,), (until, rows.serialize().to_pybytes()))
        self.handle.registerTimer(until)

    def rewrite(self, held: dict, numbers: list[int], watermark: int) -> None:
        """Replace pieces by one with the rows of their calls that last."""
        every = pa.Table.from_batches([held[n][1] for n in held], PIECE)
        calls, at = np.unique(every["hash"].to_numpy(), return_inverse=True)
        last = np.full(len(calls), np.iinfo(np.int64).min)
        np.maximum.at(last, at, every["ts_ms"].to_numpy())
        some = pa.Table.from_batches([held[n][1] for n in numbers], PIECE)
        until = last[np.searchsorted(calls, some["hash"].to_numpy())] + self.ttl_ms
        for n in numbers:
            self.pieces.removeKey((n,))
        if (until > watermark).any():
            rows = some.filter(pa.array(until > watermark)).combine_chunks().to_batches()[0]
            self.store(max(held) + 1, int(until.max()), rows, watermark)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark, held = timerValues.getCurrentWatermarkInMs(), self.load()
        number = max(held, default=-1) + 1
        pdf = pd.concat(rows, ignore_index=True)
        new = pa.table([pa.array(pdf[f.name], f.type) if f.name in pdf else pa.array(np.full(len(pdf), f.type == pa.bool_() or number), f.type)
                        for f in PIECE], schema=PIECE)
        wanted = new["hash"].unique()
        found = pa.Table.from_batches([b.filter(pc.is_in(b["hash"], value_set=wanted)) for _, b in held.values()], PIECE)
        order = np.lexsort((new["seq"].to_numpy(), new["hash"].to_numpy()))
        new = new.take(order)
        plain = np.zeros(len(pdf), bool)
        if len(pdf) >= COLUMNS:
            plain = self.plain(new) & ~pc.is_in(new["hash"], value_set=found["hash"]).to_numpy()
        kept, frames = new.filter(pa.array(plain)), []
        if kept.num_rows:
            frames.append(self.whole(kept))
        if kept.num_rows < new.num_rows:
            more, out = self.merged(new.filter(pa.array(~plain)), found, number, watermark)
            kept = pa.concat_tables([kept, more])
            if out:
                frames.append(pd.DataFrame(out, columns=SHARD_OUT.names))
        if kept.num_rows:
            piece, until = kept.combine_chunks().to_batches()[0], pc.max(kept["ts_ms"]).as_py() + self.ttl_ms
            self.store(number, until, piece, watermark)
            held[number] = until, piece
            small = [n for n, (_, b) in held.items() if b.nbytes < SMALL]
            if len(small) >= MERGE:
                self.rewrite(held, small, watermark)
        yield from frames

    @staticmethod
    def plain(new: pa.Table) -> np.ndarray:
        """Rows, in order of hash and seq, of calls that have their hash alone and come with no fragment twice."""
        h = new["hash"].to_numpy()
        same = h[1:] == h[:-1]
        odd = same & (new["seq"].to_numpy()[1:] == new["seq"].to_numpy()[:-1])
        for c in PIECE.names[1:4]:
            odd |= same & (new[c].to_numpy()[1:] != new[c].to_numpy()[:-1])
        return ~np.isin(h, h[1:][odd])

    @staticmethod
    def whole(new: pa.Table) -> pd.DataFrame:
        """The result of calls that are new and plain."""
        h = new["hash"].to_numpy()
        starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        ends = np.append(starts[1:], len(h))
        texts = pa.ListArray.from_arrays(pa.array(np.append(starts, len(h)), pa.int32()), pc.fill_null(new["tool_args"], "").combine_chunks())

        def told(column: str) -> list:
            at = np.minimum.reduceat(np.where(new[column].is_valid().to_numpy(), np.arange(len(h)), len(h)), starts)
            return new[column].take(pa.array(at, mask=at == len(h))).to_pylist()

        return pd.DataFrame({**{c: new[c].to_numpy()[starts] for c in PIECE.names[1:4]}, "tool_id": told("tool_id"), "tool_name": told("tool_name"),
                             "arguments": pc.binary_join(texts, "").to_pylist(), "n_fragments": ends - starts})

    def merged(self, new: pa.Table, found: pa.Table, number: int, watermark: int) -> tuple[pa.Table, list[tuple]]:
        """The rows to keep and the results of the other calls, one by one."""
        calls = defaultdict(_Call)
        for r in zip(*(c.to_pylist() for c in new.columns)):
            calls[r[1:4]].rows.append([*r])
        for r in zip(*(c.to_pylist() for c in found.columns)):
            if call := calls.get(r[1:4]):
                call.known.append(r)
        kept, out = [], []
        for ids, call in calls.items():
            call.forget(watermark - self.ttl_ms)
            rows = call.add(number)
            kept += rows
            if any(r[FRAGMENT] for r in rows):  # a batch of re-deliveries changes nothing
                out.append((*ids, *call.result(call.known + rows)))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*kept), PIECE)] if kept else PIECE.empty_table().columns, schema=PIECE), out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark, held = timerValues.getCurrentWatermarkInMs(), self.load()
        if due := [n for n, (until, _) in held.items() if until <= watermark]:
            self.rewrite(held, due, watermark)
        yield from ()


def stream_assemble_tool_calls(chunks: DataFrame, *, watermark: str = "1 hour", ttl_ms: int = 3_600_000) -> DataFrame:
    """ST2 over a streaming frame ``(request_id, seq, tool_index, tool_id, tool_name,
    tool_args, ts)``: fragments of a call may come at different times, out of order and twice."""
    ids = ("request_id", "tool_index")
    src = _timed(chunks, watermark)
    src = src.select(  # no nulls in the integers: pandas would make them floats
        F.pmod(F.hash(*ids), F.lit(SHARDS)).alias("shard"), F.xxhash64(*ids).alias("hash"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ids),
        sum(F.col(c).isNull().cast("int") * (i + 1) for i, c in enumerate(ids)).alias("nulls"),
        "seq", "tool_args", "tool_id", "tool_name", F.coalesce("ts_ms", F.lit(0)).alias("ts_ms"), "ts")
    out = src.groupBy("shard").transformWithStateInPandas(_ToolCalls(ttl_ms), SHARD_OUT, "Update", "EventTime")
    return out.select(*(F.when(F.col("nulls").bitwiseAND(i + 1) == 0, F.col(c)).alias(c) for i, c in enumerate(ids)),
                      "tool_id", "tool_name", "arguments", "n_fragments")


def stream_tool_call_snapshots(chunks: DataFrame) -> DataFrame:
    """ST2 as a streaming aggregation in update mode, same columns as `stream_assemble_tool_calls`: a
    call's fragments may come at any time, out of order and twice. State is kept until the query ends."""
    def first(c: str):
        return F.min(F.when(F.col(c).isNotNull(), F.struct(F.col("seq").alias("s"), F.col(c).alias("v"))))

    agg = chunks.groupBy("request_id", "tool_index").agg(
        F.collect_set(F.struct("seq", "tool_args")).alias("_f"), first("tool_id").alias("_id"), first("tool_name").alias("_name"))
    return agg.select(
        "request_id", "tool_index", F.col("_id.v").alias("tool_id"), F.col("_name.v").alias("tool_name"),
        F.array_join(F.transform(F.array_sort("_f"), lambda x: x["tool_args"]), "").alias("arguments"),
        F.size("_f").cast("bigint").alias("n_fragments"))
