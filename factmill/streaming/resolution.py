"""Resolution of a stream of claims: state per key with timers, or states kept in versioned tables.

``resolved_stream`` keeps one state per key (see ``ledger.states``: counts and extremes, no claims) in the
state store. Repeated claims are dropped by key and id while the watermark keeps them. Every batch that
tells a key something new gives a row of its new state with a revision; ``ledger.decided`` makes
answers of states, in the stream as in the batch, so there is one rule for both. A timer at the key's last
event plus ``ttl`` of event time closes the key: its row comes once more, marked closed, and its state goes. So
the store holds keys that were told of within ``ttl``, and ids within the watermark. A key that is told of
again later starts anew; where all claims must count for ever, ``maintained`` is the way.

``maintained`` gives each micro-batch to a ``Resolution``. That knows claims by id and notes the batch in
the version it commits, so a batch that comes again after a failure changes nothing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import cached_property

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from factmill.operators import ledger
from factmill.operators.incremental import Resolution

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_NAMES = [n for n, _ in ledger.STATE]
_BLANK = tuple(0 if n.startswith("n_") else False if n == "stated" else None for n in _NAMES)
BUCKETS = 1 << 14


def state_fields(value: T.DataType) -> list[T.StructField]:
    """The columns of a state over values of this type, as ``ledger.states`` makes them with a long seq."""
    kinds = {"n_": T.LongType(), "stated": T.BooleanType(), "seq": T.LongType()}
    return [T.StructField(n, next((k for p, k in kinds.items() if n.startswith(p)), value)) for n in _NAMES]


def told(state: dict, value: object, tier: str | None, confidence: str | None, seq: int | None, manual: bool, boolean: bool) -> None:
    """Adds one claim to a state. A claim without seq is never the first or the last."""
    state["n_seen"] += 1
    if value is None:
        return
    state["stated"] = True
    if manual and seq is not None and (state["seq_hand"] is None or seq > state["seq_hand"]):
        state["by_hand"], state["seq_hand"] = value, seq
    if tier not in ledger.TIERS or (boolean and value == 0):
        return
    low, first, rank = f"low_{tier}", f"seq_{tier}", {"HIGH": 0, "LOW": 2}.get(confidence, 1)
    state[low] = value if state[low] is None else min(state[low], value)
    if seq is not None and (state[first] is None or seq < state[first]):
        state[f"first_{tier}"], state[first] = value, seq
    top = f"top_{tier}{rank}"
    state[f"n_{tier}{rank}"] += 1
    state[top] = value if state[top] is None else max(state[top], value)


class KeyStates(StatefulProcessor):
    """A bucket's keys, each with its state, its last event and its revision, as one value; and one timer, for the key that closes first.

    A call of the state store costs much more than a claim does, so it is paid for a bucket and not for each key.
    """

    def __init__(self, keys: list[str], value: str, ttl_ms: int, boolean: bool, manual: str | None):
        self.keys, self.value, self.ttl_ms, self.boolean, self.manual = keys, value, ttl_ms, boolean, manual

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("resolution", T.StructType([T.StructField("held", T.BinaryType()), T.StructField("timer", T.LongType())]))

    def _held(self) -> tuple[dict, int | None]:
        """The keys' (values of the state, last event, revision), and the timer."""
        found = self.state.get()
        return (pickle.loads(found[0]), found[1]) if found else ({}, None)

    def _kept(self, held: dict, timer: int | None) -> None:
        first = min((last for _, last, _ in held.values()), default=None)
        due = None if first is None else first + self.ttl_ms
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if held:
            self.state.update((pickle.dumps(held, pickle.HIGHEST_PROTOCOL), due))
        else:
            self.state.clear()

    def _row(self, key: tuple, values: tuple, last: int, revision: int, closed: bool) -> Row:
        return self.row(*key, *values, last, revision, closed)

    @cached_property
    def row(self) -> Row:
        return Row(*self.keys, *_NAMES, "last_at", "revision", "closed")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, timer = self._held()
        now: dict[tuple, tuple[dict, int]] = {}
        for r in rows:
            own = tuple([r[k] for k in self.keys])
            if own not in now:
                values, last, _ = held.get(own, (None, -(1 << 62), 0))
                now[own] = dict(zip(_NAMES, values or _BLANK, strict=True)), last
            state, last = now[own]
            told(state, r[self.value], r["tier"], r["confidence"], r["seq"], bool(self.manual and r[self.manual]), self.boolean)
            if r["__ms"] > last:
                now[own] = state, r["__ms"]
        for own, (state, last) in now.items():
            held[own] = tuple(state.values()), last, (held[own][2] if own in held else 0) + 1
        self._kept(held, timer)
        for own in now:
            yield self._row(own, *held[own], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, _ = self._held()
        due = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) - self.ttl_ms
        over = [own for own, (_, last, _) in held.items() if last <= due]
        closed = [self._row(own, values, last, revision + 1, True) for own in over for values, last, revision in [held.pop(own)]]
        self._kept(held, None)  # the timer that went off is gone
        yield from closed

    def close(self) -> None:
        pass


def resolved_stream(claims: DataFrame, keys: list[str], id: str = "id", value: str = "value", at: str = "at", late: str = "1 day", ttl_seconds: int = 7 * 86_400, boolean: bool = False, manual: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """A stream of states: keys, the state's columns, last_at (ms), revision and closed, one row per key and batch that tells of it.

    ``claims`` has keys, id, value, tier, confidence, seq (a long) and an event time ``at``; claims later than ``late`` or
    without a time are dropped. ``ttl_seconds`` must be longer than ``late``, or a key could close before its late claims.
    Keys are plain values. The store holds them by bucket of their hash: a batch rewrites the buckets that it tells of, so there should be some
    hundred keys in one; a checkpoint holds for its number of ``buckets``.
    """
    fields = state_fields(claims.schema[value].dataType)
    claims.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    own = [*dict.fromkeys([*keys, id, value, "tier", "confidence", "seq", at, *([manual] if manual else [])])]
    rows = claims.select(*own).where(F.col(at).isNotNull()).withWatermark(at, late).dropDuplicatesWithinWatermark([*keys, id])
    rows = rows.withColumn("__ms", F.unix_millis(F.col(at).cast("timestamp")))
    out = T.StructType([*[claims.schema[k] for k in keys], *fields, T.StructField("last_at", T.LongType()), T.StructField("revision", T.LongType()), T.StructField("closed", T.BooleanType())])
    rows = rows.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    return rows.groupBy("__bucket").transformWithState(KeyStates(keys, value, ttl_seconds * 1000, boolean, manual), out, "Append", "EventTime")


def newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows that a stream of states has written, each key's newest."""
    others = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct("last_at", "revision")).alias("s")).select(*keys, "s.*")


def answers(rows: DataFrame, keys: list[str], value: str = "value", boolean: bool = False) -> DataFrame:
    """What the stream has resolved so far, as ``ledger.resolved`` tells it of the same claims."""
    return ledger.decided(newest(rows, keys), keys, value, boolean).drop("__tier")


def written(states: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the states of what is there and stops; runs again from the checkpoint."""
    return states.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def maintained(claims: DataFrame, kept: Resolution, name: str, checkpoint: str) -> StreamingQuery:
    """Applies each micro-batch of claims to ``kept``, once; runs again from the checkpoint.

    A boolean column ``live`` marks retractions by false, if there is one.
    """

    def apply(batch: DataFrame, number: int) -> None:
        live = F.coalesce(F.col("live"), F.lit(True)) if "live" in batch.columns else F.lit(True)
        batch = batch.persist()
        try:
            kept.apply(batch.where(live).drop("live"), batch.where(~live), {"stream": name, "batch": number})
        finally:
            batch.unpersist()

    return claims.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def claims_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """Claims from JSON files as they come."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)
