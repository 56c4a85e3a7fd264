"""Fusing detector results per flow as they arrive, with early completion and a time-out.

Time is the clock of the machine or, where results carry one, their own event time. Under event time a flow's state follows
from its results alone: rows of a batch are taken in event order, a row later than the open group's time-out closes the group
first, and the watermark closes what no row does. The same results in the same order give the same flows, however they are cut
into batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from flowguard.operators.correlate import EARLY_RULES
from flowguard.schema import MODULES

TIMEOUT_MS = 30_000

RESULT = "key string, module string, score double, is_anomalous boolean, features string, arrival long, flow string"
FUSED = (
    "key string, "
    + ", ".join(f"{m.lower()} struct<score: double, is_anomalous: boolean, features: string>" for m in MODULES)
    + ", first_arrival long, flow string, reason string"
)
_STATE = "module string, score double, is_anomalous boolean, features string, arrival long, flow string"
COLUMNS = ["key", *[m.lower() for m in MODULES], "first_arrival", "flow", "reason"]

#: Flows by event time are kept in so many buckets, whatever their number.
BUCKETS = 4096
_TAKEN = ("key", "module", "us", "arrival", "score", "is_anomalous", "features", "flow")
_EVENT_ORDER = itemgetter(2, 3)


def first_per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keep the first result per flow and detector, so that repeats stay on their side of the shuffle.

    Used when late results are dropped; when they reopen a flow, a repeat may count.
    """
    for pdf in batches:
        yield pdf.sort_values("arrival", kind="stable").drop_duplicates(["key", "module"])


class Correlator(StatefulProcessor):
    """State per flow: the first result of each detector and the processing time of the first one."""

    def __init__(self, rule: str = "ALL", timeout_ms: int = TIMEOUT_MS, late: str = "reopen", need_features: bool = False,
                 only_anomalous: bool = True):
        self.needed = set(EARLY_RULES[rule])
        self.timeout_ms, self.late = timeout_ms, late
        self.need_features, self.only_anomalous = need_features, only_anomalous

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.results = handle.getMapState("results", "module string", _STATE)
        self.emitted = handle.getValueState("emitted", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.emitted.exists():
            return
        known = {}
        if self.results.exists():
            known = {k[0]: tuple(v) for k, v in self.results.iterator()}
        fresh = not known
        # Dropping repeats first bounds a flow's rows, so they can be put in arrival order as a whole;
        # otherwise rows are taken as they come, ordered within each chunk.
        chunks = [pd.concat(list(rows))] if self.late == "drop" else rows
        for pdf in chunks:
            for row in pdf.sort_values("arrival", kind="stable").itertuples(index=False):
                if row.module in MODULES and row.module not in known:
                    known[row.module] = self._value(row)
                    if self.needed <= known.keys():
                        yield from self._close(key, known, "complete", now)
                        known, fresh = {}, True
                        if self.late == "drop":
                            return
        if not known:
            return
        for module, value in known.items():
            self.results.updateValue((module,), value)
        if fresh:
            self.handle.registerTimer(now + self.timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.emitted.exists():
            self.emitted.clear()
            return
        if self.results.exists():
            known = {k[0]: tuple(v) for k, v in self.results.iterator()}
            yield from self._close(key, known, "timeout", timerValues.getCurrentProcessingTimeInMs())

    @staticmethod
    def _value(row) -> tuple:
        return row.module, row.score, bool(row.is_anomalous), row.features, int(row.arrival), row.flow

    def _close(self, key, known, reason, now) -> Iterator[pd.DataFrame]:
        self.results.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        if self.late == "drop":
            # A tombstone outlives the group for one time-out; results that come later are ignored.
            self.emitted.update((now,))
            self.handle.registerTimer(now + self.timeout_ms)
        yield from self._fused(key, known, reason)

    def _fused(self, key, known, reason) -> Iterator[pd.DataFrame]:
        row = self._fields(key, known, reason)
        if row:
            yield pd.DataFrame([row], columns=COLUMNS)

    def _fields(self, key, known, reason) -> dict | None:
        """The fused row, if it is to be sent."""
        anomalous = any(v[2] for v in known.values())
        featured = "AE" in known or "IFOREST" in known
        if self.only_anomalous and not (anomalous and (featured or not self.need_features)):
            return None
        row = {"key": key[0], "first_arrival": min(v[4] for v in known.values()), "reason": reason, "flow": min(known.values(), key=lambda v: v[4])[5]}
        for m in MODULES:
            v = known.get(m)
            row[m.lower()] = None if v is None else {"score": v[1], "is_anomalous": v[2], "features": v[3]}
        return row

    def close(self) -> None:
        pass


class EventTimeCorrelator(Correlator):
    """State per bucket of flows: of an open flow its first results and the event time of the first one, of a closed one until
    when it stays closed.

    A group takes results up to ``timeout_ms`` after its first one. With ``late="drop"`` a closed flow ignores results for
    another time-out, so what repeats is not sent again; then its state is removed. A bucket's rows of one batch are held at once.
    There are many flows of a few rows each, and every call to the state store is a message to the JVM and back: flows that
    share a bucket are read, stored and timed together, as texts that need no conversion field by field. A bucket has a timer at
    or before the time its next flow is due; one that comes too early sets the next.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.results = handle.getValueState("results", "flows string")  # [[key, opened, [result, ...]], ...]
        self.shut = handle.getValueState("shut", "flows string")  # [[key, until], ...]

    def _stored(self) -> tuple[dict, dict]:
        """Open flows (key, opened, results) by key, and until when others are closed; a flow is open or closed, not both."""
        opened, shut = self.results.get(), self.shut.get()
        return {f[0]: f for f in json.loads(opened[0])} if opened else {}, dict(json.loads(shut[0])) if shut else {}

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        came, pick = {}, None
        for row in rows:
            pick = pick or itemgetter(*map(row.__fields__.index, _TAKEN))  # a row is slow to search by name
            taken = pick(row)
            if taken[1] in MODULES and taken[2] is not None:
                came.setdefault(taken[0], []).append(taken)
        if not came:
            return
        opened, shut = self._stored()
        before, changed = self._due(opened, shut), [False, False]
        for flow, taken in came.items():
            first, until = opened.pop(flow, None), shut.pop(flow, None)
            left, still = yield from self._taken(flow, taken, first, until)
            changed = [changed[0] or left is not first, changed[1] or still != until]
            if left is not None:
                opened[flow] = left
            elif still is not None:
                shut[flow] = still
        self._keep(opened, shut, changed)
        due = self._due(opened, shut)
        if due is not None and (before is None or due < before):
            self.handle.registerTimer(due)

    def _taken(self, flow, rows, stored, shut) -> Iterator[Row]:
        """Takes a flow's rows of one batch in event order; returns what is to be stored for it: the open flow, or until when it is closed."""
        opened, known = (stored[1], {v[0]: v for v in stored[2]}) if stored else (None, {})
        before = opened, len(known)
        for row in sorted(rows, key=_EVENT_ORDER) if len(rows) > 1 else rows:
            at = row[2] // 1000
            if opened is not None and at > opened + self.timeout_ms:
                yield from self._fused((flow,), known, "timeout")
                known, opened, shut = {}, None, opened + 2 * self.timeout_ms
            if self.late == "drop" and shut is not None and at <= shut:
                continue
            shut = None
            opened = at if opened is None else opened
            if row[1] not in known:
                known[row[1]] = row[1], row[4], bool(row[5]), row[6], int(row[3]), row[7]
            if self.needed <= known.keys():
                yield from self._fused((flow,), known, "complete")
                known, opened, shut = {}, None, at + self.timeout_ms
        if opened is None:
            return None, shut if self.late == "drop" else None
        return stored if (opened, len(known)) == before else [flow, opened, list(known.values())], None

    def _keep(self, opened: dict, shut: dict, changed) -> None:
        for state, flows, new in ((self.results, list(opened.values()), changed[0]), (self.shut, list(shut.items()), changed[1])):
            if new:
                state.update((json.dumps(flows),)) if flows else state.clear()

    def _due(self, opened: dict, shut: dict) -> int | None:
        """When the next flow times out, or the next closed one may be forgotten."""
        ends = [f[1] + self.timeout_ms + 1 for f in opened.values()]
        ends.extend(until + 1 for until in shut.values())
        return min(ends, default=None)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        opened, shut = self._stored()
        over = [f for f in opened.values() if f[1] + self.timeout_ms < now]
        for flow, first, results in over:
            yield from self._fused((flow,), {v[0]: v for v in results}, "timeout")
            del opened[flow]
            if self.late == "drop":
                shut[flow] = first + 2 * self.timeout_ms
        kept = {flow: until for flow, until in shut.items() if until >= now}
        self._keep(opened, kept, (bool(over), bool(over) or len(kept) < len(shut)))
        due = self._due(opened, kept)
        if due is not None:
            self.handle.registerTimer(due)

    def _fused(self, key, known, reason) -> Iterator[Row]:
        row = self._fields(key, known, reason)
        if row:
            yield Row(**{c: Row(**row[c]) if isinstance(row[c], dict) else row[c] for c in COLUMNS})


def correlate_stream(results: DataFrame, time: str | None = None, delay: str = "0 seconds", buckets: int = BUCKETS, **options) -> DataFrame:
    """Fused rows from a stream of (key, module, score, is_anomalous, features, arrival), and ``flow``, a text that the first
    result hands on, if there is such a column.

    With ``time``, a timestamp column, time-outs follow event time with results at most ``delay`` out of order. The flows of a
    bucket are stored together: more ``buckets`` suit very many open flows and small batches; the number stays with the checkpoint.
    """
    flow = F.col("flow").cast("string") if "flow" in results.columns else F.lit(None).cast("string")
    narrow = results.select("key", "module", "score", "is_anomalous", "features", F.col("arrival").cast("long").alias("arrival"), flow.alias("flow"),
                            *([F.col(time).alias("at"), F.unix_micros(time).alias("us")] if time else []))
    if time:
        narrow = narrow.withWatermark("at", delay)
    elif options.get("late") == "drop":
        narrow = narrow.mapInPandas(first_per_batch, RESULT)
    # Stateful processors need this state store.
    results.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    if time:
        flows = narrow.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket")
        return flows.transformWithState(EventTimeCorrelator(**options), outputStructType=FUSED, outputMode="Append", timeMode="EventTime")
    return narrow.groupBy("key").transformWithStateInPandas(Correlator(**options), outputStructType=FUSED, outputMode="Append", timeMode="ProcessingTime")
