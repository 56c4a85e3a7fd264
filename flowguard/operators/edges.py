"""Burst scores of (source, destination) edges over count-min sketches.

Counts are kept per sketch cell (``mode="sketch"``) or per entity (``mode="exact"``, no hash
collisions). A cell may be touched by a large share of all events, so counting inside a cell
and slot is a chunked running count; everything between slots works on one row per cell and
slot. Scores depend on arrival order, given by a unique integer column.
"""

from __future__ import annotations

import math
import random
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.functions.scalar import burst_filtered, burst_relative, slot_number
from flowguard.operators.scan import CHUNK_BITS, attach, running, spread_join
from flowguard.session import checkpointed, scan_parallelism

# Sketch shape, merge threshold, decay and default score cutoffs by slot length.
ROWS, COLS = 2, 1024
MERGE_THRESHOLD = 1000.0
DECAY = 0.5
DEFAULT_CUTOFF = {"1min": 7062069, "2min": 1387058, "5min": 9114476}
FALLBACK_CUTOFF = 8759679

EDGE, SOURCE, DESTINATION = 0, 1, 2


def hash_params(rows: int = ROWS, seed: int = 1) -> list[int]:
    """Multipliers then offsets, drawn from 1..65535."""
    rng = random.Random(seed)
    return [rng.randrange(1, 1 << 16) for _ in range(2 * rows)]


def cell_index(a: Column, b: Column, row: int, cols: int, params: list[int]) -> Column:
    rows = len(params) // 2
    hashed = (a + b * 347) * params[row] + params[row + rows]
    return F.pmod(hashed, F.lit(cols).cast("bigint")) + row * cols


def with_slots(
    df: DataFrame, epoch: str, length: int, order: str, origin: int | None = None, keys: list[str] = ()
) -> DataFrame:
    """Slot number since the time of the first event in arrival order (or a given origin)."""
    if origin is not None:
        return df.withColumn("slot", slot_number(F.col(epoch), origin, length))
    keys = list(keys)
    first = df.groupBy(*keys).agg(F.min_by(epoch, order).alias("_origin"))
    joined = df.join(F.broadcast(first)) if not keys else spread_join(df, first, keys, order)
    return joined.withColumn("slot", slot_number(F.col(epoch), F.col("_origin"), length)).drop("_origin")


def with_instances(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """Copy every event to several detector instances that differ in slot length."""
    choices = F.array(*[F.struct(F.lit(n).alias("instance"), F.lit(s).alias("slot_len")) for n, s in lengths.items()])
    return df.withColumn("_i", F.explode(choices)).select("*", "_i.instance", "_i.slot_len").drop("_i")


def cutoff_for(stored: Column, configured: Column, slot_label: Column) -> Column:
    """Stored cutoff, else configured, else the default of the slot length."""
    default = F.lit(FALLBACK_CUTOFF)
    for label, value in DEFAULT_CUTOFF.items():
        default = F.when(slot_label == label, value).otherwise(default)
    whole = lambda c: F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(c)).try_cast("bigint")
    return F.coalesce(whole(stored), whole(configured), default.cast("bigint"))


def observed_slot(df: DataFrame, order: str, keys: list[str] = (), bits=CHUNK_BITS) -> DataFrame:
    """Slot the scorer is in when the event arrives: the clock never goes back."""
    seen = running(df, list(keys), order, {"now": ("max", F.col("slot").cast("bigint"))}, bits)
    return seen.withColumn("now", F.greatest(F.col("now"), F.lit(1).cast("bigint")))


def _events(df, order, keys, bits, state=None):
    """Narrow events with the slot the scorer is in, stored once because counting reads them repeatedly."""
    events = observed_slot(df.select(*keys, order, "src", "dst", "slot"), order, keys, bits)
    if state is not None:
        clock = state.groupBy(*keys).agg(F.max("now").alias("_clock"))
        events = events.join(F.broadcast(clock)) if not keys else spread_join(events, clock, keys, order)
        events = events.withColumn("now", F.greatest("now", F.coalesce("_clock", F.lit(1)))).drop("_clock")
    return checkpointed(events)


def _explode_cells(df, kinds, mode, rows, cols, params):
    src, dst = F.col("src").cast("bigint"), F.col("dst").cast("bigint")
    zero = F.lit(0).cast("bigint")
    pairs = {EDGE: (src, dst), SOURCE: (src, zero), DESTINATION: (dst, zero)}
    cells = []
    for kind in kinds:
        a, b = pairs[kind]
        if mode == "exact":
            cells.append((kind, 0, a, b))
        else:
            cells += [(kind, r, cell_index(a, b, r, cols, params), zero) for r in range(rows)]
    options = F.array(
        *[
            F.struct(F.lit(k).alias("kind"), F.lit(r).alias("row"), a.alias("cell"), b.alias("cell2"))
            for k, r, a, b in cells
        ]
    )
    return df.withColumn("_x", F.explode(options)).select("*", "_x.*").drop("_x")


def _slot_table(events, keys):
    """Observed slots with their dense rank and the growth of idle totals up to them.

    One row per observed slot, so its size follows elapsed time and not traffic.
    """
    slots = events.select(*keys, "now").distinct()
    order = Window.partitionBy(*keys).orderBy("now")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    growth = F.when(F.col("now") > 1, F.log1p(1 / (F.col("now") - 1))).otherwise(0.0)
    return slots.select(
        *keys,
        "now",
        F.row_number().over(order).alias("rank"),
        F.coalesce(F.sum(growth).over(before), F.lit(0.0)).alias("growth"),
    )


NEAR = 128  # slots back that one row may collect


def _decayed(ranked, cell, factor):
    """Add ``decayed``: the counts ``n`` of a cell's earlier slots, each times factor to the number of slots in between. A slot may
    have several rows.

    A factor at which 2**-64 is reached within NEAR slots looks back directly. Nearer to 1, slots fall into blocks over which
    the factor sinks to 2**-40: sums scaled inside a block, and the sums of the three blocks before it, hold all that a
    double can tell. 1 keeps everything, 0 nothing.
    """
    order = Window.partitionBy(*cell).orderBy("rank")
    if not 0 <= factor <= 1:
        raise ValueError("the decay factor must lie in [0, 1]")
    if factor in (0, 1):
        kept = F.coalesce(F.sum("n").over(order.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)) * factor
        return ranked.withColumn("decayed", kept.cast("double"))
    reach = math.ceil(64 * math.log(2) / -math.log(factor))
    if reach <= NEAR:
        past = F.collect_list(F.struct("rank", "n")).over(order.rangeBetween(-reach, -1))
        fold = F.aggregate(past, F.lit(0.0), lambda acc, p: acc + p["n"] * F.pow(F.lit(factor), F.col("rank") - p["rank"]))
        return ranked.withColumn("decayed", fold)
    length = int(40 * math.log(2) / -math.log(factor))
    power = lambda e: F.pow(F.lit(factor), e)
    block = F.floor(F.col("rank") / length)
    rows = ranked.withColumn("_block", block).withColumn("_at", F.col("rank") - block * length)
    inside = Window.partitionBy(*cell, "_block").orderBy("rank").rangeBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy(*cell).orderBy("_block")
    ended = [F.sum(F.col("n") * power(length - F.col("_at"))).over(blocks.rangeBetween(-k, -k)) * factor ** ((k - 1) * length) for k in (1, 2, 3)]
    carry = reduce(lambda a, b: a + b, [F.coalesce(e, F.lit(0.0)) for e in ended])
    own = F.coalesce(F.sum(F.col("n") * power(-F.col("_at"))).over(inside), F.lit(0.0))
    return rows.withColumn("decayed", (own + carry) * power(F.col("_at"))).drop("_block", "_at")


TASK_ROWS = 1 << 18  # touched cells that one task counts


def _tasks(events, copies):
    return math.ceil(events.count() * copies / TASK_ROWS)  # events are stored: a look at the files' footers


def _in_tasks(touched, events, keys, copies):
    """Deal touched cells to tasks of about TASK_ROWS. Spark joins shuffled partitions by their compressed size, and these rows,
    much alike, take over twenty times that in memory."""
    parts = _tasks(events, copies)
    spark = touched.sparkSession
    return touched.repartition(max(parts, scan_parallelism(spark)), *keys) if parts > spark.sparkContext.defaultParallelism else touched


def _chunks(events, keys, kinds, mode, rows, cols, params, order, ranked, bits, stored=False):
    """Touched cells, one row per event and cell, and their chunks, one row per cell, slot and run of 2**bits[0] arrivals.

    Chunks are made once and dealt by cell once; a cell has as many as slots and runs that touch it, not as events.
    """
    cell, spark = [*keys, "kind", "cell", "cell2"], events.sparkSession
    parts = _tasks(events, len(kinds) * (1 if mode == "exact" else rows))
    many = parts > spark.sparkContext.defaultParallelism
    dealt = lambda df, by: df.repartition(max(parts, scan_parallelism(spark)), *by) if many else df.repartition(*by)
    runs = events.withColumn("_c0", F.shiftright(F.col(order).cast("bigint"), bits[0]))
    # Dealt by run, events are counted where they lie: only chunks move.
    at_home = _explode_cells(dealt(runs, [*keys, "_c0"]), kinds, mode, rows, cols, params)
    chunks = at_home.groupBy(*cell, "now", "_c0").agg(F.count("*").alias("n"), F.max(order).alias("last"))
    if ranked:
        # Stored, so that Spark knows how small it is before chunks are shuffled for it.
        chunks = attach(chunks, checkpointed(_slot_table(events, keys)), [*keys, "now"])
    return _explode_cells(runs, kinds, mode, rows, cols, params), dealt(checkpointed(chunks) if stored else chunks, cell)


def _chunk_counts(chunks, events, keys, factor, state):
    """Adds a slot's events in earlier chunks ``carry``, those of earlier slots ``before`` and ``decayed``, and the slot's ``last`` event."""
    cell, at = [*keys, "kind", "cell", "cell2"], "now" if factor is None else "rank"
    slot = Window.partitionBy(*cell, at)
    earlier = Window.partitionBy(*cell).orderBy(at).rangeBetween(Window.unboundedPreceding, -1)
    carry = F.sum("n").over(slot.orderBy("_c0").rowsBetween(Window.unboundedPreceding, -1))
    chunks = chunks.withColumn("carry", F.coalesce(carry, F.lit(0))).withColumn("last", F.max("last").over(slot))
    chunks = chunks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    chunks = chunks.withColumn("decayed", F.lit(0.0)) if factor is None else _decayed(chunks, cell, factor)
    if state is not None:
        kept = state.select(*cell, F.col("current").alias("_kept"), F.col("now").alias("_kept_now"))
        chunks = attach(chunks, kept, cell)
        first = _first_slot(events, keys)
        chunks = chunks.join(F.broadcast(first)) if not keys else attach(chunks, first, keys)
        steps = F.col("rank") - F.when(F.col("_first_now") == F.col("_kept_now"), 1).otherwise(0)
        chunks = chunks.withColumn(
            "decayed",
            F.col("decayed") + F.coalesce(F.col("_kept") * F.pow(F.lit(factor), steps), F.lit(0.0)),
        )
    return chunks.select(*cell, "now", "_c0", "carry", "before", "decayed", "last")


def _counted(touched, chunks, events, keys, order, copies):
    """Touched cells with what their chunk knows, and ``inslot``, the events of the slot so far."""
    cell = [*keys, "kind", "cell", "cell2", "now", "_c0"]
    # Chunks are unique, so their partitions are even: hashed, and touched cells are sorted once, for the count.
    out = attach(_in_tasks(touched, events, cell, copies), chunks.hint("shuffle_hash"), cell)
    local = Window.partitionBy(*cell).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    inslot = F.coalesce(F.col("carry"), F.lit(0)) + F.count(F.lit(1)).over(local)
    return out.withColumn("inslot", inslot).drop("_c0", "carry")


def _touch(events, keys, kinds, mode, rows, cols, params, order, factor, bits, state=None):
    """One row per event and touched cell with ``inslot``, ``before`` and ``decayed`` counts, and the ``last`` event of the slot."""
    touched, chunks = _chunks(events, keys, kinds, mode, rows, cols, params, order, factor is not None, bits)
    known = _chunk_counts(chunks, events, keys, factor, state)
    return _counted(touched, known, events, keys, order, len(kinds) * (1 if mode == "exact" else rows))


def _first_slot(events, keys):
    return events.groupBy(*keys).agg(F.min("now").alias("_first_now"))


def plain_burst(
    df: DataFrame, order: str = "seq", keys: list[str] = (), mode: str = "sketch", rows: int = ROWS, cols: int = COLS,
    seed: int = 1, bits=CHUNK_BITS,
) -> DataFrame:
    """Count in the current slot against the count so far, per edge."""
    keys = list(keys)
    events = _events(df, order, keys, bits)
    touched = _touch(events, keys, [EDGE], mode, rows, cols, hash_params(rows, seed), order, None, bits)
    least = touched.groupBy(*keys, order, "src", "dst", "slot").agg(
        F.min("inslot").alias("_a"), F.min(F.col("before") + F.col("inslot")).alias("_s")
    )
    return least.withColumn("score", burst_relative(F.col("_a"), F.col("_s"), F.col("slot"))).drop("_a", "_s")


def relational_burst(
    df: DataFrame, order: str = "seq", keys: list[str] = (), mode: str = "sketch", rows: int = ROWS, cols: int = COLS,
    factor: float = DECAY, seed: int = 1, bits=CHUNK_BITS,
) -> DataFrame:
    """As ``plain_burst`` with decaying current counts, worst of edge, source and destination."""
    keys, kinds = list(keys), [EDGE, SOURCE, DESTINATION]
    events = _events(df, order, keys, bits)
    touched = _touch(events, keys, kinds, mode, rows, cols, hash_params(rows, seed), order, factor, bits)
    current, total = F.col("decayed") + F.col("inslot"), F.col("before") + F.col("inslot")
    least = touched.groupBy(*keys, order, "src", "dst", "slot", "now").agg(
        *[F.min(F.when(F.col("kind") == k, current)).alias(f"_a{k}") for k in kinds],
        *[F.min(F.when(F.col("kind") == k, total)).alias(f"_s{k}") for k in kinds],
    )
    scores = [burst_relative(F.col(f"_a{k}"), F.col(f"_s{k}"), F.col("now")) for k in kinds]
    return least.select(*keys, order, "src", "dst", "slot", F.greatest(*scores).alias("score"))


def filtered_burst(
    df: DataFrame, order: str = "seq", keys: list[str] = (), mode: str = "sketch", rows: int = ROWS, cols: int = COLS,
    threshold: float = MERGE_THRESHOLD, factor: float = DECAY, seed: int = 1, bits=CHUNK_BITS,
) -> DataFrame:
    """Burst score whose history skips slots that ended above ``threshold``.

    What a cell remembers depends on the score of its last event in a slot, and that score on
    the slot's start totals only. So events are counted in parallel, the recursion over slots
    sees one row per touched cell and slot, and its totals go back to the events.
    """
    keys = list(keys)
    if mode == "exact":
        return _exact_scores(df, order, keys, threshold, factor, bits)
    counted, totals, _ = _filtered(df, order, keys, rows, cols, threshold, factor, seed, bits, None, False)
    return _filtered_scores(counted, totals, order, keys, rows)


STATE_COLUMNS = ["kind", "cell", "cell2", "current", "total", "last_score", "now", "reciprocal"]


def filtered_burst_step(
    df: DataFrame, state: DataFrame | None, order: str = "seq", keys: list[str] = (), rows: int = ROWS,
    cols: int = COLS, threshold: float = MERGE_THRESHOLD, factor: float = DECAY, seed: int = 1, bits=CHUNK_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Scores of one micro-batch and the sketch state after it (sketch mode)."""
    keys = list(keys)
    counted, totals, after = _filtered(df, order, keys, rows, cols, threshold, factor, seed, bits, state, True)
    return _filtered_scores(counted, totals, order, keys, rows), after


def _filtered(df, order, keys, rows, cols, threshold, factor, seed, bits, state, keep_state):
    kinds = [EDGE, SOURCE, DESTINATION]
    events = _events(df, order, keys, bits, state)
    touched, chunks = _chunks(events, keys, kinds, "sketch", rows, cols, hash_params(rows, seed), order, True, bits, stored=True)
    touched = _counted(touched, _chunk_counts(chunks, events, keys, factor, state), events, keys, order, len(kinds) * rows)
    current = F.col("decayed") + F.col("inslot")
    regroup = [F.min(current).alias("least")]
    for r in range(rows):
        here = F.col("row") == r
        regroup += [
            F.max(F.when(here, F.col("cell"))).alias(f"cell_{r}"),
            F.max(F.when(here, current)).alias(f"current_{r}"),
            F.max(F.when(here, F.col(order) == F.col("last"))).alias(f"last_{r}"),
        ]
    # One row per event and kind, read twice below: written once instead of counted twice.
    counted = checkpointed(touched.groupBy(*keys, order, "src", "dst", "slot", "now", "kind").agg(*regroup))
    paired = [f"cell_{r}" for r in range(rows)]
    ends = [F.struct(F.col(f"cell_{r}").alias("cell"), F.col(f"current_{r}").alias("current"), F.col(f"last_{r}").alias("last")) for r in range(rows)]
    last = counted.select(*keys, "kind", "now", "least", *paired, F.explode(F.array(*ends)).alias("_e"))
    last = last.filter("_e.last").select(*keys, "kind", "now", "least", *paired, "_e.cell", "_e.current")
    starts, after = _sketch_totals(last, keys, rows, cols, threshold, factor, state, keep_state)
    # Totals per chunk: no more than 2**bits[0] events ask for one, so rows can be dealt evenly and nothing is sorted.
    place = [*keys, "kind", "now", "cell"]
    totals = checkpointed(chunks.select(*place, "_c0").join(starts.select(*place, "total"), place))
    return counted.withColumn("_c0", F.shiftright(F.col(order).cast("bigint"), bits[0])), totals, after


def _filtered_scores(counted, chunk_totals, order, keys, rows):
    scored = counted
    for r in range(rows):
        lookup = chunk_totals.withColumnsRenamed({"cell": f"cell_{r}", "total": f"_total_{r}"})
        on = [*keys, "kind", "now", f"cell_{r}", "_c0"]
        scored = attach(_in_tasks(scored, counted, on, 1), lookup.hint("shuffle_hash"), on)
    totals = [F.col(f"_total_{r}") for r in range(rows)]
    least = F.least(*totals) if rows > 1 else totals[0]
    score = burst_filtered(F.col("least"), least, F.col("now"))
    return scored.groupBy(*keys, order, "src", "dst", "slot").agg(F.max(score).alias("score"))


def _exact_scores(df, order, keys, threshold, factor, bits):
    """An entity is a cell of its own, so an event's count is its least one, and the recursion needs no more than the chunks."""
    kinds = [EDGE, SOURCE, DESTINATION]
    events = _events(df, order, keys, bits)
    touched, chunks = _chunks(events, keys, kinds, "exact", 1, COLS, hash_params(1), order, True, bits)
    counted = _counted(touched, _exact_totals(chunks, keys, threshold, factor), events, keys, order, len(kinds))
    score = burst_filtered(F.col("decayed") + F.col("inslot"), F.col("total"), F.col("now"))
    # Chunks of an entity's first slot are not sent back: there is no history, and the score is 0.
    score = F.when(F.col("cell").isNotNull() & F.col("cell2").isNotNull(), F.coalesce(score, F.lit(0.0)))
    return counted.groupBy(*keys, order, "src", "dst", "slot").agg(F.max(score).alias("score"))


def _chi(a, s, t):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(s == 0, 0.0, (a + s - a * t) ** 2 / (s * (t - 1)))


def _sketch_totals(last, keys, rows, cols, threshold, factor, state, keep_state):
    """Walk the observed slots of a sketch once; memory holds one sketch, not the group."""
    size = rows * cols
    paired = [f"cell_{r}" for r in range(rows)]
    group = [*keys, "kind"]
    frame = last.select(
        *group, "now", F.lit(False).alias("kept"), "cell", "current", "least", *paired,
        *[F.lit(0.0).alias(c) for c in ("total", "last_score", "reciprocal")],
    )
    if state is not None:
        frame = frame.unionByName(
            state.select(
                *group, "now", F.lit(True).alias("kept"), "cell", "current", F.lit(0.0).alias("least"),
                *[F.lit(0).cast("bigint").alias(c) for c in paired], "total", "last_score", "reciprocal",
            )
        )
    frame = frame.repartition(*group).sortWithinPartitions(*group, F.col("kept").desc(), "now")
    fields = {f.name: f for f in frame.schema.fields}
    out = T.StructType(
        [fields[g] for g in group]
        + [
            T.StructField("final", T.BooleanType()),
            T.StructField("now", T.LongType()),
            T.StructField("cell", T.LongType()),
            T.StructField("current", T.DoubleType()),
            T.StructField("total", T.DoubleType()),
            T.StructField("last_score", T.DoubleType()),
            T.StructField("reciprocal", T.DoubleType()),
        ]
    )
    columns = [f.name for f in out.fields]

    def emit(key, final, now, cells, s):
        data = dict(zip(group, key))
        data |= {
            "final": final, "now": now, "cell": cells, "current": s.current[cells], "total": s.total[cells],
            "last_score": s.score[cells], "reciprocal": s.reciprocal,
        }
        return pd.DataFrame(data, columns=columns)

    class Sketch:
        def __init__(self):
            self.current, self.total, self.score = np.zeros(size), np.zeros(size), np.zeros(size)
            self.now, self.reciprocal = 1, 0.0

    def walk(frames):
        sketch, key = Sketch(), None
        for pdf in frames:
            if not len(pdf):
                continue
            marks = pdf[[*group, "kept", "now"]]
            change = (marks != marks.shift()).any(axis=1).to_numpy()
            bounds = [*np.flatnonzero(change), len(pdf)]
            for start, stop in zip(bounds[:-1], bounds[1:]):
                part = pdf.iloc[start:stop]
                here = tuple(part[g].iloc[0] for g in group)
                if here != key:
                    if key is not None:
                        yield emit(key, True, sketch.now, np.arange(size), sketch)
                    sketch, key = Sketch(), here
                now, cells = int(part["now"].iloc[0]), part["cell"].to_numpy()
                if part["kept"].iloc[0]:
                    sketch.current[cells] = part["current"]
                    sketch.total[cells] = part["total"]
                    sketch.score[cells] = part["last_score"]
                    sketch.now, sketch.reciprocal = now, float(part["reciprocal"].iloc[0])
                    continue
                if sketch.now < now:
                    quiet = sketch.score < threshold
                    sketch.total += np.where(quiet, sketch.current, sketch.total * sketch.reciprocal)
                    sketch.current *= factor
                    sketch.now, sketch.reciprocal = now, 1.0 / (now - 1)
                yield emit(key, False, now, cells, sketch)
                known = np.min([sketch.total[part[c].to_numpy()] for c in paired], axis=0)
                sketch.score[cells] = _chi(part["least"].to_numpy(), known, now)
                sketch.current[cells] = part["current"]
        if key is not None:
            yield emit(key, True, sketch.now, np.arange(size), sketch)

    walked = frame.mapInPandas(walk, out).withColumn("cell2", F.lit(0).cast("bigint"))
    if keep_state:
        walked = checkpointed(walked)  # read for the scores and for the state: walked once
    starts = walked.filter("not final").select(*group, "now", "cell", "cell2", "total")
    after = walked.filter("final").select(*keys, *STATE_COLUMNS)
    return starts, after


def _exact_totals(chunks, keys, threshold, factor):
    """The same recursion per entity; idle slots have a closed form, so only touched ones count. A further chunk of a slot adds to
    its count and leaves its total alone. Chunks come dealt by entity; those without history are left out of the result."""
    entity = [*keys, "kind", "cell", "cell2"]
    frame = chunks.select(*entity, "now", "_c0", "rank", "growth", "n").sortWithinPartitions("cell", "cell2", "kind", *keys, "now", "_c0")
    fields = {f.name: f for f in frame.schema.fields}
    place = [*entity, "now", "_c0"]
    added = [T.StructField("carry", T.LongType()), T.StructField("decayed", T.DoubleType()), T.StructField("total", T.DoubleType())]
    out = T.StructType([fields[c] for c in place] + added)

    def kept(gap):
        """Sum of the factor's powers below ``gap``: what one slot's count adds to the totals until then."""
        return gap if factor == 1 else (1.0 - factor**gap) / (1.0 - factor)

    def walk(frames):
        last_key, last = None, None
        for pdf in frames:
            if not len(pdf):
                continue
            codes = np.stack([pd.factorize(pdf[c])[0] for c in entity])
            start = np.flatnonzero(np.concatenate([[True], (codes[:, 1:] != codes[:, :-1]).any(axis=0)]))
            length = np.diff(np.append(start, len(pdf)))
            now, rank, growth, n = (pdf[c].to_numpy(float) for c in ("now", "rank", "growth", "n"))
            first = pdf[entity].iloc[0]
            # total, decayed, count, score, rank and growth of every entity after its last row; an entity may go on from the last frame.
            state = np.zeros((6, len(start)))
            known = np.zeros(len(start), bool)
            if last_key is not None and all(a == b or (pd.isna(a) and pd.isna(b)) for a, b in zip(first, last_key)):
                state[:, 0], known[0] = last, True
            found = np.empty((3, len(pdf)))  # carry, decayed, total

            def advance(which, at):
                total, decayed, count, score, r, g = state[:, which]
                seen, gap = known[which], rank[at] - r
                grown = np.where(score < threshold, total + (decayed + count) * kept(gap), total * np.exp(growth[at] - g))
                total = np.where(seen, grown, 0.0)
                carry = np.where(seen & (gap == 0), count, 0.0)
                decayed = np.where(seen, np.where(gap == 0, decayed, (decayed + count) * factor**gap), 0.0)
                count = carry + n[at]
                off = decayed + count + total - (decayed + count) * now[at]
                with np.errstate(divide="ignore", invalid="ignore"):
                    score = np.where(total == 0, 0.0, off * off / (total * (now[at] - 1)))
                found[:, at] = carry, decayed, total
                state[:, which] = total, decayed, count, score, rank[at], growth[at]
                known[which] = True

            by_length = np.argsort(-length, kind="stable")
            longest = -length[by_length]
            for step in range(int(length.max())):
                live = by_length[: np.searchsorted(longest, -step, side="left")]
                if len(live) < 16:  # few long entities: row by row
                    for one in live.tolist():
                        one_by_one(one, start[one] + step, start[one] + length[one], state, known, found, now, rank, growth, n)
                    break
                advance(live, start[live] + step)
            last_key, last = tuple(pdf[entity].iloc[-1]), state[:, -1].copy()
            has = found[2] != 0
            yield pdf.loc[has, place].assign(carry=found[0, has].astype("int64"), decayed=found[1, has], total=found[2, has])

    def one_by_one(which, low, high, state, known, found, now, rank, growth, n):
        total, decayed, count, score, r0, g0 = state[:, which].tolist()
        seen = bool(known[which])
        rows = zip(range(low, high), now[low:high].tolist(), rank[low:high].tolist(), growth[low:high].tolist(), n[low:high].tolist())
        for i, at, r, g, more in rows:
            if not seen:
                total = decayed = carry = 0.0
            elif r == r0:
                carry = count
            else:
                total = total + (decayed + count) * kept(r - r0) if score < threshold else total * math.exp(g - g0)
                decayed, carry = (decayed + count) * factor ** (r - r0), 0.0
            found[:, i] = carry, decayed, total
            count = carry + more
            off = decayed + count + total - (decayed + count) * at
            score = 0.0 if total == 0 else off * off / (total * (at - 1))
            r0, g0, seen = r, g, True
        state[:, which] = total, decayed, count, score, r0, g0
        known[which] = True

    return frame.mapInPandas(walk, out)
