"""Exact n-gram Jaccard join with a token-group matrix.

Two documents link if the Jaccard similarity of their sets of five-word shingles is at least 0.8; the operator returns the
connected components of the links. The steps, each a Spark job over written tables:

1. *Profiles.* Every text gives its number of shingles and a class, the hash of its whole set: exact copies fold into one
   class here. The same pass adds shingle frequencies of all texts up in a counting sketch of fixed size.
2. *Tokens.* Shingles are ordered by (sketch count, hash), rarest first. If two sets reach the threshold, some token is among
   the first n - ceil(0.8 n) + 1 of both, so only these are shuffled; passages that many documents share come last.
3. *Groups.* In every token's list the smallest class leads. A class joins the group of the leader of most of its tokens, so
   copies of one text, close or not so close, come together.
4. *Matrix.* The token union of each group is its rows (token, group), with the number and the smallest and largest size of
   the classes that hold the token. Every class is a query against the groups: the number of its tokens in a union bounds
   its overlap with any member. Two groups are opened to each other for the members whose bounds suffice.
5. *Opening.* Those members meet in blocks of bounded size, where sets are compared in full. A block returns links that join
   what it found to be connected, not all pairs.

A pair that reaches the threshold shares a token of both prefixes, and the bound of either document against the other's
group suffices: no link between different components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.components import components
from flowguard.llm.grams import U, chunks, mix, shingle_sets, signed, text_buffers
from flowguard.llm.registry import query, table
from flowguard.llm.tables import Stored, free_name

WORDS, PERCENT = 5, 80
SKETCH_BITS, CHUNK_BITS = 20, 16  # 2**20 counters of 4 bytes: 4 MB, whatever the corpus
HOT_LIST = 4096  # longer token lists are split between tasks
BLOCK_TOKENS = 1_000_000  # shingles (8 bytes each) of one side of an opened block
FILTER_WORDS = 1 << 17  # 64-bit words of the filter of wanted ids: 1 MB
ASKS, HELD = 1, 2
SMALLEST = 4  # a set of fewer shingles reaches 0.8 with equal sets only


def class_of(found: np.ndarray) -> int:
    """64-bit hash of a set of shingles, whatever their order."""
    total = mix(found ^ U(0x5851F42D4C957F2D)).sum(dtype=U, keepdims=True)
    return int(signed(mix(total + mix(np.array([len(found)], U))))[0])


def least_overlap(n: Column) -> Column:
    """Shingles that a set of n must share with any partner."""
    return F.floor((4 * n + 4) / 5)


def after_prefix(n: Column) -> Column:
    """Shingles of a set behind its prefix."""
    return least_overlap(n) - 1


def can_reach(shared: Column, a: Column, b: Column) -> Column:
    """Whether sets of a and b shingles that share ``shared`` prefix tokens may reach the threshold.

    Whichever prefix ends first, the other overlap lies behind it. The threshold asks for 4/9 of both sizes together.
    """
    return (9 * (shared + F.greatest(after_prefix(a), after_prefix(b))) >= 4 * (a + b)) & (5 * F.least(a, b) >= 4 * F.greatest(a, b))


# 1. profiles and sketch

PROFILE = "doc_id long, n long, class long, chunk int, part int, counts binary"


def profile(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n, class) and, per task, rows (chunk, part, counts) of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(1 << SKETCH_BITS, np.int64)
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("class", pa.int64()), ("chunk", pa.int32()),
                            ("part", pa.int32()), ("counts", pa.binary())])
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            sizes, classes = [], []
            for a, b in chunks(offsets):
                sets = list(shingle_sets(data, offsets[a : b + 1], WORDS))
                sizes += [len(s) for s in sets]
                classes += [class_of(s) if len(s) else None for s in sets]
                np.add.at(sketch, (np.concatenate(sets) >> U(64 - SKETCH_BITS)).astype(np.int64), 1)
            nothing = [pa.nulls(len(sizes), t) for t in (pa.int32(), pa.int32(), pa.binary())]
            yield pa.record_batch([batch.column("doc_id").cast(pa.int64()), pa.array(sizes, pa.int64()), pa.array(classes, pa.int64()), *nothing], schema=schema)
        part = TaskContext.get().partitionId()
        pieces = [(i, pack(c)) for i, c in enumerate(sketch.reshape(-1, 1 << CHUNK_BITS)) if c.any()]
        if pieces:
            yield pa.record_batch([*[pa.nulls(len(pieces), pa.int64())] * 3, pa.array([i for i, _ in pieces], pa.int32()),
                                   pa.array([part] * len(pieces), pa.int32()), pa.array([x for _, x in pieces], pa.binary())], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, PROFILE)


def pack(counts: np.ndarray) -> bytes:
    """Counters as bytes: all of them, or the non-zero ones with their places if that is shorter."""
    at = np.flatnonzero(counts)
    capped = np.minimum(counts, 0xFFFFFFFF).astype(np.uint32)
    if 6 * len(at) < 4 * len(counts):
        return b"S" + at.astype(np.uint16).tobytes() + capped[at].tobytes()
    return b"D" + capped.tobytes()


def unpack(data: bytes) -> np.ndarray:
    out = np.zeros(1 << CHUNK_BITS, np.int64)
    if data[:1] == b"D":
        out += np.frombuffer(data, np.uint32, offset=1)
    else:
        n = (len(data) - 1) // 6
        out[np.frombuffer(data, np.uint16, n, 1)] = np.frombuffer(data[1 + 2 * n :], np.uint32)
    return out


def merge_sketch(pieces: DataFrame) -> np.ndarray:
    """Sum of the tasks' sketches, in rounds of at most 64 pieces per group."""

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(unpack(x) for x in frame["counts"])
        return pd.DataFrame({"chunk": [frame["chunk"].iloc[0]], "part": [frame["part"].iloc[0] // 64], "counts": [pack(total)]})

    top = pieces.agg(F.max("part")).first()[0]
    sketch = np.zeros((1 << (SKETCH_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.int64)
    if top is None:
        return sketch.ravel()
    while True:
        pieces = pieces.groupBy("chunk", F.floor(F.col("part") / 64).alias("_g")).applyInPandas(add, "chunk int, part int, counts binary")
        top //= 64
        if not top:
            break
    for row in pieces.collect():
        sketch[row["chunk"]] = unpack(bytes(row["counts"]))
    return sketch.ravel()


# 2. tokens

def prefix_tokens(docs: DataFrame, sketch: np.ndarray) -> DataFrame:
    """(token, class, n, salt, ways): the prefix of every class, once per task that meets it."""
    # The order only steers the work: an exact total order over tokens, whatever the counts.
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(sketch, (1 << 24) - 1).astype(np.uint32))
    usual = int(2 * sketch.mean())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = shared.value, set()
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in chunks(offsets):
                tokens, owners, sizes = [], [], []
                for found in shingle_sets(data, offsets[a : b + 1], WORDS):
                    n = len(found)
                    if n < SMALLEST or (c := class_of(found)) in seen:
                        continue
                    seen.add(c)
                    key = (counts[(found >> U(64 - SKETCH_BITS)).astype(np.int64)].astype(U) << U(40)) | (found << U(SKETCH_BITS) >> U(24))
                    first = n - (4 * n + 4) // 5 + 1
                    tokens.append(np.partition(key, first - 1)[:first])
                    owners.append((c, first))
                    sizes.append(n)
                if not tokens:
                    continue
                token = np.concatenate(tokens)
                repeat = [k for _, k in owners]
                owner = np.repeat(np.array([c for c, _ in owners], np.int64), repeat)
                above = np.maximum((token >> U(40)).astype(np.int64) - usual, 0)
                ways = 1 + above // HOT_LIST
                yield pa.record_batch(
                    [pa.array(signed(token)), pa.array(owner), pa.array(np.repeat(np.array(sizes, np.int32), repeat)),
                     pa.array((owner % ways).astype(np.int32)), pa.array(ways.astype(np.int32))], ["token", "class", "n", "salt", "ways"])

    return docs.select("text").mapInArrow(run, "token long, class long, n int, salt int, ways int")


def shared_tokens(tokens: DataFrame) -> DataFrame:
    """Rows of lists with two classes at least, with the list's leader; hot lists are kept in parts."""
    part = Window.partitionBy("token", "salt")
    led = tokens.withColumn("leader", F.min("class").over(part)).withColumn("_last", F.max("class").over(part))
    led = led.filter((F.col("leader") != F.col("_last")) | (F.col("ways") > 1)).drop("_last")
    # Tasks may have sent the same class: the rows already lie together.
    return led.groupBy("token", "salt", "class", "n", "ways").agg(F.min("leader").alias("leader")).drop("salt")


# 3. groups, 4. matrix

def with_groups(shared: DataFrame) -> DataFrame:
    """(token, class, n, group) of the shared tokens."""
    counts = shared.groupBy("class", "leader").agg(F.count("*").alias("x"))
    best = counts.groupBy("class").agg(F.max(F.struct("x", "leader")).alias("b"))
    return shared.select("token", "class", "n").join(best.select("class", F.col("b.leader").alias("group")), "class")


def matrix_pairs(rows: DataFrame) -> DataFrame:
    """(class, n, lo, hi, role): the pairs of groups that each class is opened in.

    A class meets every group with its tokens, its own too if another member has the token; a token counts if a class of
    the group has it whose size is within 4/5 to 5/4 of the query's. In a pair of groups the members of ``hi`` ask those of
    ``lo``; inside a group all do both.
    """
    union = rows.groupBy("token", F.col("group").alias("g")).agg(
        F.count("*").alias("k"), F.min("n").alias("low"), F.max("n").alias("high")
    )
    asks = (F.col("group") != F.col("g")) | (F.col("k") > 1)
    fits = (5 * F.col("high") >= 4 * F.col("n")) & (4 * F.col("low") <= 5 * F.col("n"))
    met = rows.join(union, "token").filter(asks & fits)
    bound = met.groupBy("class", "n", "group", "g").agg(F.count("*").alias("x"), F.min("low").alias("low"), F.max("high").alias("high"))
    # For a fixed query the bound is weakest at the smallest or largest member within 4/5 to 5/4 of its size, or next to the
    # largest: the prefix rule grows by 4 in 5 sizes, so where it stands still (5k - 1 to 5k) the smaller size passes first.
    least = F.greatest(F.col("low"), F.ceil(F.col("n") * 4 / 5))
    most = F.least(F.col("high"), F.floor(F.col("n") * 5 / 4))
    reach = can_reach(F.col("x"), F.col("n"), least) | can_reach(F.col("x"), F.col("n"), most)
    reach = reach | ((most > least) & can_reach(F.col("x"), F.col("n"), most - 1))
    role = F.when(F.col("group") == F.col("g"), ASKS | HELD).when(F.col("group") > F.col("g"), ASKS).otherwise(HELD)
    return bound.filter((least <= most) & reach).select(
        "class", "n", F.least("group", "g").alias("lo"), F.greatest("group", "g").alias("hi"), role.alias("role"))


def shingles_of(docs: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, tokens) of the wanted classes, once each, from the text of one document each.

    A bit filter of fixed size over the ids keeps most other texts from being read again; what it lets through by
    chance is dropped by the join.
    """
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(64 * FILTER_WORDS))
    ids = wanted.join(classes, "class").select("class", F.col("rep").alias("doc_id"))
    filled = ids.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(doc_id), 64) as int))")).alias("bits")).collect()
    bits = np.zeros(FILTER_WORDS, np.int64)
    for row in filled:
        bits[row["w"]] = row["bits"]
    spread = docs.sparkSession.sparkContext.broadcast(bits.view(U))

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        x = h.to_numpy(np.int64)
        at = x % (64 * FILTER_WORDS)
        return pd.Series(((spread.value[at >> 6] >> (x % 64).astype(U)) & U(1)) == 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for a, b in chunks(offsets):
                sets = [s for s in shingle_sets(data, offsets[a : b + 1], WORDS) if len(s) >= SMALLEST]
                lengths = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = np.concatenate(sets) if sets else np.zeros(0, U)
                yield pa.record_batch(
                    [pa.array([class_of(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(lengths), pa.array(signed(values)))],
                    ["class", "tokens"])

    some = docs.filter("doc_id IS NOT NULL").filter(maybe(F.xxhash64("doc_id"))).select("text")
    return some.mapInArrow(run, "class long, tokens array<long>").dropDuplicates(["class"])


# 5. opening groups

def places(pairs: DataFrame) -> DataFrame:
    """(class, lo, hi, role, bin, own, i, j): the blocks that each class of an opened pair of groups goes to.

    Small pairs share a bin, large ones keep to themselves and are dealt over parts of queries (i) and members (j), so that
    a task holds about BLOCK_TOKENS shingles of either side. Pairs with one side only are dropped.
    """
    side = lambda bit: F.sum(F.when(F.col("role").bitwiseAND(bit) > 0, F.col("n")).otherwise(0))
    sizes = pairs.groupBy("lo", "hi").agg(side(ASKS).alias("ask"), side(HELD).alias("hold"))
    plan = Stored(sizes.filter("ask > 0 AND hold > 0"), "plan").df
    totals = plan.agg(F.sum(F.col("ask") + F.col("hold"))).first()[0] or 0
    bins = max(1, int(totals // BLOCK_TOKENS) + 1)
    ways = lambda c: F.ceil(F.col(c) / BLOCK_TOKENS).cast("int")
    pair = F.xxhash64("lo", "hi")
    sized = plan.select("lo", "hi", F.pmod(pair, F.lit(bins)).cast("int").alias("bin"), pair.alias("_pair"), ways("ask").alias("qs"), ways("hold").alias("ms"))
    placed = pairs.join(sized, ["lo", "hi"]).withColumn("own", F.when((F.col("qs") > 1) | (F.col("ms") > 1), F.col("_pair")).otherwise(0))
    steps = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    part = lambda n: F.pmod(F.xxhash64("class"), F.col(n)).cast("int")
    keys = ["class", "lo", "hi", "bin", "own"]
    asked = placed.filter(F.col("role").bitwiseAND(ASKS) > 0).select(*keys, part("qs").alias("i"), F.explode(steps("ms")).alias("j"), F.lit(ASKS).alias("role"))
    held = placed.filter(F.col("role").bitwiseAND(HELD) > 0).select(*keys, F.explode(steps("qs")).alias("i"), part("ms").alias("j"), F.lit(HELD).alias("role"))
    return asked.union(held).groupBy(*keys, "i", "j").agg(F.bit_or("role").alias("role"))


def compare(frame: pd.DataFrame) -> pd.DataFrame:
    """Links between queries and members of each group of a block that join what is connected there."""
    out_a, out_b = [], []
    for _, part in frame.groupby(["lo", "hi"]):
        held = part[(part["role"] & HELD) > 0]
        asks = part[(part["role"] & ASKS) > 0]
        if not len(held) or not len(asks):
            continue
        ids = held["class"].to_numpy(np.int64)
        sets = [np.asarray(t, np.int64) for t in held["tokens"]]
        sizes = np.array([len(s) for s in sets])
        token, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        joined = np.arange(len(sets))  # what is known to be connected
        for q, mine in zip(asks["class"].to_numpy(np.int64), asks["tokens"]):
            mine = np.asarray(mine, np.int64)
            lo, hi = np.searchsorted(token, mine), np.searchsorted(token, mine, side="right")
            count = hi - lo
            at = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            both = np.bincount(owner[at], minlength=len(sets))
            hit = np.flatnonzero(100 * both >= PERCENT * (sizes + len(mine) - both))
            labels, first = np.unique(joined[hit], return_index=True)
            links = ids[hit[first]]
            out_a.append(np.full((links != q).sum(), q, np.int64))
            out_b.append(links[links != q])
            if len(labels) > 1:
                joined[np.isin(joined, labels)] = labels[0]
    empty = np.zeros(0, np.int64)
    return pd.DataFrame({"a": np.concatenate([empty, *out_a]), "b": np.concatenate([empty, *out_b])})


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) for every row; other columns are ignored.

    ``component_id`` is the smallest id reachable by links, its own included. A text without words, or null, has no
    shingles and no links; equal texts always link if they have words. Repeated ids are rows of their own. A row with
    a null id gets its number of shingles, links with nothing and has a null component. An empty table gives an empty
    one. Sets are told apart by 64-bit hashes.
    """
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    seen = Stored(profile(docs), "profiles")
    profiles = seen.df.filter("chunk IS NULL").select("doc_id", "n", "class")
    classes = Stored(
        profiles.filter("doc_id IS NOT NULL AND class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "classes"
    ).df
    sketch = merge_sketch(seen.df.filter("chunk IS NOT NULL").select("chunk", "part", "counts"))
    held = docs.filter("doc_id IS NOT NULL")
    shared = Stored(shared_tokens(prefix_tokens(held, sketch)), "shared")
    rows = Stored(with_groups(shared.df), "matrix")
    shared.drop()
    pairs = Stored(matrix_pairs(rows.df), "pairs")
    rows.drop()
    put = Stored(places(pairs.df), "places")
    sets = shingles_of(held, put.df.select("class").distinct(), classes)
    links = Stored(put.df.join(sets, "class").groupBy("bin", "own", "i", "j").applyInPandas(compare, "a long, b long"), "links")
    merged = components(links.df)
    for table_ in (pairs, put, links):
        table_.drop()
    top = classes.join(merged.toDF("class", "g"), "class", "left").select("class", "rep", F.coalesce("g", "class").alias("g"))
    labels = top.groupBy("g").agg(F.min("rep").alias("component_id"))
    named = top.join(labels, "g").select("class", "component_id")
    out = profiles.join(named, "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component with words: the one with the smallest id. Rows without words or id all stay."""
    found = near_duplicates(df, id_col, text)
    # Per id: repeated ids get one verdict and, if they hold words, one row. Own columns take names that the rows leave free.
    key, least, place = (free_name(df, n) for n in ("_id", "_least", "_place"))
    verdict = found.groupBy(F.col(id_col).alias(key)).agg(F.min("component_id").alias(least), F.max("n_shingles").alias("n_shingles"))
    verdict = verdict.filter(F.col(key).isNotNull() & (F.col("n_shingles") > 0)).select(key, least)
    rows = df.join(verdict, F.col(f"`{id_col}`") == F.col(key), "left")
    order = F.row_number().over(Window.partitionBy(F.col(f"`{id_col}`"), F.col(key).isNull()).orderBy(F.col(f"`{text}`").desc_nulls_last()))
    stays = F.col(key).isNull() | (F.col(least) == F.col(key))
    kept = rows.filter(stays).withColumn(place, order).filter((F.col(place) == 1) | F.col(key).isNull())
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])


@query("op6_token_group_join")
def op6_token_group_join(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))
