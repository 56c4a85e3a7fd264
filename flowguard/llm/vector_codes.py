"""Vector codes: equal parts of a vector, each named by the nearest entry of a small codebook, in whole numbers only.

Vectors are cut into consecutive parts; a part position has a codebook of its own, trained in rounds: every part goes to its
nearest entry, every entry moves to the mean of its parts, rounded down. A round is one map over the vectors whose tasks return
counts and sums per entry, so that what meets is bounded by the codebooks.

The nearest entry is found on an integer Walsh-Hadamard transform of the zero-padded parts and entries: the transform of D
numbers multiplies squared distances by D exactly. Squared differences are added up in sequency order, where smooth parts have
their weight in front; a partial sum is a lower bound, and an entry whose bound exceeds the whole sum of the entry that looked
best after the first number is out. What is left at the end has its exact distance, and the first smallest one wins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.registry import query, table
from flowguard.llm.tables import Stored
from flowguard.operators.scan import skew_join

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
CHUNK_ROWS = 4096  # vectors transformed at a time


def walsh_hadamard(x: np.ndarray) -> np.ndarray:
    """Transform of the last axis, whose length is a power of two, rows in sequency order (sign changes ascending)."""
    size, out, step = x.shape[-1], x.copy(), 1
    while step < size:
        pairs = out.reshape(*x.shape[:-1], size // (2 * step), 2, step)
        out = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2).reshape(x.shape)
        step *= 2
    return out[..., sequency_order(size)]


def sequency_order(size: int) -> np.ndarray:
    """Natural index of the Walsh function with 0, 1, 2, ... sign changes: the bit-reversed Gray code."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    out = np.zeros(size, np.int64)
    for i in range(bits):
        out |= ((gray >> i) & 1) << (bits - 1 - i)
    return out


def padded(x: np.ndarray) -> np.ndarray:
    """Zeros behind the last axis up to a power of two."""
    size = 1 << max(0, x.shape[-1] - 1).bit_length()
    out = np.zeros((*x.shape[:-1], size), np.int64)
    out[..., : x.shape[-1]] = x
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of every row of ``x``; ties go to the lower index."""
    rows, held = walsh_hadamard(padded(x)), walsh_hadamard(padded(entries))
    n, size = rows.shape
    sums = (rows[:, :1] - held[None, :, 0]) ** 2
    leader = sums.argmin(axis=1)
    most = ((rows - held[leader]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= most[:, None])
    total = sums[row, entry]
    for j in range(1, size):
        total = total + (rows[row, j] - held[entry, j]) ** 2
        stays = total <= most[row]
        row, entry, total = row[stays], entry[stays], total[stays]
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, row, total)
    best = total == least[row]
    index = np.full(n, len(held), np.int64)
    np.minimum.at(index, row[best], entry[best])
    return index, least // size  # the sum is a multiple of the transform's length


def assign(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry index, squared distance) per row and part; ``x`` is (n, parts, width), ``books`` (parts, entries, width)."""
    found = [nearest(x[:, p], books[p]) for p in range(x.shape[1])]
    return np.stack([i for i, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def integer_components(x: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as long; null if the vector or a component is null or not finite."""
    wide = F.transform(x, lambda v: v.cast("double"))
    bad = F.exists(wide, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda v: F.floor(scale * v).cast("long")))


def stacked(column: pa.Array, parts: int, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, last row, (n, parts, width) numbers) of a list column, a chunk at a time; short vectors end in zeros."""
    for at in range(0, len(column), CHUNK_ROWS):
        some = column.slice(at, CHUNK_ROWS)
        flat, sizes = some.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(some.offsets.to_numpy())
        if (sizes == parts * width).all():
            x = flat
        else:
            x = np.zeros((len(some), parts * width), np.int64)
            x[np.repeat(np.arange(len(some)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
        yield at, at + len(some), x.reshape(len(some), parts, width)


def shape_of(vectors: DataFrame, parts: int) -> int:
    """Width of a part; raises if a squared distance or a sum of them might leave 64 bits."""
    longest, most = vectors.agg(F.max(F.size("x")), F.max(F.array_max(F.transform("x", lambda v: F.abs(v))))).first()
    width = -(-(longest or 0) // parts)
    size = 1 << max(0, width - 1).bit_length()
    if (2 * (most or 0)) ** 2 * parts * width * size >= 2**62:
        raise OverflowError(f"components up to {most} do not fit exact 64-bit distances")
    return width


def first_books(vectors: DataFrame, parts: int, width: int, entries: int) -> np.ndarray:
    """Parts of the vectors with the smallest ids; of several rows with one id the smallest vector counts."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.zeros(0, np.int64)
        for batch in batches:
            least = np.unique(np.concatenate([least, batch.column(0).to_numpy(zero_copy_only=False)]))[:entries]
        yield pa.RecordBatch.from_arrays([pa.array(least)], names=["id"])

    known = vectors.filter("id IS NOT NULL")
    ids = [r["id"] for r in known.select(F.col("id").cast("long")).mapInArrow(smallest, "id long").distinct().orderBy("id").limit(entries).collect()]
    named = known.filter(F.col("id").isin(ids)).groupBy("id").agg(F.min("x").alias("x"))
    rows = [list(r["x"]) for r in named.orderBy("id").collect()]
    flat = np.zeros((len(rows), parts * width), np.int64)
    for i, row in enumerate(rows):
        flat[i, : len(row)] = row
    return flat.reshape(len(rows), parts, width).transpose(1, 0, 2).copy()


def one_round(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round of assigning all parts and moving every used entry to their mean, rounded down."""
    parts, k, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, k, width), np.int64), np.zeros((parts, k, 1), np.int64)
        for batch in batches:
            for _, _, x in stacked(batch.column(0), parts, width):
                index, _ = assign(x, books)
                for p in range(parts):
                    np.add.at(total[p], index[:, p], x[:, p])
                    count[p, :, 0] += np.bincount(index[:, p], minlength=k)
        flat = np.concatenate([count, total], axis=2).ravel()
        cell = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(flat[cell])], names=["cell", "total"])

    found = vectors.select("x").mapInArrow(sums, "cell long, total long")
    out = [0] * (parts * k * (width + 1))
    for r in found.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        out[r["cell"]] = int(r["total"])
    moved = books.copy()
    for p in range(parts):
        for e in range(k):
            at = (p * k + e) * (width + 1)
            if out[at]:
                moved[p, e] = [v // out[at] for v in out[at + 1 : at + 1 + width]]
    return moved


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts, entries, width) of (id, x array<long>) rows; fewer entries where there are fewer ids."""
    width = shape_of(vectors, parts)
    books = first_books(vectors, parts, width, entries)
    if books.size:
        kept = Stored(vectors.select("x"), "vector-parts")
        for _ in range(rounds):
            books = one_round(kept.df, books)
        kept.drop()
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: np.ndarray, x: str = "x") -> DataFrame:
    """``vectors`` without column ``x`` but with ``code`` (two hex digits a part) and ``error`` (squared distance).

    Vectors shorter than the codebooks end in zeros, as in training. Other columns, null or not, pass untouched, and may be
    called ``code`` or ``error``: theirs are then dropped.
    """
    parts, k, width = books.shape
    rest = [c for c in vectors.columns if c.lower() not in (x.lower(), "code", "error")]
    if k > 256:
        raise ValueError("two hex digits name 256 entries at most")
    hexes = np.array([f"{i:02x}" for i in range(max(k, 1))])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, values in stacked(batch.column(len(rest)), parts, width):
                index, distance = assign(values, books)
                code = hexes[index[:, 0]]
                for p in range(1, parts):
                    code = np.char.add(code, hexes[index[:, p]])
                some = batch.slice(first, last - first)
                columns = [some.column(i) for i in range(len(rest))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(code.tolist(), pa.string()), pa.array(distance.sum(axis=1))], names=[*rest, "code", "error"])

    kept = vectors.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{x}`"))
    if not k:
        return kept.filter(F.lit(False)).select(*[F.col(f"`{c}`") for c in rest], F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name != x)
    return kept.mapInArrow(coded, ", ".join(s for s in (fields, "code string, error long") if s))


def compress(df: DataFrame, id_col: str, vector: str, label: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256) of every row whose vector is whole and finite.

    Rows with a null vector or a null, NaN or infinite component are left out. ``label_error`` sums errors over equal labels,
    nulls together. Vectors whose length is no multiple of ``parts``, or shorter than the longest, count as if zeros followed.
    A null id is coded like any other but starts no codebook entry; repeated rows count and come out as often as they occur.
    An empty table gives no rows. Components whose squared distances might leave 64 bits raise OverflowError. Other columns
    are not looked at. Labels may be as uneven as they like: adaptive execution splits the join where one label is hot.
    """
    own = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label}`").alias("label"), integer_components(F.col(f"`{vector}`")).alias("x"))
    own = own.filter("x IS NOT NULL")
    books = train(own.select("id", "x"), parts, entries, rounds)
    coded = encode(own, books)
    # Nulls meet as one key: the flag tells them from any value that stands in for them.
    keyed = coded.withColumn("no_label", F.col("label").isNull()).withColumn("key", F.coalesce(F.col("label").cast("string"), F.lit("")))
    sums = keyed.groupBy("no_label", "key").agg(F.sum("error").alias("label_error"))
    out = skew_join(keyed, sums, ["no_label", "key"], "id")
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same rounds in SQL: parts as rows, every entry's distance, the first smallest, then means rounded down."""
    def assigned(i: int) -> str:
        return f"""near{i} AS MATERIALIZED (SELECT id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.id, p.part, b.entry, list_sum(list_transform(range(1, len(p.x) + 1), lambda j: CAST((p.x[j] - b.x[j]) * (p.x[j] - b.x[j]) AS HUGEINT))) AS d
    FROM parts p JOIN book{i} b ON b.part = p.part) GROUP BY id, part)"""

    steps = [f"""whole AS (SELECT rowid AS id, vec_id, label, embedding AS e, list_transform(embedding, lambda v: CAST(floor({SCALE} * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM (SELECT row_number() OVER () AS rowid, * FROM embeddings) WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0)""",
             f"""parts AS MATERIALIZED (SELECT id, vec_id, part, list_slice(x, part * (len(x) // {PARTS}) + 1, (part + 1) * (len(x) // {PARTS})) AS x
  FROM whole, (SELECT unnest(range({PARTS})) AS part))""",
             f"""firsts AS (SELECT id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT vec_id, arg_min(id, x) AS id FROM whole WHERE vec_id IS NOT NULL GROUP BY vec_id)
  ORDER BY vec_id LIMIT {ENTRIES})""",
             "book0 AS MATERIALIZED (SELECT part, entry, x FROM parts JOIN firsts USING (id))"]
    for i in range(ROUNDS):
        steps.append(assigned(i))
        steps.append(f"""mean{i} AS (SELECT part, entry, list(m ORDER BY j) AS x FROM (
    SELECT part, entry, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS m FROM (
      SELECT part, entry, j, sum(CAST(v AS HUGEINT)) AS s, count(*) AS n FROM (
        SELECT p.part, near{i}.entry, unnest(p.x) AS v, unnest(range(len(p.x))) AS j FROM parts p JOIN near{i} USING (id, part)) GROUP BY ALL)) GROUP BY part, entry)""")
        steps.append(f"book{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{i} b LEFT JOIN mean{i} m USING (part, entry))")
    steps.append(assigned(ROUNDS))
    steps.append(f"coded AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY id)")
    steps.append(f"hash AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{ROUNDS})")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM whole JOIN coded USING (id), hash"""


@query("op13_walsh_vector_codes", _sql())
def op13_walsh_vector_codes(spark, folder):
    return compress(table(spark, folder, "embeddings"), "vec_id", "embedding", "label")
