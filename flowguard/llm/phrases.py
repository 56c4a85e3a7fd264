"""Phrase collocations: multikey three-way quicksort of suffix pointers, as deep as the longest phrase.

Every word position is a suffix of its piece of text, cut to the longest phrase. Suffixes go to buckets by their language and two
leading words, so that the partition of equal leading words is whole in its bucket. There pointers to the suffixes are sorted word
by word: a pivot word splits a partition in smaller, equal and larger; the size of an equal partition is the phrase's count, and
the equal part goes on with the next word. Partitions smaller than the least count are abandoned, whatever their depth. All
partitions of a round are split together, so that a round is a handful of array operations.

Before they move, equal suffixes of a chunk of text fold to one weighted pointer, and a chunk's suffixes for one bucket travel as
one packed row. Pairs of leading words so frequent that their suffixes would overfill a bucket are found in a first pass; their
phrases go by all of their own words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.grams import LOWER, PLACE, U, chunks, mix, text_buffers
from flowguard.llm.registry import query, table
from flowguard.llm.tables import Stored

CHUNK_BYTES = 2_000_000
BUCKET_WORDS = 1_000_000  # word positions a bucket is meant for
HOT_PAIRS = 20_000  # a pair of this share of all words, or one that fills a quarter of a bucket if that is more, is hot
UNKNOWN = "und"
SALTS = 32


def _marks(signs: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(signs)] = True
    return out


SPACE, BREAK = _marks(b" \t"), _marks(b".,;:!?\x0a\x0b\x0c\x0d")


class Words:
    """Words of a chunk of texts as numbers: ``vocab`` spells them, ``word`` lists them in order, ``lang`` is a word's language
    (a number), ``room`` how many words its piece has from there on, up to ``longest``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray, longest: int):
        b = LOWER[data[offsets[0] : offsets[-1]]]
        at = offsets - offsets[0]
        breaks = BREAK[b]
        gap = SPACE[b] | breaks
        edge = np.zeros(len(b) + 1, bool)
        edge[at] = True
        start = np.flatnonzero(~gap & (np.concatenate([[True], gap[:-1]]) | edge[:-1])) if len(b) else np.zeros(0, np.int64)
        inside = np.cumsum(~gap)
        first = inside[start] - 1 if len(b) else start
        ends = np.append(first, inside[-1] if len(b) else 0).astype(np.int32)
        spelled = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(b[~gap]))])
        coded = spelled.dictionary_encode()
        self.vocab = coded.dictionary
        self.word = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        text = np.searchsorted(at, start, side="right") - 1
        self.lang = langs[text]
        piece = np.cumsum(breaks)[start] if len(b) else start
        follows = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
        self.room = np.ones(len(start), np.int64)
        for d in range(1, longest):
            self.room[:-d] += (self.room[:-d] == d) & follows[d - 1 :]

    def __len__(self) -> int:
        return len(self.word)

    def codes(self, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every vocabulary entry, hash of every language), the same for equal spellings everywhere."""
        hashed = [pd.util.hash_array(np.array(x, object)) if len(x) else np.zeros(0, U) for x in (self.vocab.to_pylist(), langs)]
        return hashed[0], hashed[1]

    def columns(self, at: np.ndarray, depth: int) -> list[np.ndarray]:
        """Language and ``depth`` words from the positions ``at`` on; -1 where the piece has ended."""
        out = [self.lang[at]]
        for d in range(depth):
            has = self.room[at] > d
            out.append(np.where(has, self.word[np.minimum(at + d, len(self.word) - 1)], -1))
        return out


def route(lang: np.ndarray, words: list[np.ndarray], codes: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """64-bit hash of a language and words; -1 adds nothing."""
    total = codes[1][lang] + U(len(words))
    for d, w in enumerate(words):
        total = total + np.where(w >= 0, codes[0][np.maximum(w, 0)], U(0)) * PLACE[d % len(PLACE)]
    return mix(total)


def folded(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """(distinct rows in order, how often each occurs)."""
    if not len(columns[0]):
        return columns, np.zeros(0, np.int64)
    sizes = [int(c.max()) + 2 for c in columns]
    if np.prod(sizes, dtype=float) >= 2**62:
        order = np.lexsort(columns[::-1])
        ordered = [c[order] for c in columns]
        first = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in ordered])]))
        return [c[first] for c in ordered], np.diff(np.append(first, len(order)))
    key, span = np.zeros(len(columns[0]), np.int64), 1
    for c, size in zip(columns, sizes):
        key, span = key * size + (c + 1), span * size
    if span <= 4 * len(key):
        count = np.bincount(key)
        key = np.flatnonzero(count)
        count = count[key]
    else:
        key = np.sort(key)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, count = key[first], np.diff(np.append(first, len(key)))
    out = []
    for size in sizes[::-1]:
        key, digit = np.divmod(key, size)
        out.append(digit - 1)
    return out[::-1], count


def word_chunks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[Words, list[str]]]:
    """Words and languages of (text, lang) batches, some MB of whole texts at a time."""
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        langs = batch.column(1).fill_null(UNKNOWN).dictionary_encode()
        names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in chunks(offsets, CHUNK_BYTES):
            yield Words(data, offsets[a : b + 1], code[a:b], longest), names


def hot_pairs(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(number of words, sorted hashes of the hot pairs): at most twice ``HOT_PAIRS`` of them, whatever the data.

    A chunk reports pairs of half that share among its own words, so that no pair of the whole share is missed but where its
    chunks hold hardly any words; a pair missed costs balance, not results.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in word_chunks(batches, 2):
            codes = words.codes(langs)
            (lang, one, two), n = folded(words.columns(np.flatnonzero(words.room > 1), 2))
            often = n >= max(8, len(words) / (2 * HOT_PAIRS))
            pairs = route(lang[often], [one[often], two[often]], codes).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([None, *pairs.tolist()], pa.int64()), pa.array([len(words), *n[often].tolist()], pa.int64())], names=["pair", "n"])

    counts = texts.mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    stored = Stored(counts, "pair-counts")
    total = stored.df.filter("pair IS NULL").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    least = max(total / HOT_PAIRS, BUCKET_WORDS / 4) / 2
    hot = [r["pair"] for r in stored.df.filter(F.col("pair").isNotNull() & (F.col("n") >= least)).select("pair").collect()]
    stored.drop()
    return total, np.sort(np.array(hot, np.int64)).view(U)


def phrase_rows(words: Words, codes: tuple[np.ndarray, np.ndarray], hot: np.ndarray, longest: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """(language and word columns, weights, whole phrase or suffix, hash to route by) of a chunk, equal rows folded.

    Whole phrases count as they are: no words (all positions of a language), single words, and what begins with a hot pair.
    Suffixes count with every beginning of two words and more.
    """
    every = np.arange(len(words))
    pair = np.flatnonzero(words.room > 1)
    two = words.columns(pair, 2)
    hashes = route(two[0], two[1:], codes)
    is_hot = np.isin(hashes, hot) if len(hot) else np.zeros(len(pair), bool)
    out: list[tuple[list[np.ndarray], np.ndarray, bool, np.ndarray]] = []

    def add(at: np.ndarray, depth: int, whole: bool, by: int) -> None:
        columns, n = folded(words.columns(at, depth))
        pad = [np.full(len(n), -1, np.int64)] * (longest - depth)
        out.append(([*columns, *pad], n, whole, route(columns[0], columns[1 : 1 + by], codes)))

    add(every, 0, True, 0)
    add(every, 1, True, 1)
    add(pair[~is_hot], longest, False, 2)
    for d in range(2, longest + 1):
        some = pair[is_hot]
        add(some[words.room[some] >= d], d, True, d)
    return ([np.concatenate([o[0][c] for o in out]) for c in range(longest + 1)], np.concatenate([o[1] for o in out]),
            np.concatenate([np.full(len(o[1]), o[2]) for o in out]), np.concatenate([o[3] for o in out]))


PACKED = "bucket long, langs array<string>, vocab binary, n int, rows binary"


def packed(texts: DataFrame, hot: np.ndarray, buckets: int, longest: int) -> DataFrame:
    """One row per chunk and bucket: its vocabulary, space-joined, and its weighted pointers as 32-bit columns."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, langs in word_chunks(batches, longest):
            columns, weight, whole, by = phrase_rows(words, words.codes(langs), hot, longest)
            bucket = (by % U(buckets)).astype(np.int64)
            order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
            heads, first = np.unique(bucket[order], return_index=True)
            used, rows_of = [], []
            for a, b in zip(first, [*first[1:], len(order)]):
                rows = order[a:b]
                own = np.stack([c[rows] for c in columns[1:]])
                seen = np.zeros(len(words.vocab) + 1, bool)
                seen[own] = True  # -1 marks the last place
                number = np.cumsum(seen, dtype=np.int32) - 1
                number[-1] = -1
                used.append(np.flatnonzero(seen[:-1]))
                rows_of.append(np.vstack([columns[0][rows], *number[own], weight[rows], whole[rows]]).astype(np.int32).tobytes())
            ends = np.cumsum([0, *map(len, used)]).astype(np.int32)
            spelled = words.vocab.take(pa.array(np.concatenate([np.zeros(0, np.int64), *used])))
            vocab = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), spelled), b" ")
            made = {"bucket": heads.tolist(), "langs": [langs] * len(heads), "vocab": vocab, "n": np.diff(np.append(first, len(order))).tolist(), "rows": rows_of}
            types = [pa.int64(), pa.list_(pa.string()), pa.binary(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(made.values(), types)], names=list(made))

    return texts.mapInArrow(pack, PACKED)


def quicksort(columns: list[np.ndarray], weight: np.ndarray, least: int, seed: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to the rows of ``columns``: yields equal partitions as they appear.

    Yields (column numbers, a row of each, its key there, its weight) for partitions of rows that are equal up to that column,
    per round. Partitions of less than ``least`` weight, equal or not, are abandoned; keys below zero end a row.
    """
    depth_of = len(columns)
    keys = np.stack(columns)
    pointer = np.random.default_rng(seed).permutation(len(weight))  # pivots are taken from the middle
    start, depth = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(pointer):
        size = np.diff(np.append(start, len(pointer)))
        part = np.repeat(np.arange(len(start)), size)
        key = keys[depth[part], pointer]
        pivot = key[start + size // 2]
        side = (key >= pivot[part]).astype(np.int64) + (key > pivot[part])
        # A stable move of smaller, equal and larger keys to the front, middle and end of their partition.
        cell = part * 3 + side
        count = np.bincount(cell, minlength=3 * len(start))
        begin = np.cumsum(count) - count
        place = np.empty(len(pointer), np.int64)
        for s in range(3):
            mine = np.flatnonzero(side == s)
            before = np.cumsum(count[s::3]) - count[s::3]
            place[mine] = begin[cell[mine]] + np.arange(len(mine)) - before[part[mine]]
        moved = np.empty_like(pointer)
        moved[place] = pointer
        filled = np.flatnonzero(count)
        at = begin[filled]
        total = np.add.reduceat(weight[moved], at)
        equal, own_depth = filled % 3 == 1, depth[filled // 3]
        enough = total >= least
        found = equal & enough
        value = pivot[filled // 3]
        yield own_depth[found], moved[at[found]], value[found], total[found]
        own_depth = own_depth + equal
        goes = enough & ~(equal & ((value < 0) | (own_depth == depth_of)))
        lengths = count[filled]
        pointer = moved[np.repeat(goes, lengths)]
        kept = lengths[goes]
        start, depth = np.cumsum(kept) - kept, own_depth[goes]


def frequent_in(part: pa.Table, least: int, longest: int) -> pa.Table:
    """Frequent phrases of a bucket's packed rows, each with its words, spelling and count."""
    matrices, named = [], {}
    spelled = pc.split_pattern(part["vocab"].combine_chunks(), b" ")
    bases = np.cumsum(pc.list_value_length(spelled).to_numpy(zero_copy_only=False)).tolist()
    coded = spelled.flatten().dictionary_encode()
    for base, own, n, rows in zip([0, *bases], part["langs"].to_pylist(), part["n"].to_pylist(), part["rows"]):
        rows = rows.as_buffer()
        m = np.frombuffer(rows, np.int32).reshape(longest + 3, n).copy()
        code = np.array([named.setdefault(x, len(named)) for x in own], np.int32)
        m[0] = code[m[0]]
        m[1 : longest + 1] += np.where(m[1 : longest + 1] >= 0, np.int32(base), np.int32(0))
        matrices.append(m)
    langs = pa.array(list(named), pa.string())
    same = np.append(coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), np.int32(-1))
    m = np.concatenate(matrices, axis=1)
    del matrices
    m[1 : longest + 1] = same[m[1 : longest + 1]]
    rows, words, counts = [], [], []
    for whole in (0, 1):
        own = m[:, m[longest + 2] == whole]
        if not own.shape[1]:
            continue
        columns = [*own[: longest + 1], np.full(own.shape[1], -1, np.int32)]
        for depth, row, value, total in quicksort(columns, own[longest + 1].astype(np.int64), least):
            # A suffix counts with each of its beginnings, a whole phrase where its words end.
            good = (value < 0) if whole else (value >= 0) & (depth >= 2)
            rows.append(own[: longest + 1, row[good]])
            words.append(depth[good] - whole)
            counts.append(total[good])
    if not rows:
        return pa.table([pa.array([], t) for t in (pa.string(), pa.int32(), pa.string(), pa.int64())], names=["lang", "words", "phrase", "f"])
    rows, words, counts = np.concatenate(rows, axis=1), np.concatenate(words), np.concatenate(counts)
    phrase = pa.array([b""] * len(words), pa.binary())
    for d in range(1, longest + 1):
        has = words >= d
        word = coded.dictionary.take(pa.array(np.maximum(rows[d], 0), mask=~has))
        longer = word if d == 1 else pc.binary_join_element_wise(phrase, word, pa.scalar(b" "))
        phrase = pc.if_else(pa.array(has), longer, phrase)
    return pa.table([langs.take(pa.array(rows[0])), pa.array(words, pa.int32()), phrase.cast(pa.string()), pa.array(counts)], names=["lang", "words", "phrase", "f"])


def frequent_phrases(docs: DataFrame, text: str, lang: str, least: int, longest: int) -> DataFrame:
    """(lang, words, phrase, f) of every phrase of up to ``longest`` words that occurs ``least`` times or more in a language.

    The phrase of no words counts all word positions. Counts are exact and overlaps count.
    """
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    total, hot = hot_pairs(texts)
    buckets = max(1, -(-total // BUCKET_WORDS))
    sent = packed(texts, hot, buckets, longest)
    return sent.groupBy("bucket").applyInArrow(lambda part: frequent_in(part, least, longest), "lang string, words int, phrase string, f long")


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact decimals."""
    wide = [c.cast("decimal(19,0)") for c in (a, left, right)]
    above = (F.lit(1_000_000).cast("decimal(7,0)") * wide[0]).cast("decimal(25,0)") * wide[0]
    return F.call_function("div", above, wide[1] * wide[2])


def collocations(docs: DataFrame, text: str, lang: str, least: int = 10, longest: int = 3, top: int = 2000, inside: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's ``top`` phrases of 2 to ``longest`` words.

    Words are runs without blanks and tabs inside pieces between ``. , ; : ! ?`` and line ends, A-Z lower-cased. A phrase of
    ``a`` occurrences, ``least`` at least, is cut after each of its words; the cut of the lowest score counts, the first of equal
    ones. Phrases inside a longer one that occurs in ``inside`` per cent of their cases or more are dropped. Order: score, then
    a, both falling, then phrase by bytes.

    A null text has no words, a null language is ``und``, as is a language of that name. Repeated rows count as often as they
    occur; very long texts are read whole. A language or table without frequent phrases has no rows. Other columns, whatever
    their names, are not looked at. ``longest`` may be 2 to 60.
    """
    found = Stored(frequent_phrases(docs, text, lang, least, longest), "phrases")
    every = found.df
    counts = every.select("lang", "phrase", "f")
    cand = every.filter("words >= 2")
    cuts = cand.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left", F.expr("substring_index(phrase, ' ', cut)")).withColumn("right", F.expr("substring_index(phrase, ' ', cut - words)"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    scored = cuts.groupBy("lang", "phrase", F.col("f").alias("a")).agg(F.min(F.struct(cut_score(F.col("f"), F.col("l"), F.col("r")).alias("score"), "cut", "l", "r")).alias("best"))
    word = F.split("phrase", " ")
    parts = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda k: F.transform(
        F.sequence(F.lit(1), F.col("words") - k + 1), lambda at: F.array_join(F.slice(word, at, k), " "))))
    longer = cand.filter("words > 2").select("lang", F.explode(parts).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = scored.join(longer, ["lang", "phrase"], "left")
    wide = [F.coalesce(F.col(c), F.lit(0)).cast("decimal(19,0)") for c in ("most", "a")]
    kept = kept.filter(~((wide[0] * 100 >= wide[1] * inside) & F.col("most").isNotNull()))
    kept = kept.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    # A language's best are among the best of its shares, so that no task sorts all phrases of one language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    kept = kept.withColumn("salt", salt).withColumn("place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("place") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    totals = every.filter("words = 0").select("lang", F.col("f").alias("n"))
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP11_SQL = r"""
WITH pieces AS (SELECT doc, coalesce(lang, 'und') AS lang, unnest(p) AS piece, unnest(range(len(p))) AS piece_no FROM (
  SELECT row_number() OVER () AS doc, lang, string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
  FROM documents WHERE text IS NOT NULL)),
listed AS (SELECT doc, lang, piece_no, list_filter(string_split_regex(piece, '[ \x09]+'), lambda w: w <> '') AS ws FROM pieces),
words AS (SELECT doc, lang, piece_no, unnest(ws) AS w, unnest(range(len(ws))) AS pos FROM listed),
runs AS (SELECT lang, w, lead(w) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM words WINDOW p AS (PARTITION BY doc, piece_no ORDER BY pos)),
f1 AS MATERIALIZED (SELECT lang, w AS phrase, count(*) AS f FROM runs GROUP BY ALL),
f2 AS MATERIALIZED (SELECT lang, w, w2, w || ' ' || w2 AS phrase, count(*) AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS MATERIALIZED (SELECT lang, w, w2, w3, w || ' ' || w2 || ' ' || w3 AS phrase, count(*) AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, 1 AS cut, x.f AS l, y.f AS r FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.phrase = c.w JOIN f1 y ON y.lang = c.lang AND y.phrase = c.w2 WHERE c.f >= 10
  UNION ALL SELECT c.lang, c.phrase, c.f, 1, x.f, y.f FROM f3 c JOIN f1 x ON x.lang = c.lang AND x.phrase = c.w JOIN f2 y ON y.lang = c.lang AND y.w = c.w2 AND y.w2 = c.w3
  UNION ALL SELECT c.lang, c.phrase, c.f, 2, x.f, y.f FROM f3 c JOIN f2 x ON x.lang = c.lang AND x.w = c.w AND x.w2 = c.w2 JOIN f1 y ON y.lang = c.lang AND y.phrase = c.w3),
scored AS (SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored) WHERE nth = 1),
longer AS (SELECT lang, phrase, max(f) AS most FROM (SELECT lang, w || ' ' || w2 AS phrase, f FROM f3 UNION ALL SELECT lang, w2 || ' ' || w3, f FROM f3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer x USING (lang, phrase) WHERE x.most IS NULL OR 100 * x.most < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000
"""


@query("op11_phrase_quicksort", OP11_SQL)
def op11_phrase_quicksort(spark, folder):
    return collocations(table(spark, folder, "documents"), "text", "lang")
