"""Benchmark decontamination: word n-grams find passages, Smith-Waterman alignment scores them.

Every n-gram of an item is a seed, however many documents hold it: copies cannot make their own seeds common. A pass over
the documents meets seeds inside each document, lays a window of the item's length around them and aligns the item's words
with it, so that edited and paraphrased copies are scored by what they keep. Stock phrases meet many windows; an upper bound
of the score, taken for many windows at once, leaves out those that cannot reach the least score, and no others. Case and
punctuation do not count. The pass is a map: nothing is shuffled. The benchmark is taken in slices of bounded size, whatever
its own size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.grams import PUNCTUATION, U, chunks, mix, ngrams, text_buffers, words
from flowguard.llm.registry import query, table
from flowguard.llm.tables import free_name

SEED_WORDS = 3
MATCH, MISMATCH, GAP = 2, -1, 1
MIN_SCORE = 0.5  # of a verbatim copy's alignment score
ENOUGH = 50  # words: what scores like a verbatim run of so many counts, however long the item is
SLACK = 8  # words of the document on either side of where the item would lie
SLICE_WORDS = 1_000_000  # benchmark words held by a worker at a time: about 50 MB
TABLE_BITS = 20
USES = 500_000  # hits of a chunk that are laid out at a time: about 50 MB
WINDOW_WORDS = 500_000  # words of windows that are bounded at a time


@dataclass
class Seeds:
    """Words and seeds of one slice of the benchmark."""

    ids: list
    texts: list[np.ndarray]  # word hashes of each item
    hashes: np.ndarray  # distinct n-grams, sorted
    first: np.ndarray  # where the uses of each n-gram begin in ``item`` and ``place``, and the total
    item: np.ndarray
    place: np.ndarray
    door: np.ndarray  # bit table over the n-grams' low bits, asked first
    owned: np.ndarray  # keys of the words of each item, sorted

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, n-gram numbers) of the n-grams that are in the table."""
        maybe = np.flatnonzero(self.door[(grams & U((1 << TABLE_BITS) - 1)).astype(np.int64)])
        at = np.searchsorted(self.hashes, grams[maybe])
        at[at == len(self.hashes)] = 0
        sure = self.hashes[at] == grams[maybe]
        return maybe[sure], at[sure]


def owned_key(item: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit key of a word in an item."""
    return mix(word + mix(item.astype(U)))


def make_seeds(ids: list, texts: list[str]) -> Seeds:
    """All n-grams of the items."""
    data, offsets = text_buffers(pa.array(texts, pa.large_string()))
    hashes, first = words(data, offsets, PUNCTUATION, singles=True)
    parts = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
    grams = [ngrams(p, SEED_WORDS) for p in parts]
    flat = np.concatenate([np.zeros(0, U), *grams])
    item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(g)) for g in grams]])
    order = np.argsort(flat, kind="stable")
    flat, item, place = flat[order], item[order], place[order]
    distinct, start = np.unique(flat, return_index=True)
    door = np.zeros(1 << TABLE_BITS, bool)
    door[(distinct & U((1 << TABLE_BITS) - 1)).astype(np.int64)] = True
    owned = np.unique(owned_key(np.repeat(np.arange(len(parts)), np.diff(first)), hashes))
    return Seeds(ids, parts, distinct, np.append(start, len(flat)), item, place, door, owned)


def grams_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of a text column: first row, word hashes, first word of each text and the total, n-grams."""
    data, offsets = text_buffers(column)
    for a, b in chunks(offsets):
        hashes, first = words(data, offsets[a : b + 1], PUNCTUATION, singles=True)
        yield a, hashes, first, ngrams(hashes, SEED_WORDS)


def inside(at: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The text of each n-gram position, and whether the n-gram ends in the same text."""
    row = np.searchsorted(first, at, side="right") - 1
    return row, at + SEED_WORDS <= first[row + 1]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(best local alignment score, end of it in the text), row by row of the Smith-Waterman table.

    Gaps along the text cost GAP per word: their best start is a running maximum.
    """
    step = np.arange(len(text) + 1) * GAP
    above = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros(len(text) + 1, np.int64)
        row[1:] = np.maximum(above[:-1] + np.where(text == word, MATCH, MISMATCH), above[1:] - GAP)
        row = np.maximum(np.maximum.accumulate(np.maximum(row, 0) + step) - step, 0)
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
        above = row
    return best, end


def least_score(length):
    """The alignment score from which a passage of an item of that many words counts."""
    return MATCH * np.minimum(MIN_SCORE * np.asarray(length), ENOUGH)


def score_bounds(seeds: Seeds, hashes: np.ndarray, item: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """An upper bound of the alignment score of each item with the words lo to hi.

    A word of the text that is in the item gives MATCH at most. Any other inside the alignment is a mismatch or a gap, and
    costs 1. So no alignment scores more than the best run of words counted like this.
    """
    size = hi - lo
    out = np.zeros(len(size), np.int64)
    cut = np.searchsorted(np.cumsum(size) // WINDOW_WORDS, np.arange(int(size.sum()) // WINDOW_WORDS + 1))
    for a, b in zip(cut, np.append(cut[1:], len(size))):
        if a == b:
            continue
        n = size[a:b]
        first = np.cumsum(n) - n
        part = np.repeat(np.arange(b - a), n)
        at = np.repeat(lo[a:b] - first, n) + np.arange(n.sum())
        key = owned_key(item[a:b][part], hashes[at])
        near = np.searchsorted(seeds.owned, key)
        near[near == len(seeds.owned)] = 0
        worth = np.where(seeds.owned[near] == key, MATCH, -min(-MISMATCH, GAP))
        total = np.cumsum(worth)
        before = total - worth
        # Running minimum inside each window: later windows lie lower by more than sums can differ.
        drop = part * (MATCH * 2 * len(part) + 1)
        lowest = np.minimum.accumulate(before - drop) + drop
        out[a:b] = np.maximum.reduceat(total - lowest, first)
    return out


def matches_in(seeds: Seeds, hashes: np.ndarray, first: np.ndarray, grams: np.ndarray, known: dict) -> Iterator[tuple[int, int, float, int, int]]:
    """(text, item, score, first word, end) of the best passage of each item in each text of a chunk."""
    at, gram = seeds.find(grams)
    row, whole = inside(at, first)
    at, gram, row = at[whole], gram[whole], row[whole]
    uses = seeds.first[gram + 1] - seeds.first[gram]
    if not len(at):
        return
    # Whole texts, as many as hold USES hits together.
    texts = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])), len(row))
    hits = np.append(0, np.cumsum(uses))
    a = 0
    while a < len(texts) - 1:
        b = max(a + 1, int(np.searchsorted(hits[texts], hits[texts[a]] + USES, side="right")) - 1)
        piece = slice(texts[a], texts[b])
        yield from _matches(seeds, hashes, first, at[piece], gram[piece], row[piece], uses[piece], known)
        a = b


def _matches(seeds: Seeds, hashes: np.ndarray, first: np.ndarray, at: np.ndarray, gram: np.ndarray, row: np.ndarray, uses: np.ndarray, known: dict) -> Iterator[tuple[int, int, float, int, int]]:
    use = np.repeat(seeds.first[gram], uses) + np.arange(uses.sum()) - np.repeat(np.cumsum(uses) - uses, uses)
    item, row = seeds.item[use], np.repeat(row, uses)
    begin = np.repeat(at, uses) - seeds.place[use]  # where the item would begin
    order = np.lexsort((begin, item, row))
    item, row, begin = item[order], row[order], begin[order]
    length = np.array([len(t) for t in seeds.texts])[item]
    fresh = np.ones(len(item), bool)
    fresh[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1]) | (begin[1:] - begin[:-1] > length[1:] + 2 * SLACK)
    head = np.flatnonzero(fresh)
    tail = np.append(head[1:], len(item)) - 1
    item, row, length = item[head], row[head], length[head]
    lo = np.maximum(first[row], begin[head] - SLACK)
    hi = np.minimum(first[row + 1], begin[tail] + length + SLACK)
    can = np.flatnonzero(score_bounds(seeds, hashes, item, lo, hi) >= least_score(length))
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    for i, r, a, b in zip(item[can].tolist(), row[can].tolist(), lo[can].tolist(), hi[can].tolist()):
        target, window, base = seeds.texts[i], hashes[a:b], int(first[r])
        key = (i, window.tobytes())
        if key not in known:
            if len(known) > 10_000:
                known.clear()
            score, end = align(target, window)
            start = end - align(target[::-1], window[:end][::-1])[1] if score >= least_score(len(target)) else 0
            known[key] = (score / (MATCH * len(target)), start, end)
        score, start, end = known[key]
        if score * MATCH * len(target) >= least_score(len(target)) - 1e-9 and score > best.get((r, i), (0.0,))[0]:
            best[r, i] = (score, a - base + start, a - base + end)
    for (r, i), (score, start, end) in best.items():
        yield r, i, score, start, end


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> Column:
    """Array column of (item_id, score, start_word, end_word) for the documents' text column.

    ``score`` is the alignment score over that of a verbatim copy: 0.5 to 1, for items of over ``2 * ENOUGH`` words from
    ``ENOUGH`` words' share on; one entry per item, its best passage. In scripts without blanks every letter is a word. Null and empty texts match nothing, neither do items that are null or shorter than a seed. Repeated items each
    match. The item id keeps its type.
    """
    kind = dict(benchmark.dtypes)[item_id]
    items = benchmark.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{item_text}`").alias("text")).filter("text IS NOT NULL")
    size = items.agg(F.sum(F.regexp_count("text", F.lit("[A-Za-z0-9]+|[\u0e00-\u0e7f\u3000-\u9fff]|[^\x00-\x7f]+")))).first()[0] or 0
    slices = size // SLICE_WORDS + 1
    result = F.array().cast(f"array<struct<item_id:{kind},score:double,start_word:int,end_word:int>>")
    for k in range(slices):
        rows = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == k).orderBy("id", "text").collect()
        if not rows:
            continue
        ids, texts = [r["id"] for r in rows], [r["text"] for r in rows]
        seeds = make_seeds(ids, texts)
        if not len(seeds.hashes):
            continue
        result = F.concat(result, _matcher(docs, seeds, kind)(F.col(f"`{text}`")))
    return result


def _matcher(docs: DataFrame, seeds: Seeds, kind: str):
    shared = docs.sparkSession.sparkContext.broadcast(seeds)

    @F.arrow_udf("array<struct<item:string,score:double,start_word:int,end_word:int>>")
    def matcher(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        found = pa.list_(pa.struct([("item", pa.string()), ("score", pa.float64()), ("start_word", pa.int32()), ("end_word", pa.int32())]))
        names = [None if x is None else str(x) for x in shared.value.ids]
        known: dict = {}
        for part in column:
            out: list[list] = [[] for _ in range(len(part))]
            for a, hashes, first, grams in grams_of(part):
                for r, i, score, start, end in matches_in(shared.value, hashes, first, grams, known):
                    out[a + r].append({"item": names[i], "score": score, "start_word": start, "end_word": end})
            yield pa.array(out, found)

    return lambda column: F.transform(matcher(column), lambda m: F.struct(
        m["item"].cast(kind).alias("item_id"), m["score"].alias("score"), m["start_word"].alias("start_word"), m["end_word"].alias("end_word")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents that hold no benchmark passage, with their columns as they are."""
    found = free_name(docs, "_found")
    marked = docs.withColumn(found, F.size(benchmark_matches(docs, benchmark, text)))
    return marked.filter(F.col(found) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])


@query("op4_rare_seed_alignment")
def op4_rare_seed_alignment(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", F.explode(benchmark_matches(docs, table(spark, folder, "benchmark"))).alias("m"))
    return found.select("doc_id", "m.item_id", "m.score", "m.start_word", "m.end_word")
