"""Languages of a document as a mixture, fitted by expectation-maximisation over n-gram likelihoods.

Training counts byte trigrams (letters with their neighbours; everything else is a blank) per language, hashed into a
fixed number of cells. A word's likelihood under a language is the product of its trigrams'. For each document the
proportions of the languages are the mixture weights of its words; the language set is the one with the best
log-likelihood less a penalty per further language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.grams import LOWER, chunks, text_buffers
from flowguard.llm.registry import query, table
from flowguard.llm.tables import free_name

CELL_BITS = 15
SMOOTHING = 0.05
PENALTY = 2.0  # times log(1 + words) for every language beyond the first
STEPS = 30
MAX_LANGUAGES = 512  # the model has 2**15 numbers of 4 bytes per language: 64 MB at most
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """Lower-cased letters as they are, bytes of other characters above 127 too, all else a blank."""
    table_ = np.full(256, 0x20, np.uint8)
    table_[97:123] = np.arange(97, 123)
    table_[128:] = np.arange(128, 256)
    return table_[LOWER]


LETTERS = letter_table()
ASCII_LETTER = (LETTERS > 0x20) & (np.arange(256) < 128)


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell of the trigram around every letter byte, first trigram of each word, first word of each text and the total)."""
    at = offsets - offsets[0]
    gap = 0x20
    b = np.full(len(data[offsets[0] : offsets[-1]]) + len(at) + 1, gap, np.uint8)
    # A blank between texts keeps their words apart.
    inside = LETTERS[data[offsets[0] : offsets[-1]]]
    shift = np.repeat(np.arange(1, len(at)), np.diff(at))
    b[np.arange(len(inside)) + shift] = inside
    place = np.flatnonzero(b != gap)
    wide = b.astype(np.uint32)
    key = wide[place - 1] << np.uint32(16) | wide[place] << np.uint32(8) | wide[place + 1]
    cell = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - CELL_BITS)
    first = np.flatnonzero(b[place - 1] == gap) if len(place) else np.zeros(0, np.int64)
    text_at = at + np.arange(1, len(at) + 1) - 1
    return cell.astype(np.int64), first, np.searchsorted(place[first], text_at) if len(place) else np.zeros(len(at), np.int64)


@dataclass
class Model:
    languages: list[str]
    logp: np.ndarray  # cells x languages

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-likelihood of every word under every language, and the first word of each text and the total."""
        cell, first, text_first = trigrams(data, offsets)
        if not len(cell):
            return np.zeros((0, len(self.languages)), np.float32), text_first
        return np.add.reduceat(self.logp[cell], first, axis=0), text_first

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the leading language, its proportion) of each text; index -1 for texts without words."""
        like, first = self.words(data, offsets)
        n = len(offsets) - 1
        best, share = np.full(n, -1), np.zeros(n)
        have = np.flatnonzero(first[1:] > first[:-1])
        if not len(have) or not self.languages:
            return best, share
        begin = first[:-1][have]
        sums = np.add.reduceat(like, begin, axis=0, dtype=np.float64)
        # No mixture can exceed the sum of every word's best language: most texts are settled by that bound.
        bound = np.add.reduceat(like.max(axis=1), begin, dtype=np.float64)
        single = sums.max(axis=1)
        count = (first[1:] - first[:-1])[have]
        best[have], share[have] = sums.argmax(axis=1), 1.0
        for j in np.flatnonzero(bound - single > PENALTY * np.log1p(count)):
            k = have[j]
            best[k], share[k] = mixture(like[first[k] : first[k + 1]].astype(np.float64))
        return best, share


def mixture(like: np.ndarray, steps: int = STEPS, penalty: float = PENALTY) -> tuple[int, float]:
    """Leading language and its proportion for the words of one text (words x languages log-likelihoods).

    Proportions over all languages come from EM. Their order gives nested candidate sets; each is fitted and judged by
    its log-likelihood less penalty * log(1 + words) per further language, up to the first set that is worse.
    """
    peak = like.max(axis=1, keepdims=True)
    p = np.exp(like - peak)
    cost = penalty * np.log1p(len(like))
    order = np.argsort(-fit(p, steps), kind="stable")
    lead = int(like.sum(axis=0).argmax())
    order = np.concatenate([[lead], order[order != lead]])
    chosen, weights = order[:1], np.ones(1)
    value = np.log(np.maximum(p[:, lead], 1e-300)).sum()
    for size in range(2, len(order) + 1):
        part = p[:, order[:size]]
        w = fit(part, steps)
        now = np.log(np.maximum(part @ w, 1e-300)).sum() - cost * (size - 1)
        if now <= value:
            break
        chosen, weights, value = order[:size], w, now
    top = int(np.argmax(weights))
    return int(chosen[top]), float(weights[top])


def fit(p: np.ndarray, steps: int) -> np.ndarray:
    """Mixture weights that maximise the likelihood of the rows of p."""
    w = np.full(p.shape[1], 1.0 / p.shape[1])
    for _ in range(steps):
        joint = p * w
        new = (joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)).mean(axis=0)
        if np.abs(new - w).max() < 1e-4:
            return new
        w = new
    return w


def train(rows: DataFrame) -> Model:
    """Model of (text, lang) rows; rows without a language teach nothing. All rows count.

    Tasks add their trigrams up per language before anything is shuffled.
    """
    cells = 1 << CELL_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            names = batch.column("lang").dictionary_encode()
            code, known = names.indices.to_numpy(zero_copy_only=False), names.dictionary.to_pylist()
            for a, b in chunks(offsets):
                cell, first, text_first = trigrams(data, offsets[a : b + 1])
                ends = np.append(first, len(cell))
                of_text = np.diff(ends[text_first])
                mine = np.repeat(code[a:b], of_text)
                found = np.bincount(mine * cells + cell, minlength=len(known) * cells).reshape(len(known), cells)
                for i, name in enumerate(known):
                    totals[name] = totals.get(name, 0) + found[i]
        for name, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                                  ["lang", "cell", "n"])

    languages = sorted(r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 2).collect() if r[0] is not None)
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    taught = rows.filter("lang IS NOT NULL").select(F.coalesce("text", F.lit("")).alias("text"), "lang")
    counts = taught.mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most languages * cells numbers
    table_ = np.zeros((cells, len(languages)))
    if len(found):
        table_[found["cell"].to_numpy(), found["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()] = found["n"]
    table_ += SMOOTHING
    return Model(languages, np.log(table_ / table_.sum(axis=0)).astype(np.float32))


def has_letters(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def detect(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (proportion of the leading language, 0 to 1) from the text alone.

    ``und`` and 0 if the text is null, empty or has no letters, or nothing was learned. Columns already called so are
    replaced, all others pass. Texts of any length are read whole, equal texts get equal answers, repeated rows come out as
    often as they occur, and an empty table gives none. Languages that fit equally well: the first in the order of names.
    A model has at most ``MAX_LANGUAGES`` languages; ``train`` raises beyond, since the model is broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.drop("lang_pred", "score")

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def guess(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names = pa.array([*shared.value.languages, UNKNOWN], pa.string())
        for part in texts:
            data, offsets = text_buffers(part)
            best, share = np.full(len(part), -1), np.zeros(len(part))
            for a, b in chunks(offsets):
                best[a:b], share[a:b] = shared.value.predict(data, offsets[a : b + 1])
                # Bytes above 127 count as letters there; a text of them alone is looked at character by character.
                plain = np.concatenate([[0], np.cumsum(ASCII_LETTER[data[offsets[a] : offsets[b]]])])
                at = offsets[a : b + 1] - offsets[a]
                for i in a + np.flatnonzero((best[a:b] >= 0) & (plain[at[1:]] == plain[at[:-1]])):
                    if not has_letters(part[int(i)].as_py()):
                        best[i], share[i] = -1, 0.0
            code = pa.array(np.where(best < 0, len(names) - 1, best))
            yield pa.StructArray.from_arrays([names.take(code), pa.array(np.clip(share, 0.0, 1.0))], ["lang_pred", "score"])

    found = free_name(rows, "_guess")
    # Not deterministic as far as Spark knows: a filter on the answer must not run the model a second time.
    hidden = rows.withColumn(found, guess.asNondeterministic()(F.col(f"`{text}`")))
    return hidden.select(*[F.col(f"`{c}`") for c in rows.columns], F.col(found)["lang_pred"].alias("lang_pred"), F.col(found)["score"].alias("score"))


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@query("op5_mixture_language")
def op5_mixture_language(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    model = train(docs.filter(~F.col("held_out")).select("text", "lang"))
    return detect(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")
