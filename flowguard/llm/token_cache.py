"""Token counts through a cache of content digests.

Every text is reduced to the SHA-256 digest of its UTF-8 bytes. Digests are joined to the counts stored for this tokenizer;
one row per distinct missing digest fetches its text and is encoded, and its count is appended to the cache.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.registry import query, table
from flowguard.llm.tables import Stored, exists, new_path

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
# Characters for which both encoders classify letters, digits and white space alike (tests/llm/test_token_cache.py).
COMMON = re.compile("[\x00-ɏ]*")
#: The pre-tokenizer of byte-level vocabularies; a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Counter:
    """Token counts as ``tokenizers`` gives them for a vocabulary file, without begin, end or padding.

    A plain byte-level vocabulary whose merges are in id order is also encoded by ``tiktoken``, several times faster,
    for texts of common characters; special strings are split off first, as the library does. All other texts and
    vocabularies go through the library itself.
    """

    def __init__(self, content: bytes):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_str(content.decode())
        self.slow.no_truncation()
        self.slow.no_padding()
        self.fast = self.special = None
        spec = json.loads(content)
        added, model = spec.get("added_tokens") or [], spec["model"]
        plain = spec.get("normalizer") is None and spec.get("post_processor") is None and model.get("type", "BPE") == "BPE"
        plain &= not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        before = spec.get("pre_tokenizer") or {}
        plain &= before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        plain &= not any(t.get(k) for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if plain:
            self._prepare(model, [t["content"] for t in added])

    def _prepare(self, model: dict, special: list[str]) -> None:
        import tiktoken

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in printable}
        byte_of |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        if made != sorted(set(made)) or not set(byte_of) <= set(model["vocab"]):
            return
        kept = [*byte_of, *(a + b for a, b in merges)]
        rank = {c: i for i, c in enumerate(byte_of)} | {a + b: 256 + i for i, (a, b) in enumerate(merges)}
        ranks = {bytes(byte_of[c] for c in token): rank[token] for token in kept}
        self.fast = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def count(self, text: str) -> int:
        if self.fast is None or not COMMON.fullmatch(text):
            return len(self.slow.encode(text, add_special_tokens=False).ids)
        if self.special is None or not self.special.search(text):
            return len(self.fast.encode_ordinary(text))
        pieces = self.special.split(text)
        return len(pieces) - 1 + sum(len(self.fast.encode_ordinary(p)) for p in pieces)


def encode_misses(texts: DataFrame, content: bytes) -> DataFrame:
    """(digest, n_tokens) of (digest, text) rows."""
    shared = texts.sparkSession.sparkContext.broadcast(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            counts = [counter.count(x.as_py() or "") for x in batch.column("text")]
            yield pa.record_batch([batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return texts.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def count_tokens(df: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row (id, n_bytes, n_tokens) for every row; the cache at ``cache_path`` grows by the distinct misses.

    A null text counts as empty (0 tokens). Rows with equal texts get the same count, encoded once; repeated ids and null
    ids keep their rows. Other columns are ignored. The cache is a Parquet table keyed by (tokenizer digest, content
    digest); counts of another vocabulary file are never used. Runs that append at the same time may store a digest
    twice; readers take one of them.
    """
    spark = df.sparkSession
    with open(tokenizer_path, "rb") as file:
        content = file.read()
    version = hashlib.sha256(content).hexdigest()
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), body.alias("text"), F.unhex(F.sha2(body, 256)).alias("digest"))
    narrow = Stored(rows.select("_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests").df

    def stored() -> DataFrame:
        cached = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer") == version)
        return cached.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))

    wanted = narrow.groupBy("digest").agg(F.min("_id").alias("_id"))
    if exists(spark, cache_path):
        wanted = wanted.join(stored(), "digest", "left_anti")
    # One id per missing digest: the key of the text join is spread evenly, however often a text occurs.
    wanted = wanted.select(F.col("digest").alias("_d"), F.col("_id").alias("_i"))
    misses = rows.join(wanted, (F.col("digest") == F.col("_d")) & F.col("_id").eqNullSafe(F.col("_i")), "left_semi")
    fresh = encode_misses(misses, content).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))
    fresh.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(cache_path)
    return narrow.join(stored(), "digest").select(F.col("_id").alias(id_col), "n_bytes", "n_tokens")


@query("op9_digest_cache")
def op9_digest_cache(spark, folder):
    import public_tokenizers

    counted = count_tokens(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), new_path(spark, "token-cache")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
