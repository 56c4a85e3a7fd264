import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import sharding as S


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 257, 5000])
def test_permutation_is_one_to_one_and_can_be_undone(n):
    at = S.permute(np.arange(n), n)
    assert sorted(at) == list(range(n))
    assert (S.row_at(at % 24, at // 24, n) == np.arange(n)).all()
    if n > 100:
        assert (S.permute(np.arange(n), n, seed=1) != at).any()
        assert abs(np.corrcoef(np.arange(n), at)[0, 1]) < 0.2


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, _row int, _place int")


def check(rows, n, shards):
    assert len(rows) == n
    counts = {}
    for r in rows:
        counts.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in counts.values())
    sizes = [len(counts.get(s, ())) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_shards_with_nulls_repeats_and_clashing_names(spark):
    rows = [(i, f"text {i}", "old", 1, 2) for i in range(100)] + [(None, None, "old", 1, 2)] * 5 + [(7, "text 7", "old", 1, 2)] * 3 + [(8, "", "x" , 0, 0)]
    got = S.shard_rows(frame(spark, rows), ["doc_id"], 7)
    assert got.columns == ["doc_id", "text", "_row", "_place", "shard", "slot"]
    check(got.collect(), len(rows), 7)


def test_place_follows_from_the_row_number_alone(spark):
    base = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    one = {tuple(r) for r in S.shard_rows(base.repartition(3), ["doc_id"]).collect()}
    two = {tuple(r) for r in S.shard_rows(base.repartition(11, "doc_id"), ["doc_id"]).collect()}
    assert one == two
    at = S.permute(np.arange(500), 500)
    assert one == {(i, "t", int(at[i] % 24), int(at[i] // 24)) for i in range(500)}


def test_empty_table(spark):
    assert S.shard_rows(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).count() == 0


def test_shard_files_hold_slots_in_order(spark, tmp_path):
    base = spark.range(100).select(F.col("id").alias("doc_id"))
    S.write_shards(S.shard_rows(base, ["doc_id"], 4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and {r[0] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_query_over_the_whole_table(spark):
    import zlib

    folder = "/root/testdata/sf0.001"
    rows = S.op1_feistel_shards(spark, folder).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    check(rows, len(texts), 24)
    at = S.permute(np.arange(len(texts)), len(texts))
    place = {d: int(at[i]) for i, d in enumerate(sorted(texts))}
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 8, zlib.crc32(data), "rows", None)
        assert (r["shard"], r["slot"]) == (place[r["doc_id"]] % 24, place[r["doc_id"]] // 24)


def scalar_place(i, n, seed):
    """The permutation by its definition, one number at a time in Python integers."""
    def mixed(z):
        z &= 2**64 - 1
        z = (z ^ (z >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ (z >> 27)) * 0x94D049BB133111EB % 2**64
        return z ^ (z >> 31)

    bits = max(1, -(-max(n - 1, 1).bit_length() // 2))
    while True:
        left, right = divmod(i, 2**bits)
        for round_ in range(1, 7):
            left, right = right, left ^ (mixed(right + mixed(round_ + seed * 256)) % 2**bits)
        i = left * 2**bits + right
        if i < n:
            return i


@pytest.mark.parametrize("n", [1, 2, 5, 100, 1000, 4097, 10**12])
def test_places_equal_a_scalar_feistel_network(n):
    rows = np.arange(n) if n < 5000 else np.array([0, 1, 12345, n // 2, n - 1])
    for seed in (S.SEED, 3):
        assert S.permute(rows, n, seed).tolist() == [scalar_place(int(i), n, seed) for i in rows]
