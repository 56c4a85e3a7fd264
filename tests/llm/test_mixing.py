import hashlib
import math

from pyspark.sql import functions as F

from flowguard.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, copy string, _source int"


def uniform(*parts):
    return (int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52


def quantile(u, rate):
    if rate == 0:
        return 0
    k, total = 0, math.exp(-rate)
    while total < u:
        k += 1
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    return k


def brute(rows, weights=None):
    size = {}
    for _, text, source, *_ in rows:
        size[source] = size.get(source, 0) + len((text or "").encode())
    weights = {s: 1.0 for s in size} if weights is None else weights
    total = sum(weights.get(s, 0.0) for s in size if size[s])
    every = sum(size.values())
    out = []
    for doc, text, source, *_ in rows:
        rate = weights.get(source, 0.0) / total * every / size[source] if size[source] else 0.0
        n = quantile(uniform("mix-1", "" if doc is None else str(doc)), rate)
        out += [(doc, source, i, n) for i in range(n)]
    return out


def sample():
    rows = [(i, "word " * (1 + i % 9), f"s{i % 3}" if i % 7 else "big", "x", 1) for i in range(300)]
    return rows + [(None, "no id", None, "x", 1), (301, None, "s1", "x", 1), (302, "", "hollow", "x", 1), (5, "word", "s2", "x", 1)] + [rows[3]] * 2


def got(df):
    return [(r["doc_id"], r["source"], r["copy"], r["n_copies"]) for r in df.collect()]


def key(row):
    return tuple((x is None, x or 0) if not isinstance(x, str) else (False, x) for x in row)


def test_counts_equal_the_poisson_quantile(spark):
    rows = sample()
    mixed = M.mix_sources(spark.createDataFrame(rows, SCHEMA))
    assert mixed.columns == ["doc_id", "text", "source", "_source", "copy", "n_copies", "rate", "shuffle_key"]
    assert sorted(got(mixed), key=str) == sorted(brute(rows), key=str)


def test_weights_leave_sources_out_and_rows_come_in_key_order(spark):
    rows = sample()
    weights = spark.createDataFrame([("s1", 3.0), ("s2", 1.0), ("nowhere", 9.0), ("s0", None)], "source string, weight double")
    mixed = M.mix_sources(spark.createDataFrame(rows, SCHEMA), weights=weights)
    assert sorted(got(mixed), key=str) == sorted(brute(rows, {"s1": 3.0, "s2": 1.0}), key=str)
    keys = [r[0] for r in mixed.select("shuffle_key").collect()]
    assert keys == sorted(keys) and len({k % 97 for k in keys}) > 20


def test_large_rates_keep_their_mean(spark):
    rate = 900.0
    steps = spark.range(1).select(M.poisson_steps(F.lit(rate)).alias("s")).first()["s"]
    assert abs(steps[-1] - 1) < 1e-9 and abs(sum(1 - s for s in steps) - rate) < 1e-3
    assert spark.range(1).select(M.poisson_steps(F.lit(0.0)).alias("s")).first()["s"] == [1.0]


def test_empty_table_and_empty_texts(spark):
    assert M.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    assert M.mix_sources(spark.createDataFrame([(1, "", "a", "", 0), (2, None, None, "", 0)], SCHEMA)).count() == 0


def test_plan_has_no_python(spark):
    plan = M.mix_sources(spark.createDataFrame(sample(), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_any_column_names_pass(spark):
    names = ["steps", "_steps", "_source", "size", "weight", "u"]
    rows = spark.createDataFrame([(i, "text", "s", *range(6)) for i in range(40)], f"doc_id long, text string, source string, {', '.join(f'{n} int' for n in names)}")
    mixed = M.mix_sources(rows)
    assert mixed.columns == [*rows.columns, "copy", "n_copies", "rate", "shuffle_key"]
    assert all(tuple(r)[3:9] == tuple(range(6)) for r in mixed.collect())
