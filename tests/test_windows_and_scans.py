import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowguard.operators import scan as S
from flowguard.operators import windows as W


@pytest.fixture(scope="module")
def flows(spark):
    """Dense seconds, and one source and one second that hold a third of all rows."""
    rng = np.random.default_rng(1)
    n = 500
    sec = np.sort(np.where(rng.random(n) < 0.33, 1500, rng.integers(0, 3000, n)))
    pdf = pd.DataFrame(
        {
            "id": np.arange(n) * 7, "sec": sec, "sa": np.where(rng.random(n) < 0.33, 0, rng.integers(0, 4, n)),
            "sp": rng.integers(0, 9, n), "dp": rng.integers(0, 4, n), "td": rng.normal(1e6, 1, n),
        }
    )
    return pdf, spark.createDataFrame(pdf.sample(frac=1, random_state=2)).repartition(4).cache()


def ordered(df):
    return df.toPandas().sort_values("id").reset_index(drop=True)


@pytest.mark.parametrize("bucket", [600, 3600])
def test_global_windows(flows, bucket):
    pdf, df = flows
    got = ordered(W.trailing_features(df, ["sp", "dp"], ["td"], bucket=bucket))
    for w in (10, 60, 600):
        seen = [pdf[(pdf.sec >= s - w) & (pdf.sec <= s)] for s in pdf.sec]
        np.testing.assert_allclose(got[f"td_{w}_mean"], [x.td.mean() for x in seen], rtol=1e-12)
        assert (got[f"sp_{w}_mean"] == [x.sp.nunique() for x in seen]).all()
        assert (got[f"dp_{w}_mean"] == [x.dp.nunique() for x in seen]).all()
    assert list(got.columns[: len(pdf.columns)]) == list(pdf.columns)


def test_approximate_counts_are_close(flows):
    _, df = flows
    exact = ordered(W.trailing_distinct(df, ["sp"]))["sp_600_mean"]
    close = ordered(W.trailing_distinct(df, ["sp"], approximate=True))["sp_600_mean"]
    assert np.abs(exact - close).max() <= 1


@pytest.mark.parametrize("bits", [(3, 5), (16, 32)])
def test_source_windows(flows, bits):
    pdf, df = flows
    got = ordered(W.source_features(df, ["td"], ["sp", "dp"], window=300, bucket=700, bits=bits))
    seen = [pdf[(pdf.sa == r.sa) & (pdf.id <= r.id) & (pdf.sec > r.sec - 300)] for r in pdf.itertuples()]
    np.testing.assert_allclose(got["td_mean"], [x.td.mean() for x in seen], rtol=1e-12)
    np.testing.assert_allclose(got["td_std"], [x.td.std() if len(x) > 1 else 0 for x in seen], atol=1e-8)
    assert (got["sp_count"] == [x.sp.nunique() for x in seen]).all()
    assert (got["dp_count"] == [x.dp.nunique() for x in seen]).all()


def test_source_windows_equal_pandas_rolling(flows):
    pdf, df = flows
    got = ordered(W.source_features(df, ["td"], window=600))
    timed = pdf.assign(t=pd.to_datetime(pdf.sec, unit="s")).set_index("t")
    for sa, part in timed.groupby("sa"):
        want = part["td"].rolling("600s", min_periods=1)
        mine = got[got.sa == sa]
        np.testing.assert_allclose(mine["td_mean"], want.mean(), rtol=1e-9)


def test_running_sum_and_max(flows):
    pdf, df = flows
    got = ordered(S.running(df, ["sa"], "id", {"n": ("sum", F.lit(1)), "top": ("max", F.col("sp")), "low": ("min", F.col("dp"))}, (4, 6)))
    by = pdf.groupby("sa")
    assert (got["n"] == by.cumcount() + 1).all()
    assert (got["top"] == by["sp"].cummax()).all() and (got["low"] == by["dp"].cummin()).all()


def test_null_keys_belong_to_no_group(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "a")], "id long, k string")
    got = ordered(S.running(df, ["k"], "id", {"n": ("sum", F.lit(1))}))
    assert got["n"].isna().tolist() == [True, False, True, False] and got["n"].dropna().tolist() == [1, 2]


@pytest.mark.parametrize("descending", [False, True])
def test_running_by_value(spark, descending):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"k": rng.integers(0, 3, 300), "v": rng.integers(0, 1000, 300).astype(float)}).drop_duplicates()
    pdf["n"] = rng.integers(1, 5, len(pdf))
    got = S.running_by_value(spark.createDataFrame(pdf), "v", {"c": F.col("n")}, ["k"], descending).toPandas()
    want = pdf.sort_values("v", ascending=not descending)
    want["c"] = want.groupby("k")["n"].cumsum()
    want["_next"] = want.groupby("k")["v"].shift(-1)
    both = got.merge(want, on=["k", "v"], suffixes=("", "_w"))
    assert (both["c"] == both["c_w"]).all()
    np.testing.assert_array_equal(both["_next"].astype(float), both["_next_w"].astype(float))


@pytest.mark.parametrize("join", [S.spread_join, S.skew_join])
def test_hot_key_joins(spark, join):
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = join(rows, lookup, ["k"], "id").toPandas()
    assert len(got) == 1000
    assert ((got["v"] == got["k"] * 10) | (got["v"].isna() & (got["k"] >= 40))).all()
    assert len(join(rows, lookup, ["k"], "id", how="inner").toPandas()) == (got["k"] < 40).sum()


def test_no_window_runs_in_one_task(flows):
    """Windows over rows are always partitioned: the only unpartitioned ones see one row per task or slot."""
    _, df = flows
    for frame in (W.trailing_features(df, ["sp"], ["td"]), W.source_features(df, ["td"], ["sp"]), W.arrival_ordinal(df, keys=["sa"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_results_do_not_depend_on_partitions(spark, flows):
    _, df = flows
    first = ordered(W.source_features(df, ["td"], ["sp"]))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    second = ordered(W.source_features(df.repartition(9), ["td"], ["sp"]))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    pd.testing.assert_frame_equal(first, second, rtol=1e-12)


def test_windows_never_broadcast_their_seconds(flows):
    """The copied table of seconds grows with time: however small Spark takes it for, it does not pass through the driver."""
    _, df = flows
    for frame in (W.trailing_means(df, ["td"]), W.trailing_distinct(df, ["sp"]), W.trailing_features(df, ["sp"], ["td"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan.split("explode(")[0]
