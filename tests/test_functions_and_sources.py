import ipaddress

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowguard import schema
from flowguard.functions import scalar as S
from flowguard.ml import text as X
from flowguard.operators import clean, edges, metrics as M
from flowguard.sources import parse, readers, writers


def column(spark, values, build, type_="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_}")
    return [r[0] for r in df.select("i", build(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


ADDRESSES = [
    "1.2.3.4", "255.255.255.255", "256.1.1.1", "1.2.3", "01.2.3.4", "::", "::1", "fe80::1:2", "1::", "1:2:3:4:5:6:7::", "::ffff:1.2.3.4",
    "2001:db8:0:0:0:0:ff:1", "1:2:3:4:5:6:7", "1::2::3", ":1:2:3:4:5:6:7", "12345::", "g::", "FE80::ABCD:EF01", "text", "", "1:2:3:4:5:6:1.2.3.4",
]


def test_addresses_match_the_standard_library(spark):
    def want(x):
        try:
            return int(ipaddress.ip_address(x)) % 2**32
        except ValueError:
            return None

    assert column(spark, ADDRESSES, S.ip_to_long32) == [want(a) for a in ADDRESSES]
    assert column(spark, ["2001:db8::1", "::"], S.ipv6_hextet_sum) == [0x2001 + 0xDB8 + 1, 0]


def test_timestamps_ports_and_slots(spark):
    texts = ["03/07/2017 8:55", "3/7/2017 08:55:10", "2017-07-03 08:55:10", "2017-13-03 08:55:10", "x", None]
    got = column(spark, texts, lambda c: S.epoch_seconds(S.parse_timestamp(c)))
    assert got == [1499072100, 1499072110, 1499072110, None, None, None]
    assert column(spark, ["80", "0x50", "0X1f", "ff", "zz", "", None], S.port_number) == [80, 80, 31, 255, None, None, None]
    assert S.slot_seconds("30s") == 30 and S.slot_seconds("2m") == 120
    with pytest.raises(ValueError):
        S.slot_seconds("2h")
    assert column(spark, [100, 159, 160], lambda c: S.slot_number(c, 100, 60), "long") == [1, 1, 2]


SYSLOG = [
    "Jan  5 08:09:10 host-1 sshd[123]: Accepted key", "Feb 29 00:00:00 a.b cron: job: done", "Mar 01 01:02:03 h : bare", "no syslog here",
    "Foo 01 01:02:03 h x: bad month", "Jan 01 01:02:03 h app(x)[7]: with brackets",
]


def test_syslog(spark):
    rows = column(spark, SYSLOG, S.syslog_fields)
    assert [None if r is None else (r.hostname, r.appname, r.pid, r.message) for r in rows] == [
        ("host-1", "sshd", "123", "Accepted key"), ("a.b", "cron", "", "job: done"), ("h", "", "", "bare"), None, None,
        ("h", "app(x)", "7", "with brackets"),
    ]
    assert str(rows[1].timestamp) == "2020-02-29 00:00:00"


def test_history(spark):
    hot = column(spark, ["Sh", None], S.history_one_hot)
    assert len(hot[0]) == 23 and all(len(r) == 26 and sum(r) == 1 for r in hot[0])
    assert hot[0][0].index(1.0) == S.HISTORY_ALPHABET.index("S") and hot[1][0].index(1.0) == 24


def test_result_payloads(spark):
    flow48, flow71 = ",".join("a" * 48), ",".join("b" * 71)
    features = ",".join(["1.5"] * 33)
    lines = [
        f'{flow48},MIDAS,"[]",0.5,1', f'{flow71},IFOREST,"[{features}]",0.6,0', f'{flow71},IFOREST,"[1,2]",0.6,0', f"{flow48},MIDAS,[],2,0",
        f'{flow48},OTHER,"[]",0.5,1', "short", f'{flow48},AE,"[]",0.5,1',
    ]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, value string")
    got = {r["i"]: r for r in parse.parse_results(df, keep=["i"]).collect()}
    assert sorted(got) == [0, 1, 3]
    assert got[1]["features"] == features and len(got[1]["flow"]) == 71 and got[0]["is_anomalous"] and not got[3]["is_anomalous"]
    keyed = parse.parse_results(df, keep=["i"]).select(S.sha1_key(parse.shared_flow_fields(F.col("flow")), 8).alias("k")).collect()
    assert all(len(r["k"]) == 8 for r in keyed)


def test_the_flow_key_ignores_history_and_ratios(spark):
    names = schema.NETFLOW71
    one = ["1" if n != "zeek" else "Sh" for n in names]
    two = ["1" if n not in schema.RATIOS8 else "9" for n in names]
    df = spark.createDataFrame([(one,), (two,)], "flow array<string>")
    keys = {r[0] for r in df.select(S.sha1_key(parse.shared_flow_fields(F.col("flow")))).collect()}
    assert len(keys) == 1 and names[57:] == schema.DERIVED14 and len(schema.MODEL_FEATURES) == 33


def test_conn_log_and_csv(spark, tmp_path):
    header = "\n".join(f"#h{i}" for i in range(8))
    row = "\t".join(["1.5", "C1", "10.0.0.1", "80", "10.0.0.2", "443", "tcp", "-", "bad", *["1"] * 6, "ShA", *["2"] * 4, "-"])
    (tmp_path / "conn.log").write_text(f"{header}\n{row}\n#close\n")
    got = readers.read_conn_log(spark, str(tmp_path / "conn.log")).collect()
    assert len(got) == 1 and got[0]["history"] == "ShA" and got[0]["service"] is None and got[0]["duration"] is None
    (tmp_path / "flow.csv").write_text(",".join(schema.NETFLOW12) + "\n" + ",".join("x" * 12) + "\n")
    assert readers.read_flow_csv(spark, str(tmp_path / "flow.csv"), schema.NETFLOW12).first()["ibyt"] == "x"
    (tmp_path / "n.csv").write_text("1,2.5\n3,4.5\n")
    assert dict(readers.read_inferred_csv(spark, str(tmp_path / "n.csv")).dtypes) == {"_c0": "int", "_c1": "double"}
    assert readers.arrays_to_frame(spark, [[1, 2], [3, 4]], [0, 1]).count() == 2
    kept = writers.materialise(spark.range(3), str(tmp_path / "stage"))
    assert kept.count() == 3


def test_json_and_utf8(spark):
    assert [r and r["k"] for r in column(spark, ['{"k": 3}', "nope", None], lambda c: parse.json_or_null(c, "k bigint"))] == [3, None, None]
    assert column(spark, [b"ok", b"\xff", None], S.utf8_or_null, "binary") == ["ok", None, None]


def test_nearest_known_takes_the_first_minimum(spark):
    assert column(spark, ["abd", "zzz", "abc", None], lambda c: clean.nearest_known(c, ["abc", "abe", "xyz"])) == ["abc", "xyz", "abc", None]


def test_metrics_against_numpy(spark):
    rng = np.random.default_rng(8)
    score, label = np.round(rng.normal(size=400), 1), rng.integers(0, 2, 400)
    df = spark.createDataFrame(pd.DataFrame({"score": score, "label": label}))
    pos, neg = score[label == 1], score[label == 0]
    auc = np.mean([(p > neg).mean() + (p == neg).mean() / 2 for p in pos])
    assert M.roc_auc(df, "score", "label").first()[0] == pytest.approx(auc)
    for q in (0.0, 0.3, 0.99999, 1.0):
        assert M.quantile(df, "score", q).first()[0] == pytest.approx(np.percentile(score, q * 100))
    grid = np.unique(score)
    gap = [abs((pos <= g).mean() - (neg <= g).mean()) for g in grid[:-1]]
    assert M.wasserstein(df, "score", "label", 1, 0).first()[0] == pytest.approx(np.sum(gap * np.diff(grid)))
    for percent in (0.1, 5.0):
        k = int(np.floor(len(score) * (percent / 100)) - 1)
        assert M.benign_cutoff(df, "score", percent).first()[0] == np.sort(score)[::-1][k]
    assert M.rank_quantile(df, "score", 0.9).first()[0] == np.sort(score)[int(np.ceil(400 * 0.9)) - 1]


def test_cutoffs_and_params(spark):
    assert edges.hash_params(2, 4) == edges.hash_params(2, 4) and all(1 <= p < 65536 for p in edges.hash_params(8, 1))
    df = spark.createDataFrame([("7", "5", "1min"), ("x", "5", "1min"), (None, None, "1min"), (None, "y", "9min")], "a string, b string, c string")
    got = [r[0] for r in df.select(edges.cutoff_for(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [7, 5, 7062069, 8759679]


def test_term_weights_and_windows(spark):
    docs = spark.createDataFrame([(1, 0, "alpha beta beta"), (2, 5, "alpha gamma"), (3, 5, "x"), (4, 900, "beta")], "id long, sec long, message string")
    vocabulary = X.fit_vocabulary(docs, size=2)
    assert [r["term"] for r in vocabulary.orderBy("code").collect()] == ["alpha", "beta"]
    rows = X.term_windows(X.term_arrays(docs, vocabulary, 2), (10,)).toPandas()
    alpha = rows[rows.code == 0].sort_values("id")
    seen = [alpha.weight[:1], alpha.weight[:2], alpha.weight[:3], alpha.weight[3:]]
    np.testing.assert_allclose(alpha.mean_10, [s.mean() for s in seen])
    np.testing.assert_allclose(alpha.std_10, [0, *[s.std() for s in seen[1:3]], 0], atol=1e-12)
    assert X.windowed_arrays(X.term_arrays(docs, vocabulary, 2), (10,)).select(F.size("features")).distinct().collect() == [(6,)]
