import numpy as np
import pandas as pd
import pytest

from flowguard.operators import edges as E
from tests.models import edge_model as M

BITS = (4, 7)


@pytest.fixture(scope="module")
def stream(spark):
    rng = np.random.default_rng(3)
    n = 900
    slot = np.sort(rng.choice([1, 2, 3, 5, 9, 10, 11, 20, 21, 22], n))
    late = rng.random(n) < 0.05
    slot = np.where(late, np.maximum(slot - 3, 1), slot)
    src = np.where(rng.random(n) < 0.4, 7, rng.integers(1, 30, n))
    dst = np.where(rng.random(n) < 0.4, 9, rng.integers(1, 12, n))
    slot[:3] = 1
    pdf = pd.DataFrame({"seq": np.arange(n) * 3 + 5, "src": src, "dst": dst, "slot": slot})
    return pdf, spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(5)


def scores(df):
    return df.toPandas().sort_values("seq")["score"].to_numpy()


def events(pdf):
    return list(zip(pdf.src.tolist(), pdf.dst.tolist(), pdf.slot.tolist()))


@pytest.mark.parametrize("mode,cols", [("sketch", 16), ("exact", None)])
def test_plain(stream, mode, cols):
    pdf, df = stream
    want = M.plain(events(pdf), E.hash_params(2, 5), cols)
    got = scores(E.plain_burst(df, mode=mode, cols=cols or 16, seed=5, bits=BITS))
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("mode,cols", [("sketch", 16), ("exact", None)])
def test_relational(stream, mode, cols):
    pdf, df = stream
    want = M.relational(events(pdf), E.hash_params(2, 5), cols)
    got = scores(E.relational_burst(df, mode=mode, cols=cols or 16, seed=5, bits=BITS))
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("factor", [0.0, 0.5, 0.9, 0.99, 0.999, 1.0])
def test_decay_is_exact_for_every_factor(spark, factor):
    """One hot cell over 60,000 slots, against the recursion over slots."""
    rng = np.random.default_rng(6)
    ranks = np.sort(rng.choice(60_000, 3000, replace=False)) + 1
    n = rng.integers(1, 9, len(ranks))
    frame = spark.createDataFrame(pd.DataFrame({"cell": 1, "rank": ranks, "n": n}))
    got = E._decayed(frame, ["cell"], factor).toPandas().sort_values("rank")["decayed"].to_numpy()
    want, held, at = [], 0.0, 0
    for r, count in zip(ranks.tolist(), n.tolist()):
        held *= factor ** (r - at) if want else 1.0
        want.append(held)
        held, at = held + count, r
    np.testing.assert_allclose(got, want, rtol=1e-11, atol=1e-15)


@pytest.mark.parametrize("threshold", [5.0, 1000.0])
@pytest.mark.parametrize("mode,cols", [("sketch", 16), ("exact", None)])
def test_filtering(stream, mode, cols, threshold):
    pdf, df = stream
    want = M.filtering(events(pdf), E.hash_params(2, 5), cols, threshold)
    got = scores(E.filtered_burst(df, mode=mode, cols=cols or 16, seed=5, bits=BITS, threshold=threshold))
    np.testing.assert_allclose(got, want, rtol=1e-8, atol=1e-8)


def test_filtering_in_steps_equals_one_pass(spark, stream):
    pdf, _ = stream
    want = M.filtering(events(pdf), E.hash_params(2, 5), 16, 5.0)
    got, state = [], None
    for part in np.array_split(pdf, 4):
        frame, state = E.filtered_burst_step(
            spark.createDataFrame(part), state, cols=16, seed=5, bits=BITS, threshold=5.0
        )
        state = E.checkpointed(state)
        got.append(scores(frame))
    np.testing.assert_allclose(np.concatenate(got), want, rtol=1e-8, atol=1e-8)


@pytest.mark.parametrize("factor", [0.0, 0.5, 1.0])
@pytest.mark.parametrize("batch", [3, 40, 10_000])
def test_exact_filtering_over_frames_and_factors(spark, stream, factor, batch):
    """Entities that go on from one Arrow frame to the next, few long and many short ones, and factors at both ends."""
    pdf, df = stream
    want = M.filtering(events(pdf), E.hash_params(2, 5), None, 5.0, factor)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = scores(E.filtered_burst(df, mode="exact", threshold=5.0, factor=factor, bits=BITS))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    np.testing.assert_allclose(got, want, rtol=1e-8, atol=1e-8)


@pytest.mark.parametrize("mode", ["sketch", "exact"])
def test_touched_cells_are_dealt_to_tasks_by_rows(spark, monkeypatch, mode):
    rows = [(i, i % 7, i % 3, 1 + i // 100) for i in range(900)]
    df = spark.createDataFrame(rows, "seq long, src long, dst long, slot long")
    burst = lambda: E.relational_burst(df, mode=mode)
    want = sorted(map(tuple, burst().collect()))
    monkeypatch.setattr(E, "TASK_ROWS", 50)
    dealt = burst()
    assert f", {5400 // 50 if mode == 'sketch' else 2700 // 50}), REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == want


@pytest.mark.parametrize("mode", ["sketch", "exact"])
def test_a_slot_over_several_chunks_is_dealt_by_cell_once(spark, mode):
    """A hot entity whose slots span many chunks; chunks are made once and shuffled once to their cells."""
    rng = np.random.default_rng(8)
    n = 600
    pdf = pd.DataFrame({"seq": np.arange(n) * 5, "src": np.where(rng.random(n) < 0.8, 7, 3), "dst": 9, "slot": 1 + np.arange(n) // 150 * 2})
    burst = E.filtered_burst(spark.createDataFrame(pdf), mode=mode, cols=16, seed=5, threshold=5.0, factor=0.99, bits=BITS)
    want = M.filtering(events(pdf), E.hash_params(2, 5), 16 if mode == "sketch" else None, 5.0, 0.99)
    np.testing.assert_allclose(scores(burst), want, rtol=1e-8, atol=1e-8)


def test_exact_filtering_sends_touched_cells_to_their_counts_once(spark):
    rows = [(i, i % 7, i % 3, 1 + i // 100) for i in range(900)]
    plan = E.filtered_burst(spark.createDataFrame(rows, "seq long, src long, dst long, slot long"), mode="exact")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join") <= 2 and text.count("Generate explode") == 2  # touched cells and their chunks


@pytest.mark.parametrize("step", [False, True])
def test_filtered_scores_are_dealt_to_tasks_by_rows(spark, monkeypatch, step):
    rows = [(i, i % 7, i % 3, 1 + i // 100) for i in range(900)]
    df = spark.createDataFrame(rows, "seq long, src long, dst long, slot long")
    burst = lambda: E.filtered_burst_step(df, None, threshold=5.0)[0] if step else E.filtered_burst(df, threshold=5.0)
    want = sorted(map(tuple, burst().collect()))
    monkeypatch.setattr(E, "TASK_ROWS", 50)
    dealt = burst()
    assert f", {2700 // 50}), REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == want
