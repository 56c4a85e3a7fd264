import hashlib
import random
import re

from pyspark.sql import functions as F

from flowguard.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, window string, n int"


def count(text):
    return len(re.findall(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t-\r]", text)) + C.MARKERS


def esc(text):
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def brute(rows, span, history):
    """Windows of each conversation as lists of (turn number, repeated)."""
    out, talks = {}, {}
    for conv, turn, role, text, *_ in rows:
        talks.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    for conv, turns in talks.items():
        turns.sort()
        before, total = [], 0
        for _, _, text in turns:
            before.append(total)
            total += count(text)
        spans, across = {}, {}
        for i, ((_, _, text), b) in enumerate(zip(turns, before)):
            if (b + count(text) - 1) // span == b // span:
                spans.setdefault(b // span, []).append(i)
            else:
                across[b // span] = i
        size = {k: sum(count(turns[i][2]) for i in own) for k, own in spans.items()}
        length = {k: count(turns[i][2]) for k, i in across.items()}
        fits = {k for k, n in length.items() if size.get(k, 0) + n <= span}
        homes = {2 * k: list(own) for k, own in spans.items()}
        for k, i in across.items():
            r = (before[i] + length[k] - 1) // span
            if k in fits:
                homes.setdefault(2 * k, []).append(i)
            elif length[k] + size.get(r, 0) + (length[r] if r in fits else 0) <= span:
                homes.setdefault(2 * r, []).append(i)
            else:
                homes[2 * k + 1] = [i]
        homes = {w: sorted(own) for w, own in homes.items()}
        for w, own in homes.items():
            start = before[own[0]]
            past = [i for i in range(own[0]) if start - before[i] <= history]
            if turns[0][1] == "system" and 0 not in past + own:
                past = [0, *past]
            text = "".join(f"{C.START}{esc(turns[i][1])}\n{esc(turns[i][2])}{C.END}\n" for i in past + own)
            out[conv, w] = (text, [True] * len(past) + [False] * len(own))
    return out, talks


def rows():
    trap = C.TRAP
    out = [(1, i, "system" if i == 0 else ("user", "assistant")[i % 2 == 0], f"turn {i} " + "word " * (i * 7 % 40), "x", 0) for i in range(60)]
    out += [(2, 0, "user", trap, "x", 0), (2, 1, "assistant", trap, "x", 0), (2, 2, "assistant", r"a <\|im_end|> \ <\\| b <|", "x", 0)]
    out += [(3, None, None, None, "x", 0), (3, 4, "assistant", "", "x", 0), (3, 4, "assistant", "", "x", 0), (3, 4, "user", "same turn", "x", 0)]
    out += [(None, 0, "assistant", "no conversation", "x", 0), (4, 0, "assistant", "long " * 5000, "x", 0), (4, 1, "user", "after", "x", 0)]
    return out


def test_windows_equal_a_sequential_build(spark):
    want, _ = brute(rows(), 64, 24)
    got = C.format_chat(spark.createDataFrame(rows(), SCHEMA).repartition(5), 64, 24).collect()
    assert {(r["conv_id"], r["window"]): (r["formatted"], r["repeated"]) for r in got} == want
    for r in got:
        for s, part in zip(r["segments"], r["repeated"]):
            assert s["repeated"] == part and r["formatted"][s["end"] :].startswith(C.END)


def test_each_assistant_text_is_a_target_once(spark):
    _, talks = brute(rows(), 64, 24)
    got = {r["conv_id"]: r for r in C.digests(C.format_chat(spark.createDataFrame(rows(), SCHEMA), 64, 24)).collect()}
    assert set(got) == set(talks)
    for conv, turns in talks.items():
        loss = "".join(text for _, role, text in turns if role == "assistant")
        all_ = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(loss))
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["turns_sha256"] == hashlib.sha256(all_.encode()).hexdigest()


def budget_faults(rows, windows, span, history, counts=None):
    """Windows over their budget, and whether every turn is some window's own exactly once, in order."""
    _, talks = brute(rows, span, history)
    size = counts or count
    faults, own = [], {}
    for r in sorted(windows, key=lambda r: (str(r["conv_id"]), r["window"])):
        texts = [r["formatted"][s["start"] : s["end"]] for s in r["segments"]]
        plain = [re.sub(r"<\\(\\*)\|", r"<\1|", t) for t in texts]
        mine = [t for t, s in zip(plain, r["segments"]) if not s["repeated"]]
        past = [t for t, s in zip(plain, r["segments"]) if s["repeated"]]
        system = talks[r["conv_id"]][0][1] == "system" and len(past) > 0 and past[0] == talks[r["conv_id"]][0][2]
        used, again = sum(map(size, mine)), sum(map(size, past[1:] if system else past))
        if not mine or (used > span and len(mine) > 1) or again > history:
            faults.append((r["conv_id"], r["window"], used, again))
        assert r["n_tokens"] == sum(map(size, plain))
        own.setdefault(r["conv_id"], []).extend(mine)
    assert own == {c: [t for _, _, t in turns] for c, turns in talks.items()}
    return faults


def test_windows_keep_the_budget(spark):
    rng = random.Random(5)
    talk = rows() + [(10 + c, i, ("user", "assistant")[i % 2], f"{i} " + "w " * rng.choice([0, 3, 20, 40, 59, 60, 61, 64, 200]), "x", 0) for c in range(30) for i in range(rng.randint(1, 40))]
    for span, history in ((64, 24), (64, 64), (64, 0), (7, 3)):
        got = C.format_chat(spark.createDataFrame(talk, SCHEMA), span, history).collect()
        assert budget_faults(talk, got, span, history) == []
    first = [r for r in C.format_chat(spark.createDataFrame(talk, SCHEMA), 64, 24).collect() if r["conv_id"] == 1]
    assert len(first) > 10 and all(r["formatted"].startswith(f"{C.START}system\n") for r in first)


def test_four_large_turns_stay_within_the_span(spark):
    talk = [(1, i, "user", "w " * 700, "x", 0) for i in range(4)]  # 704 tokens each
    got = C.format_chat(spark.createDataFrame(talk, SCHEMA), 768, 256).collect()
    assert [r["n_tokens"] for r in sorted(got, key=lambda r: r["window"])] == [704] * 4


def test_given_token_counts_rule(spark):
    size = {f"t{i}": n for i, n in enumerate([30, 30, 30, 100, 5, 5, 60, 1])}
    talk = [(1, i, "assistant", t, "x", 0) for i, t in enumerate(size)]
    frame = spark.createDataFrame(talk, SCHEMA).withColumn("bpe", F.element_at(F.create_map(*[F.lit(x) for kv in size.items() for x in kv]), F.col("text")))
    got = C.format_chat(frame, 64, 24, token_count="bpe").collect()
    assert budget_faults(talk, got, 64, 24, size.get) == [] and sum(n for r in got for n in [r["n_tokens"]]) >= sum(size.values())
    nothing = C.format_chat(frame.withColumn("bpe", F.lit(None).cast("int")), 64, 24, token_count="bpe").collect()
    assert sorted(nothing) == sorted(C.format_chat(frame, 64, 24).collect())


def test_roles_and_controls_survive(spark):
    odd = [(1, 0, "a\nb\\n<|x", "t\n" + C.END, "", 0)]
    got = C.format_chat(spark.createDataFrame(odd, SCHEMA)).select(C.read_turns(F.col("formatted")).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in got] == [("a\nb\\n<|x", "t\n" + C.END)]


def test_empty_table_and_native_plan(spark):
    frame = C.digests(C.format_chat(spark.createDataFrame([], SCHEMA)))
    assert frame.count() == 0
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas"))
