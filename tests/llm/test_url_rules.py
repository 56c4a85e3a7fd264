import random

from flowguard.llm import url_rules as R

SCHEMA = "page_id long, url string, host int, _keys string"


def brute(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
        host = rest[:cut].translate(str.maketrans(R.UPPER, R.LOWER))
        tail = rest[cut:]
        path = tail[: min((i for i in (tail.find(c) for c in "?#") if i >= 0), default=len(tail))]
    fits = [(len(h) + len(p), len(h), h + p, a) for a, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, key=lambda f: f[:2], default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def judged(spark, urls, rules):
    frame = spark.createDataFrame([(i, u, 1, "k") for i, u in enumerate(urls)], SCHEMA)
    got = R.judge_urls(frame, rules)
    assert got.columns == ["page_id", "url", "_keys", "host", "path", "rule", "verdict"]
    return {r["page_id"]: tuple(r)[3:] for r in got.collect()}


def test_equal_to_trying_every_rule(spark):
    rng = random.Random(3)
    parts = ["a", "bb", "ccc", "net", "org", "com", "example"]
    host = lambda: ".".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "/".join(rng.choice(["en", "de", "x", ""]) for _ in range(rng.randint(0, 3)))
    rules = {(host(), path()): rng.choice(["allow", "block"]) for _ in range(150)}
    rules = [(a, h, p) for (h, p), a in rules.items()]
    urls = [f"http{rng.choice(['', 's'])}://{host().upper() if rng.random() < .2 else host()}{rng.choice(['', path(), path()])}{rng.choice(['', '?q=://x', '#f/'])}" for _ in range(800)]
    urls += [None, "", "no scheme", "://", "http://", "http:///en/", "http://a.NET", "x://a.net?/en/", urls[0], urls[0], "http://" + "a." * 200 + "net/", "http://ünï.Ä.net/"]
    got = judged(spark, urls, rules)
    for i, url in enumerate(urls):
        assert got[i] == brute(url, rules), url


def test_production_rules_empty_table_and_no_rules(spark):
    urls = ["http://a.example.net/en/1", "http://a.example.net/fr/", "https://x.org/fr/a", "http://example.com/de/", "http://example.com/de"]
    got = judged(spark, urls, R.RULES)
    assert [got[i][2:] for i in range(5)] == [("example.net/en/", "allow"), ("net/", "block"), ("org/fr/", "allow"), ("example.com/de/", "block"), (None, "allow")]
    assert judged(spark, [], R.RULES) == {}
    assert judged(spark, urls[:1], []) == {0: ("a.example.net", "/en/1", None, "allow")}


def test_cascade_is_exact_over_its_universe(spark):
    import numpy as np
    from pyspark.sql import functions as F

    keys = spark.range(20_000).select(F.xxhash64("id").alias("a"), F.xxhash64("id", F.lit(1)).alias("b"), "id")
    cascade = R.build_cascade(keys.select("a", "b"), keys.filter("id % 50 = 0").select("a", "b"))
    rows = keys.toPandas()
    listed = cascade.listed(rows["a"].to_numpy().view(np.uint64), rows["b"].to_numpy().view(np.uint64))
    assert (listed == (rows["id"] % 50 == 0).to_numpy()).all()
    assert len(cascade.levels) > 2
    assert sum(len(x.bits) for x in cascade.levels) < 400 * 8  # a few bytes per listed key


def test_keys_with_equal_first_hashes_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    real = R.key_hashes
    monkeypatch.setattr(R, "key_hashes", lambda key: (F.length(key).cast("long") % 3, real(key)[1]))
    rules = [("block", "a.com", "/x"), ("allow", "b.org", "/y"), ("block", "net", "")]
    urls = [f"http://{h}{p}" for h in ("a.com", "b.com", "a.org", "b.org", "c.net", "net", "c.a.com") for p in ("/x", "/y", "/z", "")]
    assert judged(spark, urls, rules) == {i: brute(u, rules) for i, u in enumerate(urls)}
    a, b = spark.range(1).select(*real(F.lit("some key"))).first()
    assert a != b


def test_any_column_names_pass(spark):
    names = ["page_id", "url", "_row", "_host", "_path", "_keys", "_hit", "key", "a", "b", "at", "action"]
    frame = spark.createDataFrame([(1, "http://x.net/q", *range(10))], f"page_id long, url string, {', '.join(f'{n} int' for n in names[2:])}")
    got = R.judge_urls(frame, [("block", "net", "/")])
    assert got.columns == [*names, "host", "path", "rule", "verdict"]
    assert tuple(got.first()) == (1, "http://x.net/q", *range(10), "x.net", "/q", "net/", "block")
