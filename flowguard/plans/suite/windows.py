"""Queries over time windows."""

from pyspark.sql import functions as F

from flowguard.operators import windows as W
from flowguard.plans.suite.base import Tables, flow_sql, query


def _rounded(df, columns, digits=9):
    return df.select("id", *[F.round(c, digits).alias(c) for c in columns])


def _means_sql(per, features, windows):
    picks = ", ".join(
        f"round(avg({c}) OVER (ORDER BY sec RANGE BETWEEN {w} PRECEDING AND CURRENT ROW), 9) AS {c}_{w}_mean"
        for w in windows for c in features
    )
    return f"WITH {flow_sql(per)} SELECT id, {picks} FROM flow"


def _distinct_sql(per, features, windows):
    picks = ", ".join(
        f"count(DISTINCT {c}) OVER (ORDER BY sec RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) AS {c}_{w}_mean"
        for w in windows for c in features
    )
    return f"WITH {flow_sql(per)} SELECT id, {picks} FROM flow"


for _suffix, _per in (("", 1), ("_dense", 60)):

    @query(f"w01_trailing_mean{_suffix}", _means_sql(_per, ["td", "ipkt", "ibyt", "stos"], (10, 60, 600)))
    def _(t: Tables, per=_per):
        out = W.trailing_means(t.flow(per), ["td", "ipkt", "ibyt", "stos"])
        return _rounded(out, [f"{c}_{w}_mean" for w in (10, 60, 600) for c in ("td", "ipkt", "ibyt", "stos")])

    @query(f"w02_trailing_distinct{_suffix}", _distinct_sql(_per, ["sp", "dp", "da"], (10, 60, 600)))
    def _(t: Tables, per=_per):
        out = W.trailing_distinct(t.flow(per), ["sp", "dp", "da"])
        return out.select("id", *[f"{c}_{w}_mean" for w in (10, 60, 600) for c in ("sp", "dp", "da")])


@query("w02_trailing_distinct_approximate", "SELECT event_id AS id, true AS near FROM events")
def _(t: Tables):
    """Sketched counts lie within a quarter (and one) of the exact ones, for every row and window."""
    names = [f"{c}_{w}_mean" for w in (10, 60, 600) for c in ("sp", "dp", "da")]
    flow = t.flow(60)
    near = W.trailing_distinct(flow, ["sp", "dp", "da"], approximate=True).select("id", *names)
    exact = W.trailing_distinct(flow, ["sp", "dp", "da"]).select("id", *[F.col(n).alias(f"_{n}") for n in names])
    gaps = [F.abs(F.col(n) - F.col(f"_{n}")) <= 1 + F.col(f"_{n}") / 4 for n in names]
    return near.join(exact, "id").select("id", F.least(*gaps).alias("near"))


# A row sees its own source's rows that are younger than 600 and not later in id order.
_SEEN = "FROM flow r JOIN flow o ON o.sa = r.sa AND o.id <= r.id AND o.sec > r.sec - 600 AND o.sec <= r.sec GROUP BY r.id"

for _suffix, _per in (("", 1), ("_dense", 3600)):

    @query(f"w03_source_moments{_suffix}", f"""WITH {flow_sql(_per)} SELECT r.id,
      round(avg(o.td), 9) AS td_mean, round(coalesce(stddev_samp(o.td), 0), 6) AS td_std,
      round(avg(o.ibyt), 8) AS ibyt_mean, round(coalesce(stddev_samp(o.ibyt), 0), 5) AS ibyt_std {_SEEN}""")
    def _(t: Tables, per=_per):
        out = W.source_features(t.flow(per), means=["td", "ibyt"])
        return out.select(
            "id", F.round("td_mean", 9).alias("td_mean"), F.round("td_std", 6).alias("td_std"),
            F.round("ibyt_mean", 8).alias("ibyt_mean"), F.round("ibyt_std", 5).alias("ibyt_std"),
        )

    @query(f"w04_source_distinct{_suffix}", f"""WITH {flow_sql(_per)} SELECT r.id, count(DISTINCT o.sp) AS sp_count,
      count(DISTINCT o.dp) AS dp_count, count(DISTINCT o.da) AS da_count {_SEEN}""")
    def _(t: Tables, per=_per):
        out = W.source_features(t.flow(per), counts=["sp", "dp", "da"])
        return out.select("id", "sp_count", "dp_count", "da_count")


@query("w09_arrival_ordinal", f"WITH {flow_sql()} SELECT id, row_number() OVER (ORDER BY id) AS ordinal FROM flow")
def _(t: Tables):
    return W.arrival_ordinal(t.flow().select("id"))
