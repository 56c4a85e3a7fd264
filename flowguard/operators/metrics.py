"""Quality measures over scored rows.

Scores are folded to one row per distinct value first; what depends on value order is then a
range-partitioned running sum, so no measure sorts the data in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.operators.scan import running_by_value


def value_counts(df: DataFrame, score: str, keys: list[str] = (), **counts: Column) -> DataFrame:
    counts = counts or {"n": F.lit(1)}
    return (
        df.filter(F.col(score).isNotNull())
        .groupBy(*keys, F.col(score).cast("double").alias("score"))
        .agg(*[F.sum(e.cast("bigint")).alias(n) for n, e in counts.items()])
    )


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve, ties count half."""
    positive = F.col(label).cast("int") == 1
    folded = value_counts(df, score, pos=F.when(positive, 1).otherwise(0), neg=F.when(positive, 0).otherwise(1))
    ranked = running_by_value(folded, "score", {"below": F.col("neg")})
    wins = F.col("pos").cast("double") * (F.col("below") - F.col("neg") / 2.0)
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(F.when(pairs > 0, F.sum(wins) / pairs).alias("auc"))


def average_precision(df: DataFrame, score: str, label: str) -> DataFrame:
    positive = F.col(label).cast("int") == 1
    folded = value_counts(df, score, pos=F.when(positive, 1).otherwise(0), all=F.lit(1))
    ranked = running_by_value(folded, "score", {"tp": F.col("pos"), "seen": F.col("all")}, descending=True)
    gain = F.col("pos") * (F.col("tp") / F.col("seen"))
    total = F.sum("pos")
    return ranked.agg(F.when(total > 0, F.sum(gain) / total).alias("average_precision"))


def wasserstein(df: DataFrame, score: str, group: str, u: str, v: str) -> DataFrame:
    """First Wasserstein distance between the scores of two groups."""
    is_u, is_v = F.col(group) == u, F.col(group) == v
    folded = value_counts(
        df.filter(is_u | is_v), score, nu=F.when(is_u, 1).otherwise(0), nv=F.when(is_v, 1).otherwise(0)
    )
    ranked = running_by_value(folded, "score", {"cu": F.col("nu"), "cv": F.col("nv")})
    totals = ranked.agg(F.sum("nu").alias("_tu"), F.sum("nv").alias("_tv"))
    gap = F.abs(F.col("cu") / F.col("_tu") - F.col("cv") / F.col("_tv")) * (F.col("_next") - F.col("score"))
    return ranked.join(F.broadcast(totals)).agg(F.sum(gap).alias("distance"))


def _at_ranks(df: DataFrame, score: str, keys: list[str], ranks: dict[str, Column], descending=False) -> DataFrame:
    """Values at 1-based ranks; a rank may use ``n``, the number of values of the group."""
    folded = value_counts(df, score, keys)
    ranked = running_by_value(folded, "score", {"upto": F.col("n")}, keys, descending)
    sizes = folded.groupBy(*keys).agg(F.sum("n").alias("_size"))
    joined = ranked.join(F.broadcast(sizes)) if not keys else ranked.join(sizes, keys)
    lower = F.col("upto") - F.col("n")
    picks = []
    for name, rank in ranks.items():
        hit = (lower < rank) & (rank <= F.col("upto"))
        picks.append(F.max(F.when(hit, F.col("score"))).alias(name))
    return joined.groupBy(*keys).agg(*picks, F.max("_size").alias("_size"))


def quantile(df: DataFrame, score: str, q: float, keys: list[str] = (), name: str = "quantile") -> DataFrame:
    """Exact quantile with linear interpolation."""
    at = (F.col("_size") - 1) * F.lit(q)
    ranks = {"_lo": F.floor(at) + 1, "_hi": F.ceil(at) + 1}
    picked = _at_ranks(df, score, list(keys), ranks)
    share = at - F.floor(at)
    value = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share
    return picked.select(*keys, value.alias(name))


def rank_quantile(df: DataFrame, score: str, q: float, error: float = 0.0, name: str = "quantile") -> DataFrame:
    """Value at rank ceil(q*n); with an error above 0 the mergeable approximate quantile."""
    if error > 0:
        accuracy = F.lit(int(1 / error))
        return df.agg(F.percentile_approx(F.col(score).cast("double"), q, accuracy).alias(name))
    rank = F.greatest(F.ceil(F.col("_size") * F.lit(q)), F.lit(1))
    return _at_ranks(df, score, [], {name: rank}).select(name)


def benign_cutoff(df: DataFrame, score: str, percent: float) -> DataFrame:
    """The k-th largest score with k = floor(n*percent/100)-1 counted from 0.

    A negative k means the smallest score, as in negative list positions.
    """
    k = F.floor(F.col("_size") * F.lit(percent / 100)) - 1
    rank = F.when(k < 0, F.col("_size") + k).otherwise(k) + 1
    return _at_ranks(df, score, [], {"cutoff": rank}, descending=True).select("cutoff")


def retrained_cutoff(df: DataFrame, score: str, q: float = 0.99999) -> DataFrame:
    """New integer cutoff from historical scores, with their range."""
    spread = df.agg(F.min(score).alias("lowest"), F.avg(score).alias("mean"), F.max(score).alias("highest"))
    cutoff = quantile(df, score, q, name="_q")
    return spread.join(F.broadcast(cutoff)).select(
        F.col("_q").cast("bigint").alias("cutoff"), "lowest", "mean", "highest"
    )


def confusion(df: DataFrame, score: str, label: str, cutoff: float | Column) -> DataFrame:
    """Counts, precision and recall of ``score >= cutoff``."""
    hit, truth = F.col(score) >= cutoff, F.col(label).cast("int") == 1
    counts = df.agg(
        F.count_if(hit & truth).alias("tp"),
        F.count_if(hit & ~truth).alias("fp"),
        F.count_if(~hit & truth).alias("fn"),
        F.count_if(~hit & ~truth).alias("tn"),
    )
    return counts.select(
        "*",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", F.col("tp") + F.col("fn")).alias("recall"),
    )


def score_histogram(df: DataFrame, score: str, low: float, high: float, bins: int) -> DataFrame:
    bucket = F.width_bucket(F.col(score), F.lit(low), F.lit(high), F.lit(bins))
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def date_histogram(df: DataFrame, ts: str, zone: str, width: str = "12 hours") -> DataFrame:
    """Counts per fixed bucket of local time; empty buckets do not appear."""
    local = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    return df.groupBy(F.window(local, width).alias("_w")).agg(F.count("*").alias("n")).select(
        F.col("_w.start").alias("bucket"), "n"
    )


def class_profile(df: DataFrame, features: list[str], by: str) -> DataFrame:
    """Median and mean of every feature per class, as (class, feature, median, mean) rows."""
    cells = df.select(
        by,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
        ).alias("_c"),
    ).select(by, "_c.*")
    medians = quantile(cells, "value", 0.5, [by, "feature"], "median")
    means = cells.groupBy(by, "feature").agg(F.avg("value").alias("mean"))
    return medians.join(means, [by, "feature"])


def multiclass_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Per class precision, recall and F1, from one pass over (label, prediction) counts."""
    pairs = df.groupBy(F.col(label).cast("int").alias("l"), F.col(prediction).cast("int").alias("p")).agg(
        F.count("*").alias("n")
    )
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("l").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("predicted"),
                         F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0).alias("right")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("predicted"),
                         F.lit(0).cast("bigint").alias("right")),
            )
        ).alias("_s")
    ).select("_s.*")
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "right")])
    precision = F.coalesce(F.try_divide("right", "predicted"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("right", "actual"), F.lit(0.0))
    return per.select(
        "class", "actual", precision.alias("precision"), recall.alias("recall"),
        F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0)).alias("f1"),
    )


def regression_metrics(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    gap = F.col(label) - F.col(prediction)
    return df.agg(
        F.avg(gap * gap).alias("mse"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        (1 - F.try_divide(F.avg(gap * gap), F.var_pop(F.col(label)))).alias("r2"),
    )
