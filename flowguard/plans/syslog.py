"""System-log lines to outlier scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.functions.scalar import epoch_seconds, syslog_fields
from flowguard.ml import text as X
from flowguard.ml.sparse_forest import SparseForest
from flowguard.session import checkpointed

CUTOFF = -0.45


def _fields(lines: DataFrame, column: str, year: int) -> DataFrame:
    return lines.withColumn("_f", syslog_fields(F.col(column), year))


def parse_lines(lines: DataFrame, column: str = "line", year: int = 2020) -> DataFrame:
    """(id, sec, hostname, appname, pid, message) of the lines that parse; ``rejects`` gives the others."""
    return _fields(lines, column, year).filter("_f is not null").select(
        "id", epoch_seconds(F.col("_f.timestamp")).alias("sec"), "_f.hostname", "_f.appname", "_f.pid", "_f.message"
    )


def rejects(lines: DataFrame, column: str = "line", year: int = 2020) -> DataFrame:
    """(id, line): lines that do not parse and are not scored."""
    return _fields(lines, column, year).filter("_f is null").select("id", F.col(column).alias("line"))


@dataclass
class SyslogForest:
    """Vocabulary with inverse document frequencies, and a forest whose features are all of its terms."""

    vocabulary: DataFrame
    forest: SparseForest

    @staticmethod
    def fit(lines: DataFrame, size: int | None = None, **forest) -> "SyslogForest":
        """Every term of every message is a feature; ``size`` keeps the most used terms only."""
        parsed = checkpointed(parse_lines(lines))
        vocabulary = checkpointed(X.fit_vocabulary(parsed, size=size))
        weights = checkpointed(X.tfidf(parsed, vocabulary).select("id", "term", "weight"))
        return SyslogForest(vocabulary, SparseForest.fit(weights, parsed, **forest))

    def score(self, lines: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
        """Parsed lines with negated scores: the lower, the more unusual; outliers lie below the cutoff."""
        parsed = checkpointed(parse_lines(lines))
        weights = checkpointed(X.tfidf(parsed, self.vocabulary).select("id", "term", "weight"))
        scored = self.forest.score(weights, parsed).select("id", (-F.col("score")).alias("anomalyScore"))
        return parsed.join(scored, "id").withColumn("is_anomalous", F.col("anomalyScore") < cutoff)

    def save(self, path: str) -> None:
        self.vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
        self.forest.save(f"{path}/forest")

    @staticmethod
    def load(path: str) -> "SyslogForest":
        return SyslogForest(SparkSession.getActiveSession().read.parquet(f"{path}/vocabulary"), SparseForest.load(f"{path}/forest"))
