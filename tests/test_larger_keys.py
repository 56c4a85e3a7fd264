"""Queries over tables whose keys outgrow what their texts were built for, next to their SQL."""

import duckdb
import pytest

from tests.oracle_check import canonical


@pytest.fixture(scope="module")
def against_sql(spark, tmp_path_factory):
    def check(name: str, table: str, sql: str):
        import __spark_entry__ as entry

        folder = str(tmp_path_factory.mktemp("keys"))
        con = duckdb.connect()
        con.execute("SET TimeZone='UTC'")
        con.execute(f"COPY ({sql}) TO '{folder}/{table}.parquet'")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        got = entry.queries()[name](spark, folder).toPandas()
        assert canonical(got) == canonical(con.execute(entry.oracle_sql()[name]).fetchdf())
        return got

    return check


def test_keys_beyond_one_group_of_an_address(against_sql):
    keys = "SELECT unnest(range(65530, 65560) || range(99990, 100010) || range(4294900, 4294910) || range(0, 20)) AS c_custkey"
    assert (against_sql("c06_ipv6_low32", "customer", keys)["ip"] > 65536).sum() > 30


@pytest.mark.parametrize("name", ["p03_edge_messages", "t10_retrained_cutoff"])
def test_edges_of_users_beyond_dotted_bytes(against_sql, name):
    users = "SELECT * REPLACE (user_id + (event_id % 3) * 65530 AS user_id) FROM '/root/testdata/sf0.001/events.parquet'"
    assert len(against_sql(name, "events", users)) in (1, 1000)


def test_histories_are_encoded_once_and_on_all_cores(spark):
    from pyspark.sql import functions as F

    import __spark_entry__ as entry

    rows = entry.queries()["c13_history_one_hot"](spark, "/root/testdata/sf0.001")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "lambdafunction" in line]
    # The table is one file; its cells are summed where its ids were dealt to.
    assert rows.select(F.spark_partition_id()).distinct().count() > 1


def test_texts_are_tokenised_once_for_vocabulary_and_weights(spark):
    from pyspark.sql import functions as F

    from flowguard.ml import text as X
    from flowguard.session import checkpointed

    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    plain = spark.createDataFrame([(1, "one two two"), (2, "two three"), (3, None)], "id long, message string")
    docs = plain.withColumn("message", counted("message"))
    counts = checkpointed(X.term_counts(docs))
    got = X.tfidf(docs, X.fit_vocabulary(docs, counts=counts), counts=counts).collect()
    assert reads.value == 3
    assert sorted(got) == sorted(X.tfidf(plain, X.fit_vocabulary(plain)).collect())
