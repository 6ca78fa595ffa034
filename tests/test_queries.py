import pytest

from tests.oracle import assert_same
from tidewell.plans import registry

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(name, spark, tiny):
    assert_same(registry.queries()[name], SQL[name], spark, tiny)


def test_every_query_has_sql_or_is_stateful():
    assert set(registry.queries()) == set(SQL)


def test_totals_of_the_fixture(spark, tiny):
    row = registry.queries()["gold_lateness_totals"](spark, tiny).first()
    assert tuple(row) == (225, 117, 112, 27, 4)
    assert registry.post_windows(spark, tiny).count() == 346


def test_results_do_not_depend_on_the_session_zone(spark, tiny):
    before = registry.post_windows(spark, tiny).toPandas()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        after = registry.post_windows(spark, tiny).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = ["window_start"]
    assert before.sort_values(key).reset_index(drop=True).equals(after.sort_values(key).reset_index(drop=True))


def test_instants_survive_gaps_of_the_session_zone(spark):
    from tidewell.functions import exprs as X

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.000001' a, timestamp_ntz'2024-03-10 03:30:00' b").withColumn("us", X.micros("a"))
        row = df.select("us", X.instant("us").alias("back"), "a", X.delay_seconds("a", "b").alias("d")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.us == 1_710_037_800_000_001 and row.back == row.a and row.d == 3599.999999
