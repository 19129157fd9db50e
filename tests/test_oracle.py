"""Every registered query against its SQL counterpart, on whole tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def engine():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, engine, name):
    problem = compare(engine, QUERIES[name](spark, FOLDER), ORACLES[name])
    assert problem in (None, "both empty"), problem


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["site", "month", "days", "clicks", "impressions", "ctr", "position"]
    assert df.count() > 0


def test_registry_hash_ignores_order_and_partitions(spark):
    from sightline.operators import registry
    part = spark.read.parquet(f"{FOLDER}/part.parquet")
    one = registry.registry_hash(registry.with_semantic_hash(part.coalesce(1)), "p_partkey").first()
    many = registry.registry_hash(registry.with_semantic_hash(part.orderBy("p_name").repartition(7)), "p_partkey").first()
    other = registry.registry_hash(registry.with_semantic_hash(part.where("p_partkey > 0")), "p_partkey").first()
    assert one == many == QUERIES["K18_registry_hash"](spark, FOLDER).first()
    assert one.registry_hash != other.registry_hash
