"""The jobs as a whole: shapes, equivalence over separate tables, and plans."""

import pytest

from fixtures import star as fx
from fixtures.queries import QUERIES
from patronage.model import FEATURE_TABLE
from patronage.plans.customer_360 import (
    PERSONAL_COLUMNS,
    customer_360,
    customer_360_clean,
)
from patronage.plans.customer_analytics import customer_analytics
from patronage.plans.feature_step import feature_step
from patronage.plans.ingest import ingest
from patronage.plans.star import star_from_parquet
from patronage.sources import parquet

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def same_rows(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def star(spark):
    return fx.star(spark, SF_DIR)


def test_customer_360_shape(star):
    profiles = customer_360(star)
    assert len(profiles.columns) == 42
    types = dict(profiles.dtypes)
    assert types["total_sales_amount"] == types["net_sales_amount"] == "decimal(29,2)"
    assert types["avg_transaction_value"] == types["return_rate"] == "double"
    assert profiles.count() == star.customer.count()


def test_customer_360_clean_shape(star):
    clean = customer_360_clean(star)
    assert len(clean.columns) == 35
    assert clean.columns[:4] == ["c_customer_sk", "c_preferred_cust_flag", "birth_date", "cd_gender"]
    assert not set(PERSONAL_COLUMNS) & set(clean.columns)
    assert len(customer_360_clean(star, keep_gender=False).columns) == 34


def test_customer_analytics_shape_and_order(star):
    rows = customer_analytics(star, "joined")
    assert rows.dtypes == [(f.name, f.dataType.simpleString()) for f in FEATURE_TABLE.fields]
    order = [(r["total_sales_amount"], r["c_customer_sk"]) for r in rows.collect()]
    expected = sorted(order, key=lambda row: (row[0] is None, -(row[0] or 0), row[1]))
    assert order == expected


def test_returns_modes_differ_only_in_returns(star):
    joined = customer_analytics(star, "joined", ordered=False)
    true = customer_analytics(star, "per_channel", ordered=False)
    returns = [c for c in joined.columns if "return" in c]
    assert same_rows(joined.drop(*returns), true.drop(*returns))
    assert not same_rows(joined.select(returns), true.select(returns))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The twelve tables of the star, ingested."""
    tables = fx.tables(spark, SF_DIR)
    base = str(tmp_path_factory.mktemp("star"))
    ingest(spark, tables.__getitem__, list(tables), base, at_once=4)
    return star_from_parquet(spark, base)


def test_stored_tables_give_the_same_rows(star, stored):
    assert same_rows(customer_360(stored), customer_360(star))
    assert same_rows(
        customer_analytics(stored, "joined", ordered=False),
        customer_analytics(star, "joined", ordered=False),
    )


def test_every_line_is_a_sale_and_some_buyers_are_unknown(spark, star):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    assert star.ledger.where("is_sale").count() == lines
    buyers = star.ledger.where("customer_sk IS NOT NULL").select("customer_sk").distinct()
    known = star.customer.select("c_customer_sk")
    assert buyers.join(known, buyers.customer_sk == known.c_customer_sk, "left_anti").count() > 0


def test_jobs_without_any_broadcast(spark, star, capsys):
    """Dimensions beyond the budget are shuffled to, with the same result."""
    large = fx.star(spark, SF_DIR)
    names = ("demographics", "household", "bands", "address", "dates")
    large._measured.update(dict.fromkeys(names, False))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        profiles, analytics = customer_360(large), customer_analytics(large, "joined", ordered=False)
        assert "Broadcast" not in plan_of(profiles, capsys) + plan_of(analytics, capsys)
        assert same_rows(profiles, customer_360(star))
        assert same_rows(analytics, customer_analytics(star, "joined", ordered=False))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_feature_step_shape(star, tmp_path):
    features = feature_step(customer_analytics(star, "joined", ordered=False), f"{tmp_path}/run")
    assert len(features.columns) == 29
    types = dict(features.dtypes)
    assert types["cd_gender"] == "int" and types["total_sales_amount"] == "double"
    assert types["active_channels_count"] == "bigint"


def test_feature_step_drops_copies(star, tmp_path):
    rows = customer_analytics(star, "joined", ordered=False)
    twice = feature_step(rows.unionAll(rows), f"{tmp_path}/twice")
    once = feature_step(rows, f"{tmp_path}/once")
    assert same_rows(twice.select("c_customer_sk"), once.select("c_customer_sk"))


def test_customer_360_shuffles_the_ledger_once(stored, capsys):
    """By customer; the join to customers reuses that, and the days arrive as sets."""
    plan = plan_of(customer_360(stored), capsys)
    by_customer = [line for line in plan.splitlines() if "Exchange hashpartitioning(customer_sk" in line]
    assert len(by_customer) == 1 and "partial_collect_set" in plan and "Expand" not in plan


def test_customer_analytics_shuffles_the_ledger_once(stored, capsys):
    plan = plan_of(customer_analytics(stored, "joined"), capsys)
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning(customer_sk" in line]
    assert len(lines) == 1


def test_stored_facts_are_read_once_and_narrow(stored, capsys):
    plan = plan_of(customer_analytics(stored, "joined"), capsys)
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 11  # six facts, customers, three dimensions, dates
    store = next(line for line in scans if "ss_customer_sk" in line)
    assert "PushedFilters: [IsNotNull(ss_customer_sk)]" in store
    assert "ss_quantity" not in store
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(customer_sk" in line]
    assert len(exchanges) == 1


def test_nothing_is_broadcast_unmeasured(stored, capsys):
    """Only the measured dimensions; customers and totals are shuffled."""
    star = stored
    threshold = star.customer.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    star.customer.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(customer_360(star), capsys)
    finally:
        star.customer.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert plan.count("BroadcastHashJoin") == 4
    assert plan.count("SortMergeJoin") == 1  # totals


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_stay_in_the_jvm(spark, capsys, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR), capsys)
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
