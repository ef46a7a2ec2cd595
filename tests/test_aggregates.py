import random
from decimal import Decimal
from itertools import product

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from patronage.model import CHANNELS, STORE_SALES
from patronage.operators import aggregates as agg
from patronage.operators.channels import drop_undated_store_sales, ledger

SALES = (
    "channel string, customer_sk int, sale_date int, item_sk int, price decimal(7,2), "
    "profit decimal(7,2), quantity int"
)
RETURNS = "channel string, customer_sk int, return_amount decimal(7,2), return_quantity int"


def money(x):
    return None if x is None else Decimal(x).quantize(Decimal("0.01"))


def test_sums_over_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3), (2, None), (None, 7)], "k int, x int")
    plain = dict(agg.sum_by(df, "k", {"s": "x"}).collect())
    assert plain == {1: None, 2: 3, None: 7}
    assert dict(agg.sum_coalesced_by(df, "k", {"s": "x"}).collect()) == {1: 0, 2: 3, None: 7}
    assert dict(agg.count_by(df, "k", "n").collect()) == {1: 2, 2: 2, None: 1}
    assert dict(agg.average_by(df, "k", "x", "a").collect()) == {1: None, 2: 3.0, None: 7.0}
    assert dict(agg.distinct_by(df, "k", "x", "d").collect()) == {1: 0, 2: 1, None: 1}
    assert dict(agg.has_any_by(df, "k", "x", "f").collect()) == {1: 0, 2: 1, None: 1}


def returned(spark, rows, mode):
    customer = spark.createDataFrame([(1,), (2,)], "c_customer_sk int")
    returns = spark.createDataFrame(rows, RETURNS)
    out = agg.returned_amounts(customer, "c_customer_sk", returns, mode)
    return {r["c_customer_sk"]: [r[f"{c}_return_amount"] for c in CHANNELS] for r in out.collect()}


def test_joined_returns_repeat_each_other(spark):
    rows = [("catalog", 1, Decimal(a), 1) for a in (10, 20)]
    rows += [("web", 1, Decimal(5), 1)] * 3
    assert returned(spark, rows, "joined") == {1: [90, 30, 0], 2: [0, 0, 0]}
    assert returned(spark, rows, "per_channel") == {1: [30, 15, 0], 2: [0, 0, 0]}


def test_joined_returns_against_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for customer in range(60):
        for channel in CHANNELS:
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                amount = rng.choice([None, Decimal(rng.randrange(10_000)) / 100])
                rows.append((channel, customer, amount, 1))
    customers = spark.range(60).select(F.col("id").cast("int").alias("c_customer_sk"))
    frame = spark.createDataFrame(rows, RETURNS)
    out = agg.returned_amounts(customers, "c_customer_sk", frame, "joined")
    for row in out.collect():
        parts = {
            channel: [a for c, k, a, _ in rows if c == channel and k == row["c_customer_sk"]] or [None]
            for channel in CHANNELS
        }
        joined = list(product(*[parts[channel] for channel in CHANNELS]))
        for i, channel in enumerate(CHANNELS):
            expected = sum((combo[i] or Decimal(0) for combo in joined), Decimal(0))
            assert row[f"{channel}_return_amount"] == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_joined_returns_beyond_the_limit_name_the_customer(spark, ansi):
    amount, many = Decimal("10") ** 12, 10**8
    totals = [(k, *(x for _ in CHANNELS for x in (amount, n))) for k, n in ((4, many), (5, 3))]
    kinds = ", ".join(f"{c}_returned decimal(22,2), {c}_return_rows long" for c in CHANNELS)
    df = spark.createDataFrame(totals, f"customer_sk int, {kinds}")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        few = df.where("customer_sk = 5").select(agg.joined_return("web").alias("x"))
        assert few.first()["x"] == 9 * amount
        with pytest.raises(PySparkException, match="customer 4 has joined returns in the web channel"):
            df.select(agg.joined_return("web")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_unknown_returns_mode():
    with pytest.raises(ValueError, match="returns mode"):
        agg.return_column("both", "web")


def book(spark):
    sales = spark.createDataFrame(
        [
            ("store", 1, 100, 7, None, Decimal(1), 1),
            ("store", 1, 999, 7, Decimal(5), Decimal(1), 2),
            ("store", 1, None, 7, Decimal(6), Decimal(1), 3),
            ("catalog", 1, None, None, Decimal(10), None, 4),
            ("web", 2, 100, 8, Decimal(3), Decimal(1), None),
            ("web", None, 100, 8, Decimal(4), Decimal(1), 9),
        ],
        SALES,
    )
    returns = spark.createDataFrame(
        [("web", 1, Decimal(2), 1), ("store", 3, None, 2)], RETURNS
    )
    return ledger(sales, returns)


@pytest.mark.parametrize("dates_fit", [True, False])
def test_undated_store_sales_leave_but_returns_stay(spark, dates_fit):
    dates = spark.createDataFrame([(100,), (101,)], "d_date_sk int")
    kept = drop_undated_store_sales(book(spark), dates, dates_fit)
    totals = {r["customer_sk"]: r for r in agg.analytics_totals(kept).collect()}
    assert set(totals) == {1, 2, 3}
    assert totals[1]["store_transaction_count"] == 1
    assert totals[1]["store_sales_amount"] is None
    assert totals[1]["catalog_sales_amount"] == 10
    assert totals[1]["has_catalog_sales"] == 0  # a sale without an item
    assert totals[2]["has_web_sales"] == 1
    assert totals[1]["web_returned"] == 2
    assert (totals[3]["store_returned"], totals[3]["store_return_rows"]) == (None, 1)


def test_profile_totals(spark):
    totals = {r["customer_sk"]: r for r in agg.profile_totals(book(spark)).collect()}
    assert set(totals) == {1, 2, 3}
    one = totals[1]
    assert one["total_transactions"] == 4
    assert one["total_sales_amount"] == 21
    assert one["avg_transaction_value"] == 7.0  # three priced sales, not four
    assert one["distinct_purchase_days"] == 2
    assert one["total_items_purchased"] == 10
    assert (one["store_transactions"], one["store_sales"]) == (3, 11)
    assert totals[2]["total_items_purchased"] is None
    only_returns = totals[3]
    assert only_returns["total_transactions"] == 0
    assert only_returns["total_sales_amount"] is None
    assert only_returns["avg_transaction_value"] is None
    assert (only_returns["total_returns"], only_returns["total_return_quantity"]) == (1, 2)


def test_store_totals_need_a_known_customer_and_date(spark):
    sales = spark.createDataFrame(
        [(1, 100, 1, Decimal(2), Decimal(1), 1), (1, None, 1, Decimal(2), Decimal(1), 1),
         (None, 100, 1, Decimal(2), Decimal(1), 1), (9, 100, 1, Decimal(2), Decimal(1), 1)],
        "ss_customer_sk int, ss_sold_date_sk int, ss_item_sk int, ss_ext_sales_price decimal(7,2), "
        "ss_net_profit decimal(7,2), ss_quantity int",
    )
    customer = spark.createDataFrame([(1,), (2,)], "c_customer_sk int")
    dates = spark.createDataFrame([(100,), (100,)], "d_date_sk int")
    for fit in (True, False):
        rows = agg.store_totals(customer, "c_customer_sk", sales, STORE_SALES, dates, fit).collect()
        assert [(r["c_customer_sk"], r["store_transaction_count"]) for r in rows] == [(1, 1)]


def test_hot_customer(spark):
    """A third of the rows under one key, and as many without a customer."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 2, F.col("id"))
    sales = spark.range(0, 300_000, 1, 8).select(
        F.lit("web").alias("channel"),
        key.cast("int").alias("customer_sk"),
        (F.col("id") % 500).cast("int").alias("sale_date"),
        F.lit(1).alias("item_sk"),
        F.lit(2).cast("decimal(7,2)").alias("price"),
        F.lit(1).cast("decimal(7,2)").alias("profit"),
        F.lit(1).alias("quantity"),
    )
    returns = spark.createDataFrame([], RETURNS)
    totals = agg.profile_totals(ledger(sales, returns))
    assert totals.count() == 100_001
    hot = totals.where("customer_sk = 1").first()
    assert (hot["total_transactions"], hot["distinct_purchase_days"]) == (100_000, 500)
    assert hot["total_sales_amount"] == 200_000


def test_null_default_in_left_join(spark):
    customer = spark.createDataFrame([(1,), (2,)], "c_customer_sk int")
    sales = spark.createDataFrame(
        [(1, 5, Decimal(3), None, 2)],
        "ss_customer_sk int, ss_item_sk int, ss_ext_sales_price decimal(7,2), "
        "ss_net_profit decimal(7,2), ss_quantity int",
    )
    rows = agg.left_join_totals(customer, "c_customer_sk", sales, STORE_SALES).collect()
    assert {tuple(r) for r in rows} == {(1, money(3), money(0), 2), (2, money(0), money(0), 0)}
