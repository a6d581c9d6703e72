from decimal import Decimal

import pytest
from fixtures import bag, customers, dimensions, fact, facts, sellers, stores
from pyspark.sql import functions as F

from tallymart.operators.aggregates import attach_group_sum, monthly_cube, with_month
from tallymart.plans import marts
from tallymart.sources.dimensions import DuplicateKey


def incentives(spark, rows, **tables):
    mart = marts.sales_incentive(with_month(facts(spark, rows)), dimensions(spark, **tables))
    return bag(mart, "store_id", "sales_person_id", "sales_month", "total_sales", "incentive")


def test_tied_leaders_share_the_first_rank(spark):
    rows = [
        fact(1, 121, 1, "2024-03-01", "10.00"),
        fact(1, 121, 2, "2024-03-02", "10.00"),
        fact(1, 121, 3, "2024-03-03", "5.00"),
    ]
    assert incentives(spark, rows) == [
        (121, 1, "2024-03", Decimal("10.00"), Decimal("0.10")),
        (121, 2, "2024-03", Decimal("10.00"), Decimal("0.10")),
        (121, 3, "2024-03", Decimal("5.00"), Decimal("0.00")),
    ]
    monthly = marts.seller_monthly(with_month(facts(spark, rows)), dimensions(spark))
    assert bag(marts.rank_sellers(monthly), "sales_person_id", "rnk") == [(1, 1), (2, 1), (3, 3)]


def test_half_cents_round_up(spark):
    rows = [fact(1, 121, 1, "2024-03-01", "250.50")]
    assert incentives(spark, rows) == [(121, 1, "2024-03", Decimal("250.50"), Decimal("2.51"))]


def test_null_total_ranks_first_only_alone(spark):
    rows = [
        fact(1, 121, 1, "2024-03-01", None),
        fact(1, 122, 2, "2024-03-01", None),
        fact(1, 122, 3, "2024-03-01", "4.00"),
    ]
    assert incentives(spark, rows) == [
        (121, 1, "2024-03", None, None),
        (122, 2, "2024-03", None, Decimal("0.00")),
        (122, 3, "2024-03", Decimal("4.00"), Decimal("0.04")),
    ]


def test_null_name_part_empties_the_full_name(spark):
    team = sellers(spark, ids=(), extra=[(1, "Sam", None, 9, "N", "Road", "2000")])
    people = customers(spark, ids=(), extra=[(1, None, "Bell", "Town", "1000", "91")])
    found = dimensions(spark, customers=people, sellers=team)
    rows = with_month(facts(spark, [fact(1, 121, 1, "2024-03-01", "4.00")]))
    assert bag(marts.sales_incentive(rows, found), "full_name") == [(None,)]
    assert bag(marts.customer_monthly(rows, found), "full_name") == [(None,)]


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_unknown_and_null_keys_are_in_no_mart(spark, limit):
    good = fact(1, 121, 1, "2024-03-01", "4.00")
    bad = [
        fact(99, 121, 1, "2024-03-01", "4.00"),
        fact(1, 999, 1, "2024-03-01", "4.00"),
        fact(1, 121, 99, "2024-03-01", "4.00"),
        fact(None, 121, 1, "2024-03-01", "4.00"),
        fact(1, None, 1, "2024-03-01", "4.00"),
        fact(1, 121, None, "2024-03-01", "4.00"),
    ]
    found = dimensions(spark, broadcast_bytes=limit)
    sold = facts(spark, [good, *bad])
    rows = with_month(sold)
    assert bag(marts.customer_monthly(rows, found), "customer_id", "total_sales") == [(1, Decimal("4.00"))]
    assert bag(marts.sales_incentive(rows, found), "store_id", "total_sales") == [(121, Decimal("4.00"))]
    assert bag(marts.customer_rows(sold, found), "customer_id") == [(1,)]
    assert bag(marts.sales_rows(sold, found), "store_id") == [(121,)]
    assert bag(marts.daily_purchases(sold, found), "customer_id", "purchases") == [(1, 1)]
    assert bag(marts.customers_by_month(rows, found), "customer_id") == [(1,)]
    assert bag(marts.sellers_by_month(rows, found), "sales_person_id") == [(1,)]


def test_missing_dates_form_their_own_month(spark):
    rows = [fact(1, 121, 1, None, "4.00"), fact(1, 121, 2, None, "3.00"), fact(1, 121, 1, "2024-03-01", "2.00")]
    assert incentives(spark, rows) == [
        (121, 1, "2024-03", Decimal("2.00"), Decimal("0.02")),
        (121, 1, None, Decimal("4.00"), Decimal("0.04")),
        (121, 2, None, Decimal("3.00"), Decimal("0.00")),
    ]


def test_copies_count_every_time(spark):
    rows = with_month(facts(spark, [fact(1, 121, 1, "2024-03-01", "4.00")] * 2))
    assert bag(marts.customer_monthly(rows, dimensions(spark)), "total_sales") == [(Decimal("8.00"),)]


def test_repeated_dimension_key_is_refused(spark):
    twice = customers(spark, ids=(1, 1))
    with pytest.raises(DuplicateKey, match="customer_id 1"):
        dimensions(spark, customers=twice)
    with pytest.raises(DuplicateKey, match="store_id"):
        dimensions(spark, stores=stores(spark, ids=(121, 121)))


def test_seller_in_two_stores_is_ranked_in_each(spark):
    rows = [fact(1, 121, 1, "2024-03-01", "4.00"), fact(1, 122, 1, "2024-03-01", "9.00")]
    assert incentives(spark, rows) == [
        (121, 1, "2024-03", Decimal("4.00"), Decimal("0.04")),
        (122, 1, "2024-03", Decimal("9.00"), Decimal("0.09")),
    ]


def test_marts_agree_with_the_facts_and_with_the_cube(spark):
    rows = [
        fact(1 + i % 3, 121 + i % 2, 1 + i % 4, f"2024-0{1 + i % 5}-10", str(i)) for i in range(60)
    ]
    sold = facts(spark, rows)
    found = dimensions(spark)
    total = Decimal(sum(range(60)))
    for mart in (marts.customer_monthly(with_month(sold), found), marts.sales_incentive(with_month(sold), found)):
        assert mart.agg(F.sum("total_sales")).first()[0] == total
    assert bag(marts.sales_incentive(monthly_cube(sold), found)) == bag(
        marts.sales_incentive(with_month(sold), found)
    )
    assert bag(marts.customer_monthly(monthly_cube(sold), found)) == bag(
        marts.customer_monthly(with_month(sold), found)
    )


def test_group_sum_on_rows_equals_the_aggregate(spark):
    days = ["2024-01-10", "2024-02-10", None]
    rows = [fact(i % 5 % 3 or None, 121, 1, days[i % 3], str(i)) for i in range(40)]
    sold = with_month(facts(spark, rows)).select("customer_id", "sales_month", "total_cost")
    keys = ["customer_id", "sales_month"]
    attached = attach_group_sum(sold, keys, "total")
    assert attached.count() == 40
    grouped = sold.groupBy(*keys).agg(F.sum("total_cost").cast("decimal(18,2)").alias("total"))
    assert bag(attached.select(*keys, "total").distinct()) == bag(grouped)
