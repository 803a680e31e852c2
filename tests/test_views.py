from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal as D

import pytest
from conftest import day
from pyspark.sql import functions as F

from tillmetrics.operators import calendar as cal
from tillmetrics.operators import quality
from tillmetrics.plans import findings, views
from tillmetrics.sources import schemas as S


@pytest.fixture(scope="module")
def star(spark, frame):
    def line(i, order, customer, product, date, quantity, revenue):
        return {
            "order_line_id": i,
            "order_id": order,
            "customer_id": customer,
            "product_id": product,
            "date_id": date,
            "quantity": quantity,
            "unit_price": 1,
            "discount": 0,
            "line_revenue": revenue,
        }

    customers = [
        (1, "guest", "Unknown", "Unknown", "2026-01-01"),
        (2, "b", "Spain", "Email", "2026-01-10"),
        (3, "c", "Spain", "Email", "2026-01-20"),
        (4, "d", "France", "Affiliate", "2026-02-01"),
        (5, "e", "France", "Email", "2026-02-02"),
    ]
    names = ("customer_id", "email", "region", "acquisition_channel", "signup_date")
    return {
        "dim_date": cal.calendar(cal.day_range(spark, day("2025-12-25"), day("2026-03-31"))),
        "dim_customers": frame(
            S.DIM_CUSTOMERS,
            [{**dict(zip(names, c)), "signup_date": day(c[4])} for c in customers],
        ),
        "dim_products": frame(
            S.DIM_PRODUCTS,
            [
                {"product_id": 1, "category": "Books", "product_name": "Novel"},
                {"product_id": 2, "category": "Beauty", "product_name": "Soap"},
            ],
        ),
        "fact_orders": frame(
            S.FACT_ORDERS,
            [
                line(1, 1, 2, 1, 20260105, 2, 10),
                line(2, 1, 2, 2, 20260105, 1, 20.01),
                line(3, 2, 3, 1, 20260106, 1, 30),
                line(4, 3, 2, 2, 20260106, 3, 40),
                line(5, 4, 1, 1, 20260112, 1, 50),
                line(6, 5, 4, 1, 20260112, 1, 0.10),
                line(7, 9, 4, 1, 20270101, 1, 999),  # no such day in the calendar
            ],
        ),
        "fact_returns": frame(
            S.FACT_RETURNS,
            [
                {"return_id": 1, "order_line_id": 1, "date_id": 20260112, "refund_amount": 10},
                {"return_id": 2, "order_line_id": 1, "date_id": 20260113, "refund_amount": 2},
                {"return_id": 3, "order_line_id": 4, "date_id": 20260112, "refund_amount": 45},
                {"return_id": 4, "order_line_id": 99, "date_id": 20260112, "refund_amount": 1},
            ],
        ),
        "fact_marketing_spend": frame(
            S.FACT_MARKETING_SPEND,
            [
                {"spend_id": 1, "date_id": 20260101, "channel": "Email", "spend": 100},
                {"spend_id": 2, "date_id": 20260131, "channel": "Email", "spend": 1},
                {"spend_id": 3, "date_id": 20260201, "channel": "Paid Search", "spend": 7},
            ],
        ),
    }


def test_daily_revenue(star, rows):
    found = views.daily_revenue(star["fact_orders"], star["dim_date"], star["fact_returns"])
    assert rows(found) == [
        (day("2026-01-05"), "Monday", False, 1, 3, D("30.01"), D("0.00"), D("30.01"), D("30.01")),
        (day("2026-01-06"), "Tuesday", False, 2, 4, D("70.00"), D("0.00"), D("70.00"), D("35.00")),
        # refunds count on the day they came back; 2026-01-13 sold nothing and is not listed
        (day("2026-01-12"), "Monday", False, 2, 2, D("50.10"), D("56.00"), D("-5.90"), D("25.05")),
    ]


def test_category_weekly(star, rows):
    found = views.category_weekly(star["fact_orders"], star["dim_date"], star["dim_products"])
    assert rows(found) == [
        (day("2026-01-05"), "Beauty", D("60.01"), D("60.00")),
        (day("2026-01-05"), "Books", D("40.00"), D("40.00")),
        (day("2026-01-12"), "Books", D("50.10"), D("100.00")),
    ]


def test_region_summary(star, rows):
    found = views.region_summary(star["fact_orders"], star["dim_customers"])
    assert rows(found) == [
        ("France", 1, 2, D("999.10"), D("499.55")),
        ("Spain", 2, 3, D("100.01"), D("33.34")),
    ]


def test_region_summary_multiplies_no_rows(star, rows):
    # An order of two customers of a region counts once; customers repeated in the dimension, too.
    orders, customers = star["fact_orders"], star["dim_customers"]
    spain = customers.filter("region = 'Spain'")
    first = spain.agg({"customer_id": "min"}).first()[0]
    shared = orders.unionByName(
        orders.join(spain.select("customer_id"), "customer_id", "left_semi")
        .select(*[F.lit(first).cast("bigint").alias(c) if c == "customer_id" else c for c in orders.columns])
    )
    found = views.region_summary(shared, customers)
    (row,) = [r for r in found.collect() if r["region"] == "Spain"]
    assert (row["customers"], row["orders"], row["revenue"]) == (2, 3, D("200.02"))
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()


def test_repeat_rate_counts_customers_without_orders(star, rows):
    found = views.customer_repeat_rate(star["fact_orders"], star["dim_customers"])
    assert rows(found) == [
        (day("2026-01-01"), 2, 1, D("50.00")),
        (day("2026-02-01"), 2, 1, D("50.00")),
    ]


def test_marketing_cost(star, rows):
    found = views.marketing_cost(
        star["fact_marketing_spend"], star["dim_date"], star["dim_customers"]
    )
    assert rows(found) == [
        (day("2026-01-01"), "Email", D("101.00"), 2, D("50.50")),
        (day("2026-02-01"), "Paid Search", D("7.00"), 0, None),
    ]


def test_returns(star, rows):
    orders, returns = star["fact_orders"], star["fact_returns"]
    assert rows(views.return_summary(orders, star["dim_products"], returns)) == [
        ("Beauty", 2, 1, D("50.00"), D("45.00")),
        ("Books", 5, 1, D("20.00"), D("12.00")),
    ]
    weekly = views.return_weekly(orders, star["dim_date"], star["dim_products"], returns)
    assert rows(weekly) == [
        (day("2026-01-05"), "Beauty", 2, 1, D("50.00")),
        (day("2026-01-05"), "Books", 2, 1, D("50.00")),
        (day("2026-01-12"), "Books", 2, 0, D("0.00")),
    ]


def test_returns_agree_with_the_plain_join_on_repeated_line_ids(spark, star, rows):
    """COUNT(DISTINCT) over the join, as the view is defined, even where the key is broken."""
    orders = star["fact_orders"].unionAll(star["fact_orders"].filter("order_line_id <= 3"))
    views.publish_views({**star, "fact_orders": orders})
    defined = spark.sql(
        """select category, count(distinct f.order_line_id), count(distinct r.order_line_id),
               coalesce(sum(refund_amount), 0)
           from fact_orders f join dim_products p on f.product_id = p.product_id
           left join fact_returns r on r.order_line_id = f.order_line_id group by category"""
    )
    found = spark.table("vw_return_summary").drop("return_rate_pct")
    assert rows(found) == rows(defined)


def test_week_start_of_lines_is_shared_by_the_week(star, rows):
    found = views.order_weeks(star["fact_orders"], star["dim_date"], star["dim_products"])
    assert rows(found.filter("order_line_id in (2, 3)"), "order_line_id", "week_start") == [
        (2, day("2026-01-05")),
        (3, day("2026-01-05")),
    ]


def test_calendar_year_splits_the_new_year_week(spark, frame, star, rows):
    base = {"order_id": 1, "customer_id": 2, "product_id": 1, "quantity": 1, "line_revenue": 1}
    lines = frame(
        S.FACT_ORDERS,
        [
            {"order_line_id": i, "date_id": d, **base}
            for i, d in enumerate((20251230, 20260101), start=1)
        ],
    )

    def weeks(iso):
        weekly = views.category_week_revenue(lines, star["dim_date"], star["dim_products"], iso)
        return rows(weekly, "year", "week_of_year")

    assert weeks(iso=False) == [(2025, 1), (2026, 1)]
    assert weeks(iso=True) == [(2026, 1)]


def test_latest_days_and_costs(star, rows):
    daily = views.daily_revenue(star["fact_orders"], star["dim_date"], star["fact_returns"])
    latest = [r["date"] for r in views.latest_days(daily, 2).collect()]
    assert latest == [day("2026-01-12"), day("2026-01-06")]
    costs = views.marketing_cost(
        star["fact_marketing_spend"], star["dim_date"], star["dim_customers"]
    )
    assert rows(views.latest_costs(costs, "Paid Search")) == []
    assert rows(views.latest_costs(costs, "Email")) == [(day("2026-01-01"), D("50.50"))]


def test_return_decisions_are_made_once(spark, star, rows):
    def due(first, last):
        days = cal.day_range(spark, day(first), day(last))
        return views.return_decision_cohort(
            star["fact_orders"], star["dim_date"], star["dim_products"], days, 25
        )

    assert rows(due("2026-01-30", "2026-01-30"), "order_line_id") == [(1,), (2,)]
    assert rows(due("2026-01-29", "2026-02-28"), "order_line_id") == [(i,) for i in range(1, 7)]
    assert due("2026-02-01", "2026-02-05").count() == 0


def test_published_views_can_be_queried_and_republished(spark, star):
    for _ in range(2):
        names = views.publish_views(star)
    assert len([n for n in names if n.startswith("vw_")]) == 7
    assert spark.sql("select sum(orders) from vw_daily_revenue").first()[0] == 5


def test_invariants(star):
    daily = views.daily_revenue(star["fact_orders"], star["dim_date"], star["fact_returns"])
    assert tuple(quality.net_revenue_mismatches(daily).first()) == (3, 0)
    shares = views.category_week_shares(star["fact_orders"], star["dim_date"], star["dim_products"])
    assert tuple(quality.week_share_mismatches(shares).first()) == (2, 0)
    summary = views.return_summary(star["fact_orders"], star["dim_products"], star["fact_returns"])
    assert tuple(quality.rates_out_of_bounds(summary).first()) == (2, 0)
    regions = views.region_summary(star["fact_orders"], star["dim_customers"])
    assert tuple(quality.unknown_regions(regions).first()) == (2, 0)


def test_violations_are_counted(star, rows):
    broken = dict(rows(quality.reference_violations(star).filter("violations > 0"), "key", "violations"))
    assert broken == {"date_id": 1, "order_line_id": 1}
    plan = quality.reference_violations(star)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    nowhere = star["fact_orders"].withColumn("product_id", F.lit(None).cast("long"))
    found = quality.reference_violations({**star, "fact_orders": nowhere})
    lost = found.filter("relation = 'fact_orders' and key = 'product_id'").first()["violations"]
    assert lost == star["fact_orders"].count() and found.count() == 6
    twice = {**star, "dim_products": star["dim_products"].unionAll(star["dim_products"])}
    found = quality.key_violations(twice).filter("violations > 0")
    assert rows(found) == [("dim_products", "product_id", 2)]
    nulls = quality.null_violations(star).filter("relation = 'fact_returns' and nulls > 0")
    assert rows(nulls) == [("fact_returns", "reason", 4)]


def test_days_without_calendar(spark, star):
    days = cal.day_range(spark, day("2026-03-30"), day("2026-04-02"))
    assert quality.days_without_calendar(days, star["dim_date"]).first()[0] == 2


# --- findings ---------------------------------------------------------------------------


def test_decline_hidden_in_a_flat_total(spark, frame, star, rows):
    """Books shrink, Beauty grows, the total stays; a category gone by the last week counts 0."""
    weekly = {20260105: (80, 20), 20260112: (50, 50), 20260119: (0, 100)}
    lines = [
        {"order_line_id": d * 10 + p, "product_id": p, "date_id": d, "line_revenue": v}
        for d, values in weekly.items()
        for p, v in enumerate(values, start=1)
        if v
    ]
    found = findings.category_decline(
        frame(S.FACT_ORDERS, lines), star["dim_date"], star["dim_products"], day("2026-01-25"), 70
    )
    first, last = day("2026-01-05"), day("2026-01-19")
    hundred = D("100.00")
    assert rows(found) == [
        ("Beauty", first, last, D("20.00"), hundred, D("20.00"), hundred, hundred, hundred),
        ("Books", first, last, D("80.00"), D("0.00"), D("80.00"), D("0.00"), hundred, hundred),
    ]


def test_decline_reads_the_days_of_its_weeks_alone(spark, frame, star, rows, tmp_path):
    """Around New Year, where a week number comes twice in a year, and a long way from it."""
    calendar = cal.calendar(cal.day_range(spark, day("2024-12-20"), day("2026-02-10")))
    dates = [r["date_id"] for r in calendar.select("date_id").collect()]
    lines = [
        {"order_line_id": d * 10 + p, "product_id": p, "date_id": d, "line_revenue": (d * p) % 97 + 1}
        for d in dates for p in (1, 2)
    ]
    frame(S.FACT_ORDERS, lines).write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")

    def found(end, window):
        return findings.category_decline(orders, calendar, star["dim_products"], day(end), window)

    weekly = views.category_week_shares(orders, calendar, star["dim_products"])
    weekly = [r.asDict() for r in weekly.collect()]
    for end, window in (("2026-01-25", 40), ("2025-12-30", 21), ("2025-01-12", 20), ("2025-08-20", 0)):
        since = day(end) - dt.timedelta(days=window)
        first = {}
        for r in weekly:
            key = r["year"], r["week_of_year"]
            first[key] = min(r["week_start"], first.get(key, r["week_start"]))
        held = sorted((w, k) for k, w in first.items() if since <= w <= day(end))
        edges = [held[0][1], held[-1][1]] if held else []
        want = {
            (r["category"], i): r["revenue"]
            for r in weekly for i, k in enumerate(edges) if (r["year"], r["week_of_year"]) == k
        }
        got = found(end, window).collect()
        assert {(r["category"], i): v for r in got for i, v in enumerate((r.first_revenue, r.last_revenue))} == want
    plan = found("2025-08-20", 10)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*In\(date_id, \[20250804,", plan)


def costs(spark, channel, *values):
    rows = [(day(f"2026-0{m}-01"), channel, D(v) if v else None) for m, v in enumerate(values, 1)]
    return spark.createDataFrame(rows, "month date, channel string, cac decimal(12,2)")


def test_cost_rise(spark, rows):
    # seven months, one without a cost: the recent five start at the third
    up = costs(spark, "up", "900", None, "100", "110", "120", "300", "5")
    few = costs(spark, "few", "1", "2", "3")
    down = costs(spark, "down", "9", "8", "7", "6")
    found = findings.cost_rise(up.unionAll(few).unionAll(down))
    assert rows(found) == [
        ("down", day("2026-01-01"), D("9.00"), day("2026-03-01"), D("7.00"), False),
        ("up", day("2026-03-01"), D("100.00"), day("2026-06-01"), D("300.00"), True),
    ]


def test_return_peak(spark, rows):
    weekly = spark.createDataFrame(
        [("a", D("3.00")), ("a", D("13.30")), ("b", D("10.00"))],
        "category string, return_rate_pct decimal(10,2)",
    )
    assert rows(findings.return_peak(weekly, 10)) == [
        ("a", D("13.30"), True),
        ("b", D("10.00"), False),
    ]


def test_return_window(star, rows):
    found = findings.return_window(
        star["fact_orders"],
        star["dim_products"],
        star["fact_returns"],
        day("2026-01-05"),
        day("2026-01-06"),
    )
    assert rows(found) == [
        ("Beauty", 2, 1, D("50.00"), D("50.00")),
        ("Books", 2, 1, D("50.00"), D("50.00")),
    ]


def test_calendar_effect_counts_days_without_orders(frame, star, rows):
    lines = frame(
        S.FACT_ORDERS,
        [
            {"order_line_id": 1, "order_id": 1, "date_id": 20251227},  # Saturday, holidays
            {"order_line_id": 2, "order_id": 2, "date_id": 20251227},
            {"order_line_id": 3, "order_id": 2, "date_id": 20251227},
            {"order_line_id": 4, "order_id": 3, "date_id": 20260105},
        ],
    )
    found = findings.calendar_effect(
        lines, star["dim_date"], day("2025-12-27"), day("2026-01-05")
    )
    assert rows(found) == [
        ("holiday", False, 5, D("0.20")),
        ("holiday", True, 5, D("0.40")),
        ("weekend", False, 6, D("0.17")),
        ("weekend", True, 4, D("0.50")),
    ]
