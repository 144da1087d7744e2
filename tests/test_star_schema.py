from __future__ import annotations

from dataclasses import replace
from datetime import date
from decimal import Decimal

from conftest import ts

from bazaarlake.config import ReportParams
from bazaarlake.plans.calendar import calendar
from bazaarlake.plans.questions import QUESTIONS
from bazaarlake.plans.quality import RULES, quality_report


def order(n, status="delivered", bought="2018-01-01 23:59:00", delivered=None, promised=None):
    return (f"o{n}", f"c{n}", status, ts(bought), None, None, ts(delivered), ts(promised))


def item(n, seq=1, price="10.00", freight="1.00", product="p1", seller="s1"):
    return (f"o{n}", seq, product, seller, None, Decimal(price), Decimal(freight))


def customer(n, person=None, state="SP", zip_code="01"):
    return (f"c{n}", person or f"u{n}", zip_code, "city", state)


def by_order(df):
    return {r["order_id"]: r for r in df.collect()}


def test_calendar_bounds_and_names(spark):
    days = calendar(spark, date(2016, 9, 1), date(2018, 12, 31)).collect()
    assert len(days) == 852
    day = next(d for d in days if d["date_key"] == 20180315)
    assert (day["month_name"], day["day_name"], day["day_of_week"]) == ("March", "Thursday", 5)
    assert (day["quarter"], day["is_weekend"], day["calendar_date"]) == (1, 0, date(2018, 3, 15))
    assert sum(d["is_weekend"] for d in days) == sum(d["day_of_week"] in (1, 7) for d in days)


def test_order_flags(tiny):
    wh = tiny(
        orders=[
            order(1, delivered="2018-01-02 00:01:00", promised="2018-01-02 00:00:00"),
            order(2, delivered="2018-01-03 00:00:00", promised="2018-01-02 23:00:00"),
            order(3, status="shipped", delivered="2018-01-09 00:00:00"),
            order(4, status=None),
            order(5, status="canceled"),
            order(6, status="unavailable"),
            order(7),
            order(8, delivered="2018-01-05 00:00:00"),
        ],
        order_items=[item(n) for n in (1, 2, 3, 4, 5, 6, 8)] + [item(99)],
    )
    facts = by_order(wh.gold("fact_orders"))
    assert len(facts) == 8
    flags = "is_delivered delivery_days delay_days is_late is_valid_sale".split()
    assert {k: tuple(r[f] for f in flags) for k, r in facts.items()} == {
        "o1": (1, 1, 0, 0, 1),  # delivered at 23:00 of the promised day is not late
        "o2": (1, 2, 1, 1, 1),
        "o3": (0, None, None, 0, 1),  # a date without the status does not count
        "o4": (0, None, None, 0, 1),  # unknown status with items is a valid sale
        "o5": (0, None, None, 0, 0),
        "o6": (0, None, None, 0, 0),
        "o7": (0, None, None, 0, 0),  # no items
        "o8": (1, 4, None, 0, 1),  # no promise: no delay, not late
    }
    assert set(by_order(wh.fact_orders(valid_only=True, customer=False))) == {
        "o1", "o2", "o3", "o4", "o8",
    }


def test_line_facts_are_not_gated_by_status_and_drop_orphans(tiny):
    wh = tiny(
        orders=[order(1, status="shipped", delivered="2018-01-03 00:00:00",
                      promised="2018-01-05 00:00:00")],
        order_items=[item(1), item(1, 2, seller="nobody"), item(99)],
        customers=[customer(1)],
        products=[("p1", "x", *[None] * 7)],
        sellers=[("s1", "01", "city", "SP")],
    )
    lines = {r["order_item_id"]: r for r in wh.gold("fact_order_items").collect()}
    assert set(lines) == {"1", "2"}
    assert (lines["1"]["delivery_days"], lines["1"]["delivery_delay_days"]) == (2, -2)
    assert (lines["1"]["customer_key"], lines["1"]["product_key"]) == (1, 1)
    assert lines["1"]["purchase_date_key"] == 20180101
    assert (lines["1"]["seller_key"], lines["2"]["seller_key"]) == (1, None)


def test_dates_outside_the_calendar_have_no_key(tiny):
    wh = tiny(
        orders=[order(1, bought="2030-01-01 00:00:00")],
        order_reviews=[("r1", "o1", 5, None, None, ts("2030-01-02 00:00:00"),
                        ts("2030-01-04 01:00:00"))],
    )
    review = wh.gold("fact_reviews").first()
    assert (review["purchase_date_key"], review["customer_key"]) == (None, None)
    assert review["review_response_days"] == 2


def test_summaries_do_not_multiply(tiny):
    review = ("r", "o1", 1, None, None, None, None)
    wh = tiny(
        orders=[order(1)],
        order_items=[item(1), item(1, 2, seller="s2")],
        order_payments=[("o1", n, kind, n, Decimal("5.00")) for n, kind in
                        ((1, "boleto"), (2, "voucher"), (3, "voucher"))],
        order_reviews=[review, (*review[:2], 4, *review[3:])],
    )
    row = wh.gold("fact_orders").first()
    assert (row["item_count"], row["seller_count"], row["items_value"]) == (2, 2, Decimal("20.00"))
    assert (row["payment_value"], row["max_installments"], row["payment_type_count"]) == (15, 3, 2)
    assert row["review_score"] == Decimal("2.5")


def test_dimensions_flag_missing_points(tiny):
    wh = tiny(
        customers=[customer(2, zip_code="99"), customer(1)],
        geolocation=[("01", Decimal("-10"), Decimal("-50"), "c", "s")],
    )
    dims = [tuple(r) for r in wh.gold("dim_customers")
            .select("customer_key", "customer_id", "has_geolocation")
            .orderBy("customer_key").collect()]
    assert dims == [(1, "c1", 1), (2, "c2", 0)]


# -- reports on hand-made rows -----------------------------------------------------------


def report(wh, name):
    return [r.asDict() for r in QUESTIONS[name](wh).collect()]


def test_half_star_orders_and_missing_delay(tiny):
    delivered = dict(delivered="2018-01-03 00:00:00")
    reviews = [("r1", "o1", 1, None, None, None, None), ("r1", "o1", 4, None, None, None, None),
               ("r2", "o2", 2, None, None, None, None)]
    wh = tiny(
        orders=[order(1, **delivered), order(2, **delivered)],
        order_items=[item(1), item(2)],
        order_reviews=reviews,
    )
    assert report(wh, "q12_review_by_delay") == [
        {"delay_bucket": "6. Late 15+ days", "orders": 2, "avg_review": 2.25,
         "pct_1_or_2_star": 50.0}
    ]


def test_null_status_counts_as_sale_but_not_in_status_filters(tiny):
    wh = tiny(
        orders=[order(1, status=None), order(2)],
        order_items=[item(1), item(2)],
        products=[("p1", "x", *[None] * 7)],
    )
    assert report(wh, "q06_category_pareto")[0]["orders"] == 1
    assert report(wh, "q07_category_scorecard")[0]["orders"] == 2


def test_state_on_one_side_only(tiny):
    wh = tiny(
        customers=[customer(1, state="SP")],
        sellers=[("s1", "01", "c", "SP"), ("s2", "01", "c", "RJ")],
    )
    assert {r["state"]: (r["sellers"], r["customers"], r["demand_share_pct"],
                         r["supply_share_pct"]) for r in report(wh, "q21_supply_demand")} == {
        "SP": (1, 1, 100.0, 50.0),
        "RJ": (1, None, 0.0, 50.0),
    }


def test_equal_revenue_shares_a_rank_and_ties_are_cut_by_id(tiny):
    params = replace(ReportParams(), min_seller_orders=1, top_sellers=2)
    wh = tiny(
        params,
        orders=[order(n) for n in range(1, 5)],
        order_items=[item(n, seller=s) for n, s in ((1, "s3"), (2, "s1"), (3, "s2"))]
        + [item(4, seller="s4", price="99.00")],
        sellers=[(s, "01", "c", "SP") for s in ("s1", "s2", "s3", "s4")],
    )
    got = [(r["revenue_rank"], r["seller_id"]) for r in report(wh, "q18_seller_scorecard")]
    assert got == [(1, "s4"), (2, "s1")]


def test_cohorts(tiny):
    bought = {1: "2017-01-31", 2: "2017-02-01", 3: "2017-02-20", 4: "2017-01-05", 5: "2017-09-01"}
    people = {1: "a", 2: "a", 3: "a", 4: "b", 5: "b"}
    wh = tiny(
        orders=[order(n, bought=f"{d} 10:00:00") for n, d in bought.items()] + [order(9)],
        order_items=[item(n) for n in (*bought, 9)],
        customers=[customer(n, person=p) for n, p in people.items()],
    )
    got = [tuple(r.values()) for r in report(wh, "q24_cohort_retention")]
    # Months beyond the sixth drop; an order without a customer belongs to no cohort.
    assert got == [(date(2017, 1, 1), 0, 2, 100.0), (date(2017, 1, 1), 1, 1, 50.0)]


def test_growth_compares_months_present(tiny):
    bought = {1: "2017-01-10", 2: "2017-03-10", 3: "2018-03-10", 4: "2019-01-01"}
    wh = tiny(
        orders=[order(n, bought=f"{d} 00:00:00") for n, d in bought.items()],
        order_items=[item(1), item(2, price="15.00"), item(3, price="30.00"), item(4)],
    )
    months = report(wh, "q01_monthly_sales_growth")
    assert [m["mom_growth_pct"] for m in months] == [None, 50.0, 100.0]
    assert [(m["purchase_month"], m["yoy_growth_pct"]) for m in report(wh, "q02_yoy_revenue")] == [
        (date(2018, 3, 1), 100.0)
    ]


def test_pareto_cutoff_keeps_the_group_that_reaches_it(tiny):
    params = replace(ReportParams(), pareto_cutoff_pct=80.0)
    wh = tiny(
        params,
        orders=[order(1)],
        order_items=[item(1, 1, "60.00", product="p1"), item(1, 2, "30.00", product="p2"),
                     item(1, 3, "10.00", product="p3")],
        products=[(f"p{n}", f"cat{n}", *[None] * 7) for n in (1, 2, 3)],
    )
    got = [(r["category"], r["cumulative_pct"]) for r in report(wh, "q06_category_pareto")]
    assert got == [("cat1", 60.0), ("cat2", 90.0)]


def test_quality_rules_on_empty_tables(tiny):
    wh = tiny()
    for check in RULES:
        assert all(r["failing_rows"] == 0 for r in check(wh).collect()), check.__name__
    assert sorted(r["rule_name"] for r in quality_report(wh).collect()) == [
        "delivered_without_date", "duplicate_sample", "missing_category", "missing_geolocation",
        "missing_geolocation", "outside_calendar", "undefined_payment", "untranslated_category", "zero_weight",
    ]


def test_recency_can_be_turned(tiny):
    def segments(recency_desc):
        wh = tiny(
            replace(ReportParams(), recency_desc=recency_desc),
            orders=[order(n, bought=f"2018-01-{n:02d} 10:00:00") for n in range(1, 11)],
            order_items=[item(n, price=f"{n}.00") for n in range(1, 11)],
            customers=[customer(n) for n in range(1, 11)],
        )
        return {
            r["segment"]: (r["customers"], int(r["revenue"]))
            for r in report(wh, "q23_rfm_segments")
        }

    # As published the latest buyers hold the low scores, turned the high ones.
    assert segments(False) == {"One-Time - Lapsed": (4, 34), "One-Time - Recent": (6, 21)}
    assert segments(True) == {
        "One-Time - Lapsed": (4, 10),
        "High-Value New": (2, 19),
        "One-Time - Recent": (4, 26),
    }
