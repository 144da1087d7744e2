"""The report library: each report is a function of a warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from bazaarlake.plans.questions import (
    customers,
    delivery,
    logistics,
    payments,
    products,
    reviews,
    sales,
    sellers,
)
from bazaarlake.plans.warehouse import Warehouse

QUESTIONS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "q01_monthly_sales_growth": sales.monthly_sales_growth,
    "q02_yoy_revenue": sales.yoy_revenue,
    "q03_status_funnel": sales.status_funnel,
    "q04a_weekday_profile": sales.weekday_profile,
    "q04b_hour_profile": sales.hour_profile,
    "q05_top_sale_days": sales.top_sale_days,
    "q06_category_pareto": products.category_pareto,
    "q07_category_scorecard": products.category_scorecard,
    "q08_lowest_rated_categories": products.lowest_rated_categories,
    "q09_order_value_bands": products.order_value_bands,
    "q10_delivery_kpis": delivery.delivery_kpis,
    "q11_state_late_rate": delivery.state_late_rate,
    "q12_review_by_delay": delivery.review_by_delay,
    "q13_state_promise_buffer": delivery.state_promise_buffer,
    "q14_late_trend": delivery.late_trend,
    "q15_route_type": delivery.route_type,
    "q16_state_freight_burden": logistics.state_freight_burden,
    "q17_category_freight_burden": logistics.category_freight_burden,
    "q18_seller_scorecard": sellers.seller_scorecard,
    "q19_seller_deciles": sellers.seller_deciles,
    "q20_sellers_at_risk": sellers.sellers_at_risk,
    "q21_supply_demand": sellers.supply_demand,
    "q22_repeat_rate": customers.repeat_rate,
    "q23_rfm_segments": customers.rfm_segments,
    "q24_cohort_retention": customers.retention,
    "q25_payment_mix": payments.payment_mix,
    "q26_installments_by_value": payments.installments_by_value,
    "q27_multi_seller": reviews.multi_seller,
    "q28_review_distribution": reviews.review_distribution,
}
