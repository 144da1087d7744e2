"""Run-time configuration: where the layers live and which limits the reports use."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from bazaarlake import fixed_values as fv


@dataclass(frozen=True)
class ReportParams:
    """Every window and threshold of the report library, with its default."""

    calendar_from: date = fv.CALENDAR_FROM
    calendar_to: date = fv.CALENDAR_TO
    months_from: date = fv.MONTHS_FROM
    months_to: date = fv.MONTHS_TO
    yoy_until: date = fv.YEAR_ON_YEAR_UNTIL
    cohorts_from: date = fv.COHORTS_FROM
    cohorts_to: date = fv.COHORTS_TO
    cohort_months: int = fv.COHORT_MONTHS
    min_category_orders: int = fv.MIN_CATEGORY_ORDERS
    min_state_orders: int = fv.MIN_STATE_ORDERS
    min_category_items: int = fv.MIN_CATEGORY_ITEMS
    min_seller_orders: int = fv.MIN_SELLER_ORDERS
    min_at_risk_orders: int = fv.MIN_AT_RISK_ORDERS
    at_risk_late_pct: float = fv.AT_RISK_LATE_PCT
    at_risk_review: float = fv.AT_RISK_REVIEW
    top_days: int = fv.TOP_DAYS
    top_categories: int = fv.TOP_CATEGORIES
    lowest_rated_categories: int = fv.LOWEST_RATED_CATEGORIES
    top_freight_categories: int = fv.TOP_FREIGHT_CATEGORIES
    top_sellers: int = fv.TOP_SELLERS
    seller_tiles: int = fv.SELLER_TILES
    pareto_cutoff_pct: float | None = None
    # False keeps the published scoring, where tile 1 holds the latest buyers;
    # True scores the latest buyers highest.
    recency_desc: bool = False


@dataclass(frozen=True)
class WarehouseConfig:
    """Locations of the raw files and of the three layers.

    ``source_root`` holds one file or folder per source, ``warehouse_root`` receives
    ``bronze/``, ``silver/`` and ``gold/``. Both are URIs every executor can reach.
    """

    source_root: str
    warehouse_root: str
    files: dict[str, str] = field(default_factory=dict)
    raw_quotes: bool = False
    # A file's load fails if it has more bad lines than both allow.
    max_errors: int = fv.MAX_LOAD_ERRORS
    max_error_share: float = 0.0
    parallel_loads: int = 3
    params: ReportParams = ReportParams()

    def source_path(self, name: str) -> str:
        return f"{self.source_root}/{self.files.get(name, name + '.csv')}"

    def table_path(self, layer: str, name: str) -> str:
        return f"{self.warehouse_root}/{layer}/{name}"
