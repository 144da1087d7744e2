"""The warehouse: one object that hands out the tables of each layer.

Tables are lazy. A warehouse over raw tables derives everything on demand; one over
loaded layers reads what was written. Reports cannot tell the difference.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.config import ReportParams, WarehouseConfig
from bazaarlake.operators.hot_keys import HOT_ROWS, hot_keys
from bazaarlake.operators.ranking import add_surrogate_key
from bazaarlake.plans import dims, facts
from bazaarlake.plans.calendar import calendar
from bazaarlake.plans.silver import build_silver
from bazaarlake.session import drop_written, written
from bazaarlake.sources.csv_files import SOURCES, accepted
from bazaarlake.sources.schemas import SILVER
from bazaarlake.sources.tables import COMPRESSION, read_table

DIMENSIONS = ("dim_customers", "dim_products", "dim_sellers", "dim_date")
FACTS = ("fact_order_items", "fact_payments", "fact_reviews", "fact_orders")
GOLD_TABLES = DIMENSIONS + FACTS


class Warehouse:
    """Access to the raw, cleansed and star-schema tables.

    ``raw`` maps a raw table name to its DataFrame, ``silver`` likewise where that layer
    is loaded. ``gold`` holds the star tables that are loaded, by name; the others are
    derived.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Callable[[str], DataFrame],
        params: ReportParams = ReportParams(),
        silver: Callable[[str], DataFrame] | None = None,
        gold: Mapping[str, DataFrame] | None = None,
    ):
        self.spark = spark
        self.params = params
        self.raw = raw
        self._silver = silver
        self._gold = dict(gold or {})
        self._built: dict[str, DataFrame] = {}
        self._orders: DataFrame | None = None
        self._hot_orders: list[str] = []
        self._hot_products: list[str] | None = None

    @classmethod
    def from_tables(
        cls, spark: SparkSession, config: WarehouseConfig, gold: Sequence[str] = ()
    ) -> Warehouse:
        """Over loaded raw and cleansed layers, and the star tables named in ``gold``."""

        def raw(name: str) -> DataFrame:
            path = config.table_path("bronze", name)
            return accepted(read_table(spark, path, SOURCES[name].landing_schema))

        def silver(name: str) -> DataFrame:
            return read_table(spark, config.table_path("silver", name), SILVER[name])

        star = {name: read_table(spark, config.table_path("gold", name)) for name in gold}
        return cls(spark, raw, config.params, silver, star)

    # -- cleansed tables ---------------------------------------------------------------

    def silver(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = (
                self._silver(name) if self._silver else build_silver(name, self.raw)
            )
        return self._built[name]

    # -- star schema -------------------------------------------------------------------

    def share_orders(self) -> None:
        """Join the orders to their customers and write them once, for all facts to come.

        Worth a table where several facts are built, as in a load. So is a count of the
        orders and products with very many lines.
        """
        keyed = facts.orders_with_customers(self.silver("orders"), self.gold("dim_customers"))
        self._orders = written(keyed, "orders-with-customers", COMPRESSION)
        items, payments = self.silver("order_items"), self.silver("order_payments")
        self._hot_orders = sorted({*hot_keys(items, "order_id"), *hot_keys(payments, "order_id")})
        self._hot_products = hot_keys(items, "product_id")

    def drop_shared_orders(self) -> None:
        """Delete what ``share_orders`` wrote, once all facts are loaded."""
        if self._orders is not None:
            drop_written(self._orders)
        self._orders = None

    def _fact_headers(self) -> DataFrame:
        """Orders for the facts: the shared ones, else the cleansed table."""
        return self.silver("orders") if self._orders is None else self._orders

    def gold(self, name: str) -> DataFrame:
        """Star table ``name``, loaded or derived."""
        if name not in GOLD_TABLES:
            raise KeyError(name)
        return self._gold[name] if name in self._gold else getattr(self, f"_{name}")()

    def _dim_customers(self) -> DataFrame:
        return dims.dim_customers(self.silver("customers"), self.silver("geolocation"))

    def _dim_products(self) -> DataFrame:
        return dims.dim_products(self.silver("products"))

    def _dim_sellers(self) -> DataFrame:
        return dims.dim_sellers(self.silver("sellers"), self.silver("geolocation"))

    def _dim_date(self) -> DataFrame:
        return calendar(self.spark, self.params.calendar_from, self.params.calendar_to)

    def _keys(self, table: str, key: str, source_id: str) -> DataFrame:
        if f"dim_{table}" in self._gold:
            return self._gold[f"dim_{table}"].select(source_id, key)
        return add_surrogate_key(self.silver(table).select(source_id), key, source_id)

    # The keys are numbered and written once; all facts of this object share them.

    @cached_property
    def customer_keys(self) -> DataFrame:
        return self._keys("customers", "customer_key", "customer_id")

    @cached_property
    def product_keys(self) -> DataFrame:
        return self._keys("products", "product_key", "product_id")

    @cached_property
    def seller_keys(self) -> DataFrame:
        return self._keys("sellers", "seller_key", "seller_id")

    def fact_orders(self, valid_only: bool = False, customer: bool = True) -> DataFrame:
        """Order facts; see ``facts.fact_orders`` for what the two switches leave out."""
        if "fact_orders" in self._gold:
            loaded = self._gold["fact_orders"]
            return loaded.filter(F.col("is_valid_sale") == 1) if valid_only else loaded
        return facts.fact_orders(
            self._fact_headers(),
            self.silver("customers") if customer else None,
            self.silver("order_items"),
            self.silver("order_payments"),
            self.silver("order_reviews"),
            valid_only,
        )

    def _fact_orders(self) -> DataFrame:
        if self._orders is None:
            return self.fact_orders()
        return facts.fact_orders_together(
            self._orders,
            self.silver("customers"),
            self.silver("order_items"),
            self.silver("order_payments"),
            self.silver("order_reviews"),
            self._hot_orders,
        )

    def _fact_order_items(self) -> DataFrame:
        return facts.fact_order_items(
            self.silver("order_items"),
            self._fact_headers(),
            self.customer_keys,
            self.product_keys,
            self.seller_keys,
            self.gold("dim_date"),
            self._hot_products,
        )

    def _fact_payments(self) -> DataFrame:
        return facts.fact_payments(
            self.silver("order_payments"),
            self._fact_headers(),
            self.customer_keys,
            self.gold("dim_date"),
        )

    def _fact_reviews(self) -> DataFrame:
        return facts.fact_reviews(
            self.silver("order_reviews"),
            self._fact_headers(),
            self.customer_keys,
            self.gold("dim_date"),
        )

    # -- report inputs -----------------------------------------------------------------

    def loaded(self, name: str) -> DataFrame | None:
        """A star table that has been loaded, else None."""
        return self._gold.get(name)

    def product_categories(self) -> DataFrame:
        """Report category per product, without numbering the dimension."""
        return self.silver("products").select(
            "product_id", F.col("product_category_name_eng").alias("category")
        )

    def hot_orders(self) -> DataFrame:
        """Ids of orders with many items, over the loaded order fact: few rows."""
        return self.fact_orders().filter(F.col("item_count") >= HOT_ROWS).select("order_id")

    def order_outcomes(self) -> DataFrame:
        """What reports on items need to know of an order: status, lateness, review.

        Valid orders only; that an order has items is implied by joining them to it.
        """
        if "fact_orders" in self._gold:
            return self.fact_orders(valid_only=True).select(
                "order_id", "is_late", "review_score"
            )
        late = F.when(facts.is_late(), 1).otherwise(0)
        return (
            self.silver("orders")
            .filter(facts.not_voided())
            .select("order_id", late.alias("is_late"))
            .join(
                facts.order_review_summary(self.silver("order_reviews")), "order_id", "left"
            )
        )
