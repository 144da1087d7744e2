"""Raw retail tables derived from the test data (orders, lineitem, customer, ...).

Each table is one SELECT in SQL that Spark and DuckDB both run, so both sides of an
oracle check start from the same rows. Values that the raw files wrap in double quotes
carry them here too; the cleansing has to take them off again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.config import ReportParams
from bazaarlake.operators.lookup import estimated_bytes
from bazaarlake.session import setting_bytes
from bazaarlake.sources.schemas import BRONZE, conform, declared

# Windows and thresholds that select something, but not everything, of this data.
PARAMS = ReportParams(
    calendar_from=date(1995, 1, 1),
    calendar_to=date(2001, 12, 31),
    months_from=date(1996, 1, 1),
    months_to=date(2000, 12, 1),
    yoy_until=date(2001, 7, 1),
    cohorts_from=date(1996, 1, 1),
    cohorts_to=date(2000, 12, 1),
    at_risk_late_pct=40.0,
    at_risk_review=3.05,
)


def _quoted(expression: str) -> str:
    return f"""'"' || {expression} || '"'"""


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _id(prefix: str, key: str) -> str:
    return f"'{prefix}' || {_text(key)}"


def _days(n: str) -> str:
    return f"({n}) * INTERVAL '1' DAY"


def _hours(n: str) -> str:
    return f"({n}) * INTERVAL '1' HOUR"


def _select(columns: dict[str, str], source: str) -> str:
    body = ",\n  ".join(f"{expression} AS {name}" for name, expression in columns.items())
    return f"SELECT\n  {body}\nFROM {source}"


_PURCHASED = f"o_orderdate + {_hours('o_orderkey % 24')}"
_IS_DELIVERED = "o_orderkey % 20 >= 4 AND o_orderkey % 97 <> 0"
_DELIVERED_AT = (
    f"{_PURCHASED} + {_days('1 + (o_orderkey * 7) % 45')} + {_hours('o_orderkey % 11')}"
)
_BRAND = "substr(p_brand, 7)"
_CATEGORY = f"lower(p_type) || '_' || {_BRAND}"
_CUSTOMER_ZIP = _text("1000 + c_nationkey * 40 + c_custkey % 40")


def _money(column: str, factor: str, scale: int) -> str:
    return f"CAST(CAST({column} AS DECIMAL(18,2)) * {factor} AS DECIMAL(18,{scale}))"


def _degrees(start: int, step: int) -> str:
    hundredths = f"{start} + (c_custkey * {step}) % 4400"
    return f"CAST(CAST({hundredths} AS DECIMAL(9,0)) * 0.01 AS DECIMAL(18,8))"


_FIRST_PAYMENT = _select(
    {
        "order_id": _quoted(_id("o", "o_orderkey")),
        "payment_sequential": "1",
        "payment_type": "CASE WHEN o_orderkey % 500 = 0 THEN 'not_defined'"
        " WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'boleto'"
        " WHEN substr(o_orderpriority, 1, 1) = '2' THEN 'debit_card'"
        " ELSE 'credit_card' END",
        "payment_installments": "CAST(1 + o_orderkey % 12 AS INT)",
        "payment_value": _money("o_totalprice", "0.005", 2),
    },
    "orders",
)
_SECOND_PAYMENT = _select(
    {
        "order_id": _quoted(_id("o", "o_orderkey")),
        "payment_sequential": "2",
        "payment_type": "'voucher'",
        "payment_installments": "1",
        "payment_value": "CAST(o_orderkey % 90 AS DECIMAL(18,2))",
    },
    "orders WHERE o_orderkey % 10 = 3",
)

_REVIEW = {
    "review_id": _id("r", "o_orderkey"),
    # Reviews of orders that do not exist, so that some orders have none.
    "order_id": f"CASE o_orderkey % 20 WHEN 7 THEN {_id('x', 'o_orderkey')}"
    f" ELSE {_id('o', 'o_orderkey')} END",
    "review_score": "CAST(1 + (o_orderkey * 13) % 5 AS INT)",
    "review_comment_title": "CASE WHEN o_orderkey % 6 = 0 THEN 'title ' || "
    f"{_text('o_orderkey % 7')} END",
    "review_comment_message": "CASE WHEN o_orderkey % 15 = 0"
    " THEN 'said \"fine\", then' || chr(13) || chr(10) || 'left'"
    " WHEN o_orderkey % 3 = 0 THEN 'slow, but' || chr(13) || chr(10) || 'arrived' END",
    "review_creation_date": f"o_orderdate + {_days('5 + o_orderkey % 9')}",
    "review_answer_timestamp": f"o_orderdate + {_days('5 + o_orderkey % 9 + o_orderkey % 7')}"
    " + INTERVAL '3' HOUR",
}
_EXTRA_REVIEW = {
    **_REVIEW,
    "review_score": "3",
    "review_comment_title": "CAST(NULL AS STRING)",
    "review_comment_message": "CAST(NULL AS STRING)",
    "review_creation_date": "o_orderdate",
    "review_answer_timestamp": "o_orderdate + INTERVAL '49' HOUR",
}

RAW_SQL: dict[str, str] = {
    "customers": _select(
        {
            "customer_id": _quoted(_id("c", "o_orderkey")),
            "customer_unique_id": _quoted(
                f"CASE WHEN o_orderkey % 4 = 0 THEN {_id('u', 'c_custkey')}"
                f" ELSE {_id('v', 'o_orderkey')} END"
            ),
            "customer_zip_code_prefix": _quoted(_CUSTOMER_ZIP),
            "customer_city": _quoted(_id("city ", "c_custkey % 200")),
            "customer_state": _quoted(_id("S", "c_nationkey")),
        },
        "orders JOIN customer ON c_custkey = o_custkey",
    ),
    "geolocation": _select(
        {
            # Zips no customer has, so that some customers' zips are missing here.
            "geolocation_zip_code_prefix": _quoted(
                f"CASE c_custkey % 40 WHEN 39 THEN {_id('x', 'c_custkey')}"
                f" ELSE {_CUSTOMER_ZIP} END"
            ),
            "geolocation_lat": _degrees(-3600, 37),
            "geolocation_lng": _degrees(-7600, 53),
            "geolocation_city": _quoted(_id("city ", "c_custkey % 200")),
            "geolocation_state": _quoted(_id("S", "c_nationkey")),
        },
        "customer",
    ),
    "order_items": _select(
        {
            "order_id": _quoted(_id("o", "l_orderkey")),
            "order_item_id": "l_linenumber",
            "product_id": _quoted(_id("p", "l_partkey")),
            "seller_id": _quoted(_id("s", "l_suppkey")),
            "shipping_limit_date": "l_shipdate",
            "price": _money("l_extendedprice", "0.01", 2),
            "freight_value": _money("l_quantity", "0.5", 2),
        },
        "lineitem",
    ),
    "order_payments": f"{_FIRST_PAYMENT}\nUNION ALL\n{_SECOND_PAYMENT}",
    "order_reviews": _select(_REVIEW, "orders")
    + "\nUNION ALL\n"
    + _select(_EXTRA_REVIEW, "orders WHERE o_orderkey % 100 = 1"),
    "orders": _select(
        {
            "order_id": _quoted(_id("o", "o_orderkey")),
            "customer_id": _quoted(_id("c", "o_orderkey")),
            "order_status": "CASE o_orderkey % 20 WHEN 0 THEN 'canceled'"
            " WHEN 1 THEN 'unavailable' WHEN 2 THEN 'shipped' WHEN 3 THEN 'invoiced'"
            " ELSE 'delivered' END",
            "order_purchase_timestamp": _PURCHASED,
            "order_approved_at": f"{_PURCHASED} + INTERVAL '1' HOUR",
            "order_delivered_carrier_date": "CASE WHEN o_orderkey % 20 = 2"
            f" OR o_orderkey % 20 >= 4 THEN {_PURCHASED} + INTERVAL '1' DAY END",
            "order_delivered_customer_date": f"CASE WHEN {_IS_DELIVERED}"
            f" THEN {_DELIVERED_AT} END",
            "order_estimated_delivery_date": f"o_orderdate + {_days('10 + o_orderkey % 30')}",
        },
        "orders",
    ),
    "products": _select(
        {
            "product_id": _quoted(_id("p", "p_partkey")),
            "product_category_name": "CASE p_partkey % 50 WHEN 0 THEN CAST(NULL AS STRING)"
            f""" WHEN 1 THEN '""' ELSE {_quoted(_CATEGORY)} END""",
            "product_name_lenght": "CAST(length(p_name) AS INT)",
            "product_description_lenght": "CAST(p_partkey % 900 AS INT)",
            "product_photos_qty": "CAST(p_partkey % 4 AS INT)",
            "product_weight_g": "CASE WHEN p_partkey % 40 = 0 THEN 0 ELSE p_size * 100 END",
            "product_length_cm": "CAST(10 + p_partkey % 60 AS INT)",
            "product_height_cm": "CAST(2 + p_partkey % 30 AS INT)",
            "product_width_cm": "CAST(5 + p_partkey % 40 AS INT)",
        },
        "part",
    ),
    "sellers": _select(
        {
            "seller_id": _quoted(_id("s", "s_suppkey")),
            "seller_zip_code_prefix": _quoted(
                _text("1000 + s_nationkey * 40 + s_suppkey % 40")
            ),
            "seller_city": _quoted(_id("city ", "s_suppkey % 50")),
            "seller_state": _quoted(_id("S", "s_nationkey")),
        },
        "supplier",
    ),
    "category_translation": _select(
        {
            # Names no product has, so that one brand's categories are missing here.
            "product_category_name": _quoted(
                f"CASE p_brand WHEN 'Brand#2' THEN 'x ' ELSE '' END || {_CATEGORY}"
            ),
            "product_category_name_english": _quoted(
                f"'eng ' || lower(p_type) || ' ' || {_BRAND}"
            ),
        },
        "(SELECT DISTINCT p_type, p_brand FROM part) AS names",
    ),
}

_STAR_SCHEMAS = {
    table: declared(columns)
    for table, columns in {
        "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double,"
        " c_mktsegment string",
        "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
        "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int,"
        " p_retailprice double",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string,"
        " o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    }.items()
}
_SPREAD_FROM = 1 << 20


def _star_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A test table, spread over the cores where its scan is a single task.

    The test tables are one file of one row group, which one task reads whole; hashing
    its first two columns cannot make that worse. Tables of several files or of more
    than one split are taken as they are.
    """
    schema = _STAR_SCHEMAS[table]
    df = spark.read.schema(schema).parquet(f"{sf_dir}/{table}.parquet")
    split = setting_bytes(spark, "spark.sql.files.maxPartitionBytes")
    if _SPREAD_FROM < estimated_bytes(df) < split and len(df.inputFiles()) == 1:
        df = df.repartition(spark.sparkContext.defaultParallelism, *schema.names[:2])
    return df


def raw_tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """Raw retail tables over the star schema in ``sf_dir``, as lazy DataFrames."""

    def raw(name: str) -> DataFrame:
        sql = RAW_SQL[name]
        frames = {}
        for table in _STAR_SCHEMAS:
            for clause in ("FROM", "JOIN"):
                reference = f"{clause} {table}"
                if reference in sql:
                    sql = sql.replace(reference, f"{clause} {{{table}}}")
                    frames[table] = _star_table(spark, sf_dir, table)
        return conform(spark.sql(sql, **frames), BRONZE[name])

    return raw
