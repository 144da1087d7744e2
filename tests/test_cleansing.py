from __future__ import annotations

from decimal import Decimal

from bazaarlake.sources.schemas import SILVER


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def product(product_id, category):
    return (product_id, category, *[None] * 7)


def test_product_category_falls_back(tiny):
    wh = tiny(
        products=[
            product('"a"', '"beleza"'),
            product('"b"', '"novo"'),
            product('"c"', '""'),
            product('"d"', None),
            product('"e"', '" "'),
        ],
        category_translation=[('"beleza"', '"beauty"'), ('"outro"', '"other"')],
    )
    assert rows(wh.silver("products"), *SILVER["products"].names) == [
        ("a", "beleza", "beauty"),
        ("b", "novo", "novo"),
        ("c", "uncategorized", "uncategorized"),
        ("d", "uncategorized", "uncategorized"),
        ("e", "uncategorized", "uncategorized"),
    ]


def test_repeated_translation_does_not_multiply_products(tiny):
    wh = tiny(
        products=[product("a", "x")], category_translation=[("x", "one"), ("x", "two")]
    )
    assert rows(wh.silver("products"), "product_category_name_eng") == [("one",)]


def test_payment_without_known_type_drops(tiny):
    wh = tiny(
        order_payments=[
            ('"o1"', 1, "boleto", 1, Decimal("1.00")),
            ('"o2"', 1, None, 1, Decimal("1.00")),
            ('"o3"', 1, "not_defined", 1, Decimal("0.00")),
        ]
    )
    assert rows(wh.silver("order_payments"), "order_id", "payment_value") == [
        ("o1", Decimal("1.0000"))
    ]


def test_geolocation_bounds_are_inclusive(tiny):
    def sample(zip_code, lat, lng):
        return (zip_code, lat and Decimal(lat), lng and Decimal(lng), "c", "s")

    wh = tiny(
        geolocation=[
            sample('"01"', "-35", "-75"),
            sample('"02"', "6", "-33"),
            sample('"03"', "-35.01", "-50"),
            sample('"04"', "6.01", "-50"),
            sample('"05"', "0", "-75.01"),
            sample('"06"', None, "-50"),
            sample('"07"', "1", "-50"),
            sample("07", "2", "-40"),
            sample("07", "90", "-40"),
        ]
    )
    assert rows(wh.silver("geolocation"), *SILVER["geolocation"].names) == [
        ("01", Decimal("-35"), Decimal("-75")),
        ("02", Decimal("6"), Decimal("-33")),
        ("07", Decimal("1.5"), Decimal("-45")),
    ]


def test_silver_schemas_are_the_declared_ones(tiny):
    wh = tiny()
    for name, schema in SILVER.items():
        got = [(f.name, f.dataType) for f in wh.silver(name).schema]
        assert got == [(f.name, f.dataType) for f in schema], name
