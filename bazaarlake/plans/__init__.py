"""The layers: cleansing, star schema, quality rules, loads and reports."""
