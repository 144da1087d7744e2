"""Retail analytics warehouse on Spark: raw files to cleansed tables to star schema to reports."""
