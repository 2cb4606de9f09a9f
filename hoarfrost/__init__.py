"""Snowflake-warehouse operators expressed as Spark DataFrames."""
