"""Retail lake-to-warehouse preparation as lazy Spark DataFrame operators."""
