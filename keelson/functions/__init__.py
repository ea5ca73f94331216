"""Column expressions, all built from ``pyspark.sql.functions``."""

from keelson.functions.money import MONEY, discounted, money

__all__ = ["MONEY", "discounted", "money"]
