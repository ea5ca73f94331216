"""Exact money arithmetic.

Prices are stored as doubles. Summing doubles gives a result that depends
on the order rows arrive in, which changes with partitioning, so amounts
are made exact before they are summed: ``CAST(price AS DECIMAL(18,2)) *
(1 - CAST(discount AS DECIMAL(18,2)))``, a decimal(38,4) that nothing
narrows. Amounts are whole cents; other doubles are rounded half up, which
is Spark's cast (another engine may round them differently).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed value: money is decimal(18,2) as in the oracle SQL.
MONEY = DecimalType(18, 2)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(col: str | Column) -> Column:
    """``col`` as decimal(18,2), rounded half up."""
    return _col(col).cast(MONEY)


def discounted(price: str | Column, discount: str | Column) -> Column:
    """``price * (1 - discount)`` in decimals: decimal(38,4), exact."""
    return money(price) * (F.lit(1) - money(discount))
