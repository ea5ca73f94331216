"""Query plans, each a function from tables to a DataFrame."""

from keelson.plans.region_revenue import ORACLE_SQL as REVENUE_BY_REGION_SQL
from keelson.plans.region_revenue import revenue_by_region, revenue_by_region_of

__all__ = ["REVENUE_BY_REGION_SQL", "revenue_by_region", "revenue_by_region_of"]
