"""pickbay: hot-warehouse assortment and order-split analytics on Spark.

Every operator is a function ``DataFrame(s) -> DataFrame`` built from Spark SQL
built-ins (joins, aggregates, windows).  Nothing is collected to the driver on
the data path; jobs in :mod:`pickbay.plans` compose the operators and write one
output table per action.
"""

from pickbay.scenario import PurchaseWindow, Scenario

__all__ = ["Scenario", "PurchaseWindow"]
