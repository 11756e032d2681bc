"""Demand forecasting over panel data, as Spark jobs.

The package is a set of ``DataFrame -> DataFrame`` operators plus four plans
(refresh, train, select, serve) that chain them over tables.
"""

__version__ = "0.1.0"
