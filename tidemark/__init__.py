"""Warehouse workload operators for PySpark.

Every operator is a function from DataFrames to a DataFrame; Catalyst, AQE and
Tungsten choose the physical work.  ``tidemark.registry`` lists the registered
queries with the SQL statement each one has to agree with.
"""

from tidemark.registry import catalog
from tidemark.tables import Tables

__all__ = ["Tables", "catalog"]
