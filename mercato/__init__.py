"""mercato: retail invoice-line analytics on Spark DataFrames.

Layers: ``sources`` (CSV/Parquet/geo dimension/test view) -> ``plans.clean``
(cleaning job) -> ``plans.sales`` (typed and sales views) -> report plans
(KPIs, prices, Pareto, trends, geo, hours, slicer). All lazy DataFrames built
from built-in functions; no Python UDFs.
"""

__version__ = "0.1.0"
