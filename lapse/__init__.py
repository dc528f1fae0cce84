"""lapse — subscriber churn and lifetime-value analytics as Spark DataFrame operators.

Every operator is a function ``DataFrame(s), params -> DataFrame``.  Relational work is
expressed with the DataFrame / SQL API so Catalyst and AQE plan it; nothing here collects
user rows to the driver.  The only driver-side values are bounded statistics (quantile
bounds, per-bucket counts, fitted scalars) documented where they occur.
"""

from lapse.config import Budget, Params, Windows  # noqa: F401

__all__ = ["Budget", "Params", "Windows"]
