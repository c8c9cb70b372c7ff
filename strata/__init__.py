"""strata — composable Spark DataFrame operators for layered (raw → bronze →
silver → gold) lakehouse pipelines.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from Spark SQL built-ins, so Catalyst and AQE plan the work.
Library code never configures the session; I/O happens at the edges
(``strata.sources`` / ``strata.streaming``).
"""

__version__ = "0.1.0"
