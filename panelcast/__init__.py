"""panelcast: account x period panel analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (column names are
parameters), so the work is planned by Catalyst and runs on the executors.
"""

__version__ = "0.1.0"
