"""objsync: release-manifest reconciliation with cloud inventories and a
metadata index, built from Spark DataFrame operators."""

__version__ = "0.1.0"
