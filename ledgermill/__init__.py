"""ledgermill: a banking medallion pipeline written as PySpark DataFrame operators."""
