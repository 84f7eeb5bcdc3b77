"""lakeforge: a Spark-native lakehouse analytics engine.

Sub-packages are independent: ``operators`` / ``functions`` / ``plans`` hold the
relational building blocks, ``sources`` reads and writes, ``store`` versions
tables, ``streaming`` runs micro-batches.
"""

__version__ = "0.1.0"
