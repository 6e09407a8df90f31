"""tidepool: research-landscape analytics as lazy PySpark DataFrame operators.

Subpackages: ``sources`` (scans and sinks), ``functions`` (column
expressions, size-checked joins), ``operators`` (named operators, each
``DataFrame -> DataFrame``), ``plans`` (test fixtures, registered queries,
DuckDB oracle, end-to-end jobs), ``streaming`` (restartable ingestion).
"""
