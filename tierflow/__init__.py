"""tierflow: a three-tier (raw, cleaned, hourly) data pipeline on Spark.

Sub-packages
------------
functions   column expressions
operators   DataFrame -> DataFrame steps, no I/O
sources     relational, file and control-data readers
sinks       append, insert-if-absent, replace, overwrite, register
streaming   the micro-batch ingest of raw event files
plans       whole flows: source to bronze, bronze to silver, silver to gold
"""

__version__ = "0.1.0"
