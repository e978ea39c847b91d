"""tableops: warehouse and lake operators written as plain Spark DataFrame plans.

Sub-packages: ``functions`` (Column expressions), ``operators`` (DataFrame -> DataFrame), ``sources`` and
``sinks`` (files in and out), ``streaming`` (once-only file ingestion) and ``plans`` (the composite jobs,
wired to the benchmark tables).
"""

__version__ = "0.1.0"
