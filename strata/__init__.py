"""strata: medallion analytics operators on Spark.

Subpackages: ``sources`` (readers), ``functions`` (column expressions),
``operators`` (DataFrame -> DataFrame building blocks), ``plans`` (composed
flows: ingestion log, medallion layers, gold questions) and ``streaming``
(incremental landing). Every function builds a lazy Spark plan.
"""

__version__ = "0.1.0"
