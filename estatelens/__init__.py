"""estatelens: a Spark-native analytics engine for daily batches of property listings.

Layers (each a module of ``DataFrame -> DataFrame`` jobs):

* ``sources``    readers, writers and driver-table adapters
* ``functions``  native column expressions (text folding, number parsing, keys, rounding)
* ``operators``  normalisation, linkage, quality gate, dedup, merge, SCD2, data checks
* ``plans``      staging, star schema, marts, reports, the daily pipeline, query catalogue
* ``streaming``  incremental fact loading with Structured Streaming
"""

__version__ = "0.1.0"
