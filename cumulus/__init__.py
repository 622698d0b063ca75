"""cumulus - daily-observation analytics as Spark DataFrame functions.

* ``cumulus.functions``  Column builders (dates, text validity, safe statistics)
* ``cumulus.sources``    readers, the delimited-text path, ingest, sinks
* ``cumulus.operators``  analyses: climate, KPIs, statistics, ML, quality counters, generic ops
* ``cumulus.plans``      binding to the test tables, checked joins, catalog, query registry
* ``cumulus.streaming``  incremental ingest with Structured Streaming

Every analysis takes and returns DataFrames; nothing is collected except scalar results.
"""

__version__ = "0.1.0"
