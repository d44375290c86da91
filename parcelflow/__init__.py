"""parcelflow — freight-network analytics as Spark DataFrame operators.

Sub-packages:

* ``functions``  Column-level building blocks (timestamp layouts, sentinel nulls, stringify).
* ``operators``  DataFrame -> DataFrame operators (latest per key, container unpacking,
                 anti/semi joins, timetable and route operators, the schedule walk).
* ``sources``    readers and sinks (CSV folders, catalog tables, partitioned and JDBC sinks)
                 plus the logistics tables derived from the test tables.
* ``plans``      the four end-to-end jobs (clean, forecast, load warning, unloaded-not-scanned)
                 and the registered queries used by ``__spark_entry__``.
* ``streaming``  incremental cleaning on Structured Streaming (``availableNow`` + ``foreachBatch``).
"""

__version__ = "0.1.0"
