"""incidex: geo-referenced incident analytics as composable Spark DataFrame functions.

Layers follow a bronze -> silver -> gold layout.  Every public function takes and
returns DataFrames (usable with ``df.transform``) and is built from Spark SQL
expressions, joins, aggregates and windows so Catalyst can prune, push down and
plan the work.
"""

__version__ = "0.1.0"
