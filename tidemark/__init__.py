"""tidemark: a change-data engine on PySpark.

Changelogs (insert / update before+after / delete rows with a log position) in, keyed
tables and delivery bookkeeping out, all as DataFrame jobs:

* ``tidemark.operators.merge``     keyed apply: latest per key, upsert, deletes, FK checks
* ``tidemark.operators.routing``   sources, routes, schema and column maps, key resolution
* ``tidemark.operators.ranges``    LSN ranges, cursors, bounded polls, high-water marks
* ``tidemark.operators.batches``   sequences, batches, acks, cursor folds, metrics
* ``tidemark.operators.analytics`` update pairs, changed columns, net changes, reconcile
* ``tidemark.functions``           column expressions (LSN, envelope, error classes)
* ``tidemark.plans``               skew-safe ordered scans, bounded broadcasts
* ``tidemark.sources``             Parquet changelog storage, JDBC, test fixtures
* ``tidemark.streaming``           change streams and the exactly-once table store
"""
