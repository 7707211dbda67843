"""Metadata-driven medallion loading for lending data, as plain Spark jobs.

Sub-packages:

* ``functions``  column expressions (keys, sampling, money, loan terms)
* ``sources``    landing-zone readers, watermarks, inventory
* ``sinks``      idempotent partition writes, upserts, compaction, catalog tables
* ``operators``  DataFrame -> DataFrame transformations
* ``streaming``  incremental arrival of landed files
* ``plans``      the registered queries and their SQL counterparts
"""
