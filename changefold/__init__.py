"""Change-data analytics on open-source Spark.

``sources``     landing files, bronze tables, schema memory, versioned publishing
``operators``   fold, dedup, rules, envelope, reconciliation, secured views
``streaming``   incremental ingest, current-state targets, validated fact feeds
``functions``   column expressions: bands, temporal decoding, loan arithmetic
``plans``       the loan book: silver, gold, panels, candidates, whole refresh
``registered``  the checked queries behind ``__spark_entry__``
"""
