"""Feature counters and candidate lists for recommenders, on Spark.

Every operator is a ``DataFrame -> DataFrame`` transform.  The same transform,
or a twin with the same meaning, runs over static tables (backfill) and over
Structured Streaming sources.
"""
