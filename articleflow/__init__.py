"""articleflow — article-corpus analytics as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column`` for scalar functions) so Catalyst sees one plan from scan to sink.

Sub-packages
------------
``sources``    table scans, fixture views, feed/page parsing, sinks
``functions``  scalar column expressions (text, url, date, labels, vectors)
``operators``  relational operators (clean, dedup, merge, reads, metrics,
               trends, events, digest)
``streaming``  Structured Streaming jobs (ingest, clean, daily counts)
``plans``      the named query catalogue and its SQL oracle
"""

__version__ = "0.1.0"
