"""shopflow: retail clickstream + orders medallion pipeline on PySpark.

Every transformation is a plain ``DataFrame -> DataFrame`` function built from
Spark's DataFrame API, so Catalyst plans it and the same code runs on a batch
table or (where it makes sense) on a stream.

Layout
------
``schemas``      bronze / wire ``StructType`` definitions
``session``      session builder and checkpoint-folder helper
``fixtures``     driver test tables -> bronze-shaped tables
``functions``    column helpers: time normalisation, recency, projections, key decoding
``operators``    reusable relational building blocks (dedup, top-k, interval sums, ...)
``plans``        the composite silver/gold outputs
``sources``      Kafka / replay sources, catalog DDL and CTAS helpers
``streaming``    streaming ingest queries, sinks, triggers
"""

__version__ = "0.1.0"
