"""Event-ledger analytics on Spark.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from Spark SQL joins, windows, aggregates and
Structured Streaming triggers.  Subpackages:

* ``functions``  scalar column expressions (base58, wrapping casts, buckets)
* ``operators``  pairing, typed projections, reconciliation, ledger, envelopes
* ``sources``    archive listings, daily Parquet export / import, ledger files
* ``streaming``  fan-out, once-mode ingest, windowed statistics
* ``plans``      stand-in inputs derived from the driver tables and the query catalog
"""

from ledgerline.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
