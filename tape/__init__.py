"""tape — tick-data analytics on Spark.

Every public function takes and returns ``DataFrame``s; nothing is collected to
the driver.  Layout:

- ``tape.sources``    readers, writers, tick views over the test tables
- ``tape.functions``  column expressions (prices, buckets, book arrays)
- ``tape.operators``  staging, bars, book depth, quality checks, marts, table checks
- ``tape.plans``      report queries, the model graph and the batch pipeline
- ``tape.streaming``  Structured Streaming versions of bars, dedup and checks
"""

from tape.session import configure, get_session, checkpoint_dir

__all__ = ["configure", "get_session", "checkpoint_dir"]
