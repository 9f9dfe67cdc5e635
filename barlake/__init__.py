"""barlake: a Spark-native end-of-day price pipeline.

Landed per-symbol price files -> raw table (insert-only) -> refined table
(clean, forward fill, drop) -> metrics table (previous value, % change, SMA,
crossovers) -> alert rules evaluated on the latest day.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own relational operators, so Catalyst plans it and it runs the same way in a
batch job, in a ``foreachBatch`` of a stream, or on a cluster.
"""

from barlake.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
