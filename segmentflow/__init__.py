"""segmentflow: contact and segment analytics on Spark.

Sub-packages: ``sources`` (readers and streams), ``sinks`` (writers,
export), ``functions`` (column helpers), ``operators`` (dedup, merges,
SCD2, ids, marts, overlap, profiles, checks, diff), ``streaming`` (stateful
folds and maintained views) and ``plans`` (the segment job and the query
registry).
"""

__version__ = "0.1.0"
