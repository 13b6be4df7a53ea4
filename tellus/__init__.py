"""tellus: hazard-feed analytics expressed as Spark DataFrame / SQL plans.

Sub-packages
------------
functions   column builders (predicates, scalar projections) - no UDFs
operators   DataFrame -> DataFrame building blocks (dedup, match, joins, merge,
            aggregates, constraint validation)
sources     feed envelopes, lake scans, table loading, sinks
plans       end-to-end jobs: clean-and-load, audit, repair, marts, report
streaming   Structured Streaming lake writer and stream dedup
"""

__version__ = "0.1.0"
