"""rollwise: incremental summary tables on Spark.

Targets declare grouping columns, aggregate templates and a chunk size;
sources declare how to reshape a table into the target's columns;
granularity is a bitmask over an ordered column list.  The engine aggregates
due chunks in one Spark job (or one Structured Streaming micro-batch) and
replaces the touched partitions of the target.

Main entry points:

* ``specs.TargetSpec`` / ``specs.SourceSpec``: what to compute.
* ``plans.incremental.chunk_batch`` / ``range_batch`` / ``run_target``: one
  chunk, a range in one job, a full run with write.
* ``plans.registry``: registry-wide operators on DataFrames.
* ``plans.workflow.Registry``: a persisted registry and its procedures.
* ``operators.rollup.rollup_targets``: several targets in one scan.
* ``operators.rates``: rate cards as joins.
* ``streaming.continuous.run_stream``: continuous load.
* ``functions.sql.register_sql_functions``: the functions for SQL users.
"""

__version__ = "0.1.0"

from .specs import SourceSpec, TargetSpec  # noqa: E402,F401
