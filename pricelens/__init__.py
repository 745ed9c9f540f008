"""pricelens — partner price-feed analytics as Spark DataFrame jobs.

Every operator takes DataFrames and returns DataFrames; nothing runs an
action except the writers in ``sources.sinks`` and the pipeline drivers in
``plans.pipeline``.
"""

from pricelens.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
