"""Bad-record review queue (REV-1..3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens import config

def _sev_order():
    return F.create_map(*[x for k, v in config.SEVERITY_RANK.items() for x in (F.lit(k), F.lit(v))])


def newest_first(bad: DataFrame) -> list[str]:
    """The columns that order bad records, the time of detection first where they
    are stamped with it; ties go by batch, offer and rule."""
    return [c for c in ("detected_at", "source_batch_id", "offer_id", "rule_id") if c in bad.columns]


def review_queue(bad: DataFrame, status=None, severity=None, assignee=None,
                 page: int = 1, size: int = 50,
                 order=None):
    """REV-1: filtered queue, newest first (:func:`newest_first`, or the columns of
    ``order``, each descending), one page; returns (page, total)."""
    b = bad
    if status is not None:
        b = b.filter(F.col("status") == status)
    if severity is not None:
        b = b.filter(F.col("severity") == severity)
    if assignee is not None:
        b = b.filter(F.col("assignee") == assignee)
    total = b.agg(F.count(F.lit(1)).alias("total"))
    pg = b.orderBy(*[F.desc(o) for o in order or newest_first(bad)]).offset((page - 1) * size).limit(size)
    return pg, total


def by_severity(bad: DataFrame) -> DataFrame:
    """Queue sorted HIGH > MEDIUM > LOW (not alphabetically)."""
    return bad.orderBy(F.desc(_sev_order()[F.col("severity")]))


def apply_resolutions(bad: DataFrame, actions: DataFrame, key=("offer_id", "rule_id")):
    """REV-2: apply (key, action RESOLVED|IGNORED, notes, resolved_at) to bad records.

    Of several valid actions on one key the latest counts (of equal times the
    alphabetically last action, then note); other actions change nothing.
    Returns (updated bad records, actions whose key matches no record).
    """
    key = list(key)
    a = (actions.filter(F.col("action").isin("RESOLVED", "IGNORED")).groupBy(*key)
         .agg(F.max(F.struct("resolved_at", "action", "notes")).alias("_a"))
         .select(*key, F.col("_a.action").alias("_action"), F.col("_a.notes").alias("_notes"), F.col("_a.resolved_at").alias("_at")))
    ok = F.col("_action").isNotNull()
    out = bad.join(a, key, "left")
    for c, t in (("resolution_notes", "string"), ("resolved_at", "timestamp")):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast(t))
    out = (out.withColumn("status", F.when(ok, F.col("_action")).otherwise(F.col("status")))
              .withColumn("resolution_notes", F.when(ok, F.col("_notes")).otherwise(F.col("resolution_notes")))
              .withColumn("resolved_at", F.when(ok, F.col("_at")).otherwise(F.col("resolved_at")))
              .drop("_action", "_notes", "_at"))
    unknown = actions.join(bad.select(*key), key, "left_anti")
    return out, unknown


def replay_batch(stg: DataFrame, batch_id, run) -> DataFrame:
    """REV-3: re-run one batch from its stored rows with the current configuration.

    ``run`` is the pipeline function applied to the batch's staging rows.
    """
    return run(stg.filter(F.col("source_batch_id") == batch_id))
