"""Mixing sources to target weights by systematic sampling.

Each source gets a target; a document of the source is expected
``target / source size`` times in the mix. Within a source the expected copies
are summed in a fixed order, one random offset is added, and a document is
emitted once for every integer boundary that its share of the sum crosses. A
document's copies are therefore the floor or the ceiling of its expectation,
and the emitted size of a source stays within about one large document of its
target, because the order runs from large to small documents.

The prefix sum is distributed: documents are counted in cells
(source, size, hash split), offsets are summed over sizes and splits, and only
the documents of one cell are ranked together. A source that holds a third of
all rows is thus spread over its sizes times ``splits`` tasks' worth of cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import BLANK_WORD, join_null_safe, settle

#: Expected copies are kept in units of 2**-24, so sums are exact integers.
UNIT_BITS = 24


def word_count(text: str = "text"):
    """Words in a text; a null text has none."""
    return F.coalesce(F.size(F.regexp_extract_all(F.col(text), F.lit(BLANK_WORD), F.lit(0))), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5,
                   max_repeats: float = 2.0) -> DataFrame:
    """Targets of sources by weight, none above ``max_repeats`` times its size.

    ``sizes``: (_ll_source, _ll_source_size), one row per source. Weights are
    dealt to the sources in code-point order, null last, and repeat. The excess
    of a capped source goes to the others by weight until none is above its
    cap; the level is found in closed form from running sums over the sources
    ordered by cap per weight. One row per source goes through the windows.
    Sources whose documents are all empty get 0.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("_ll_source").asc_nulls_last())
    by_ratio = Window.orderBy("_ll_ratio", "_ll_rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    dealt = F.array(*[F.lit(float(w)) for w in weights])
    s = (sizes.withColumn("_ll_rank", F.row_number().over(by_name))
         .withColumn("_ll_weight", F.element_at(dealt, (F.pmod(F.col("_ll_rank") - 1, F.lit(len(weights))) + 1).cast("int")))
         .withColumn("_ll_cap", F.col("_ll_source_size") * F.lit(float(max_repeats)))
         .withColumn("_ll_ratio", F.col("_ll_cap") / F.col("_ll_weight"))
         .withColumn("_ll_budget", F.sum("_ll_source_size").over(everything) * F.lit(float(share)))
         .withColumn("_ll_weights", F.sum("_ll_weight").over(everything))
         .withColumn("_ll_cap_before", F.coalesce(F.sum("_ll_cap").over(before), F.lit(0.0)))
         .withColumn("_ll_weight_before", F.coalesce(F.sum("_ll_weight").over(before), F.lit(0.0)))
         .withColumn("_ll_level", (F.col("_ll_budget") - F.col("_ll_cap_before")) / (F.col("_ll_weights") - F.col("_ll_weight_before")))
         .withColumn("_ll_first_free", F.min(F.when(F.col("_ll_ratio") > F.col("_ll_level"), F.struct("_ll_ratio", "_ll_rank", "_ll_level"))).over(everything)))
    return s.select("_ll_source", "_ll_source_size",
                    F.coalesce(F.least(F.col("_ll_cap"), F.col("_ll_weight") * F.col("_ll_first_free._ll_level")), F.col("_ll_cap")).alias("_ll_target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, max_repeats: float = 2.0,
        seed: int = 0, splits: int = 64) -> DataFrame:
    """All rows of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    A row with ``copies`` 0 is not in the mix, one with 2 is in it twice
    (:func:`emit` makes the repeated rows). Null text counts as size 0, null
    source is a source of its own, null ids rank first in their cell; repeated
    rows are mixed as separate documents; rows with equal ids are ordered
    arbitrarily among themselves, which changes no total. An empty table gives
    an empty result. Input columns named like an output column are replaced.
    """
    names = ("size", "source_size", "target", "copies")
    kept = [c for c in docs.columns if c not in names]
    rows = docs.select(*kept, word_count(text_col).alias("_ll_size"), F.col(source_col).alias("_ll_source"),
                       F.pmod(F.coalesce(F.col(id_col), F.lit(0)).cast("long"), F.lit(splits)).alias("_ll_split"))
    key = ["_ll_source", "_ll_size", "_ll_split"]
    counts = settle(rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_ll_n")), "mix-cells")
    targets = source_targets(counts.groupBy("_ll_source").agg(F.sum(F.col("_ll_n") * F.col("_ll_size")).alias("_ll_source_size")),
                             weights, share, max_repeats)
    unit = F.lit(float(1 << UNIT_BITS))
    targets = (targets
               .withColumn("_ll_each", F.when(F.col("_ll_source_size") > 0, F.floor(F.col("_ll_target") / F.col("_ll_source_size") * unit)).otherwise(F.lit(0)).cast("long"))
               .withColumn("_ll_offset", F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("_ll_source", F.lit("\x00null")))), 1, 6), 16, 10).cast("long")))
    by_size = counts.groupBy("_ll_source", "_ll_size").agg(F.sum("_ll_n").alias("_ll_of_size"))
    sizes_before = Window.partitionBy("_ll_source").orderBy(F.desc("_ll_size")).rowsBetween(Window.unboundedPreceding, -1)
    splits_before = Window.partitionBy("_ll_source", "_ll_size").orderBy("_ll_split").rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.select("_ll_source", "_ll_size", F.coalesce(F.sum("_ll_of_size").over(sizes_before), F.lit(0)).alias("_ll_larger"))
    cells = counts.withColumn("_ll_earlier", F.coalesce(F.sum("_ll_n").over(splits_before), F.lit(0)))
    cells = join_null_safe(join_null_safe(cells, by_size, ["_ll_source", "_ll_size"]), targets, ["_ll_source"])
    cells = cells.select(*key, "_ll_source_size", "_ll_target", "_ll_each", "_ll_offset", (F.col("_ll_larger") + F.col("_ll_earlier")).alias("_ll_before"))
    in_cell = Window.partitionBy(*key).orderBy(F.col(id_col).asc_nulls_first())
    ranked = join_null_safe(rows.withColumn("_ll_at", F.row_number().over(in_cell)), cells, key)
    upto = (F.col("_ll_before") + F.col("_ll_at")) * F.col("_ll_each") + F.col("_ll_offset")
    copies = F.shiftright(upto, UNIT_BITS) - F.shiftright(upto - F.col("_ll_each"), UNIT_BITS)
    return ranked.select(*kept, F.col("_ll_size").alias("size"), F.col("_ll_source_size").alias("source_size"),
                         F.col("_ll_target").alias("target"), copies.alias("copies"))


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mix itself: each row as often as its ``copies``, with ``columns``."""
    return mixed.where("copies > 0").select(*columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_ll_copy")).drop("_ll_copy")
