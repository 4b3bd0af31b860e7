"""Shards of equal weight in bytes, tokens and rows by vector bin packing.

Groups of equal texts are the items. Small groups are bundled by a hash and large ones cut
into pieces, so that the number of units to place is bounded by the number of shards,
however many documents there are. A unit goes to the shard where the dot product of its
weights with what the shard has left is largest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import numbered, written

#: A shard's fair share holds about so many units.
UNITS = 256
#: A group is cut where it is more than this part of a shard.
CUT = 1 / 16
WEIGHTS = ("size", "tokens", "rows")


def shards(
    docs: DataFrame,
    count: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    overhead: int = 16,
) -> DataFrame:
    """Per row of ``docs``: ``id``, ``size``, ``text_crc32``, ``tokens``, ``shard``, ``slot``.

    ``size`` is the UTF-8 length of the text and ``overhead``, ``tokens`` its number of
    words, ``slot`` numbers a shard's rows from 0. Rows of one text share a shard unless
    they are more than ``CUT`` of one; such a group is cut into pieces.

    A null text is an empty one. Repeated rows are placed each, with slots of their own;
    null ids are placed like others. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"\S+")).cast("long").alias("tokens"),
        F.unhex(F.md5(text)).alias("_text"),
    )
    rows = written(rows.withColumn("_no", F.monotonically_increasing_id()))
    units = count * UNITS
    tagged = _units(rows, units, CUT / count)
    sums = tagged.groupBy("_unit").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    # At most ``units`` bundles; all groups that are cut are no more than three times the
    # whole in the share that counts, so that they have at most 6 * units pieces.
    got = sums.toArrow().to_pandas().sort_values("_unit")
    got["shard"] = place(got[list(WEIGHTS)].to_numpy(np.float64), count)
    to = docs.sparkSession.createDataFrame(got[["_unit", "shard"]], "_unit string, shard int")
    placed = written(tagged.join(F.broadcast(to), "_unit").drop("_unit"))
    return numbered(placed, ["shard"], ["_no"], "slot").drop("_no")


def _units(rows: DataFrame, units: int, cut: float) -> DataFrame:
    """Add ``_unit``, the bundle or piece that a row belongs to."""
    total = rows.agg(*[F.sum(c).alias(c) for c in ("size", "tokens")], F.count(F.lit(1)).alias("rows")).first()
    groups = rows.groupBy("_text").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    )
    share = F.greatest(*[F.col(c) / F.lit(float(total[c] or 1)) for c in WEIGHTS])
    pieces = F.ceil(share * units).cast("int")
    # At most three groups in every 1 / cut can be as large as this: a bounded table.
    large = groups.where((share > cut) & (F.col("rows") > 1)).select("_text", pieces.alias("_pieces"))
    found = rows.join(F.broadcast(large), "_text", "left")
    bundle = F.concat(F.lit("b"), F.pmod(F.xxhash64("_text"), F.lit(units)).cast("string"))
    piece = F.concat_ws(
        "/", F.hex("_text"), F.pmod(F.xxhash64("_no"), F.col("_pieces")).cast("string")
    )
    return found.withColumn("_unit", F.when(F.col("_pieces").isNull(), bundle).otherwise(piece)).drop(
        "_text", "_pieces"
    )


def place(weights: np.ndarray, count: int) -> np.ndarray:
    """The bin of each unit (a row of ``weights``): the largest units first, each where
    its dot product with the residual capacity is highest, ties to the lowest bin."""
    share = weights / np.maximum(weights.sum(axis=0), 1)
    left = np.full((count, weights.shape[1]), 1.0 / count)
    bins = np.zeros(len(weights), np.int32)
    for i in np.argsort(-share.max(axis=1), kind="stable"):
        bins[i] = at = int(np.argmax(left @ share[i]))
        left[at] -= share[i]
    return bins
