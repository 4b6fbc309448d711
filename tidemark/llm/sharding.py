"""Sharding by a Hilbert curve over quantised metadata.

Each document becomes a point with one coordinate per metadata dimension: a category's place among the
others by frequency, the power of two of a magnitude, the quantile of an id. Documents are put in the order of
the Hilbert curve through these points and the order is cut into runs of equal row counts, so that a
shard covers a small box of every dimension and a reader can skip files by any of them.

Defined cases: a null dimension gives coordinate 0; a null text has size 16 and crc32 0; a text counts
whole, however long; repeated rows get places of their own; an empty table gives no rows; columns
besides the named ones are ignored unless ``carry`` names them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, whole

BITS = 4
"""Bits of each coordinate."""
VALUES = 64
"""Values of a category that have places of their own, at most."""
SALTS = 64
"""Parts that the rows of one curve cell are split into before they are numbered, at least."""
SALT_ROWS = 500_000
"""One part more for so many rows of the table, however many are in one cell."""
ROW_BYTES = 16


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``points`` (unsigned coordinates below 2**bits).

    Rotates and reflects the coordinates from the highest bit down, turns them into a Gray code and
    interleaves the bits.
    """
    axes = [points[:, k].astype(np.int64) for k in range(points.shape[1])]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k in range(len(axes)):
            flip = (axes[k] >> level) & 1 == 1
            swap = np.where(flip, 0, (axes[0] ^ axes[k]) & low)
            axes[0] = np.where(flip, axes[0] ^ low, axes[0] ^ swap)
            axes[k] = axes[k] ^ swap
    for k in range(1, len(axes)):
        axes[k] = axes[k] ^ axes[k - 1]
    turn = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    index = np.zeros_like(axes[0])
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            index = (index << 1) | (((axis ^ turn) >> bit) & 1)
    return index


def _category(docs: DataFrame, name: str) -> Column:
    """The middle of a value's share when values are laid side by side, the most frequent first; null has cell 0.

    A value with more than one part in 2**BITS of the rows has a cell of its own, and neighbours at
    the ends of the axis fall into different halves of it. Values beyond the ``VALUES`` most frequent
    ones share the last cell.
    """
    counts = docs.where(F.col(name).isNotNull()).groupBy(F.col(name).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    first, total = counts.orderBy(F.desc("n"), "value").limit(VALUES).collect(), counts.agg(F.sum("n")).first()[0]
    cells, before = [], 0
    for r in first:
        cells.append((2 * before + r.n) * (1 << BITS) // (2 * total))
        before += r.n
    names = F.array(*[F.lit(r.value) for r in first]).cast("array<string>")
    at = F.array_position(names, F.col(name).cast("string")).cast("int")
    found = F.get(F.array(*map(F.lit, cells)).cast("array<int>"), at - 1)
    return F.when(F.col(name).isNull(), 0).when(at > 0, found).otherwise((1 << BITS) - 1)


def _magnitude(column: Column) -> Column:
    """Powers of two from 32 up; everything below shares a coordinate."""
    power = F.floor(F.log2(F.greatest(column, F.lit(1)).cast("double"))).cast("int") - 4
    return F.coalesce(F.least(F.greatest(power, F.lit(0)), F.lit((1 << BITS) - 1)), F.lit(0))


def _quantile(column: Column, edges: list[int]) -> Column:
    """How many of the edges lie below a value."""
    below = [F.when(column > edge, 1).otherwise(0) for edge in edges]
    return F.coalesce(reduce(Column.__add__, below, F.lit(0)), F.lit(0))


def hilbert_shards(
    docs: DataFrame,
    shards: int = 40,
    categories: Sequence[str] = ("lang", "source"),
    magnitudes: Sequence[str] = ("n_chars",),
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and the carried columns.

    Row counts of the shards differ by one at most. Only narrow rows are shuffled, once, on
    (cell, salt): a cell that holds a third of all rows is numbered by many tasks.
    """
    shares = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    bounds = docs.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("doc_id", shares, 1000).alias("edges")).first()
    coordinates = (
        [_category(docs, c) for c in categories]
        + [_magnitude(F.col(c)) for c in magnitudes]
        + [_quantile(F.col("doc_id"), sorted(set(bounds.edges or [])))]
    )
    salts = max(SALTS, bounds.n // SALT_ROWS)
    dims = len(coordinates)

    @F.pandas_udf("long")
    def curve(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(hilbert_index(np.column_stack([c.to_numpy() for c in columns]), BITS))

    points = docs.select(
        F.col("doc_id"),
        (F.octet_length(whole(F.col("text"))) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(whole(F.col("text"))).alias("text_crc32"),
        F.struct(*[F.col(c) for c in carry]).alias("_carried") if carry else F.lit(None).cast("int").alias("_carried"),
        *[c.alias(f"_axis{k}") for k, c in enumerate(coordinates)],
    ).select(
        "doc_id", "size", "text_crc32", "_carried",
        curve(*[F.col(f"_axis{k}") for k in range(dims)]).alias("_cell"),
        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(salts)).cast("int").alias("_salt"),
    )
    if not carry:
        # Narrow rows, and read three times: the texts and the curve are gone through once.
        points, _ = stored(points, "points")
    # Rows before each (cell, salt): sums inside a stretch of cells, then over the 256 stretches.
    stretch = F.shiftright("_cell", max(dims * BITS - 8, 0)).alias("_stretch")
    units = points.groupBy("_cell", "_salt").agg(F.count(F.lit(1)).alias("_rows")).select("*", stretch)
    inside = Window.partitionBy("_stretch").orderBy("_cell", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    units = units.select("*", F.coalesce(F.sum("_rows").over(inside), F.lit(0)).alias("_inside"))
    across = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = units.groupBy("_stretch").agg(F.sum("_rows").alias("_rows")).select(
        "_stretch", F.coalesce(F.sum("_rows").over(across), F.lit(0)).alias("_across")
    )
    starts = units.join(stretches, "_stretch").select("_cell", "_salt", (F.col("_inside") + F.col("_across")).alias("_start"))
    order = Window.partitionBy("_cell", "_salt").orderBy("doc_id", "text_crc32", "size")
    ranked = points.join(starts, ["_cell", "_salt"]).select(
        "*", (F.col("_start") + F.row_number().over(order) - 1).alias("_rank")
    )
    least, more = divmod(bounds.n, shards)
    edge = more * (least + 1)
    rank = F.col("_rank")
    large, small = F.floor(rank / (least + 1)), more + F.floor((rank - edge) / max(least, 1))
    shard = F.when(rank < edge, large).otherwise(small).cast("int")
    start = F.col("shard") * least + F.least(F.col("shard"), F.lit(more))
    return ranked.select("*", shard.alias("shard")).select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (rank - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *[F.col(f"_carried.{c}").alias(f"doc_{c}" if c in ("size", "text_crc32", "law", "shard", "slot") else c) for c in carry if c != "doc_id"],
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40, **dims) -> None:
    """Write whole documents as one folder of Parquet per shard, in the order of their slots."""
    carry = [c for c in docs.columns if c != "doc_id"]
    placed = hilbert_shards(docs, shards, carry=carry, **dims).drop("law", "grown_shard")
    placed.repartition(shards, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
