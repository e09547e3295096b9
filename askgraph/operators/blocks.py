"""Joins whose hot keys are cut into blocks.

A key with n rows on one side and m on the other gives n * m result rows. One
task would have to produce them all, however the key is hashed. Here the rows
of a key are dealt into blocks by a second column, and every pair of blocks
becomes a join key of its own: no task works on more than ``block`` rows of one
key and side, and the result is whole. Keys below the block size, normally all
of them, keep a single block and are not copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from askgraph.session import shared_folder, staged

BLOCK = 2000
LOOKUP_SALTS = 16


def spread_lookup(rows: DataFrame, table: DataFrame, key: str, by: Column, how: str) -> DataFrame:
    """Join ``rows``, which may hold a hot key, to a small ``table`` unique on the key.

    ``by`` deals the rows of a key over salts and the table is repeated once
    per salt, so a hot key is met in that many tasks.
    """
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(LOOKUP_SALTS)).cast("int"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(LOOKUP_SALTS - 1)))
    salted_table = table.withColumn("_salt", salts)
    return salted_rows.join(salted_table, [key, "_salt"], how).drop("_salt")


def key_sizes(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Rows per key. Partial counts are combined before the shuffle.

    ``value`` is never null. Counting it instead of rows keeps it in the plan,
    so that the input is the one the join uses and is shuffled once for both.
    """
    return rows.groupBy(key).agg(F.count(value).alias("_size"))


def _blocks(size: str, block: int) -> Column:
    return F.coalesce(F.ceil(F.col(size) / F.lit(block)), F.lit(1)).cast("int")


def _deal(by: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(by), blocks).cast("int")


def with_sizes(rows: DataFrame, sizes: DataFrame, key: str, by: str, above: int) -> DataFrame:
    """Add ``_size``, the rows of the key, where it is ``above`` the bound; else null."""
    big = sizes.where(F.col("_size") > above)
    return spread_lookup(rows, big, key, F.col(by), "left")


def self_join_cells(sized: DataFrame, member: str, block: int = BLOCK) -> DataFrame:
    """Prepare unordered pairs within a key, for rows that went through ``with_sizes``.

    Members of a key are dealt into blocks. Cell ``(lo, hi)`` of the key holds
    blocks ``lo`` and ``hi``; a member goes to the cells its block is part of.
    Two members meet in exactly one cell.
    """
    dealt = sized.withColumn("_blocks", _blocks("_size", block)).withColumn(
        "_block", _deal(F.col(member), F.col("_blocks"))
    )
    others = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (
        dealt.withColumn("_other", others)
        .withColumn("_lo", F.least("_block", "_other"))
        .withColumn("_hi", F.greatest("_block", "_other"))
        .drop("_size", "_blocks", "_other")
    )


def unordered_pairs(cells: DataFrame, key: str, member: str, with_self: bool = False) -> DataFrame:
    """Join the cells with themselves; every pair of members of a key comes once.

    Both sides are the same relation, so Spark shuffles it once. The sides are
    the aliases ``a`` and ``b``.
    """
    a, b = cells.alias("a"), cells.alias("b")
    same_cell = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (key, "_lo", "_hi")]
    mine, other = F.col(f"a.{member}"), F.col(f"b.{member}")
    in_order = mine <= other if with_self else mine < other
    within = (F.col("a._lo") == F.col("a._hi")) & in_order
    across = F.col("a._block") < F.col("b._block")
    return a.join(b, same_cell[0] & same_cell[1] & same_cell[2] & (within | across))


def blocked_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_by: str,
    right_by: str,
    block: int = BLOCK,
) -> DataFrame:
    """Inner many-to-many equi-join on ``key`` in blocks of either side.

    Keys beyond a block are found first, from two counts, and written once; both
    sides are usually written tables, so nothing is joined twice for that.
    Without such a key a plain join does.
    """
    sizes_left = left.groupBy(key).agg(F.count("*").alias("_left"))
    sizes_right = right.groupBy(key).agg(F.count("*").alias("_right"))
    big = (
        sizes_left.join(sizes_right, key)
        .where((F.col("_left") > block) | (F.col("_right") > block))
        .select(
            key,
            _blocks("_left", block).alias("_left"),
            _blocks("_right", block).alias("_right"),
        )
    )
    big = staged(left.sparkSession, big, "hot-keys")
    if big.isEmpty():
        return left.join(right, key)

    def cells(side: DataFrame, by: str, own: str, opposite: str) -> DataFrame:
        count = {c: F.coalesce(F.col(c), F.lit(1)) for c in ("_left", "_right")}
        return (
            spread_lookup(side, big, key, F.col(by), "left")
            .withColumn(f"_block{own}", _deal(F.col(by), count[own]))
            .withColumn(
                f"_block{opposite}", F.explode(F.sequence(F.lit(0), count[opposite] - 1))
            )
            .drop("_left", "_right")
        )

    on = [key, "_block_left", "_block_right"]
    return (
        cells(left, left_by, "_left", "_right")
        .join(cells(right, right_by, "_right", "_left"), on)
        .drop("_block_left", "_block_right")
    )


def repeat_rows(rows: DataFrame, count: str, number: str | None = None, step: int = 10_000) -> DataFrame:
    """Every row ``count`` times. Two short arrays instead of one as long as the count.

    With ``number`` the copies of a row are numbered from 1 in a column of that name.
    """
    zero = F.lit(0).cast("bigint")
    last = F.floor((F.col(count) - 1) / step)
    left = F.col(count) - F.col("_round") * step
    copies = rows.withColumn("_round", F.explode(F.sequence(zero, last))).withColumn(
        "_copy", F.explode(F.sequence(zero + 1, F.least(left, zero + step)))
    )
    if number:
        copies = copies.withColumn(number, F.col("_round") * step + F.col("_copy"))
    return copies.drop(count, "_round", "_copy")


def with_positions(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Add ``position``, the place of a row in its key's list by ``order``, from 0.

    The rows are range-partitioned by key and order, so a key with a list of any
    length spans as many partitions as needed. The position is the place in the
    partition plus the key's rows in earlier partitions; those counts are at
    most one row per key and partition. The sorted rows are read twice and must
    be the same both times, hence the checkpoint.
    """
    shared_folder(rows.sparkSession)
    placed = (
        rows.repartitionByRange(F.col(key), *order)
        .sortWithinPartitions(F.col(key), *order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_slot", 33))
        .checkpoint()
    )
    parts = placed.groupBy(key, "_part").agg(
        F.min("_slot").alias("_first"), F.count("*").alias("_rows")
    )
    earlier = (
        Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0).cast("bigint"))
    starts = parts.select(key, "_part", (before - F.col("_first")).alias("_shift"))
    return (
        placed.join(starts, [key, "_part"])
        .withColumn("position", F.col("_slot") + F.col("_shift"))
        .drop("_slot", "_part", "_shift")
    )
