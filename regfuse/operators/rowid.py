"""Dense, deterministic row ids without a single-partition global sort.

A global ``row_number()`` plans ``Exchange SinglePartition``: every row goes
through one task.  Instead:

1. range-partition by the ordering (sampling picks balanced bounds, so no
   partition is hot as long as the ordering is unique) and sort each
   partition;
2. tag every row with its partition and its position in the partition
   (``monotonically_increasing_id`` keeps the position in the low 33 bits);
3. write the tagged rows once: both uses below read the same tags, and a lost
   executor takes nothing with it (``session.scratch`` removes the table);
4. count rows per partition (one row per partition - bounded by the partition
   count), turn counts into running offsets and broadcast that tiny table;
5. ``id = offset + position + 1``.

The ordering must be unique (add tie-breaking columns), otherwise rows that
tie may swap ids between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regfuse.functions.constants import ROW_BITS
from regfuse.session import freed, materialize

_POS_MASK = (1 << 33) - 1


def dense_row_ids(df: DataFrame, order_cols, id_col: str = "row_id", num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    ordered = [c.asc_nulls_last() for c in order_cols]
    tagged = (
        df.repartitionByRange(n, *ordered)
        .sortWithinPartitions(*ordered)
        .withColumn("_rid_part", F.spark_partition_id())
        .withColumn("_rid_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)))
    )
    with freed(spark):
        tagged = materialize(tagged)
    counts = tagged.groupBy("_rid_part").agg(F.count(F.lit(1)).alias("_rid_n"))
    before = Window.orderBy("_rid_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_rid_part", F.coalesce(F.sum("_rid_n").over(before), F.lit(0)).alias("_rid_off")
    )
    # one row per partition: size is bounded by ``n``, safe to broadcast
    out = (
        tagged.join(F.broadcast(offsets), "_rid_part")
        .withColumn(id_col, (F.col("_rid_off") + F.col("_rid_pos") + 1).cast("bigint"))
        .drop("_rid_part", "_rid_pos", "_rid_off")
    )
    out.materialized_path = tagged.materialized_path  # for ``session.remove``
    return out


def cell_order_key(file_rank, row_idx):
    """Unique, order-preserving bigint for (file order, sheet row).

    Rows fit in the low 32 bits (a sheet has at most 2**20), so ``file_rank << 32 | row`` never
    collides and sorts like (file, row)."""
    fr = F.col(file_rank) if isinstance(file_rank, str) else file_rank
    ri = F.col(row_idx) if isinstance(row_idx, str) else row_idx
    return F.shiftleft(fr.cast("bigint"), ROW_BITS) + ri.cast("bigint")
