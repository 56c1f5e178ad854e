"""Global positions and running totals without a single-partition window.

``row_number() OVER (ORDER BY k)`` with no ``PARTITION BY`` moves the whole
table into one task.  Here the table is range-partitioned and sorted by the
key (a distributed sort); ``monotonically_increasing_id`` then already holds
each row's partition and place in it, and the partitions' offsets are prefix
sums over one row per partition, read by index.  The numbered table is
checkpointed into the shared checkpoint folder so the partition boundaries
cannot change between the two passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pizarra.session import ensure_checkpoint_dir

POS = "_pos"      # 0-based position in the global order
CUM = "_cum"      # running sum of the weight, inclusive of the row
GROUP_POS = "_gpos"   # 0-based position within the group
GROUP_CUM = "_gcum"   # running sum within the group, inclusive of the row
GROUP_N = "_gn"       # rows of the group
_INDEX_BITS = 33      # of monotonically_increasing_id
_SALTS = 64


def with_running_totals(df: DataFrame, order: Sequence[Column], weight_col: str | None = None,
                        num_partitions: int | None = None) -> DataFrame:
    """Add ``_pos`` (0-based global row number) and, with ``weight_col``,
    ``_cum`` (its inclusive running sum) in the order ``order``.

    ``order`` must be a total order (add id tie-breaks) for a repeatable
    answer.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a per-row tie-break makes the sort key unique, so the range partitioner
    # can split a value that a third of the rows share across partitions
    tagged = df.withColumn("_tb", F.monotonically_increasing_id())
    order = [*order, F.col("_tb")]
    numbered = (tagged.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
                .withColumn("_mid", F.monotonically_increasing_id()).drop("_tb").checkpoint(eager=True))
    part = F.shiftright(F.col("_mid"), _INDEX_BITS).cast("int")
    aggs = [F.count(F.lit(1)).alias("n")]
    if weight_col:
        aggs.append(F.coalesce(F.sum(F.col(f"`{weight_col}`").cast("double")), F.lit(0.0)).alias("w"))
    rows = {r["p"]: r for r in numbered.groupBy(part.alias("p")).agg(*aggs).collect()}  # one row per partition
    off_n, off_w, acc_n, acc_w = [], [], 0, 0.0
    for p in range(max(rows, default=0) + 1):
        off_n.append(acc_n)
        off_w.append(acc_w)
        if p in rows:
            acc_n += rows[p]["n"]
            acc_w += rows[p]["w"] if weight_col else 0.0

    def offset(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), part + 1)

    index = F.col("_mid").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    out = [F.col(f"`{c}`") for c in df.columns] + [(offset(off_n) + index).cast("long").alias(POS)]
    if weight_col:
        within = Window.partitionBy(part).orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
        out.append((offset(off_w) + F.sum(F.coalesce(F.col(f"`{weight_col}`").cast("double"), F.lit(0.0))).over(within)).alias(CUM))
    return numbered.select(*out)


def with_group_positions(df: DataFrame, group: Column, order: Sequence[Column],
                         weight_col: str | None = None) -> DataFrame:
    """Add ``_gpos`` and ``_gn`` (and ``_gcum`` with a weight): position, size
    and running sum within the group, from the global numbering.

    The groups' starts are joined back on the group and a salt, so a group
    that holds a third of the rows is dealt to many tasks.
    """
    tagged = df.withColumn("_grp", group)
    numbered = with_running_totals(tagged, [F.col("_grp").asc_nulls_last(), *order], weight_col)
    aggs = [F.min(POS).alias("_start"), F.count(F.lit(1)).alias(GROUP_N)]
    if weight_col:
        aggs.append(F.min(F.struct(F.col(POS), (F.col(CUM) - F.coalesce(F.col(f"`{weight_col}`").cast("double"), F.lit(0.0))).alias("c")))["c"].alias("_cstart"))
    starts = numbered.groupBy("_grp").agg(*aggs).withColumnRenamed("_grp", "_grp2").withColumn(
        "_salt2", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    salted = numbered.withColumn("_salt", F.pmod(F.col(POS), F.lit(_SALTS)).cast("int"))
    j = salted.join(starts, F.col("_grp").eqNullSafe(F.col("_grp2")) & (F.col("_salt") == F.col("_salt2")))
    out = [F.col(f"`{c}`") for c in df.columns] + [(F.col(POS) - F.col("_start")).alias(GROUP_POS), F.col(GROUP_N)]
    if weight_col:
        out.append((F.col(CUM) - F.col("_cstart")).alias(GROUP_CUM))
    return j.select(*out)
