"""Join operators.

Strategy is left to Catalyst and AQE: a side becomes a broadcast only when
the optimizer (or AQE at run time) measures it under
``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides shuffle on the
key and AQE splits skewed partitions.  Callers pass ``broadcast_right=True``
only for dimensions whose size is fixed by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pizarra.operators.clean import qcol


def _key_cond(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
              null_keys: str) -> Column:
    cond = None
    for lk, rk in zip(left_on, right_on):
        c = left[lk].eqNullSafe(right[rk]) if null_keys == "match" else left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return cond


def left_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
              null_keys: str = "sql", broadcast_right: bool = False) -> DataFrame:
    """Left join on differently named keys; both key columns are kept.

    ``null_keys="match"`` pairs a null key with a null key, as ``pd.merge``
    does; the default keeps SQL rules.
    """
    l_, r_ = left.alias("l"), right.alias("r")
    r_side = F.broadcast(r_) if broadcast_right else r_
    cond = None
    for lk, rk in zip(left_on, right_on):
        lc, rc = F.col(f"l.`{lk}`"), F.col(f"r.`{rk}`")
        c = lc.eqNullSafe(rc) if null_keys == "match" else lc == rc
        cond = c if cond is None else cond & c
    return l_.join(r_side, cond, "left").select("l.*", "r.*")


def merge(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None,
          left_on: Sequence[str] | None = None, right_on: Sequence[str] | None = None,
          how: str = "left", suffixes: tuple[str, str] = ("_x", "_y"),
          null_keys: str = "sql") -> DataFrame:
    """``pd.merge`` column layout.

    A shared key (``on``) appears once; other overlapping names get the
    suffixes; differently named keys are both kept.
    """
    on = list(on or [])
    left_on = list(left_on or [])
    right_on = list(right_on or [])
    l_, r_ = left.alias("l"), right.alias("r")
    cond = None
    for lk, rk in list(zip(on, on)) + list(zip(left_on, right_on)):
        lc, rc = F.col(f"l.`{lk}`"), F.col(f"r.`{rk}`")
        c = lc.eqNullSafe(rc) if null_keys == "match" else lc == rc
        cond = c if cond is None else cond & c
    joined = l_.join(r_, cond, how)
    overlap = (set(left.columns) & set(right.columns)) - set(on)
    cols = []
    for c in left.columns:
        if c in on:
            if how in ("right",):
                cols.append(F.col(f"r.`{c}`").alias(c))
            elif how in ("outer", "full"):
                cols.append(F.coalesce(F.col(f"l.`{c}`"), F.col(f"r.`{c}`")).alias(c))
            else:
                cols.append(F.col(f"l.`{c}`").alias(c))
        elif c in overlap:
            cols.append(F.col(f"l.`{c}`").alias(c + suffixes[0]))
        else:
            cols.append(F.col(f"l.`{c}`").alias(c))
    for c in right.columns:
        if c in on:
            continue
        name = c + suffixes[1] if c in overlap else c
        cols.append(F.col(f"r.`{c}`").alias(name))
    return joined.select(cols)


def semi_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> DataFrame:
    """``WHERE key IN (SELECT ...)``."""
    cond = _key_cond(left, right, left_on, right_on, "sql")
    return left.join(right, cond, "left_semi")


def anti_join(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str]) -> DataFrame:
    cond = _key_cond(left, right, left_on, right_on, "sql")
    return left.join(right, cond, "left_anti")


def unmatched_count(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                    name: str = "n_unmatched") -> DataFrame:
    """Rows of ``left`` without a partner after a left join.

    A left join keeps every left row once per match and once when unmatched;
    the unmatched ones are exactly the anti join, counted without the join
    fan-out.
    """
    return anti_join(left, right, left_on, right_on).agg(F.count(F.lit(1)).cast("long").alias(name))


def overlap_pairs(group_a: DataFrame, group_b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key tuples of group A that also occur in group B."""
    a = group_a.select([qcol(k) for k in keys]).distinct()
    return a.join(group_b.select([qcol(k) for k in keys]), list(keys), "left_semi")
