"""SCD type 1 change flow, batch form.

Semantics (whole-row replacement, upsert only):

* one row per key survives: the highest ``sequence_by``;
* a NULL sequence loses to every non-NULL one and survives only when the
  key has nothing else;
* equal sequences are broken by ``tie_breakers`` and then by every other
  column (descending, NULLs last), so the winner never depends on task or
  file order;
* rows with a NULL key are rejected before the flow.

Physical plan: ``row_number() = 1`` over a window partitioned by the keys.
Spark plans a partial ``WindowGroupLimit`` before the shuffle, so each map
task sends at most one row per key: a hot key costs one row per task, not
one row per input record.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__scd_rn"


def scd1_order(df: DataFrame, keys: Sequence[str], sequence_by: str,
               tie_breakers: Sequence[str] = ()) -> list[str]:
    """The columns by which rows of one key are compared, highest first."""
    first = [sequence_by, *[t for t in tie_breakers if t != sequence_by]]
    rest = [c for c in df.columns if c not in set(keys) | set(first)]
    return [*first, *rest]


def _order(df: DataFrame, keys: Sequence[str], sequence_by: str,
           tie_breakers: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in scd1_order(df, keys, sequence_by, tie_breakers)]


def key_not_null(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def scd1_latest(df: DataFrame, keys: Sequence[str], sequence_by: str,
                tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Current state per key of a change feed (batch)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(*_order(df, keys, sequence_by, tie_breakers))
    return (df.filter(key_not_null(keys))
              .withColumn(_RN, F.row_number().over(w))
              .filter(F.col(_RN) == 1)
              .drop(_RN))


def scd1_merge(base: DataFrame | None, changes: DataFrame, keys: Sequence[str],
               sequence_by: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """New current state = latest per key over (current state + changes).

    The base already holds one row per key, so applying an old batch again
    (a replay) or a late, older row leaves the state unchanged.
    """
    changes = changes.select(*base.columns) if base is not None else changes
    src = changes if base is None else base.unionByName(changes)
    return scd1_latest(src, keys, sequence_by, tie_breakers)
