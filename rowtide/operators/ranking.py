"""First-n and last-one per key, safe for keys that hold much of the table.

Both filter on ``row_number``, which Spark turns into a group limit that runs on every
input partition before the shuffle: a key with a billion rows sends at most ``n`` rows
per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide import types as V
from rowtide.errors import ConfigError
from rowtide.plans.sizing import scan_bytes, to_bytes

# Rows of one key that a single task may have to sort; beyond it keys are cut into parts.
ROWS_PER_TASK = 200_000_000
# Without a group limit before the shuffle nothing bounds a key: always this many parts.
UNBOUNDED_SALTS = 256
_RANK, _SALT = "__rank", "__salt"


def _ranked(df: DataFrame, keys: Sequence[Column], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= n).drop(_RANK)


def total_order(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """``order`` followed by every other column, so that no two different rows tie."""
    return [*order, *[c for c in df.columns if c not in order and c not in keys]]


def salts_for(df: DataFrame, n: int) -> int:
    """Into how many parts each key is cut before it is ranked as a whole.

    A key sends at most ``n`` rows per input task.  One part, and so one shuffle, is
    enough until that product becomes too much for the task that gets the key.
    """
    conf = df.sparkSession.conf
    if n > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return UNBOUNDED_SALTS
    size = scan_bytes(df)
    if size is None:
        return 1
    tasks = 1 + size // to_bytes(conf.get("spark.sql.files.maxPartitionBytes", "128MB"))
    return min(UNBOUNDED_SALTS, 1 + n * tasks // ROWS_PER_TASK)


def first_n(
    df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str] = (), salts: int | None = None
) -> DataFrame:
    """The first ``n`` rows of every key, in ascending ``order``.

    Ties are broken by the remaining columns.  With ``salts`` rows are first ranked
    within parts of each key, then the survivors within the key: whatever is among the
    first ``n`` of a key is among the first ``n`` of its part.
    """
    if n < 1:
        raise ConfigError("a limit must be at least 1")
    full = total_order(df, keys, order)
    by, key_columns = [V.col(c) for c in full], [V.col(c) for c in keys]
    salts = salts or salts_for(df, n)
    if salts > 1 and full:
        # Copies of one row share a part; the group limit before the shuffle bounds them.
        df = df.withColumn(_SALT, F.pmod(F.xxhash64(*by), F.lit(salts)))
        df = _ranked(df, [*key_columns, F.col(_SALT)], by, n).drop(_SALT)
    return _ranked(df, key_columns, by or key_columns, n)


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the last in ``order``, ties broken by the remaining columns.

    A null in a key equals nothing, so every row with one stays.
    """
    if not keys:
        raise ConfigError("last-wins needs key columns")
    by = [V.col(c).desc() for c in total_order(df, keys, order)]
    key_columns = [V.col(c) for c in keys]
    alone = F.when(_lacks(keys), F.monotonically_increasing_id())
    if not by:
        return df.withColumn(_SALT, alone).distinct().drop(_SALT)
    return _ranked(df.withColumn(_SALT, alone), [*key_columns, F.col(_SALT)], by, 1).drop(_SALT)


def _lacks(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [V.col(k).isNull() for k in keys])


def upsert_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The rows of an upsert, one per key.

    A null key would be added again by every repetition of the upsert, so it is refused.
    """
    message = F.lit(f"an upsert needs values in its key columns {list(keys)}")
    whole = F.coalesce(F.when(_lacks(keys), F.raise_error(message)).cast("boolean"), F.lit(True))
    return dedup_last(df.where(whole), keys, order)
