"""Keyed loads: insert-if-absent and replace-by-key.

Both are functions of (stored rows, batch) and leave writing to the caller. Duplicates inside a
batch are settled with row_number() = 1, which Spark evaluates before the shuffle as well as after
it (WindowGroupLimit): a key with very many copies sends one row per task, not all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def has_required(columns: Sequence[str]) -> Column:
    return reduce(and_, (F.col(c).isNotNull() for c in columns), F.lit(True))


def split_required(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows with a NULL in a required column)."""
    return df.filter(has_required(columns)), df.filter(~has_required(columns))


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def first_per_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return _one_per_key(df, keys, F.col(seq).asc())


def last_per_key(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    return _one_per_key(df, keys, F.col(seq).desc())


#: Keys up to which a batch's keys are looked up one by one in the stored table.
LOOKED_UP = 2_000


def has_key(key: str) -> Column:
    return F.col(key).isNotNull()


def with_keys(existing: DataFrame, keys: DataFrame, key: str, n_keys: int) -> DataFrame:
    """The stored rows that may have one of n_keys keys: the table itself if these are over LOOKED_UP, else a scan
    for them, which reads only what may hold one by the bounds and Bloom filters of row groups and pages."""
    if n_keys > LOOKED_UP:
        return existing
    values = [r[0] for r in keys.select(key).filter(has_key(key)).limit(LOOKED_UP + 1).collect()]
    return existing.filter(F.col(key).isin(values))


def staged_batch(df: DataFrame, key: str, seq: str, required: Sequence[str] = ()) -> DataFrame:
    """df's rows, the first complete one of each key only, with copies (complete rows that had its key) and complete.
    Incomplete rows and those without a key stay, each with one copy; seq becomes text.

    One shuffle, with copies counted before it. Rows that are not reduced are spread evenly."""
    own = has_required(required)
    alone = ~own | ~has_key(key)
    spread = F.when(alone, F.monotonically_increasing_id())
    row = F.struct(*(c for c in df.columns))
    return (
        df.select(
            F.when(~alone, F.col(key)).alias("_key"), spread.alias("_alone"), own.alias("complete"),
            F.col(seq).alias("_order"), row.alias("_row"),
        )
        .groupBy("_key", "_alone", "complete")
        .agg(F.min_by("_row", "_order").alias("_row"), F.count(F.lit(1)).alias("copies"))
        .select("_row.*", "copies", "complete")
        .withColumn(seq, F.to_json(F.struct(seq)))
    )


def unstored(
    existing: DataFrame, unique: DataFrame, key: str, n_keys: int, large_batch: bool = False
) -> DataFrame:
    """Of rows with at most one for each key, those whose key is not stored; NULL keys never match.

    For up to LOOKED_UP keys the stored table is scanned for just these. For more, the stored keys that the rows also
    have are found first, which shuffles none of the stored table as long as the rows' keys can be broadcast.
    Far beyond that say `large_batch`: both sides meet on one shuffle by the key."""
    keyed = unique.filter(has_key(key))
    taken = with_keys(existing, keyed, key, n_keys).select(key)
    if n_keys > LOOKED_UP and not large_batch:
        taken = taken.join(keyed.select(key), key, "left_semi")
    fresh = keyed.join(taken, key, "left_anti").select(*existing.columns)
    return fresh.unionByName(unique.filter(~has_key(key)).select(*existing.columns))


def absent_rows(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    seq: str,
    required: Sequence[str] = (),
    large_batch: bool = False,
) -> DataFrame:
    """The batch rows that insert-if-absent adds, in the columns of `existing`.

    Rows without a required value are skipped; of several batch rows with one key the first
    complete one counts; NULL keys never match, so all such rows are added.

    The stored keys that the batch also has are found first, by a semi-join. Its right side is the
    distinct batch keys, so as long as those fit Spark's broadcast limit the stored table is
    scanned for its key column only and is not shuffled, whatever its size. For a batch whose keys
    are far beyond that, say `large_batch`: it is then shuffled by its key once, and meets the stored
    keys on the same partitioning. The rows are the same.
    """
    complete, _ = split_required(incoming, required)
    keyed = complete.filter(F.col(key).isNotNull())
    taken = existing.select(key)
    if not large_batch:
        taken = taken.join(keyed.select(key).distinct(), key, "left_semi")
    fresh = first_per_key(keyed, [key], seq).join(taken, key, "left_anti")
    # NULL keys go around the shuffle, where they would all meet in one partition.
    unkeyed = complete.filter(F.col(key).isNull())
    return fresh.select(*existing.columns).unionByName(unkeyed.select(*existing.columns))


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, key: str, seq: str, required: Sequence[str] = ()
) -> DataFrame:
    """Stored rows win. To store the result, append absent_rows() instead of rewriting it all."""
    return existing.unionByName(absent_rows(existing, incoming, key, seq, required))


def fail_on_null_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    return df.withColumns(
        {
            k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL in key column {k}")).cast(types[k]))
            for k in keys
        }
    )


def replace_by_key(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], seq: str
) -> DataFrame:
    """Batch rows win, the last of them if a key repeats; stored keys not in the batch stay."""
    incoming = fail_on_null_key(incoming, keys)
    kept = existing.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*existing.columns).unionByName(
        last_per_key(incoming, keys, seq).select(*existing.columns)
    )


def insert_counts(
    existing: DataFrame, incoming: DataFrame, key: str, seq: str, required: Sequence[str] = ()
) -> DataFrame:
    """One row: stored rows before, batch rows, rejected and inserted rows, stored rows after."""
    parts = [
        existing.select(F.lit("before").alias("part")),
        incoming.select(
            F.when(has_required(required), F.lit("complete")).otherwise("rejected").alias("part")
        ),
        absent_rows(existing, incoming, key, seq, required).select(F.lit("new").alias("part")),
    ]
    part = F.col("part")
    return reduce(DataFrame.unionByName, parts).agg(
        F.count_if(part == "before").alias("rows_before"),
        F.count_if(part.isin("complete", "rejected")).alias("batch_rows"),
        F.count_if(part == "rejected").alias("rejected_rows"),
        F.count_if(part == "new").alias("inserted_rows"),
        F.count_if(part.isin("before", "new")).alias("rows_after"),
    )


def replace_counts(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: stored rows before, replaced and inserted keys, stored rows after."""
    old = existing.select(*keys, F.lit(1).alias("old"), F.lit(0).alias("new"))
    new = fail_on_null_key(incoming, keys).select(
        *keys, F.lit(0).alias("old"), F.lit(1).alias("new")
    )
    per_key = old.unionByName(new).groupBy(*keys).agg(
        F.sum("old").alias("n_old"), F.max("new").alias("in_batch")
    )
    in_batch = F.col("in_batch") == 1
    return per_key.agg(
        F.coalesce(F.sum("n_old"), F.lit(0)).alias("rows_before"),
        F.count_if(in_batch & (F.col("n_old") > 0)).alias("replaced_rows"),
        F.count_if(in_batch & (F.col("n_old") == 0)).alias("inserted_rows"),
        F.coalesce(
            F.sum(F.when(in_batch, F.lit(1)).otherwise(F.col("n_old"))), F.lit(0)
        ).alias("rows_after"),
    )
