"""Type-1 upsert with stable surrogate keys, and insert-if-absent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmill.operators.prefix import dense_rank_by


class DuplicateKeyError(ValueError):
    """One batch brings the same natural key twice with different values."""


def reject_duplicates(incoming: DataFrame, keys: Sequence[str], table: str) -> None:
    """Stop if a natural key comes more than once; says how many do and names the first ten."""
    twice = incoming.groupBy(*keys).count().where("count > 1").drop("count")
    total = twice.count()
    if total:
        first = [tuple(r) for r in twice.orderBy(*keys).limit(10).collect()]
        raise DuplicateKeyError(f"{table}: {total} keys come more than once, the first are {first}")


def assign_keys(
    new: DataFrame, natural: str, surrogate: str, existing: DataFrame | None = None, last: int | None = None
) -> DataFrame:
    """Next free serial numbers for rows whose natural key has none yet; `last` is the highest given so far, if known."""
    if last is None:
        last = 0 if existing is None else existing.agg(F.max(surrogate)).first()[0] or 0
    return dense_rank_by(new, natural, surrogate, last)


def part_of(natural: str, parts: int) -> Column:
    """The part, 0 to `parts` - 1, that holds the rows of a natural key."""
    return F.pmod(F.xxhash64(F.col(natural).cast("bigint")), F.lit(parts)).cast("int")


def row_hash(columns: Sequence[str]) -> Column:
    """One number for the values of all columns; a NULL differs from every value, wherever it stands."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c), F.col(c).isNull())])


def upsert_changes(
    existing: DataFrame, incoming: DataFrame, natural: str, surrogate: str, updates: Sequence[str], stamp: str | None, parts: int
) -> DataFrame:
    """One row: repeated keys of the batch, keys added and changed, rows there will be, the highest surrogate key, parts concerned.

    Each side is read once, its natural key and a hash of the updated columns move. With a `stamp` every known
    key counts as changed.
    """
    batch = incoming.select(F.col(natural).alias("_nk"), row_hash(updates).alias("_new")).groupBy("_nk").agg(
        F.count(F.lit(1)).alias("_n"), F.any_value("_new").alias("_new"))
    stored = existing.select(F.col(natural).alias("_nk"), F.col(surrogate).alias("_sk"), row_hash(updates).alias("_old"))
    added = F.col("_sk").isNull()
    changed = F.col("_n").isNotNull() & (F.lit(True) if stamp else F.col("_new") != F.col("_old")) & ~added
    return stored.join(batch, "_nk", "full_outer").agg(
        F.count_if(F.col("_n") > 1).alias("repeated"), F.count_if(added).alias("added"), F.count_if(changed).alias("changed"),
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.max("_sk"), F.lit(0)).alias("last"),
        F.collect_set(F.when(added | changed, part_of("_nk", parts))).alias("parts"),
    )


def type1_upsert(
    existing: DataFrame | None,
    incoming: DataFrame,
    natural: str,
    surrogate: str,
    updates: Sequence[str],
    stamp: str | None = None,
    defaults: Mapping[str, str] | None = None,
    last: int | None = None,
) -> DataFrame:
    """Insert new natural keys and overwrite only `updates` on known ones.

    `incoming` has each natural key once (see `reject_duplicates`). An existing row keeps its
    surrogate key and every column not listed, even if the incoming value differs. A listed column
    takes the incoming value also when that is NULL. `stamp` is set to the current time on update; new
    rows have it too, unless `incoming` brings a value of its own, NULL included.
    A new row takes for a column that `incoming` lacks the SQL expression in `defaults`, or NULL. New keys
    follow `last`, by default the highest of `existing`.
    """
    if stamp and stamp not in incoming.columns:
        incoming = incoming.withColumn(stamp, F.current_timestamp())
    if existing is None:
        return assign_keys(incoming, natural, surrogate, last=last)

    news = incoming.select(
        F.col(natural).alias("_nk"),
        F.lit(True).alias("_seen"),
        *[F.col(c).alias(f"_new_{c}") for c in updates],
    )
    matched = existing.join(news, F.col(natural) == F.col("_nk"), "left")

    def kept(c: str):
        if c in updates:
            return F.when(F.col("_seen"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c == stamp:
            now = F.current_timestamp().cast(existing.schema[c].dataType)
            return F.when(F.col("_seen"), now).otherwise(F.col(c)).alias(c)
        return F.col(c)

    updated = matched.select(*[kept(c) for c in existing.columns])
    unknown = incoming.join(existing.select(natural), natural, "left_anti")
    added = assign_keys(unknown, natural, surrogate, existing, last)
    absent = [c for c in existing.columns if c not in added.columns]
    added = added.withColumns({c: F.expr((defaults or {}).get(c, "null")) for c in absent})
    return updated.unionByName(added.select(*existing.columns))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the least by `order`, then by the remaining columns.

    Keys that repeat are found first, by a hash aggregate on the keys alone. Only their rows are compared, in
    an aggregate too, so copies are dropped on the map side and a key with very many of them reaches its task
    as one row per map task. All other rows pass unsorted, as do rows whose key is not complete.
    """
    order = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_{k}") for k in keys])
    least = F.min(F.struct(*order, *rest)).alias("_row")
    copies = df.join(twice, same, "left_semi").groupBy(*keys).agg(least).select(*keys, "_row.*").select(*df.columns)
    return df.join(twice, same, "left_anti").unionByName(copies)


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None) -> DataFrame:
    """Add `_nth`: the place of each row among those of its key, as `first_per_key` orders them."""
    order = list(order or [])
    rest = [c for c in df.columns if c not in keys and c not in order]
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest)))


def insert_if_absent(
    existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None, complete: bool = False
) -> DataFrame:
    """The rows of `incoming` to add: one per key, and none whose key is already present.

    Keys that lie in buckets of their own are joined where they lie: only the batch is shuffled. The join is
    an outer one, because Spark would push an anti-join below the union of first rows and read `existing` twice.

    With `complete`, no key of `incoming` has a NULL. Rows then move once, instead of three times: each task keeps
    the first row of a key before the shuffle, so a key with very many copies still reaches its task as one row per
    map task.
    """
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    if complete:
        firsts = _numbered(incoming, keys, order).where("_nth = 1")
        if existing is not None:
            known = existing.select(*[F.col(k).alias(f"_{k}") for k in keys])
            # The condition on `_nth` keeps the join above the window: below it every copy would be moved.
            firsts = firsts.join(known, reduce(lambda a, b: a & b, [*same, F.col("_nth") == 1]), "left_anti")
        return firsts.select(*incoming.columns)
    firsts = first_per_key(incoming, keys, order)
    if existing is None:
        return firsts
    known = existing.select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_known"))
    return firsts.join(known, reduce(lambda a, b: a & b, same), "left").where("_known is null").select(*firsts.columns)


def insert_if_empty(existing: DataFrame | None, rows: DataFrame) -> DataFrame:
    """`rows` for an empty target; otherwise the target unchanged."""
    return rows if existing is None or existing.isEmpty() else existing
