"""Sharding (11): rendezvous hashing of stable keys over weighted shards, in Spark functions only.

Every shard draws a number for every key, from a hash of both; the shard of the best weight / -ln(number)
has the record. A shard's share of the keys is its weight's share of all weights, and its draws do not
depend on other shards: a shard that comes takes records only into itself, one that goes or loses weight
gives records away, and no record moves between the others.

Slots number the rows of a shard from 0 in the order of another hash, of key, size and checksum, so a
shard is shuffled and its order does not depend on the cluster. Hashes are uniform: ranges of them hold
equal shares of a shard, and numbering runs inside ranges that know how many rows stand before them.
Equal rows are counted first and cross the network as one; beyond COPIES of them, each further COPIES have
a place of their own in the order, so a row that makes up a third of the table is spread as well.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmill.session import written

#: Sixteen shards of equal weight.
SHARDS = {i: 1.0 for i in range(16)}
COPIES = 4096
#: Ranges of all shards together, the rows of the one table that is broadcast; a hash digit has 16 values.
MAX_RANGES = 1 << 16


def _checked(weights: Mapping[int, float]) -> dict[int, float]:
    if not weights or min(weights.values()) <= 0:
        raise ValueError("shards need weights above 0")
    return {int(s): float(w) for s, w in weights.items()}


def _drawn(key: Column, shard: Column) -> Column:
    """A number inside (0, 1) that depends on key and shard alone: 52 bits of an MD5, exact as a double."""
    digits = F.substring(F.md5(F.concat(key, F.lit("/"), shard.cast("string")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def _key(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bid(key: Column, shard: Column, weight: Column) -> Column:
    """What a shard offers for a key; the highest bid has it."""
    return weight / -F.log(_drawn(key, shard))


def best_bid(key: Column, weights: Mapping[int, float]) -> Column:
    """struct(bid, shard) of the shard that has the key; of equal bids the lowest number wins."""
    offers = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(w).alias("weight")) for s, w in _checked(weights).items()])
    bids = F.transform(offers, lambda o: F.struct(bid(key, o["shard"], o["weight"]).alias("bid"), (-o["shard"]).alias("less")))
    best = F.array_max(bids)
    return F.struct(best["bid"].alias("bid"), (-best["less"]).alias("shard"))


def place(docs: DataFrame, weights: Mapping[int, float] = SHARDS, key: str = "doc_id") -> DataFrame:
    """All rows and columns of `docs` with the `shard` of their key; a column of that name is replaced.

    Rows without a key have the key ''. No row is shuffled.
    """
    return docs.withColumn("shard", best_bid(_key(key), weights)["shard"])


def write_shards(docs: DataFrame, path: str, weights: Mapping[int, float] = SHARDS, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Write `docs`, texts included, into a folder for each shard, and return the manifest.

    Inside a shard rows are dealt into files by ranges of the slot order, which `_order` holds, and
    sorted by it. The manifest has shard, n_rows and n_bytes (size as in `slots`). An empty table gives
    an empty manifest.
    """
    size, crc = _size(text), _crc(text)
    rows = place(docs, weights, key).withColumn("_order", _order(_key(key), size, crc, F.lit(0)))
    ranged = rows.withColumn("_range", F.substring("_order", 1, _digits(docs, len(weights))))
    # Copies of one row have one order; what task read them keeps them from meeting in one file.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ranged.withColumn("_salt", F.spark_partition_id() % tasks)
    dealt = ranged.repartition("shard", "_range", "_salt").sortWithinPartitions("shard", "_order").drop("_range", "_salt")
    dealt.write.partitionBy("shard").parquet(path)
    back = docs.sparkSession.read.schema(dealt.schema).parquet(path)
    return back.groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(_size(text)).alias("n_bytes"))


def _size(text: str) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _crc(text: str) -> Column:
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def _order(key: Column, size: Column, crc: Column, copies: Column) -> Column:
    return F.md5(F.concat_ws("/", key, size.cast("string"), crc.cast("string"), copies.cast("string")).cast("binary"))


def _digits(docs: DataFrame, shards: int) -> int:
    """Leading hash digits that tell ranges apart: four ranges a shuffle partition, within MAX_RANGES."""
    wanted = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    digits = 0
    while shards << (4 * digits) < wanted and shards << (4 * digits + 4) <= MAX_RANGES:
        digits += 1
    return digits


def slots(docs: DataFrame, weights: Mapping[int, float] = SHARDS, new_shard: int | None = None, new_weight: float = 1.0,
          key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard): one row per row of `docs`.

    `size` is the text's bytes in UTF-8 plus 1, `slot` numbers the rows of a shard from 0 without gaps,
    `grown_shard` is the shard once `new_shard` (by default the next number) has come. A null text counts
    as empty; rows without a key share the key ''; repeated rows have slots of their own; other columns
    are ignored; an empty table gives no rows.
    """
    weights = _checked(weights)
    new_shard = max(weights) + 1 if new_shard is None else new_shard
    rows = docs.select(F.col(key).alias("_key"), _size(text).alias("size"), _crc(text).alias("text_crc32"))
    counted = rows.groupBy("_key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    many = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_n - 1) div {COPIES}")))
    parts = counted.select("*", many.alias("_part")).withColumn("_n", F.least(F.lit(COPIES).cast("long"), F.col("_n") - F.col("_part") * COPIES))
    own = _key("_key")
    ordered = written(
        parts.withColumns({"_best": best_bid(own, weights), "_order": _order(own, F.col("size"), F.col("text_crc32"), F.col("_part"))})
        .withColumns({
            "shard": F.col("_best.shard").cast("int"),
            "grown_shard": F.when(bid(own, F.lit(new_shard), F.lit(float(new_weight))) > F.col("_best.bid"), F.lit(new_shard))
            .otherwise(F.col("_best.shard")).cast("int"),
            "_range": F.substring("_order", 1, _digits(docs, len(weights))),
        }).drop("_best"),
        "slots",
    )
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ordered.groupBy("shard", "_range").agg(F.sum("_n").alias("_rows")).select(
        "shard", "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_range").orderBy("_order", "_key", "size", "text_crc32", "_part").rowsBetween(Window.unboundedPreceding, -1)
    first = ordered.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(F.broadcast(offsets), ["shard", "_range"])
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))
    return first.select("*", copies.alias("_copy")).select(
        F.col("_key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("_before") + F.col("_inside") + F.col("_copy")).alias("slot"), "grown_shard",
    )


def moves(docs: DataFrame, old: Mapping[int, float], new: Mapping[int, float], key: str = "doc_id") -> DataFrame:
    """(shard, new_shard, n_rows): what a change of shards or weights moves, kept rows included."""
    own = _key(key)
    return docs.select(best_bid(own, old)["shard"].alias("shard"), best_bid(own, new)["shard"].alias("new_shard")).groupBy(
        "shard", "new_shard").agg(F.count(F.lit(1)).alias("n_rows"))
