"""Document fingerprints (2): closed syncmers, in Spark's own functions only.

A text is cut into tokens: runs of up to TOKEN characters that are not white space. In a run of more than
WORD characters, or one of a script written without spaces, a token of TOKEN characters begins at every
character instead, so that where the run begins does not matter. Its k-mers are runs of four tokens, their
inner substrings pairs of tokens. A k-mer is an anchor, a 32-bit hash, if the smallest of its three pairs,
by hash, lies at an edge. That depends on the k-mer alone, so a passage has the same anchors wherever it
stands. A fingerprint holds all distinct anchors of a text. Two texts are alike by the share of the
anchors in their fingerprints that both have, and aligned by the anchors that stand in both at one and the
same shift of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesmill.operators.prefix import cut_points, range_count, with_ranges

TOKEN, WORD = 8, 16
_SCRIPTS = "".join(rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Bopomofo", "Yi", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))
_UNSPACED = rf"\S{{{WORD + 1}}}|[{_SCRIPTS}]"


def _tokens(text: Column) -> Column:
    def cut(part: Column) -> Column:
        return F.regexp_extract_all(part, F.lit(rf"(\S{{1,{TOKEN}}})"), F.lit(1))

    def run_tokens(run: Column) -> Column:
        each = F.regexp_extract_all(run, F.lit(rf"(?=(\S{{{TOKEN}}}))\S"), F.lit(1))
        return F.when(run.rlike(_UNSPACED) & (F.char_length(run) > TOKEN), each).otherwise(cut(run))

    runs = F.regexp_extract_all(text, F.lit(r"(\S+)"), F.lit(1))
    return F.when(text.rlike(_UNSPACED), F.flatten(F.transform(runs, run_tokens))).otherwise(cut(text))


def anchors(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, position, anchor) for each closed syncmer: the token it begins at and its hash.

    A text of one to three tokens is one anchor at 0; a null text or one without tokens has none.
    """
    rows = _with_pairs(docs.select(key, F.col(text).alias("_text")), "_text", "")
    return rows.select(key, F.posexplode(_all_anchors("_pairs", "_tokens")).alias("position", "anchor")).where("anchor is not null")


def _with_pairs(docs: DataFrame, text: str, suffix: str) -> DataFrame:
    tokens, pairs, hashes = f"_tokens{suffix}", f"_pairs{suffix}", f"_hashes{suffix}"
    return (
        docs.withColumn(tokens, _tokens(F.coalesce(F.col(text), F.lit(""))))
        .withColumn(hashes, F.transform(tokens, lambda t: F.xxhash64(t)))
        .withColumn(
            pairs,
            F.zip_with(hashes, F.slice(hashes, 2, F.greatest(F.size(hashes) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b)),
        )
        .drop(hashes)
    )


def _all_anchors(pairs: str, tokens: str) -> Column:
    """For each k-mer its hash if it is an anchor, else null; in token order."""
    p = F.col(pairs)
    n = F.size(tokens)

    def short_hash(*parts: Column) -> Column:
        return F.xxhash64(*parts).bitwiseAND(F.lit(0xFFFFFFFF))

    def kmer(first: Column, i: Column) -> Column:
        middle, last = F.get(p, i + 1), F.get(p, i + 2)
        return F.when((i < n - 3) & ~((middle < first) & (middle < last)), short_hash(first, last))

    short = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(F.array(short_hash(F.array_join(tokens, " "))))
    return F.when(n < 4, short).otherwise(F.transform(p, kmer))


def _distinct(places: Column) -> Column:
    return F.array_distinct(F.array_compact(places))


def _written(anchors: str) -> Column:
    """All distinct anchors as numbers, in the order of the text."""
    return F.array_join(F.col(anchors).cast("array<string>"), " ")


def _likeness(x: str, y: str, common: str) -> Column:
    """Share of the distinct anchors of two texts that both have; 1 if both have none."""
    n = F.size(common)
    total = F.size(x) + F.size(y) - n
    return F.when(total == 0, F.lit(1.0)).otherwise(n / total)


def _with_match(rows: DataFrame, x: str, y: str, common: str, out: str) -> DataFrame:
    """Add the most anchors of `x` that stand in `y` at one shift of positions. An anchor that repeats
    is matched from its last place in `x` to its first in `y`.
    """

    def at(places: str, side: int) -> Column:
        return F.transform(places, lambda a, i: F.struct(a.alias("anchor"), F.lit(side).alias("side"), i.alias("place")))

    both = F.filter(F.concat(at(x, 0), at(y, 1)), lambda e: e["anchor"].isNotNull())
    none = F.array().cast("array<struct<anchor:bigint,side:int,place:int>>")
    rows = rows.withColumn("_both", F.when(F.size(common) > 0, F.sort_array(both)).otherwise(none))

    def shift(e: Column, following: Column) -> Column:
        meet = (e["anchor"] == following["anchor"]) & (e["side"] < following["side"])
        return F.when(meet, following["place"] - e["place"])

    after = F.slice("_both", 2, F.greatest(F.size("_both"), F.lit(1)))
    rows = rows.withColumn("_shifts", F.sort_array(F.array_compact(F.zip_with("_both", after, shift))))

    def count(seen: Column, value: Column) -> Column:
        run = F.when(seen["value"] == value, seen["run"] + 1).otherwise(F.lit(1))
        return F.struct(value.alias("value"), run.alias("run"), F.greatest(seen["best"], run).alias("best"))

    start = F.struct(F.lit(None).cast("int").alias("value"), F.lit(0).alias("run"), F.lit(0).alias("best"))
    best = F.aggregate("_shifts", start, count, lambda seen: seen["best"].cast("long"))
    return rows.withColumn(out, best).drop("_both", "_shifts")


def with_anchors(docs: DataFrame, text: str, out: str) -> DataFrame:
    """Add an array `out` with an entry for each place of `text`: the anchor that begins there, or null."""
    return _with_pairs(docs, text, "_fp").withColumn(out, _all_anchors("_pairs_fp", "_tokens_fp")).drop("_pairs_fp", "_tokens_fp")


def _with_next(docs: DataFrame) -> DataFrame:
    """Add `places` and `anchors` of the row, and `next_text`, `next_places` and `next_anchors`, those of the
    next row by descending doc_id; the last row's next is the first. Rows that share a doc_id are in the order
    of their texts; rows without one come last, dealt into ranges by a hash of their texts.

    Rows are dealt into ranges of doc_id by value. The first row of every range also stands, as a
    guest, at the end of the range before, so each range finds all its neighbours by itself and each
    text crosses the network once.
    """
    spark = docs.sparkSession
    # Several ranges for each partition, so that chance evens out what a partition gets.
    ranges = range_count(docs, 8 * range_count(docs))
    # The first rows below are found by a query of their own, so both must cut at the same ids.
    ranged = with_ranges(docs.select("doc_id", "text"), "doc_id", ranges, cut_points(docs, "doc_id", ranges))
    unnamed = -1 - F.pmod(F.xxhash64("text"), F.lit(range_count(docs))).cast("int")
    ranged = ranged.withColumn("range", F.when(F.col("doc_id").isNull(), unnamed).otherwise(F.col("_range"))).drop("_range")
    order = [F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")]
    # The first row of each range: at most MAX_RANGES of them, found on ids and then on equal ids only.
    tops = ranged.groupBy("range").agg(F.max("doc_id").alias("top")).orderBy(F.desc("range")).collect()
    if not tops:
        nothing = F.array().cast("array<bigint>")
        return ranged.withColumns({"next_text": F.col("text"), **dict.fromkeys(("places", "anchors", "next_places", "next_anchors"), nothing)})
    before = {tops[i]["range"]: tops[i - 1]["range"] for i in range(len(tops))}
    host = F.create_map(*[x for r, b in before.items() for x in (F.lit(r), F.lit(b))])
    heads = spark.createDataFrame([(r["range"], r["top"]) for r in tops], f"range int, top {docs.schema['doc_id'].dataType.simpleString()}")
    firsts = (
        ranged.join(F.broadcast(heads), "range").where(F.col("doc_id").eqNullSafe(F.col("top")))
        .groupBy("range").agg(F.min(F.struct(F.col("text").isNotNull(), "doc_id", "text")).alias("first"))
        .select(F.element_at(host, F.col("range")).alias("range"), "first.doc_id", "first.text", F.lit(True).alias("guest"))
    )
    rows = ranged.select("range", "doc_id", "text", F.lit(False).alias("guest")).unionByName(firsts).repartition("range")
    rows = with_anchors(rows, "text", "places").withColumn("anchors", _distinct(F.col("places")))
    along = Window.partitionBy("range").orderBy("guest", *order)
    following = {f"next_{c}": F.lead(c).over(along) for c in ("text", "places", "anchors")}
    return rows.withColumns(following).where("not guest").drop("guest", "range")


def edited_text(text: Column, following: Column) -> Column:
    """`text` with its last floor(n / 3) characters replaced by the first as many of `following`."""
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut), F.substring(following, F.lit(1), cut))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, aligned_edited, aligned_next.

    A fingerprint is the list of all distinct anchors of a text, written as numbers; near_* is the likeness of
    two of these lists. `aligned_edited` counts the anchors that stand at the same place in the edited text,
    which keeps the beginning; `aligned_next` those at any one shift in the next. A null text is empty; an
    empty text has no anchors and ''. A single row is its own next. Other columns are ignored.
    """
    rows = _with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = with_anchors(rows.drop("next_text"), "edited", "edited_places")
    rows = rows.select(
        "doc_id", "places", "next_places", "edited_places", "anchors", "next_anchors",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        _distinct(F.col("edited_places")).alias("edited_anchors"),
    )
    rows = rows.withColumns({
        "common_edited": F.array_intersect("anchors", "edited_anchors"),
        "common_next": F.array_intersect("anchors", "next_anchors"),
    })
    same_place = F.array_compact(F.zip_with("places", "edited_places", lambda a, b: F.when(a == b, True)))
    rows = _with_match(rows, "places", "next_places", "common_next", "aligned_next")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256",
        _written("anchors").alias("fingerprint"),
        _written("edited_anchors").alias("edited_fingerprint"),
        _likeness("anchors", "edited_anchors", "common_edited").alias("near_edited"),
        _likeness("anchors", "next_anchors", "common_next").alias("near_next"),
        F.size(same_place).cast("long").alias("aligned_edited"), "aligned_next",
    )
