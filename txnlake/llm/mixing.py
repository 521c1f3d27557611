"""Mixing sources to target weights: whole epochs first, then a weighted sample of each source's documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlake.functions.lookup import lookup
from txnlake.llm.common import id_text, stage, whole

#: Weights of the sources in their order, again and again.
WEIGHTS = (5, 2, 1)
#: How often a document may be repeated.
REPEATS = 3
#: Bits of the sort key that one pass narrows down, and rows of a source that one task may sort.
BITS, SORTED_ROWS = 12, 100_000
#: Bits of a key and, below it, of the number of a stored row.
KEY_BITS, ROW_BITS = 60, 60
LEVELS = (KEY_BITS + ROW_BITS) // BITS
SPACES = r"[\x20\x09-\x0D]+"


def word_count(text: Column | str) -> Column:
    """Words of a text between spaces, tabs and line ends; none in a null text."""
    return F.size(F.filter(F.split(whole(text), SPACES), lambda word: word != "")).cast("long")


def uniform(seed: str, *columns: str) -> Column:
    """A number strictly between 0 and 1 from the MD5 of some columns; 52 bits of it count."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[id_text(name) for name in columns]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / F.lit(float(1 << 52))


def numbered_sources(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources with a weight each: the weights in turn, by code point, null last.

    Sources are range-partitioned and counted per partition, so however many there are, no task
    sees them all; the table of offsets has one row for each partition.
    """
    order = [F.col("source").isNull(), F.col("source")]
    placed = stage(sizes.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({
        "_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    turn = F.pmod(F.col("_offset") + F.col("_place"), F.lit(len(weights)))
    return placed.join(F.broadcast(offsets), "_part").select(
        "source", "source_size", F.get(F.array(*map(F.lit, weights)), turn.cast("int")).cast("long").alias("weight"))


def targets(sources: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """Sources with target: shares of all sizes by weight, none above `repeats` times its source.

    What a target leaves at its limit is shared again among the others by weight, until none is
    above. Each pass sums the sources; one row with two sums comes to the driver, and all
    sums are whole numbers, so the order of rows has no effect.
    """
    limit = F.col("source_size") * repeats
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    share, above = None, -1
    while True:
        full = F.lit(False) if share is None else F.col("weight") * F.lit(share) > limit
        held, weight, count = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
            F.count_if(full)).first()
        if count == above or not weight:
            break
        share, above = (total - held) / weight, count
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(share or 0.0), limit.cast("double")))


def _digit(level: int) -> Column:
    """Bits of (key, row) from the highest down, BITS at a time."""
    above = KEY_BITS // BITS
    name, place = ("_key", level) if level < above else ("_row", level - above)
    return F.shiftright(F.col(name), KEY_BITS - BITS * (place + 1)).bitwiseAND((1 << BITS) - 1)


def _borders(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Where the sample of each source ends: its digits so far as an array, and the words before them.

    Each pass adds up words per next digit inside the bucket that the budget falls into and goes on
    in that bucket only. It ends when no bucket has more rows than a task may sort.
    """
    state = plan.filter("rest > 0").select("source", "rest", F.array().cast("array<long>").alias("digits"),
                                           F.lit(0).cast("long").alias("before"))
    state = stage(state, "borders")
    level = 0
    while level < LEVELS:
        inside = _inside(rows, state, level)
        own = Window.partitionBy("_s").orderBy("digit")
        sums = inside.groupBy("_s", "rest", "digits", "before", _digit(level).alias("digit")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"))
        # At most 2^BITS rows for each source.
        ends = sums.withColumn("after", F.col("before") + F.sum("words").over(own)).filter(
            "after >= rest AND after - words < rest")
        state = stage(ends.select("_s.source", "rest", F.array_append("digits", F.col("digit")).alias("digits"),
                                  (F.col("after") - F.col("words")).alias("before"), "n"), "borders")
        most = state.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
        state, level = state.drop("n"), level + 1
        if most <= SORTED_ROWS:
            break
    return state


def _inside(rows: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """Rows in the bucket that the border of their source lies in."""
    joined = _with_source(rows, state)
    same = [F.get("digits", F.lit(place)) == _digit(place) for place in range(level)]
    return joined.filter(reduce(lambda a, b: a & b, same, F.col("rest").isNotNull()))


def _with_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows beside what is known of their source; _s is the source in a struct, so that null meets null."""
    keyed = table.withColumn("_s", F.struct("source")).drop("source")
    return lookup(rows.withColumn("_s", F.struct("source")), keyed, "_s", how="left", salt_by="_row")


def mix(documents: DataFrame, text: str = "text", source: str = "source", row_id: str = "doc_id",
        qualities: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS,
        seed: str = "mix") -> DataFrame:
    """One row for each document: doc_id, source, size, quality, source_size, target, epochs, part and taken.

    size counts words. target is what the source adds to the mix, see `targets`. A source's
    budget is its rounded target: every document is taken `epochs` times, as often as the budget
    holds the whole source. The rest is a sample without replacement after Efraimidis and
    Spirakis: documents have exponential keys divided by their quality, are sorted within the source
    and taken until the budget is met; of the last one only the first `part` words. So the words
    of a source are exactly its budget, and no document is taken more than `repeats` times.

    No source is sorted whole: keys are narrowed down digit by digit to the one bucket that the
    budget falls into (`_borders`), and only that bucket is sorted. qualities has one row for each
    `row_id` with a positive number as quality; a document without one, or with one that is null or not
    positive, has quality 1. The key comes from the id, size and digest of the text, so reruns agree, and
    rows that tie are alike. Null ids and texts are ids and texts like any other, a null source is a
    source, and documents without words take none. An empty table gives an empty result. Other
    columns are left out.
    """
    sized = documents.select(F.col(row_id).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"),
                             F.md5(F.encode(whole(text), "UTF-8")).alias("_digest"),
                             F.monotonically_increasing_id().alias("_row"))
    if qualities is None:
        sized = sized.withColumn("_quality", F.lit(1.0))
    else:
        known = qualities.select(F.col(row_id).alias("doc_id"), F.col("quality").cast("double").alias("_quality"))
        sized = lookup(sized, known.filter("doc_id IS NOT NULL"), "doc_id", salt_by="_row")
    sized = sized.withColumn("quality", F.when(F.col("_quality") > 0, F.col("_quality")).otherwise(1.0))
    key = -F.log(uniform(seed, "doc_id", "size", "_digest")) / F.col("quality")
    rows = stage(sized.select("doc_id", "source", "size", "quality", "_row", _ordered(key).alias("_key")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aimed = targets(stage(numbered_sources(sizes, weights), "weights"), repeats)
    plan = aimed.withColumn("budget", F.floor(F.col("target") + 0.5)).withColumn("epochs", F.when(
        F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0).cast("long"))
    plan = stage(plan.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size")), "targets")
    borders = _borders(rows, plan).select(F.struct("source").alias("_p"), "digits", "before")
    joined = _with_source(rows, plan.withColumn("_p", F.struct("source")).join(borders, "_p", "left").drop("_p"))
    # Only rows in the bucket of the border are sorted; those before it are taken, those behind it are not.
    own = F.slice(F.array(*[_digit(level) for level in range(LEVELS)]), 1, F.size("digits"))
    joined = joined.withColumn("_side", F.when(F.col("digits").isNull() | (own > F.col("digits")), 1)
                               .when(own < F.col("digits"), -1).otherwise(0))
    earlier = F.coalesce(F.sum("size").over(Window.partitionBy("_s").orderBy("_key", "doc_id", "size", "_row")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.greatest(F.lit(0), F.col("rest") - F.col("before") - earlier)
    both = joined.filter("_side = 0").withColumn("part", F.least("size", left)).unionByName(
        joined.filter("_side <> 0").withColumn("part", F.when(F.col("_side") < 0, F.col("size")).otherwise(0)))
    return both.select("doc_id", "source", "size", "quality", "source_size", "target", "epochs", F.col("part").cast("long").alias("part"),
                       (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def _ordered(key: Column) -> Column:
    """A key's place among 2^60 on a scale that never falls as the key grows."""
    return F.least(F.floor(key / (key + 1) * float(1 << KEY_BITS)), F.lit((1 << KEY_BITS) - 1)).cast("long")


def mixed_texts(documents: DataFrame, taken: DataFrame, text: str = "text", row_id: str = "doc_id") -> DataFrame:
    """The texts of a mix: doc_id, copy (from 1), text. `taken` has doc_id, epochs and part, one row for each id.

    A document comes `epochs` times whole and, if part of it is taken, once with its first `part` words.
    """
    joined = documents.select(F.col(row_id).alias("doc_id"), whole(text).alias("text")).join(
        taken.select("doc_id", "epochs", "part", "size"), "doc_id")
    words = F.filter(F.split("text", SPACES), lambda word: word != "")
    copies = F.explode(F.sequence(F.lit(1), (F.col("epochs") + F.when(F.col("part") > 0, 1).otherwise(0)).cast("int")))
    cut = F.when((F.col("copy") <= F.col("epochs")) | (F.col("part") == F.col("size")), F.col("text")).otherwise(
        F.array_join(F.slice(words, 1, F.greatest(F.lit(1), F.col("part").cast("int"))), " "))
    some = joined.filter("epochs > 0 OR part > 0")
    return some.withColumn("copy", copies).select("doc_id", "copy", cut.alias("text"))
