"""Records of CSV files whose quoted fields hold line ends, found by many tasks.

A line either begins outside of quotes or inside. What it does to that state is a function of two
values, and functions can be put together in any grouping: each split of a file works out its own, a
running composition over the splits tells the state each one starts in, and then every line knows
whether it is a record by itself. Only the lines of longer records are grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from txnlake.functions.jobs import written
from txnlake.functions.lookup import lookup

# A quoted text up to before its closing quote, with doubled quotes inside; then one field and its comma.
_QUOTED = '[^"]*+(?:""[^"]*+)*+'
_FIELDS = f'(?:(?:[^",][^,]*+|"{_QUOTED}"[^,]*+)?+,)*+'
_LEFT_OPEN = f'{_FIELDS}"{_QUOTED}\\z'
_OPENS = f"\\A{_LEFT_OPEN}"
_STAYS = f'\\A{_QUOTED}(?:\\z|"[^,]*+,{_LEFT_OPEN})'

#: Records end in LF or CRLF; a CR elsewhere, also before a line end inside of quotes, belongs to its field.
LINE_END = "\n"


class OpenQuote(Exception):
    """A quoted field is never closed."""


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as `value`; a CR before the line end is kept."""
    return spark.read.option("lineSep", LINE_END).text(path)


def _is_empty(line: Column) -> Column:
    return line.isin("", "\r")


def opens_quote(line: Column) -> Column:
    """Whether a line that begins outside of quotes ends inside."""
    return line.contains('"') & line.rlike(_OPENS)


def _stays_inside(line: Column) -> Column:
    """Whether a line that begins inside of quotes ends inside."""
    return ~line.contains('"') | line.rlike(_STAYS)


def _composed(rows: DataFrame, before: WindowSpec) -> DataFrame:
    """Add `_swaps` and `_set`: how the rows before change the state.

    A row maps outside to `_out` and inside to `_in`. Where both are equal it sets the state, where
    they are 1 and 0 it swaps it. What counts is the last setting row and the swaps after it.
    """
    swap = ((F.col("_out") == 1) & (F.col("_in") == 0)).cast("long")
    sets = F.when(F.col("_out") == F.col("_in"), F.struct(F.col("_out").alias("state"), "_swaps"))
    return rows.withColumn("_swaps", F.coalesce(F.sum(swap).over(before), F.lit(0))).withColumn(
        "_set", F.last(sets, ignorenulls=True).over(before))


def _state(start: Column | int) -> Column:
    """The state before a row of `_composed` when the first of its rows begins in `start`; 1 is inside."""
    since = F.col("_swaps") - F.col("_set._swaps")
    return F.when(F.col("_set").isNull(), (F.lit(start) + F.col("_swaps")) % 2).otherwise(
        (F.col("_set.state") + since) % 2).cast("int")


def _after(before: Column) -> Column:
    return F.when(before == 0, F.col("_out")).otherwise(F.col("_in"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their split, their place, and for both states the split may start in their own state and record."""
    at = F.col("_metadata.file_block_start")
    lines = text_lines(spark, path).select(
        "value", F.struct(F.col("_metadata.file_path").alias("file"), at.alias("block")).alias("_split"),
        (at + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).alias("_row_seq"))
    lines = lines.withColumns({
        "_out": opens_quote(F.col("value")).cast("int"), "_in": _stays_inside(F.col("value")).cast("int")})
    # A split holds at most spark.sql.files.maxPartitionBytes.
    split = Window.partitionBy("_split").orderBy("_row_seq")
    lines = _composed(lines, split.rowsBetween(Window.unboundedPreceding, -1))
    begin = lambda start: F.max(F.when(_state(start) == 0, F.col("_row_seq"))).over(split)
    return lines.withColumns({"_state0": _state(0), "_state1": _state(1), "_begin0": begin(0), "_begin1": begin(1)})


def _splits(lines: DataFrame) -> DataFrame:
    """(_split, _start, _begun, _header, _closed) of each split.

    That is the state it starts in, the record that is open there, the first record of its file, and
    whether the split ends outside of quotes.
    """
    first = lambda start: F.min(F.when(
        (F.col(f"_state{start}") == 0) & ~_is_empty(F.col("value")), F.col("_row_seq")))
    ends = F.struct(_after(F.col("_state0")).alias("_out"), _after(F.col("_state1")).alias("_in"))
    found = lines.groupBy("_split").agg(
        F.max_by(ends, "_row_seq").alias("_ends"), F.max("_begin0").alias("_begin0"), F.max("_begin1").alias("_begin1"),
        first(0).alias("_first0"), first(1).alias("_first1")).select("*", "_ends.*")
    # One row for each split from here on.
    file = Window.partitionBy("_split.file")
    before = file.orderBy("_split.block").rowsBetween(Window.unboundedPreceding, -1)
    own = lambda name: F.when(F.col("_start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    return _composed(found, before).withColumn("_start", _state(0)).select(
        "_split", "_start", F.last(own("_begin"), ignorenulls=True).over(before).alias("_begun"),
        F.min(own("_first")).over(file).alias("_header"), (_after(F.col("_start")) == 0).alias("_closed"))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """(value, _row_seq, _file, _is_header): records with their line ends, at the place of their first line.

    Empty lines between records are left out. A quote that is still open at the end of a file is an error.
    """
    lines = _lines(spark, path)
    splits = written(_splits(lines), "splits")
    last = splits.groupBy("_split.file").agg(F.max_by("_closed", "_split.block").alias("closed"))
    if not last.filter(~F.col("closed")).isEmpty():
        raise OpenQuote(f"a quoted field is not closed before the end of the file: {path}")
    own = lambda name: F.when(F.col("_start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))
    placed = lookup(lines, splits.drop("_closed"), "_split", salt_by="_row_seq").withColumn("_state", own("_state")).select(
        "value", F.col("_split.file").alias("_file"), "_row_seq", "_header",
        F.coalesce(own("_begin"), F.col("_begun")).alias("_record"),
        ((F.col("_state") == 0) & (_after(F.col("_state")) == 0)).alias("_whole"))
    whole = placed.filter(F.col("_whole") & ~_is_empty(F.col("value"))).select("value", "_file", "_record", "_header")
    # A group is the lines of one record.
    pieces = F.array_sort(F.collect_list(F.struct("_row_seq", "value")))
    joined = placed.filter(~F.col("_whole")).groupBy("_file", "_record", "_header").agg(
        F.array_join(F.transform(pieces, lambda piece: piece["value"]), LINE_END).alias("value"))
    return whole.unionByName(joined).select(
        F.regexp_replace("value", "\r\\z", "").alias("value"), F.col("_record").alias("_row_seq"), "_file",
        (F.col("_record") == F.col("_header")).alias("_is_header"))
