"""Incremental secret scan: a ledger of scanned contents, joined back to every path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnlake.llm.common import stage, whole

SPAN = "array<struct<start:long,`end`:long>>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost non-overlapping matches count if a group is long enough.

    hint is a pattern that every text with such a match contains. A changed pattern needs a new version; the ledger then scans all contents again for it.
    """

    name: str
    version: int
    pattern: str
    group: int
    shortest: int
    hint: str


NAMES, VALUE = "(?i:password|passwd|secret|token|api_?key)", "[A-Za-z0-9+/_.=-]"
ASSIGNED = NAMES + r"[\"']?\x20*[:=]\x20*[\"']?"
# Kinds in their order, patterns and shortest lengths.
RULES = (
    Rule("assign", 1, f"{ASSIGNED}({VALUE}+)", 1, 8, f"{ASSIGNED}{VALUE}{{8,}}"),
    Rule("access", 1, "AKIA[A-Z0-9]+", 0, 16, "AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, "[0-9a-f]+", 0, 32, "[0-9a-f]{32,}"),
)


def spans(text: Column, rule: Rule) -> Column:
    """Start and end (code points, end exclusive) of the matches of a rule, in order.

    The texts between matches and the matches themselves alternate, so the lengths of both,
    added up, are the positions. Texts without a long enough match are told by one search.
    """
    pattern = F.lit(rule.pattern)
    gaps, found = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    kept = found if not rule.group else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.zip_with(F.slice(gaps, 1, F.size(found)), F.arrays_zip(found.alias("whole"), kept.alias("part")), lambda gap, match: F.struct(
        F.length(gap).cast("long").alias("gap"), F.length(match["whole"]).cast("long").alias("size"),
        F.length(match["part"]).cast("long").alias("part")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("found"))
    walked = F.aggregate(steps, start, lambda state, step: F.struct(
        (state["at"] + step["gap"] + step["size"]).alias("at"),
        F.when(step["part"] >= rule.shortest, F.concat(state["found"], F.array(F.struct(
            (state["at"] + step["gap"]).alias("start"),
            (state["at"] + step["gap"] + step["size"]).alias("end"))))).otherwise(state["found"]).alias("found")))
    return F.when(F.regexp_like(text, F.lit(rule.hint)), walked["found"]).otherwise(F.array().cast(SPAN))


def blob_id(text: Column | str) -> Column:
    """Address of a content: the SHA-256 of its UTF-8 bytes, as binary. Null is the empty text."""
    return F.unhex(F.sha2(F.encode(whole(text), "UTF-8"), 256))


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger (blob, rule, version, spans); an empty one where nothing was scanned yet."""
    schema = f"blob binary, rule string, version int, spans {SPAN}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(schema).parquet(folder) if there else spark.createDataFrame([], schema)


def scan_unseen(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> None:
    """Scan every content the ledger lacks under some rule version, and append what was found.

    A content is scanned once, however many paths and versions hold it, and only for the rule
    versions it has not met. The result for a clean content is an empty list, so it is not scanned
    again. Appending is one write, so a lost executor leaves no half of a scan; a scan that ran
    twice adds equal rows, which readers take once.
    """
    ledger = read_ledger(versions.sparkSession, folder)
    wanted = F.array(*[F.lit(f"{rule.name}:{rule.version}") for rule in rules])
    seen = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("_seen"))
    contents = versions.select(whole(text).alias("text"), blob_id(text).alias("blob"))
    known = seen.filter(F.size(F.array_except(wanted, "_seen")) == 0)
    # Contents known under all rules leave before their texts are moved.
    fresh = contents if ledger.isEmpty() else contents.join(known, "blob", "left_anti")
    fresh = fresh.groupBy("blob").agg(F.first("text").alias("text"))
    if not ledger.isEmpty():
        fresh = fresh.join(seen, "blob", "left")
    else:
        fresh = fresh.withColumn("_seen", F.lit(None).cast("array<string>"))
    missing = lambda rule: ~F.coalesce(F.array_contains("_seen", f"{rule.name}:{rule.version}"), F.lit(False))
    scanned = fresh.select("blob", F.array(*[F.when(missing(rule), F.struct(
        F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"),
        spans(F.col("text"), rule).alias("spans"))) for rule in rules]).alias("_found"))
    scanned.select("blob", F.explode("_found").alias("_one")).filter("_one IS NOT NULL").select(
        "blob", "_one.rule", "_one.version", "_one.spans").write.mode("append").parquet(folder)


def findings(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """All rows with findings: array<struct<start, place, rule, end>>, by start and then rule.

    Rows whose text is null have the findings of the empty text, which are none. Every row of the
    input is returned, repeated ones as often as they occur. A column named findings is replaced.
    """
    names = [rule.name for rule in rules]
    current = " OR ".join(f"(rule = '{rule.name}' AND version = {rule.version})" for rule in rules)
    place = F.array_position(F.array(*map(F.lit, names)), F.col("rule")).cast("int")
    # Written, so that both sides of the join are plain exchanges and a hot content can be split.
    by_blob = stage(read_ledger(versions.sparkSession, folder).filter(current)
               .select("blob", F.transform("spans", lambda span: F.struct(
                   span["start"].alias("start"), place.alias("place"), F.col("rule").alias("rule"),
                   span["end"].alias("end"))).alias("found"))
               # A handful of rows for each content: one for each rule.
               .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("findings")), "findings")
    versions = versions.drop("findings").withColumn("_blob", blob_id(text))
    return versions.join(by_blob, versions["_blob"] == by_blob["blob"], "left").drop("_blob", "blob")


def scan(versions: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """Bring the ledger up to date for these rows and return their findings."""
    scan_unseen(versions, folder, rules, text)
    return findings(versions, folder, rules, text)


def span_text(found: Column) -> Column:
    """Findings as rule:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(found, lambda one: F.concat_ws(
        ":", one["rule"], one["start"].cast("string"), one["end"].cast("string"))))


def redacted(text: Column, found: Column, mark: str = "[REDACTED]") -> Column:
    """The text with every finding replaced; findings that overlap become one mark. Null stays null."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    merged = F.aggregate(found, start, lambda state, one: F.when(one["end"] <= state["at"], state).otherwise(F.struct(
        one["end"].alias("at"),
        F.when(one["start"] < state["at"], state["out"]).otherwise(F.concat(
            state["out"], F.substring(text, (state["at"] + 1).cast("int"), (one["start"] - state["at"]).cast("int")),
            F.lit(mark))).alias("out"))))
    return F.when(F.size(found) > 0, F.concat(merged["out"], F.substring(
        text, (merged["at"] + 1).cast("int"), F.length(text)))).otherwise(text)
