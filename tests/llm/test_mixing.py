"""The mix of sources against a plain version, and its properties."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import brute
import pytest

from txnlake.llm import mixing
from txnlake.llm.queries import QUERIES


def same(left, right):
    key = lambda row: tuple((x is None, str(x)) for x in row)
    assert sorted(map(tuple, left), key=key) == sorted(map(tuple, right), key=key)


def qualities_of(rows):
    known = {}
    for doc_id, quality in rows:
        if doc_id is not None and quality in (0, 1):
            known[doc_id] = max(quality, known.get(doc_id, 0))
    return {doc_id: 2.0 if quality else 0.5 for doc_id, quality in known.items()}


@pytest.mark.parametrize("name", ["edge", "small"])
def test_query(request, spark, folder, name):
    source = request.getfixturevalue("edge") if name == "edge" else folder
    read = lambda table: spark.read.parquet(f"{source}/{table}.parquet")
    rows = [tuple(row) for row in read("documents").select("doc_id", "text", "source").collect()]
    known = qualities_of(tuple(row) for row in read("labels").select("doc_id", "quality").collect())
    same(QUERIES["op11_source_mix"](spark, source).collect(), brute.mixed(rows, known))


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size string, target int, _key string")


def test_sources(spark, monkeypatch):
    """Limits, null and empty sources, repeated rows, ties, and borders found digit by digit."""
    rng = random.Random(5)
    rows = []
    for source, count, words in (("a", 60, 9), ("b", 2, 1), ("é", 40, 30), (None, 300, 12), ("", 5, 0), ("Z", 90, 4), ("tiny", 1, 1)):
        rows += [(rng.randint(0, 400), " x" * rng.randint(0, 2 * words), source, "s", 0, "k") for _ in range(count)]
    rows += [(None, "the same \t words\n again", "a", "s", 0, "k")] * 40 + [(1, None, "a", "s", 0, "k")]
    monkeypatch.setattr(mixing, "SORTED_ROWS", 3)
    qualities = spark.createDataFrame([(place, place % 7 - 2.0) for place in range(400)] + [(None, 3.0)], "doc_id long, quality double")
    known = {place: place % 7 - 2.0 for place in range(400) if place % 7 > 2}
    found = mixing.mix(documents(spark, rows), qualities=qualities).select("doc_id", "size", "source_size", "target", "taken").collect()
    same(found, brute.mixed([row[:3] for row in rows], known))
    again = mixing.mix(documents(spark, rows[::-1]).repartition(5), qualities=qualities)
    same(again.select("doc_id", "size", "source_size", "target", "taken").collect(), found)


def test_budgets(spark, folder):
    taken, targets, sizes = Counter(), {}, defaultdict(int)
    rows = mixing.mix(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    for row in rows:
        taken[row["source"]] += row["taken"]
        sizes[row["source"]] += row["size"]
        targets[row["source"]] = row["target"]
        assert 0 <= row["taken"] <= 3 * row["size"] and row["taken"] == row["epochs"] * row["size"] + row["part"]
    assert all(abs(taken[source] - target) <= 0.5 and target <= 3 * sizes[source] for source, target in targets.items())
    assert abs(sum(targets.values()) - sum(sizes.values())) < 1


def test_quality_counts(spark):
    """Twelve times the weight brings about twelve times the odds of an early place."""
    rows = [(place, "one two three", "a" if place < 4000 else "b", "s", 0, "k") for place in range(8000)]
    qualities = spark.range(8000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 12.0, 1.0) AS quality")
    taken = mixing.mix(documents(spark, rows), qualities=qualities).filter("source = 'b' AND part > 0")
    good, bad = [taken.filter(f"doc_id % 2 = {odd}").count() for odd in (0, 1)]
    assert good + bad > 1500 and good > 3 * bad


def test_texts(spark):
    rows = [(1, "a b  c", "x", "s", 0, "k"), (2, "d e", "x", "s", 0, "k"), (3, None, "x", "s", 0, "k"), (4, "f g h i", "x", "s", 0, "k")]
    taken = spark.createDataFrame([(1, 2, 0, 3), (2, 1, 1, 2), (3, 2, 0, 0), (4, 0, 4, 4)], "doc_id long, epochs long, part long, size long")
    same(mixing.mixed_texts(documents(spark, rows), taken).collect(), [
        (1, 1, "a b  c"), (1, 2, "a b  c"), (2, 1, "d e"), (2, 2, "d"), (3, 1, ""), (3, 2, ""), (4, 1, "f g h i")])
