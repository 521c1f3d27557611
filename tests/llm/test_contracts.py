"""Every query on the edge cases and the smallest tables against a plain version."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import brute
import pytest

from txnlake.llm.queries import QUERIES


@pytest.fixture(scope="module", params=["edge", "small"])
def source(request, spark, folder):
    return request.getfixturevalue("edge") if request.param == "edge" else folder


@pytest.fixture(scope="module")
def rows(spark, source):
    return [tuple(row) for row in spark.read.parquet(f"{source}/documents.parquet").select("doc_id", "text", "lang").collect()]


def result(spark, source, name):
    return [tuple(row) for row in QUERIES[name](spark, source).collect()]


def same(left, right):
    key = lambda row: tuple((x is None, str(x)) for x in row)
    assert sorted(left, key=key) == sorted(right, key=key)


def test_secrets(spark, source, rows):
    same(result(spark, source, "op1_secret_scan"), [(one, *brute.secrets(text)) for one, text, _ in rows])


def test_shards(spark, source, rows):
    import zlib
    found = result(spark, source, "op2_histogram_shards")
    same([row[:3] for row in found], [(one, len(brute.utf8(text)) + 8, zlib.crc32(brute.utf8(text))) for one, text, _ in rows])
    slots, sizes, places = defaultdict(list), Counter(), defaultdict(set)
    for _, size, crc, law, shard, slot, grown in found:
        assert law == "bytes" and grown is None and 0 <= shard < 24
        slots[shard].append(slot)
        sizes[shard] += size
        places[crc].add(shard)
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    ideal, largest = sum(sizes.values()) / 24, max(row[1] for row in found)
    assert all(abs(sizes[shard] - ideal) <= largest + 0.01 * ideal for shard in range(24))
    # Shards are ranges of the key, so other texts never lie between the copies of one.
    assert all(shard in own or not sizes[shard] for own in places.values() for shard in range(min(own), max(own)))


def test_language(spark, source, rows):
    found = result(spark, source, "op3_rank_order_language")
    texts = {one: text for one, text, _ in rows}
    learned = {lang for one, _, lang in rows if lang and not brute.held_out(one)}
    same([row[:2] for row in found], [(one, brute.held_out(one)) for one, _, _ in rows])
    for one, _, lang, score in found:
        if one is not None:
            letters = any(c.isalpha() for c in texts[one] or "")
            assert (lang in learned) if letters else (lang == "und" and score == 0)
        assert 0 <= score <= 1


def test_language_accuracy(spark, folder):
    langs = {row[0]: row[1] for row in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    held = [row for row in result(spark, folder, "op3_rank_order_language") if row[1] and langs[row[0]]]
    assert sum(row[2] == langs[row[0]] for row in held) >= 0.97 * len(held)


def test_toxicity(spark, source, rows):
    found = result(spark, source, "op4_nearest_toxicity")
    same([row[:2] for row in found], [(one, brute.held_out(one)) for one, _, _ in rows])
    assert all(0 <= score <= 1 and predicted == (score >= 0.3) for _, _, score, predicted, _ in found)
    by_text = defaultdict(set)
    texts = {one: text for one, text, _ in rows if one is not None}
    for one, _, score, _, _ in found:
        if one is not None:
            by_text[texts[one] or ""].add(score)
    assert all(len(scores) == 1 for scores in by_text.values())


def test_simhash(spark, source, rows):
    same(result(spark, source, "op6_simhash"), brute.simhash_groups([row[:2] for row in rows]))


def test_embeddings(spark, source):
    vectors = [tuple(row) for row in spark.read.parquet(f"{source}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    same(result(spark, source, "op7_embedding_tiles"), brute.embedding_groups(vectors))


def norm(text):
    return re.sub(r"(?:[^\w]|_)+", " ", (text or "").lower())


def test_contamination(spark, source, rows):
    items = [tuple(row) for row in spark.read.parquet(f"{source}/benchmark.parquet").select("item_id", "text").collect()]
    found = {(row[0], row[1]): row for row in result(spark, source, "op8_decontaminate")}
    texts = dict(row[:2] for row in rows)
    for item, passage in items:
        own = norm(passage).strip()
        if item is None or not own:
            continue
        if len(own) < 40:
            for one, text in texts.items():
                if one is not None:
                    assert ((one, item) in found) == (f" {own} " in f" {norm(text).strip()} ")
            continue
        cut = lambda size, step: [own[at:at + size] for at in sorted({*range(0, max(0, len(own) - size), step), max(0, len(own) - size)})]
        exact, parts = cut(50, 1), cut(160, 80) + cut(80, 16)
        for one, text in texts.items():
            if len(text or "") < 3000 and one is not None:
                plain = norm(text)
                if any(part in plain for part in exact if len(part) == 50 or part == own):
                    assert (one, item) in found
                if (one, item) in found and not any(part in plain for part in exact):
                    assert any(brute.edit_distance_within(part, plain) <= int(len(part) * 0.1) for part in parts)
    for one, _, _, edits, start, end in found.values():
        assert 0 <= start < end <= len(texts[one])


def test_bpe(spark, source, rows):
    own = brute.tokenizer("word_bpe_49k.json")
    same(result(spark, source, "op9_bpe"), [(one, *brute.bpe(own, text)) for one, text, _ in rows])


def test_records(spark, source, rows):
    own = brute.tokenizer("byte_bpe_50k.json")
    expected = [(one, *brute.record(own, text)) for one, text, _ in rows]
    found = sorted(result(spark, source, "op10_token_records"), key=lambda row: row[1])
    same([(one, count, crc) for one, _, count, crc in found], expected)
    ids = [-math.inf if row[0] is None else row[0] for row in found]
    assert ids == sorted(ids)
    before = 0
    for _, start, count, _ in found:
        assert start == before
        before += count


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []
