"""The pipeline's stages against plain versions, on edge cases and the smallest tables."""

from __future__ import annotations

import re
from collections import Counter

import brute
import pytest

import corpus_pipeline
from txnlake.llm import toxicity
from txnlake.llm.common import stage

STEPS = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module", params=["edge", "small", "empty"])
def source(request, folder):
    return folder if request.param == "small" else request.getfixturevalue(request.param)


def bag(rows):
    return Counter(repr(tuple(row)) for row in rows)


def test_stages(spark, source):
    docs = spark.read.parquet(f"{source}/documents.parquet")
    columns = docs.dtypes
    scored = toxicity.toxicity(docs.select("doc_id", "text"), spark.read.parquet(f"{source}/labels.parquet"))
    bad = {row["text"] for row in scored.filter("predicted = 1").collect()}
    kept = stage(STEPS["toxicity"](spark, docs, source), "t1")
    assert kept.dtypes == columns
    assert bag(kept.collect()) == bag(row for row in docs.collect() if row["text"] not in bad)

    first = kept.collect()
    kept = stage(STEPS["simhash near-dedup"](spark, kept, source), "t2")
    assert kept.dtypes == columns
    prints = [brute.simhash(row["text"]) for row in first]
    root = brute.groups(range(len(first)), [(i, j) for i in range(len(first)) for j in range(i)
                                            if (prints[i] ^ prints[j]).bit_count() <= 4])
    least = {}
    for place, row in enumerate(first):
        order = (row["doc_id"] is None, row["doc_id"] or 0)
        least[root[place]] = min(order, least.get(root[place], order))
    assert sorted(least.values()) == sorted((row["doc_id"] is None, row["doc_id"] or 0) for row in kept.collect())

    second = kept.collect()
    kept = stage(STEPS["benchmark decontamination"](spark, kept, source), "t3")
    assert kept.dtypes == columns
    norm = lambda text: re.sub(r"(?:[^\w]|_)+", " ", (text or "").lower()).strip()
    items = [norm(row["text"]) for row in spark.read.parquet(f"{source}/benchmark.parquet").collect() if row["item_id"] is not None]
    whole = [row for row in second if any(len(item) >= 40 and item in norm(row["text"]) for item in items)]
    left = bag(kept.collect())
    assert not bag(whole) & left and left <= bag(second)

    third = kept.collect()
    kept = stage(STEPS["secret scan"](spark, kept, source), "t4")
    assert kept.dtypes == columns
    clean = [row for row in third if not brute.secrets(row["text"])[-1]]
    after = kept.collect()
    assert len(after) == len(third) and bag(clean) <= bag(after)
    assert not any(brute.secrets(row["text"])[-1] for row in after)

    coded = STEPS["bpe encoding"](spark, kept, source).collect()
    own = brute.tokenizer("word_bpe_49k.json")
    expected = Counter((row["doc_id"], tuple(own.encode(row["text"] or "", add_special_tokens=False).ids)) for row in after)
    assert Counter((row["doc_id"], tuple(row["ids"])) for row in coded) == expected


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() > 0
