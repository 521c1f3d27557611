"""Every letter in its place: BPE words against the library, language scores against plain profiles."""

from __future__ import annotations

import random
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest

from txnlake.llm import bpe, language


def mixed_texts(count, top, seed):
    rng = random.Random(seed)
    letters = [code for code in range(1, top) if not 0xD800 <= code < 0xE000]
    return ["".join(chr(rng.choice(letters)) if rng.random() < 0.6 else rng.choice(" aBc'7.") for _ in range(rng.randint(1, 60)))
            for _ in range(count)]


@pytest.mark.parametrize("top, count", [(0x250, 3000), (0x3000, 3000), (0x110000, 500)])
def test_bpe_of_random_letters(top, count):
    own, library = bpe.Codec(public_tokenizers.path("word_bpe_49k.json")), brute.tokenizer("word_bpe_49k.json")
    texts = mixed_texts(count, top, top)
    assert [row.tolist() for row in own.encode(texts)] == [library.encode(text, add_special_tokens=False).ids for text in texts]


def test_bpe_of_every_letter():
    own, library = bpe.Codec(public_tokenizers.path("word_bpe_49k.json")), brute.tokenizer("word_bpe_49k.json")
    texts = [f"a{chr(code)}b {chr(code)}{chr(code)} {chr(code)}li {chr(code)}liyev" for code in range(1, 0x3000)]
    assert [row.tolist() for row in own.encode(texts)] == [library.encode(text, add_special_tokens=False).ids for text in texts]


def plain_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    words = [f" {word} " for word in letters.split(" ") if word]
    found = Counter()
    for word in words:
        for size in (1, 2, 3):
            for at in range(len(word) - size + 1):
                gram = word[at:at + size]
                # The middle of three is a letter; a border alone is no n-gram.
                if gram.strip(" ") and (size < 3 or gram[1] != " "):
                    found[gram] += 1
    return found


def ranked(grams, ranks):
    code = lambda gram: sum((1 if c == " " else ord(c)) << 21 * (len(gram) - 1 - place) for place, c in enumerate(gram))
    return [gram for gram, _ in sorted(grams.items(), key=lambda one: (-one[1], code(one[0])))[:ranks]]


def plain_distance(text, profile, ranks):
    own = ranked(plain_grams(text), ranks)
    place = {gram: at for at, gram in enumerate(profile)}
    return sum(abs(place[gram] - at) if gram in place else ranks for at, gram in enumerate(own)) / max(1, len(own) * ranks)


def profiles(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang").collect()
    learned = {}
    for row in rows:
        if row["lang"] and not brute.held_out(row["doc_id"]):
            learned.setdefault(row["lang"], Counter()).update(plain_grams(row["text"] or ""))
    return rows, {lang: ranked(grams, language.RANKS) for lang, grams in learned.items()}


def test_language_is_the_plain_distance(spark, folder):
    rows, plain = profiles(spark, folder)
    found = {row["doc_id"]: row for row in language.identify(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    for row in rows:
        far = {lang: plain_distance(row["text"] or "", profile, language.RANKS) for lang, profile in plain.items()}
        best = min(sorted(far), key=far.get)
        own = found[row["doc_id"]]
        if plain_grams(row["text"] or ""):
            assert own["lang_pred"] == best and abs(own["score"] - (1 - far[best])) < 1e-12
        else:
            assert (own["lang_pred"], own["score"]) == ("und", 0)


def test_language_does_not_follow_the_batch(spark, folder):
    rows = [row["text"] for row in spark.read.parquet(f"{folder}/documents.parquet").select("text").limit(60).collect()]
    rows = ["!!", "", "je", "12 je 3", chr(0x323A0) * 3 + " " + chr(0x31350)] + [text or "" for text in rows]
    learned = language.learn_profiles(spark.read.parquet(f"{folder}/documents.parquet")).collect()
    own = language.Profiles([row.asDict() for row in learned])
    alone = [(names[0], scores[0]) for names, scores in (own.predict([text]) for text in rows)]
    assert list(zip(*own.predict(rows))) == alone
    order = list(range(len(rows)))
    for seed in range(3):
        random.Random(seed).shuffle(order)
        names, scores = own.predict([rows[place] for place in order])
        assert [alone[place] for place in order] == list(zip(names, scores))
    assert alone[4][0] != "und"


def test_round_trip_is_both(spark, folder):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = spark.read.parquet(f"{folder}/documents.parquet").withColumn("both", bpe.round_trip("text", path)) \
        .withColumn("ids", bpe.encoded("text", path)).select("both.ids", "both.decoded", "ids").limit(50)
    for ids, text, alone in rows.collect():
        assert ids == alone and text == bpe.codec(path).decode(np.array(ids, np.int32))
