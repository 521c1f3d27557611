"""Language by rank-order profiles: the out-of-place distance of a text's most frequent n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from txnlake.llm.common import held_out, whole

#: N-grams of a profile, and of a text that are ranked.
RANKS = 300
#: Bits of a character code in an n-gram; n-grams have one to three characters.
BITS = 21
#: Characters whose n-grams are counted at a time.
SLICE = 1 << 21
UNKNOWN = "und"
#: Code of a word border; no letter has it.
BORDER = 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The code of each letter; BORDER for any other character."""
    codes = np.full(0x110000, BORDER, np.int64)
    known = np.fromiter((code for code in range(0x110000) if chr(code).isalpha()), np.int64)
    codes[known] = known
    return codes


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, n-gram, count) of all n-grams of one to three characters, sorted by both.

    Texts are lower-cased; each run of other characters than letters is one word border, which is
    part of the n-grams at the ends of a word. N-grams of borders alone do not count.
    """
    parts = [value.lower() for value in texts]
    joined = " " + " ".join(parts) + " "
    codes = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    lengths = np.array([len(part) + 1 for part in parts])
    lengths[0] += 1
    owner = np.repeat(np.arange(len(parts)), lengths)
    letter = codes != BORDER
    # A border stays after a letter, and before the first text, so every word has one on each side.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    # Characters get small numbers in their order, so that an n-gram and its text fit one long.
    alphabet = np.union1d([0, BORDER], np.flatnonzero(np.bincount(codes)))
    size = len(alphabet)
    if size ** 3 * len(texts) >= 1 << 62 and len(texts) > 1:
        half = len(texts) // 2
        first, second = gram_counts(texts[:half]), gram_counts(texts[half:])
        return tuple(np.concatenate([x, y + half * (not place)]) for place, (x, y) in enumerate(zip(first, second)))
    number = np.zeros(alphabet[-1] + 1, np.int64)
    number[alphabet] = np.arange(size)
    codes, owner, letter = number[codes[keep]], owner[keep], letter[keep]
    # The text of an n-gram is the one its letters belong to.
    base = owner * size ** 3
    pair = codes[:-1] * size + codes[1:]
    middle = letter[1:-1]
    keys = np.concatenate([
        (base + codes)[letter],
        (np.where(letter[:-1], base[:-1], base[1:]) + pair)[letter[:-1] | letter[1:]],
        (base[1:-1] + pair[:-1] * size + codes[2:])[middle]])
    keys.sort()
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else keys
    counts = np.diff(np.append(starts, len(keys)))
    owner, rest = np.divmod(keys[starts], size ** 3)
    grams = np.zeros(len(rest), np.int64)
    for power in (size * size, size, 1):
        digit, rest = np.divmod(rest, power)
        grams = grams << BITS | alphabet[digit]
    return owner, grams, counts


def _slices(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for value in texts:
        held.append(value)
        size += len(value) + 1
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def learn_profiles(rows: DataFrame, text: str = "text", lang: str = "lang", ranks: int = RANKS) -> DataFrame:
    """The most frequent n-grams of each language: lang, gram, place (1 is the most frequent).

    All rows with a language count, in partial sums. Equal counts are ordered by the n-gram.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for name, group in frame.groupby("lang"):
                for part in _slices(group["text"].tolist()):
                    _, grams, counts = gram_counts(part)
                    different, place = np.unique(grams, return_inverse=True)
                    totals = np.bincount(place, counts, len(different)).astype(np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([name] * len(different), pa.string()), "gram": different, "n": totals})

    counted = rows.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), whole(text).alias("text")) \
        .mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counted.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= ranks).drop("n")


class Profiles:
    """Profiles of all languages as one table: n-gram by language, with the place or RANKS."""

    def __init__(self, rows: list, ranks: int = RANKS):
        self.names = sorted({row["lang"] for row in rows})
        self.ranks = ranks
        self.grams = np.unique(np.array([row["gram"] for row in rows], np.int64))
        self.places = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        for row in rows:
            self.places[np.searchsorted(self.grams, row["gram"]), self.names.index(row["lang"])] = row["place"]

    def distances(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean out-of-place distance (0 to 1) of each text to each language, and its ranked n-grams.

        A text's n-grams are ranked by count, equal counts by the n-gram. Each of the first RANKS
        adds the difference of its places, or the largest difference if the profile lacks it.
        """
        owner, grams, counts = gram_counts(texts)
        # Rows are sorted by text and n-gram, so a stable sort by count keeps the n-grams' order.
        most = counts.max(initial=0)
        order = np.argsort(owner * (most + 1) + most - counts, kind="stable")
        owner, grams = owner[order], grams[order]
        sizes = np.bincount(owner, minlength=len(texts))
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        first = place <= self.ranks
        owner, grams, place = owner[first], grams[first], place[first]
        ranked = np.minimum(sizes, self.ranks)
        if not len(self.grams):
            return np.ones((len(texts), 0)), ranked
        at = np.minimum(np.searchsorted(self.grams, grams), len(self.grams) - 1)
        at = np.where(self.grams[at] == grams, at, len(self.grams))
        result = np.empty((len(texts), len(self.names)))
        for number in range(len(self.names)):
            there = self.places[at, number]
            apart = np.where(there < 0, self.ranks, np.abs(there - place))
            result[:, number] = np.bincount(owner, apart, len(texts))
        return result / np.maximum(1, ranked * self.ranks)[:, None], ranked

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Nearest language and 1 - distance; equal distances give the first name."""
        names, scores = [], []
        for part in _slices(texts):
            far, ranked = self.distances(part)
            if not self.names:
                names += [UNKNOWN] * len(part)
                scores.append(np.zeros(len(part)))
                continue
            best = far.argmin(axis=1)
            names += [self.names[number] if size else UNKNOWN for number, size in zip(best, ranked)]
            scores.append(np.where(ranked > 0, 1 - far[np.arange(len(part)), best], 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def language(text: Column, profiles: Profiles) -> Column:
    """struct(lang, score) of whole texts; `und` and 0 for a null text or one without letters."""
    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        names, scores = profiles.predict(texts.tolist())
        return pd.DataFrame({"lang": names, "score": scores})

    return run(whole(text))


def identify(rows: DataFrame, text: str = "text", lang: str = "lang", row_id: str = "doc_id") -> DataFrame:
    """All rows with held_out, lang_pred and score.

    Profiles are learned from all rows that are not held out and have a language; a prediction
    reads the text alone, whatever lies beside it in a batch. A task holds some dozens of bytes for each
    character of a slice of its texts, or of one longer text. Ids may be null or repeated. Without any profile every text is `und`.
    Columns of the input named like the results are replaced.
    """
    rows = rows.drop("held_out", "lang_pred", "score")
    # A profile has 300 rows for each language, whatever the corpus.
    learned = learn_profiles(rows.filter(~held_out(row_id)), text, lang).collect()
    found = language(F.col(text), Profiles([row.asDict() for row in learned]))
    return rows.withColumn("held_out", held_out(row_id)).withColumn("_found", found).select(
        *rows.columns, "held_out", F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"))
