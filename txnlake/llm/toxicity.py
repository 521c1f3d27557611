"""Toxicity by nearest labelled examples: exact TF-IDF cosine of words and telling stems over a block-max index."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain, compress, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txnlake.llm.common import held_out, stage, whole

#: Labelled rows of each class that the examples are drawn from, at most. The only bound on data:
#: it is the sample the classifier is fitted on.
EXAMPLES = 2048
#: Neighbours that vote, and the weight of the prior beside them.
NEIGHBOURS, PRIOR_WEIGHT = 15, 0.25
#: Examples in a block of the index.
BLOCK = 64
#: First bytes of a word that are terms of their own, and the chi-square over the examples from which on they are.
STEMS, TELLING = (4, 5, 6), 25.0
#: Texts scored at a time, and blocks of each that are read before the bounds decide on the others.
ROWS, FIRST = 128, 2
#: The terms with the longest posting lists have them as dense rows of each block, if at least one example in HOT_SHARE
#: has the term. This changes work only.
HOT_TERMS, HOT_SHARE = 512, 16
WORD = re.compile(r"[^\W\d_]+")
#: Texts of these characters have no other letters than a-z and those beyond ASCII, so bytes can be split faster.
PLAIN = re.compile("[\0-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u024f]*")
SIGNS = bytes(code if code >= 0x80 or chr(code).isalpha() else 0x20 for code in range(256))
EPSILON = 1e-9
#: Decimals of a cosine, so that the order of sums leaves equal ones equal.
DECIMALS = 9


def words_of(text: str) -> list[bytes]:
    """Runs of letters, in lower case and UTF-8."""
    low = text.lower()
    if PLAIN.fullmatch(low):
        return low.encode().translate(SIGNS).split()
    return [word.encode("utf-8", "surrogatepass") for word in WORD.findall(low)]


def sampled(labelled: DataFrame, row_id: str, label: str, most: int) -> tuple[DataFrame, dict[int, float]]:
    """At most `most` rows of each class by a hash of the id, and the weight of a row by class.

    A class of no more rows is taken whole with weight 1.
    """
    sizes = {row[label]: row["n"] for row in labelled.groupBy(label).agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.lit("examples"), row_id)
    parts = [labelled.filter(F.col(label) == kind).orderBy(order, row_id).limit(most) for kind in (0, 1)]
    weights = {kind: max(1.0, sizes.get(kind, 0) / most) for kind in (0, 1)}
    return parts[0].unionByName(parts[1]), weights


def telling_stems(texts: list[str], labels: np.ndarray) -> list[bytes]:
    """Starts of words that the toxic and the other examples hold in different shares, by chi-square, in order.

    Inflected or compound words hardly occur twice, but their first letters do.
    """
    held = [Counter(), Counter()]
    for text, label in zip(texts, labels.tolist()):
        held[int(label)].update({word[:size] for word in set(words_of(text)) for size in STEMS if len(word) >= size})
    sizes = [int((labels == kind).sum()) for kind in (0, 1)]
    stems = sorted(held[0].keys() | held[1].keys())
    clean, toxic = (np.array([one[stem] for stem in stems], np.float64) for one in held)
    off = toxic * (sizes[0] - clean) - clean * (sizes[1] - toxic)
    spread = float(sizes[0]) * sizes[1] * (clean + toxic) * (sum(sizes) - clean - toxic)
    strength = np.divide(off * off * sum(sizes), spread, out=np.zeros(len(stems)), where=spread > 0)
    return [stems[place] for place in np.flatnonzero(strength >= TELLING)]


class Vocabulary:
    """The terms of the examples with their places: their words in order, then the telling stems."""

    def __init__(self, words: list[bytes], stems: list[bytes]):
        self.words, self.stems, self.size = words, stems, len(words) + len(stems)
        self.place = {word: place for place, word in enumerate(words)}
        self.stem_place = {stem: place for place, stem in enumerate(stems, len(words))}
        self.starts = {stem[:STEMS[0]] for stem in stems}
        # The stems of each known word, one after the other.
        own = [self._stems(word) for word in words]
        self.often = np.array([len(one) for one in own], np.int64)
        self.first = np.cumsum(self.often) - self.often
        self.of_words = np.array(list(chain.from_iterable(own)), np.int64)

    def __reduce__(self):
        # Only the terms travel.
        return Vocabulary, (self.words, self.stems)

    @staticmethod
    def of(texts: list[str], labels: np.ndarray) -> Vocabulary:
        return Vocabulary(sorted(set(chain.from_iterable(map(words_of, texts)))), telling_stems(texts, labels))

    def _stems(self, word: bytes) -> list[int]:
        """The places of the telling stems of a word."""
        if word[:STEMS[0]] not in self.starts:
            return []
        found = [self.stem_place.get(word[:size]) for size in STEMS if len(word) >= size]
        return [place for place in found if place is not None]

    def stems_of(self, places: np.ndarray, words: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(place, which word) of all telling stems of different words, of which those not known have place -1."""
        known = np.flatnonzero((places >= 0) & (self.often[places] > 0)) if len(self.often) else np.zeros(0, np.int64)
        often = self.often[places[known]]
        found, which = self.of_words[_ranges(self.first[places[known]], often)], np.repeat(known, often)
        starts, size, fresh = self.starts, STEMS[0], places < 0
        others = [(spot, stem) for spot, word in zip(np.flatnonzero(fresh).tolist(), compress(words, fresh.tolist()))
                  if word[:size] in starts for stem in self._stems(word)]
        if others:
            found = np.append(found, [stem for _, stem in others])
            which = np.append(which, [spot for spot, _ in others])
        return found, which

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, times) of all different terms of the texts; place -1 for words that no example has."""
        rows, places, times = [], [], []
        for row, text in enumerate(texts):
            found = Counter(words_of(text))
            place = np.fromiter(map(self.place.get, found, repeat(-1)), np.int64, len(found))
            often = np.fromiter(found.values(), np.int64, len(found))
            if self.stems:
                stems, which = self.stems_of(place, found)
                if len(stems):
                    stems, own = np.unique(stems, return_inverse=True)
                    place, often = np.append(place, stems), np.append(often, np.bincount(own, often[which]).astype(np.int64))
            rows.append(len(place))
            places.append(place)
            times.append(often)
        none = np.zeros(0, np.int64)
        return np.repeat(np.arange(len(texts)), rows), np.concatenate([none, *places]), np.concatenate([none, *times])


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """All places of some ranges, one range after the other."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())


class Index:
    """Posting lists of all terms of the examples; the longest ones as dense rows of blocks of examples.

    A query's products with the short lists are added up first. What the dense rows can add for any
    example of a block is at most the product of the query and the block's largest weights. The
    blocks of the largest bounds are read first; then all blocks whose bound is not below the last
    neighbour so far, so the neighbours are exact.
    """

    def __init__(self, row: np.ndarray, term: np.ndarray, weights: np.ndarray, common: np.ndarray, size: int, terms: int):
        # Examples with the same prevailing word, mostly of one language, lie together, which makes the bounds tight.
        strongest = np.full(size, -1)
        order = np.lexsort((term, common))
        strongest[row[order]] = term[order]
        self.order = np.lexsort((np.arange(size), strongest))
        self.size, self.blocks = size, -(-size // BLOCK)
        place = np.empty(size, np.int64)
        place[self.order] = np.arange(size)
        place = place[row]
        often = np.bincount(term, minlength=terms)
        hot = np.flatnonzero(often * HOT_SHARE >= size)
        hot = np.sort(hot[np.argsort(-often[hot], kind="stable")[:HOT_TERMS]])
        self.hot = np.full(terms, -1)
        self.hot[hot] = np.arange(len(hot))
        self.dense = np.zeros((self.blocks, len(hot), BLOCK))
        own = self.hot[term] >= 0
        self.dense[place[own] // BLOCK, self.hot[term[own]], place[own] % BLOCK] = weights[own]
        self.dense_most = self.dense.max(axis=2, initial=0.0).T
        term, place, weights = term[~own], place[~own], weights[~own]
        order = np.lexsort((place, term))
        self.place, self.weight = place[order], weights[order]
        self.lists = np.searchsorted(term[order], np.arange(terms + 1))

    def nearest(self, size: int, row: np.ndarray, term: np.ndarray, weights: np.ndarray, count: int,
                left_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(cosines, places) of the nearest examples of unit queries; place -1 where there are fewer.

        Only cosines above zero count; equal ones are ordered by place. left_out names the place
        of an example that each query must not meet.
        """
        best, where = np.zeros((size, count)), np.full((size, count), -1)
        if not len(term) or not self.size:
            return best, where
        hot = self.hot[term]
        queries = np.zeros((size, self.dense.shape[1]))
        queries[row[hot >= 0], hot[hot >= 0]] = weights[hot >= 0]
        row, term, weights = row[hot < 0], term[hot < 0], weights[hot < 0]
        often, width = self.lists[term + 1] - self.lists[term], self.blocks * BLOCK
        posting = _ranges(self.lists[term], often)
        spot = np.repeat(row * width, often)
        spot += self.place[posting]
        power = np.repeat(weights, often)
        power *= self.weight[posting]
        found = np.bincount(spot, power, size * width).astype(np.float64, copy=False).reshape(size, self.blocks, BLOCK)
        bounds = found.max(axis=2) + queries @ self.dense_most
        leading = np.argsort(-bounds, axis=1, kind="stable")[:, :FIRST]
        read = np.zeros(bounds.shape, bool)
        np.put_along_axis(read, leading, True, axis=1)
        self._read(found, queries, read, left_out)
        some = np.take_along_axis(found, leading[:, :, None], axis=1).reshape(size, -1)
        last = np.round(np.partition(some, -count, axis=1)[:, -count], DECIMALS) if some.shape[1] >= count else np.zeros(size)
        self._read(found, queries, ~read & (bounds >= last[:, None] - 2 * EPSILON), left_out)
        # What was not read is below its bound.
        found = found.reshape(size, width)
        own, place = np.nonzero((found >= last[:, None] - EPSILON) & (found > EPSILON / 2))
        power = np.round(found[own, place], DECIMALS)
        own, place, power = own[power > EPSILON], place[power > EPSILON], power[power > EPSILON]
        order = np.lexsort((place, -power, own))
        own, place, power = own[order], place[order], power[order]
        rank = np.arange(len(own)) - np.searchsorted(own, own)
        own, place, power, rank = own[rank < count], place[rank < count], power[rank < count], rank[rank < count]
        best[own, rank], where[own, rank] = power, place
        return best, where

    def _read(self, found: np.ndarray, queries: np.ndarray, chosen: np.ndarray, left_out: np.ndarray | None) -> None:
        """Add the products with the dense rows of the chosen blocks."""
        for block in np.flatnonzero(chosen.any(axis=0)):
            own = np.flatnonzero(chosen[:, block])
            found[own, block] += queries[own] @ self.dense[block]
        if left_out is not None:
            some = np.flatnonzero(left_out >= 0)
            found[some, left_out[some] // BLOCK, left_out[some] % BLOCK] = 0.0


class Model:
    """The words of the examples with their document frequencies, the index and the calibration."""

    def __init__(self, total: int, vocabulary: Vocabulary, frequency: np.ndarray, ids: list, texts: list[str],
                 labels: np.ndarray, weights: np.ndarray):
        self.total, self.vocabulary = total, vocabulary
        self.rarity = np.log((1 + total) / (1 + frequency)) + 1
        self.unseen = float(np.log((1 + total) / 2) + 1)
        self.prior = float((labels * weights).sum() / max(weights.sum(), EPSILON))
        row, own, unit = self.weighted(texts)
        often = np.bincount(own, minlength=vocabulary.size)
        self.index = Index(row, own, unit, unit * often[own], len(ids), vocabulary.size)
        order = self.index.order
        self.ids, self.labels, self.weights = [ids[place] for place in order], labels[order], weights[order]
        self._calibrate([texts[place] for place in order])

    def weighted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place, weight) of unit TF-IDF vectors of whole texts, with the logarithm of the count as TF.

        A word that no example has counts for the length of a text like one that occurs in one text.
        """
        row, place, times = self.vocabulary.counts(texts)
        known = place >= 0
        weights = 1 + np.log(times)
        weights[known] *= self.rarity[place[known]]
        weights[~known] *= self.unseen
        length = np.sqrt(np.bincount(row, weights * weights, len(texts)))
        return row[known], place[known], weights[known] / length[row[known]]

    def votes(self, texts: list[str], left_out: np.ndarray | None = None):
        """(share of toxic votes, whether there was any neighbour, cosines, places).

        A vote has the weight of its cosine, so nearer examples count more.
        """
        near, where = self.index.nearest(len(texts), *self.weighted(texts), NEIGHBOURS, left_out)
        there = where >= 0
        if len(self.labels):
            power = np.where(there, near * self.weights[where], 0.0)
            toxic = (power * self.labels[where]).sum(axis=1)
        else:
            power, toxic = np.zeros(near.shape), np.zeros(len(near))
        share = (toxic + PRIOR_WEIGHT * self.prior) / (power.sum(axis=1) + PRIOR_WEIGHT)
        return share, there.any(axis=1), near, where

    def _calibrate(self, texts: list[str]) -> None:
        """Rising steps from the share of votes to how often such examples are toxic.

        Each example votes without itself. Examples without any neighbour have their own share.
        """
        labels, weights = self.labels, self.weights
        parts = [self.votes(texts[low:low + ROWS], np.arange(low, min(low + ROWS, len(texts))))[:2]
                 for low in range(0, len(texts), ROWS)]
        share = np.concatenate([part[0] for part in parts]) if parts else np.zeros(0)
        some = np.concatenate([part[1] for part in parts]) if parts else np.zeros(0, bool)
        lonely = ~some
        total = weights[lonely].sum()
        self.lonely = float(((labels * weights)[lonely].sum() + self.prior) / (total + 1))
        steps: list[list[float]] = []
        for value in np.unique(share[some]):
            same = some & (share == value)
            steps.append([value, float((labels * weights)[same].sum()), float(weights[same].sum())])
            while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
                _, toxic, weight = steps.pop()
                steps[-1][1] += toxic
                steps[-1][2] += weight
        self.edges = np.array([step[0] for step in steps])
        self.levels = np.array([(step[1] + self.prior) / (step[2] + 1) for step in steps])

    def score(self, texts: list[str]):
        """(calibrated score, cosines, places) of texts."""
        share, some, near, where = self.votes(texts)
        if len(self.edges):
            level = self.levels[np.maximum(np.searchsorted(self.edges, share, side="right") - 1, 0)]
        else:
            level = np.full(len(share), self.prior)
        return np.where(some, level, self.lonely), near, where


def document_frequencies(texts: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """How many of all texts have each word of a vocabulary.

    A task holds one count for each word of the vocabulary, whatever its texts hold.
    """
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, find = shared.value, shared.value.place.get
        totals = np.zeros(own.size, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                words = set(words_of(text))
                places = np.fromiter(map(find, words, repeat(-1)), np.int64, len(words))
                totals[places[places >= 0]] += 1
                if own.stems:
                    totals[np.unique(own.stems_of(places, words)[0])] += 1
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_pydict({"place": some.astype(np.int32), "n": totals[some]})

    found = texts.mapInArrow(count, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    result = np.zeros(vocabulary.size, np.int64)
    result[found["place"].to_numpy()] = found["n"].to_numpy()
    return result


def learn(texts: DataFrame, examples: DataFrame, row_id: str, weights: dict) -> Model:
    """A model from the examples (id, text, _label), with document frequencies over all texts.

    The driver and each task hold the words of the examples, so their memory follows the documented
    number of examples and not the corpus.
    """
    # At most 2 * most rows; of a repeated id the smallest text.
    rows = examples.groupBy(row_id).agg(F.min("text").alias("text"), F.max("_label").alias("_label")).collect()
    rows = sorted(rows, key=lambda row: row[0])
    kinds = np.array([float(row["_label"]) for row in rows])
    vocabulary = Vocabulary.of([row["text"] for row in rows], kinds)
    return Model(texts.count(), vocabulary, document_frequencies(texts, vocabulary), [row[0] for row in rows],
                 [row["text"] for row in rows], kinds, np.array([weights[int(kind)] for kind in kinds]))


def toxicity(documents: DataFrame, labels: DataFrame, text: str = "text", row_id: str = "doc_id", label: str = "toxic",
             most: int = EXAMPLES, keep: list[str] | None = None) -> DataFrame:
    """All rows with held_out, score (0 to 1), predicted (1 from 0.3 on) and evidence.

    Examples are labelled rows that are not held out: at most `most` of each class. A score reads
    the text alone: its nearest examples by TF-IDF cosine of all words, and of those starts of words
    that tell the classes of the examples apart, vote with their cosines, and the share of toxic
    votes is calibrated by how the examples fare among each other. Texts that are null,
    empty or without any word of an example have no neighbours and share one low score. evidence lists the
    nearest examples as (id, cosine, label). keep names the columns that pass through, all by
    default. An id with several labels is toxic if any of them
    says so; without any labels all scores are 0. Columns named like the results are replaced.
    """
    documents = documents.drop("held_out", "score", "predicted", "evidence")
    keep = [name for name in documents.columns if keep is None or name in keep]
    known = labels.filter(F.col(label).isin(0, 1) & F.col(row_id).isNotNull() & ~held_out(row_id)) \
        .groupBy(row_id).agg(F.max(label).alias("_label"))
    present = known.join(documents.select(row_id).distinct(), row_id, "left_semi")
    picked, weights = sampled(present, row_id, "_label", most)
    # At most 2 * most rows, by the two limits above.
    picked = F.broadcast(stage(picked, "examples"))
    known = documents.join(picked, row_id).select(row_id, "_label", whole(text).alias("text"))
    model = learn(documents.select(whole(text).alias("text")), known, row_id, weights)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, evidence array<struct<id:long,cosine:double,label:int>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            scores, evidence, texts = np.zeros(len(batch)), [], batch.tolist()
            for low in range(0, len(texts), ROWS):
                part = slice(low, low + ROWS)
                scores[part], near, where = own.score(texts[part])
                for row_near, row_where in zip(near, where):
                    evidence.append([{"id": own.ids[spot], "cosine": cosine, "label": int(own.labels[spot])}
                                     for cosine, spot in zip(row_near.tolist(), row_where.tolist()) if spot >= 0])
            yield pd.DataFrame({"score": scores, "evidence": evidence})

    if not model.prior:
        scored = documents.withColumn("_found", F.struct(F.lit(0.0).alias("score"), F.array().cast(
            "array<struct<id:long,cosine:double,label:int>>").alias("evidence")))
    else:
        scored = documents.withColumn("_found", run(whole(text)))
    return scored.select(*keep, held_out(row_id).alias("held_out"), F.col("_found.score").alias("score"),
                         (F.col("_found.score") >= 0.3).cast("int").alias("predicted"), F.col("_found.evidence").alias("evidence"))
