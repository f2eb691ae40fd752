"""Toxicity by a linear classifier that is regularised by counterfactuals.

Features are hashed words, their beginnings, and beginnings with the word's length. The classifier is fitted on a bounded
sample of labelled texts. Sentences of the sample that name a group are written again with another group in its place, and
the change of score between the two is penalised: groups that are merely mentioned should not move the score.

Which words name groups is a parameter (IDENTITY_TERMS). The sample's own neutral words are swapped as well: frequent words
that are tied to neither label, together with those that they share texts with, so that words of one language replace each
other. They keep the penalty at work on texts in which no word of the list occurs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from .common import CACHE_ENTRIES, HELD_LENGTH, materialize, numbered, place_of, rows, without
from .linear import Rows, fit_logistic, sigmoid

#: Words for groups of people, by language; all swaps stay within one kind and language.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("blind", "deaf", "disabled", "elderly"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


@dataclass(frozen=True)
class Settings:
    """sample: most labelled texts that the classifier is fitted on, those with the least hash. bits: of the feature hash.

    swapped: how many of the sample's texts have their sentences swapped. swap_weight: of the mean squared change of score.
    least: how many texts a feature needs; clear: by how many standard errors its share must differ between the labels.
    neutral: most neutral words that are swapped; share: of the sample's texts that must hold such a word; tied: by how many
    standard errors its share may differ at most; together: the share of a word's texts that the first word of its set must be in.
    """

    sample: int = 20_000
    bits: int = 20
    swapped: int = 4000
    swap_weight: float = 1.0
    least: int = 3
    clear: float = 3.5
    neutral: int = 120
    share: float = 0.02
    tied: float = 2.0
    together: float = 0.35
    toxic_weight: float = 2.5
    threshold: float = 0.7
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS


_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
_SENTENCE = regex.compile(r"[.!?\n]+")


def word_features(word: str, bits: int) -> tuple[int, ...]:
    word = word.strip(_EDGE)
    if not word:
        return ()
    names = ["w" + word, *(f"b{k}{word[:k]}" for k in range(3, 8) if len(word) > k), *(f"l{k}{word[:k]}{len(word)}" for k in (4, 6) if len(word) > k)]
    mask = (1 << bits) - 1
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) & mask for x in names)


class _Known(dict):
    """Something remembered for each word, for a bounded number of words that aren't long."""

    def __init__(self, make, most: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        value = self.make(word)
        if len(word) <= HELD_LENGTH:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value


def _features(text: str | None, known: _Known) -> np.ndarray:
    """The distinct features of a text's distinct words."""
    found: set[int] = set()
    for word in set((text or "").lower().split()):
        found.update(known[word])
    return np.fromiter(found, np.int64, len(found))


def swapped_sentences(text: str, kinds: dict[str, tuple[str, ...]]) -> Iterator[tuple[list[str], list[str]]]:
    """The words of each sentence that holds a term, and those of the sentence with another term of its kind in its place.

    Each term of a sentence is replaced once, by the one that a hash of the sentence and the term names.
    """
    for sentence in _SENTENCE.split(text.lower()):
        found = [w.strip(_EDGE) for w in sentence.split()]
        for term in sorted(set(found) & kinds.keys()):
            others = [x for x in kinds[term] if x != term]
            if others:
                other = others[zlib.crc32(f"{term} {sentence}".encode("utf-8", "surrogatepass")) % len(others)]
                yield found, [other if w == term else w for w in found]


@dataclass(frozen=True)
class Model:
    """swapped: how many sentences were swapped. terms: the sets of words that replaced each other."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int
    swapped: int = 0
    terms: tuple[tuple[str, ...], ...] = ()


def neutral_sets(sample: DataFrame, s: Settings) -> tuple[tuple[str, ...], ...]:
    """Sets of frequent words of sample(text, toxic) that are tied to neither label; words of one set occur in the same texts.

    Bounded by the settings: s.neutral words come to the driver, and how many texts each two of them share.
    """
    n = sample.groupBy("toxic").count().collect()
    sizes = {r.toxic: r["count"] for r in n}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return ()
    word = F.explode(F.array_distinct(F.split(F.lower("text"), r"[\s\p{Punct}]+"))).alias("word")
    counted = sample.select(word, "toxic").where("word <> ''").groupBy("word").agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").alias("toxic"))
    frequent = counted.where(F.col("clean") + F.col("toxic") >= max(s.least, s.share * (clean + toxic)))
    differ = F.col("toxic") / toxic - F.col("clean") / clean
    part = (F.col("clean") + F.col("toxic")) / (clean + toxic)
    tied = F.abs(differ) / F.sqrt(F.greatest(part * (1 - part), F.lit(1e-12)) * (1 / clean + 1 / toxic))
    found = frequent.where(tied <= s.tied).orderBy(F.desc(F.col("clean") + F.col("toxic")), "word").limit(s.neutral).collect()
    words = [r.word for r in found]
    place = {w: i for i, w in enumerate(words)}

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((len(words), len(words)), np.int64)
        for b in rows(batches, 500):
            for text in b.column(0).to_pylist():
                at = np.array(sorted({place[x] for x in (w.strip(_EDGE) for w in (text or "").lower().split()) if x in place}), np.int64)
                both[np.ix_(at, at)] += 1
        i, j = np.nonzero(both)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(both[i, j])], ["i", "j", "n"])

    both = np.zeros((len(words), len(words)))
    for r in sample.select("text").mapInArrow(share, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        both[r.i, r.j] = r.n
    sets: list[list[int]] = []
    for i in range(len(words)):  # most frequent first
        home = next((x for x in sets if both[i, x[0]] >= s.together * both[i, i]), None)
        sets.append([i]) if home is None else home.append(i)
    return tuple(tuple(words[i] for i in x) for x in sets if len(x) > 1)


def fit(sample: DataFrame, s: Settings) -> Model:
    """The model of sample(key, text, toxic). Features are counted and chosen by Spark; what comes to the driver is bounded by the sample and the hash."""
    n_features = 1 << s.bits
    some = materialize(sample.orderBy("key").limit(s.swapped).select("text", "toxic").repartition(8), "swapped")
    sets = (*s.terms, *neutral_sets(some, s))
    kinds = {w: kind for kind in reversed(sets) for w in kind}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(lambda w: word_features(w, s.bits), 30_000)
        counts = np.zeros((2, n_features), np.int32)
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counts[toxic][_features(text, known)] += 1
        at = np.flatnonzero(counts.any(0))
        yield pa.record_batch([pa.array(at), pa.array(counts[0][at].astype(np.int64)), pa.array(counts[1][at].astype(np.int64))], ["feature", "clean", "toxic"])

    n_clean, n_toxic = sample.agg(F.coalesce(F.sum((F.col("toxic") == 0).cast("long")), F.lit(0)), F.coalesce(F.sum((F.col("toxic") == 1).cast("long")), F.lit(0))).first()
    n = max(1, n_clean + n_toxic)
    counted = sample.select("text", "toxic").mapInArrow(count, "feature long, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = (F.col("clean") + F.col("toxic")) / n
    differ = F.col("toxic") / max(1, n_toxic) - F.col("clean") / max(1, n_clean)
    error = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / max(1, n_clean) + 1 / max(1, n_toxic)))
    clear = counted.where((F.col("toxic") >= s.least) & (differ / error > s.clear))
    # the terms' own words always have a weight, which the swaps then hold together
    own = {word_features(w, s.bits)[0] for w in kinds}
    chosen = np.array(sorted({r.feature for r in clear.select("feature").collect()} | own), np.int64)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Known(lambda w: word_features(w, s.bits), 30_000)
        for b in rows(batches, 500):
            found = [np.flatnonzero(np.isin(chosen, _features(t, known))).astype(np.int32) for t in b.column(1).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(found, pa.list_(pa.int32())), b.column(2)], ["key", "features", "toxic"])

    got = sample.select("key", "text", "toxic").mapInArrow(pick, "key long, features array<int>, toxic int").toPandas().sort_values("key")
    target = got["toxic"].to_numpy(float) if len(got) else np.zeros(0)
    found = Rows.of([(np.asarray(x, np.int64), np.ones(len(x))) for x in got["features"]])

    place = {int(f): i for i, f in enumerate(chosen)}

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What swaps take from and add to the features of sentences: (off, on, n)."""
        known = _Known(lambda w: frozenset(place[f] for f in word_features(w, s.bits) if f in place), 30_000)
        changes: Counter = Counter()
        for b in rows(batches, 200):
            for text in b.column(0).to_pylist():
                for before, after in swapped_sentences(text or "", kinds):
                    a, z = (set().union(*map(known.__getitem__, set(x))) for x in (before, after))
                    changes[tuple(sorted(a - z)), tuple(sorted(z - a))] += 1
        off, on = ([list(k[i]) for k in changes] for i in (0, 1))
        yield pa.record_batch([pa.array(off, pa.list_(pa.int32())), pa.array(on, pa.list_(pa.int32())), pa.array(list(changes.values()), pa.int64())], ["off", "on", "n"])

    changes, weights = [], []
    for r in some.select("text").mapInArrow(change, "off array<int>, on array<int>, n long").groupBy("off", "on").agg(F.sum("n").alias("n")).orderBy("off", "on").collect():
        changes.append((np.array([*r.off, *r.on], np.int64), np.array([-1.0] * len(r.off) + [1.0] * len(r.on))))
        weights.append(r.n)
    swapped = int(sum(weights))
    w, b = fit_logistic(found, target, 1 + (s.toxic_weight - 1) * target, len(chosen), Rows.of(changes), s.swap_weight * np.array(weights, float) / max(1, swapped))
    return Model(chosen, w, b, s.bits, swapped, sets)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, size: int) -> DataFrame:
    """(key, text, toxic) of at most size labelled documents, those with the least key, a hash of doc_id, among those for which learn holds.

    Labels that are null or neither 0 nor 1 don't count; of several for one document the greatest does, and of several texts
    with one doc_id the least.
    """
    usable = labels.where(learn & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    usable = usable.withColumn("key", F.xxhash64("doc_id", F.lit(3)))
    n = usable.count()
    if n > size:
        # a share by hash that gives somewhat more rows, then the exact bound
        share = F.pmod("key", F.lit(1_000_000))
        usable = usable.where(share < int(1_000_000 * min(1.0, 1.2 * size / n))).orderBy(share, "key", "doc_id").limit(size)
    usable = materialize(usable, "labelled")
    joined = docs.select("doc_id", "text").join(F.broadcast(usable), "doc_id")
    return materialize(joined.groupBy("doc_id", "key").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")).select("key", "text", "toxic"), "sample")


def _scored(docs: DataFrame, labels: DataFrame, held_out: Column, s: Settings) -> DataFrame:
    """numbered(docs) with held_out, score and predicted."""
    plain = numbered(docs)
    id_, text = place_of(docs, "doc_id"), place_of(docs, "text")
    held = F.coalesce(held_out, F.lit(True))
    texts = plain.select(F.col(id_).alias("doc_id"), F.col(text).alias("text"))
    model = fit(labelled_sample(texts, labels.select("doc_id", "toxic"), ~held, s.sample), s)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # held_out is a condition on a column named doc_id
    marked = plain.withColumnRenamed(id_, "doc_id").withColumn("held_out", held).withColumnRenamed("doc_id", id_)
    names = marked.columns

    def run(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        place = {int(f): i for i, f in enumerate(m.features)}
        # hardly any word has a feature of the model, so a long memory is cheap
        known = _Known(lambda w: tuple(place[f] for f in word_features(w, m.bits) if f in place), 200_000)
        at = names.index(text)
        for b in rows(texts, 500):
            scores = []
            for t in b.column(at).to_pylist():
                found: set[int] = set()
                for features in map(known.__getitem__, set((t or "").lower().split())):
                    if features:
                        found.update(features)
                scores.append(float(sigmoid(m.bias + m.weights[sorted(found)].sum())))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), pa.array([int(x >= s.threshold) for x in scores], pa.int32())], [*names, "score", "predicted"])

    return marked.mapInArrow(run, StructType([*marked.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())]))


def score_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, settings: Settings | None = None) -> DataFrame:
    """docs with held_out, score (0 to 1) and predicted (1 at the threshold and above).

    docs: doc_id, text, and any others, which are kept (columns named held_out, score or predicted, in whatever letters, are
    replaced). held_out: a condition on doc_id; labels of such rows are never looked at, and rows for which it is null count
    as held out. Null and empty texts get the score of a text without features. Repeated rows stay. Without usable labels
    every score is 0.5. No rows: an empty table. Scores depend on the rows only, not on their order or files.
    """
    docs = docs.select(*without(docs, "held_out", "score", "predicted"))
    return _scored(docs, labels, held_out, settings or Settings()).toDF(*docs.columns, "held_out", "score", "predicted")


def drop_toxic(docs: DataFrame, labels: DataFrame, held_out: Column, settings: Settings | None = None) -> DataFrame:
    """The documents that are not predicted toxic, with all columns of docs as they were, whatever their names. Odd rows: as in score_toxicity()."""
    scored = _scored(docs, labels, held_out, settings or Settings()).where("predicted = 0")
    return scored.drop("held_out", "score", "predicted").toDF(*docs.columns)
