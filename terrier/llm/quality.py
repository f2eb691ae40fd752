"""Quality by weak labels.

Overlapping heuristics vote good, bad or not at all on every text. Expectation-maximisation over the counts of vote patterns
estimates how accurate each heuristic is, and so how likely a text with those votes is good. These posteriors, not human
labels, train a hashed linear scorer on a bounded sample; the scorer sees word shapes and never the votes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .common import CACHE_ENTRIES, HELD_LENGTH, materialize, numbered, place_of, rows, without
from .linear import Rows, fit_logistic, sigmoid

#: Frequent small words of the languages at hand; a parameter of the votes.
SMALL_WORDS = frozenset(
    "the of and to in is that it for was on are as with be at by this from or a an"
    " de la le et les des en un une du que est pour qui dans par sur pas au"
    " el los las y del se por con para su al lo"
    " der die und den von zu das mit sich des auf für ist im dem nicht ein eine als".split()
)


@dataclass(frozen=True)
class Settings:
    """sample: most texts of each side that the scorer is fitted on, those with the least hash of the row. bits: of the feature hash. threshold: scores below are rejected; texts too short for any vote lie above it."""

    sample: int = 4000
    bits: int = 16
    threshold: float = 0.35
    rounds: int = 60


HEURISTICS = ("signs", "capitals", "repeats", "variety", "top_word", "small_words", "bars", "word_length")


def votes(text: str | None) -> str:
    """A letter for each heuristic: g good, b bad, - no vote. Null and blank texts: only dashes."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return "-" * len(HEURISTICS)

    def vote(good: bool, bad: bool, least: int = 1) -> str:
        return "-" if n < least else "b" if bad else "g" if good else "-"

    joined = "".join(words)
    letters = sum(map(str.isalpha, joined)) if not joined.isalpha() else len(joined)
    signs = 1 - letters / len(joined)
    upper = sum(map(str.isupper, joined)) / max(1, letters)
    counts = Counter(words)
    same = sum(map(str.__eq__, words, words[1:])) / n
    variety = len(counts) / n
    top = counts.most_common(1)[0][1] / n
    small = sum(counts[w] for w in SMALL_WORDS if w in counts) / n
    bars = sum(c for w, c in counts.items() if not any(map(str.isalnum, w))) / n
    length = len(joined) / n
    return (
        vote(False, signs > 0.15)
        + vote(False, upper > 0.5)
        + vote(False, same > 0.1, 4)
        + vote(variety > min(0.5, 80 / n), variety < min(0.3, 40 / n), 12)
        + vote(False, top > 0.25, 12)
        + vote(small > 0.12, small < 0.04, 12)
        + vote(False, bars > 0.12, 4)
        + vote(False, length > 14)
    )


def posteriors(patterns: dict[str, int], rounds: int = 60) -> tuple[dict[str, float], np.ndarray, float]:
    """The probability of good for each vote pattern, each heuristic's rates [truth, heuristic, vote], and the share of good.

    Expectation-maximisation of the model in which votes are independent given the truth. It starts with texts that nothing
    votes against as good; pseudo-counts hold heuristics to be right rather than wrong.
    """
    if not patterns:
        return {}, np.full((2, len(HEURISTICS), 3), 0.5) * [1, 1, 0], 0.5
    names = list(patterns)
    voted = np.array([1.0, 1.0, 0.0])  # that a heuristic has no vote says nothing
    n = np.array([patterns[p] for p in names], float)
    votes_ = np.array([["bg-".index(v) for v in p] for p in names])
    good = np.where((votes_ == 0).any(1), 0.1, 0.95)
    held = 0.002 * n.sum() * np.array([[0.9, 0.1, 0], [0.1, 0.9, 0]])[:, None, :] + 1e-6
    eye = np.eye(3)[votes_]  # pattern, heuristic, vote
    for _ in range(rounds):
        prior = float(np.clip((n * good).sum() / n.sum(), 0.02, 0.98))
        rates = np.stack([np.einsum("p,phv->hv", n * side, eye) for side in (1 - good, good)]) * voted + held * voted
        rates /= rates.sum(2, keepdims=True)
        log = np.stack([np.einsum("phv,hv->p", eye, np.log(np.where(voted > 0, rates[side], 1))) for side in (0, 1)])
        good = sigmoid(np.log(prior / (1 - prior)) + log[1] - log[0])
    return dict(zip(names, good.tolist(), strict=True)), rates, prior


_RUN = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """a, A and 0 for runs of small letters, capitals and digits; other signs stay, once a run."""
    out = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUN.sub(r"\1", out)


class _Shapes(dict):
    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word: str) -> int:
        value = zlib.crc32(shape(word).encode("utf-8", "surrogatepass")) & self.mask
        if len(word) <= HELD_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = value
        return value


def features(text: str | None, shapes: _Shapes) -> tuple[np.ndarray, np.ndarray]:
    """Columns and values: the share of each word shape, and steps of how often words repeat and how varied they are."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return np.array([zlib.crc32(b"empty") & shapes.mask]), np.ones(1)
    at, counts = np.unique(np.fromiter(map(shapes.__getitem__, words), np.int64, n), return_counts=True)
    same = sum(map(str.__eq__, words, words[1:])) / n
    varied = len(set(words)) / min(n, 400)
    steps = [b"same%d" % k for k in range(1, 6) if same >= (0.02, 0.05, 0.1, 0.2, 0.4)[k - 1]] + [b"varied%d" % k for k in range(1, 6) if varied < 0.1 * k]
    steps.append(b"long%d" % min(len(str(n)), 5))
    more = np.array([zlib.crc32(x) & shapes.mask for x in steps], np.int64)
    return np.concatenate([at, more]), np.concatenate([2 * np.sqrt(counts / n), np.ones(len(more))])


def label_weakly(texts: DataFrame, rounds: int = 60) -> tuple[DataFrame, np.ndarray, float]:
    """(key, votes, posterior) of every row of texts(key, text), the heuristics' rates, and the share of good. Patterns are counted over all texts; there are at most 3^8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows(batches, 500):
            yield pa.record_batch([b.column(0), pa.array([votes(t) for t in b.column(1).to_pylist()], pa.string())], ["key", "votes"])

    voted = materialize(texts.select("key", "text").mapInArrow(run, "key long, votes string"), "votes")
    patterns = {r.votes: r.n for r in voted.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    found, rates, prior = posteriors(patterns, rounds)
    table = texts.sparkSession.createDataFrame([(k, v) for k, v in found.items()], "votes string, posterior double")
    return voted.join(F.broadcast(table), "votes").select("key", "votes", "posterior"), rates, prior


#: Keys are spread over so many values to draw a share of them.
_SHARES = 10_000_000


def fit(texts: DataFrame, s: Settings) -> tuple[np.ndarray, float] | None:
    """Weights and bias of the scorer, from texts(key, text), key being a hash of the row; None without any clear text.

    The sample is the settings' number of rows of each side with the least keys, whatever the layout of the table; rows that
    are alike in all are one. What comes to the driver are the features of at most twice that number of texts.
    """
    labels, _, _ = label_weakly(texts, s.rounds)
    # one row for each vote pattern at most; a side on which no pattern is clear takes its clearest
    known = {r.posterior: r.n for r in labels.groupBy("posterior").agg(F.count("*").alias("n")).collect()}
    good, bad = min(0.9, max(known, default=0)), max(0.1, min(known, default=1))
    sides = {k: n for k, n in ((1, sum(n for p, n in known.items() if p >= good > 0.5)), (0, sum(n for p, n in known.items() if p <= bad < 0.5))) if n}
    if not sides:
        return None
    clear = labels.withColumn("side", F.when(F.col("posterior") >= good, 1).when(F.col("posterior") <= bad, 0))
    drawn = F.pmod("key", F.lit(_SHARES))
    parts = [
        clear.where((F.col("side") == k) & (drawn < int(_SHARES * min(1.0, 1.5 * s.sample / n)) + 1)).select("key", "posterior").distinct().orderBy(drawn, "key").limit(s.sample)
        for k, n in sorted(sides.items())
    ]
    sample = materialize(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]), "sample-keys")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = _Shapes(s.bits)
        for b in rows(batches, 500):
            found = [features(t, shapes) for t in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), pa.array([c for c, _ in found], pa.list_(pa.int64())), pa.array([v for _, v in found], pa.list_(pa.float64()))], ["key", "posterior", "columns", "values"])

    seen = texts.join(F.broadcast(sample), "key").select("key", "posterior", "text").mapInArrow(extract, "key long, posterior double, columns array<long>, values array<double>")
    got = seen.dropDuplicates(["key"]).toPandas().sort_values("key")
    target = got["posterior"].to_numpy(float)
    half = np.array([max(1.0, (target <= 0.5).sum()), max(1.0, (target > 0.5).sum())])
    weight = (len(target) / 2) / half[(target > 0.5).astype(int)]
    found = Rows.of([(np.asarray(c), np.asarray(v)) for c, v in zip(got["columns"], got["values"], strict=True)])
    return fit_logistic(found, target, weight, 1 << s.bits, steps=200)


def _judged(docs: DataFrame, s: Settings) -> DataFrame:
    """numbered(docs) with score and kept."""
    plain = numbered(docs)
    id_, text = place_of(docs, "doc_id"), place_of(docs, "text")
    keyed = plain.select(F.xxhash64(F.col(id_), F.col(text), F.lit(11)).alias("key"), F.col(text).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(fit(keyed, s) or (np.zeros(1 << s.bits), 0.0))
    names = plain.columns

    def run(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, bias = sent.value
        shapes, at = _Shapes(s.bits), names.index(text)
        for b in rows(texts, 500):
            scores = []
            for t in b.column(at).to_pylist():
                columns, values = features(t, shapes)
                scores.append(float(sigmoid(bias + w[columns] @ values)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64()), pa.array([x >= s.threshold for x in scores], pa.bool_())], [*names, "score", "kept"])

    return plain.mapInArrow(run, StructType([*plain.schema.fields, StructField("score", DoubleType()), StructField("kept", BooleanType())]))


def score_quality(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """docs with score (0 to 1, higher is better) and kept (whether it is at the threshold or above).

    docs: doc_id, text, and any others, which are kept (columns named score or kept, in whatever letters, are replaced). Null
    and blank texts have no votes and are judged by the scorer's feature for them; a null doc_id is an id like any other.
    Repeated rows stay and count each, but are one row of the sample. Without any clear text every score is 0.5. No rows: an
    empty table. Scores depend on the rows only, not on their order or files.
    """
    docs = docs.select(*without(docs, "score", "kept"))
    return _judged(docs, settings or Settings()).toDF(*docs.columns, "score", "kept")


def keep_good(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The documents that the scorer keeps, with all columns of docs as they were, whatever their names. Odd rows: as in score_quality()."""
    judged = _judged(docs, settings or Settings()).where("kept")
    return judged.drop("score", "kept").toDF(*docs.columns)
