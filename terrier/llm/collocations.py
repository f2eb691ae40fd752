"""Phrases whose words occur together more often than their parts let expect, language by language.

Words are 64-bit hashes seeded by their language, so a phrase of one language never equals one of another.

1. Words are counted. A filter of fixed size holds those that are frequent enough; words outside it break phrases, as no
   phrase is more frequent than its words.
2. Tasks sort the n-grams of their shard of texts, path by path, into count transducers: acyclic automata whose paths are
   n-grams, in order, and whose weights are counts. A path that continues the last one adds states only where they part; the
   weight of a state is the sum of what lies below it, so a transducer of n-grams counts all their prefixes too. Paths begin
   with an arc for the hash of their first words, and each range of these hashes goes to one place, where the shards'
   transducers are united and their weights summed. First pairs are counted this way, then, where all pairs are frequent,
   windows of three to five words. As the range is that of two (or three) words, a hot word is spread over all ranges.
3. Frequent phrases of one to four words, by ranges of their hash, are transducers again, with which the acceptors of parts are
   composed: that gives the count of each part of each candidate. Parts of very many candidates are dealt out over salts.
4. What remains are groupings of candidates: phrases inside longer ones, the cut of least score, and the first ranks.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_bytes, materialize, mix, numbered, place_of

#: Fixed value: what ends a piece of text; no phrase goes beyond it.
BREAKS = b".,;:!?\n\x0b\x0c\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A byte that no UTF-8 text holds stands for the ends of pieces.
END = b"\xff"
_TO_WORDS = bytes.maketrans(UPPER + BREAKS + b"\t", UPPER.lower() + b" " * len(BREAKS) + b" ")
_TO_PIECES = bytes.maketrans(UPPER + BREAKS + b"\t", UPPER.lower() + END * len(BREAKS) + b" ")
LONGEST = 5
WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


@dataclass(frozen=True)
class Phrases:
    """least: occurrences of a candidate. top: rows of each language. permille: scale of scores.

    filter_bits: of the filters, a power of two; larger ones spare work where very many words are frequent, results are the same.
    block: words that a task sorts at a time. paths: of a range, about. hot: parts with so many occurrences are dealt out over salts.
    """

    least: int = 100
    top: int = 2000
    permille: int = 1000
    filter_bits: int = 1 << 25
    block: int = 3_000_000
    paths: int = 1_500_000
    hot: int = 1 << 20
    salts: int = 64


# --- hashes and filters


def seed_of(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def word_hash(word: bytes, seed: int) -> int:
    """Never 0, which stands for the end of a piece."""
    return xxhash.xxh3_64_intdigest(word, seed) or 1


def joined(columns: list[np.ndarray]) -> np.ndarray:
    """A hash of words in order; words that are 0, at the end, don't count."""
    out = mix(columns[0])
    for c in columns[1:]:
        out = np.where(c == 0, out, mix(out * np.uint64(0x9E3779B97F4A7C15) + c))
    return out


class Filter:
    """Which hashes may be in a set: all that are, and few others."""

    def __init__(self, words: np.ndarray):
        self.words, self.mask = words, np.uint64(len(words) * 64 - 1)

    def _bit(self, at: np.ndarray) -> np.ndarray:
        at = at & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        return (self._bit(hashes) & self._bit(hashes >> np.uint64(32))).astype(bool)

    def one(self):
        """The same for one number at a time, without arrays."""
        words, mask = memoryview(self.words), int(self.mask)

        def holds(h: int) -> bool:
            a, b = h & mask, h >> 32 & mask
            return bool(words[a >> 6] >> (a & 63) & words[b >> 6] >> (b & 63) & 1)

        return holds


def filter_of(keys: DataFrame, bits: int) -> np.ndarray:
    """The filter of a column of hashes, as 64-bit words: its bits are set by groups of 64, so at most bits / 64 rows reach the driver."""
    key = F.col(keys.columns[0])
    at = keys.select(F.explode(F.array(key.bitwiseAND(bits - 1), F.shiftrightunsigned(key, 32).bitwiseAND(bits - 1))).alias("at"))
    set_ = at.groupBy(F.shiftright("at", 6).alias("i")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("b")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[set_["i"].to_numpy()] = set_["b"].to_numpy().view(np.uint64)
    return words


class _Codes(dict):
    """The hash of each word of a language, or 0 for words outside the filter and ends of pieces. Short words are remembered, up to a number."""

    HELD, LONGEST = 100_000, 64

    def __init__(self, lang: str, known: Filter):
        self.seed, self.known = seed_of(lang), known.one()

    def __missing__(self, word: bytes) -> int:
        h = word_hash(word, self.seed) if word != END else 0
        if h and not self.known(h):
            h = 0
        if len(word) <= self.LONGEST:
            if len(self) >= self.HELD:
                self.clear()
            self[word] = h
        return h


# --- transducers


def path_starts(columns: list[np.ndarray]) -> list[np.ndarray]:
    """For sorted paths: whether a new state begins at each depth, that is, where a path parts from the one before."""
    out, new = [], np.zeros(len(columns[0]), bool)
    for c in columns:
        new = new | np.r_[True, c[1:] != c[:-1]][: len(c)]
        out.append(new)
    return out


class CountTransducer:
    """An acyclic automaton in order: paths (columns of labels, the first sorting first) and the weight of each.

    The states at a depth are the stretches of paths that agree up to there; 0 as a label ends a path.
    """

    def __init__(self, columns: list[np.ndarray], weights: np.ndarray):
        self.columns, self.weights = columns, weights

    @classmethod
    def of(cls, columns: list[np.ndarray], weights: np.ndarray | None = None, told: int = 0) -> CountTransducer:
        """From n-grams in any order: sorted, and those alike made one path. told: so many columns behind the first are told by it, as it is their hash, and need no sorting unless two clash."""
        rest = columns[1 + told :]
        order = np.lexsort([*rest[::-1], columns[0]]) if rest else np.argsort(columns[0])
        same = columns[0][order][1:] == columns[0][order][:-1]
        if any((same & (c[order][1:] != c[order][:-1])).any() for c in columns[1 : 1 + told]):
            order = np.lexsort(columns[::-1])
        columns = [c[order] for c in columns]
        weights = np.ones(len(order), np.int64) if weights is None else weights[order]
        if not len(order):
            return cls(columns, weights)
        first = np.flatnonzero(path_starts(columns)[-1])
        return cls([c[first] for c in columns], np.add.reduceat(weights, first))

    def __len__(self) -> int:
        return len(self.weights)

    @staticmethod
    def union(some: list[CountTransducer], told: int = 0) -> CountTransducer:
        """All paths of several transducers, their weights summed."""
        if len(some) == 1:
            return some[0]
        return CountTransducer.of([np.concatenate(c) for c in zip(*[t.columns for t in some], strict=True)], np.concatenate([t.weights for t in some]), told)

    def states(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The first path of each state behind so many labels, and the state's weight; paths that ended before have none."""
        if not len(self):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = np.flatnonzero(path_starts(self.columns[:depth])[-1])
        return (found := first[self.columns[depth - 1][first] != 0]), np.add.reduceat(self.weights, first)[np.searchsorted(first, found)]

    def compose(self, acceptor: list[np.ndarray]) -> np.ndarray:
        """The weights of whole paths, looked up label by label: each depth narrows the stretch of paths that are still possible. 0 for none."""
        n = len(acceptor[0])
        lo, hi = np.zeros(n, np.int64), np.full(n, len(self), np.int64)
        for column, label in zip(self.columns, acceptor, strict=True):
            lo, hi = _bound(column, label, lo, hi, False), _bound(column, label, lo, hi, True)
        return np.where(lo < hi, self.weights[np.minimum(lo, len(self) - 1)], 0) if len(self) else np.zeros(n, np.int64)


def _bound(column: np.ndarray, label: np.ndarray, lo: np.ndarray, hi: np.ndarray, above: bool) -> np.ndarray:
    """Binary search of each label in its own stretch [lo, hi) of a column: the first place not below it, or above it."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        left = np.flatnonzero(lo < hi)
        if not len(left):
            return lo
        middle = (lo[left] + hi[left]) // 2
        value, wanted = column[middle], label[left]
        right = value <= wanted if above else value < wanted
        lo[left] = np.where(right, middle + 1, lo[left])
        hi[left] = np.where(right, hi[left], middle)


# --- counting


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, h, n) of texts (lang, text), merged for some of them at a time."""
    held: dict[str, Counter] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            seed, found = seed_of(lang), list(counts)
            for at in range(0, len(found), 20_000):
                some = found[at : at + 20_000]
                hashes = np.fromiter((word_hash(w, seed) for w in some), np.uint64, len(some)).view(np.int64)
                columns = [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.binary()).cast(pa.string()), pa.array(hashes), pa.array([counts[w] for w in some], pa.int64())]
                yield pa.record_batch(columns, ["lang", "word", "h", "n"])
        held.clear()

    for batch in by_bytes(batches, 1):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text:
                held.setdefault(lang, Counter()).update(text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split())
                size += len(text)
        if size > 32 << 20 or sum(map(len, held.values())) > 200_000:
            yield from out()
            size = 0
    yield from out()


def _pairs(codes: np.ndarray, _: Filter | None) -> list[np.ndarray]:
    """(arc, w1, w2) of all pairs of words."""
    a, b = codes[:-1], codes[1:]
    both = (a != 0) & (b != 0)
    a, b = a[both], b[both]
    return [joined([a, b]), a, b]


def _windows(codes: np.ndarray, pairs: Filter | None) -> list[np.ndarray]:
    """(arc, w1, ..., w5) of windows of three to five words as far as all their pairs are in the filter; 0 behind the end of shorter ones."""
    codes = np.r_[codes, np.zeros(LONGEST, np.uint64)]
    n = len(codes) - LONGEST
    a, b = codes[:-1], codes[1:]
    both = np.flatnonzero((a != 0) & (b != 0))
    good = np.zeros(len(codes), bool)
    good[both[pairs.holds(joined([a[both], b[both]]))]] = True
    at = np.flatnonzero(good[:n] & good[1 : n + 1])
    columns = [codes[at + i] for i in range(3)]
    on = np.ones(len(at), bool)
    for i in range(3, LONGEST):
        on = on & good[at + i - 1]
        columns.append(np.where(on, codes[at + i], np.uint64(0)))
    return [joined(columns[:3]), *columns]


def _grams(s: Phrases, make, width: int, range_bits: int, sent_words, sent_pairs=None):
    """(lang, range, w1, ..., weight): the transducers of a shard of texts (lang, text), packed, a row for each range of arcs. Arcs follow from the words."""
    names = ["lang", "range", *WORDS[:width], "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filter(sent_words.value)
        pairs = Filter(sent_pairs.value) if sent_pairs else None
        codes: dict[str, _Codes] = {}
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                made = CountTransducer.of(make(np.concatenate(parts), pairs), told=min(width, 3))
                if not len(made):
                    continue
                place = (made.columns[0] >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(made), np.int64)
                cuts = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
                columns = [[x.tobytes() for x in np.split(c, cuts[1:])] for c in (*made.columns[1:], made.weights.astype(np.int32))]
                yield pa.record_batch([pa.array([lang] * len(cuts), pa.string()), pa.array(place[cuts]), *[pa.array(c, pa.binary()) for c in columns]], names)
            held.clear()

        for batch in by_bytes(batches, 1):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                if lang not in codes:
                    if len(codes) >= 8:
                        codes.clear()
                    codes[lang] = _Codes(lang, known)
                tokens = text.encode("utf-8", "surrogatepass").translate(_TO_PIECES).replace(END, b" " + END + b" ").split()
                tokens.append(END)
                held.setdefault(lang, []).append(np.fromiter(map(codes[lang].__getitem__, tokens), np.uint64, len(tokens)))
                size += len(tokens)
                if size >= s.block:
                    yield from out()
                    size = 0
        yield from out()

    return run


def _united(s: Phrases, width: int, depths: range):
    """(lang, w1, ..., w5, a) of frequent phrases with that many words: of rows ordered by lang and range, the union of each range's transducers."""

    told = min(width, 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, size = None, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            made = CountTransducer.union(held, told)
            for depth in depths:
                first, weight = made.states(depth + 1)  # behind the arc for the first words
                often = weight >= s.least
                first, weight = first[often], weight[often]
                if len(first):
                    words = [made.columns[i + 1][first] if i < depth else np.zeros(len(first), np.uint64) for i in range(LONGEST)]
                    yield pa.record_batch([pa.array([current[0]] * len(first), pa.string()), *[pa.array(w.view(np.int64)) for w in words], pa.array(weight)], ["lang", *WORDS, "a"])

        for batch in batches:
            for k in range(batch.num_rows):
                key = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                if key != current:
                    if held:
                        yield from out()
                    current, held, size = key, [], 0
                words = [np.frombuffer(batch.column(2 + i)[k].as_py(), np.uint64) for i in range(width)]
                held.append(CountTransducer([joined(words[:told]), *words], np.frombuffer(batch.column(2 + width)[k].as_py(), np.int32).astype(np.int64)))
                size += len(held[-1])
                if len(held) > 1 and size > s.paths and size > 2 * len(held[0]):
                    held = [CountTransducer.union(held, told)]
                    size = len(held[0])
        if held:
            yield from out()

    return run


_PHRASE = "lang string, " + ", ".join(f"{w} long" for w in WORDS) + ", a long"


def _counted(texts: DataFrame, s: Phrases, make, width: int, depths: range, range_bits: int, *sent) -> DataFrame:
    columns = "".join(f", {w} binary" for w in WORDS[:width])
    shards = texts.mapInArrow(_grams(s, make, width, range_bits, *sent), f"lang string, range long{columns}, weight binary")
    placed = shards.repartition("lang", "range").sortWithinPartitions("lang", "range")
    return placed.mapInArrow(_united(s, width, depths), _PHRASE)


# --- parts of candidates

_KEY = "key long, salt int"


def _keys(columns: list[str], batch: pa.RecordBatch) -> np.ndarray:
    return joined([batch.column(c).to_numpy().view(np.uint64) for c in columns])


def _parts(s: Phrases, hot: np.ndarray):
    """(key, salt, ask, p1, ..., p4, k, right, lang, w1, ..., w5, a): both parts of each cut of candidates (lang, w1, ..., w5, a)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [batch.column(w).to_numpy().view(np.uint64) for w in WORDS]
            size = sum((w != 0).astype(np.int64) for w in words)
            salt = (joined(words) % np.uint64(s.salts)).astype(np.int32)
            for cut in range(1, LONGEST):
                mine = np.flatnonzero(size > cut)
                if not len(mine):
                    continue
                none = np.zeros(len(mine), np.uint64)
                for right in (False, True):
                    part = [w[mine] for w in (words[cut:] if right else words[:cut])]
                    part = (part + [none] * LONGEST)[: LONGEST - 1]
                    key = joined(part)
                    dealt = np.where(np.isin(key, hot), salt[mine], 0).astype(np.int32)
                    same = [pa.array(np.full(len(mine), x)) for x in (cut, right)]
                    columns = [pa.array(key.view(np.int64)), pa.array(dealt), *[pa.array(p.view(np.int64)) for p in part], *same]
                    yield pa.record_batch([*columns, *[c.take(pa.array(mine)) for c in batch.columns]], ["key", "salt", *_P, "k", "right", *batch.schema.names])

    return run


_P = [f"p{i}" for i in range(1, LONGEST)]


def _known(s: Phrases, hot: np.ndarray):
    """(key, salt, p1, ..., p4, f) of phrases (w1, ..., w4, a): once, or for each salt where the phrase is hot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [batch.column(w).to_numpy().view(np.uint64) for w in WORDS[:-1]]
            key, f = joined(words), batch.column("a").to_numpy()
            times = np.where(np.isin(key, hot), s.salts, 1)
            at = np.repeat(np.arange(len(key)), times)
            salt = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.record_batch([pa.array(key[at].view(np.int64)), pa.array(salt.astype(np.int32)), *[pa.array(w[at].view(np.int64)) for w in words], pa.array(f[at])], ["key", "salt", *_P, "f"])

    return run


def _composed(asked: pa.Table, known: pa.Table) -> pa.Table:
    """(lang, w1, ..., w5, a, k, right, f): the acceptor of the parts asked for, composed with the transducer of a range's phrases. Paths begin with the salt."""

    def paths(t: pa.Table) -> list[np.ndarray]:
        return [t["salt"].to_numpy().astype(np.uint64), *[t[p].to_numpy().view(np.uint64) for p in _P]]

    f = CountTransducer.of(paths(known), known["f"].to_numpy()).compose(paths(asked))
    return asked.select(["lang", *WORDS, "a", "k", "right"]).append_column("f", pa.array(f, pa.int64()))


def collocations(docs: DataFrame, settings: Phrases | None = None) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of each language of docs(lang, text).

    Texts are lower-cased (A-Z) and cut into pieces at `[.,;:!?\\x0A-\\x0D]` and those into words `[^\\x20\\x09]+`. n: words of the
    language; a: occurrences of the phrase, of two to five words, within pieces. Of each cut into two parts with l and r
    occurrences the score is floor(1000 a n / (l r)); the least counts, the first cut among equals. Phrases inside a longer one
    that is as frequent are left out. Ranks by score, a, and phrase in the order of its bytes.

    A null lang is `und`; null, empty and blank texts have no words; repeated rows count each. Languages without candidates have
    no rows; an empty table gives an empty table. Other columns are not read.
    """
    s = settings or Phrases()
    plain = numbered(docs).select(F.coalesce(F.col(place_of(docs, "lang")), F.lit("und")).alias("lang"), F.col(place_of(docs, "text")).alias("text"))
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast

    words = plain.mapInArrow(_count_words, "lang string, word string, h long, n long").groupBy("lang", "word", "h").agg(F.sum("n").alias("n"))
    words = materialize(words, "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    tokens = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = words.where(F.col("n") >= s.least)
    range_bits = (tokens // s.paths).bit_length()

    known = send(filter_of(often.select("h"), s.filter_bits))
    pairs = materialize(_counted(plain, s, _pairs, 2, range(2, 3), range_bits, known), "pairs")
    pair_key = pairs.select("w1", "w2").mapInArrow(lambda batches: (pa.record_batch([pa.array(_keys(WORDS[:2], b).view(np.int64))], ["key"]) for b in batches), "key long")
    longer = materialize(_counted(plain, s, _windows, LONGEST, range(3, LONGEST + 1), range_bits, known, send(filter_of(pair_key, s.filter_bits))), "longer")

    candidates = pairs.unionByName(longer)
    # what a longer candidate, by one word, holds: its first words and its last ones
    none = F.lit(0).cast("long")
    last = [F.when(F.col(WORDS[i]) != 0, F.when(F.col(WORDS[i + 1]) != 0, F.col(WORDS[i])).otherwise(none)).otherwise(none).alias(WORDS[i]) for i in range(LONGEST - 1)]
    inside = [longer.select("lang", *last, none.alias(WORDS[-1]), F.col("a").alias("longer")), longer.select("lang", *[F.col(WORDS[i + 1]).alias(WORDS[i]) for i in range(LONGEST - 1)], none.alias(WORDS[-1]), F.col("a").alias("longer"))]
    marked = candidates.withColumn("longer", none).unionByName(inside[0].unionByName(inside[1]).withColumn("a", none))
    alone = marked.groupBy("lang", *WORDS).agg(F.max("a").alias("a"), F.max("longer").alias("longer")).where("a > 0 and longer < a").drop("longer")
    alone = materialize(alone, "alone")

    # phrases that may be parts, the most frequent of them on the driver: at most so many as the least count of a hot one allows
    single = often.select("lang", F.col("h").alias("w1"), *[none.alias(w) for w in WORDS[1:]], F.col("n").alias("a"))
    parts = single.unionByName(candidates.where("w5 = 0"))
    hot, above = s.hot, parts.where(F.col("a") >= s.hot)
    while above.limit(HOT_PARTS + 1).count() > HOT_PARTS:
        hot *= 2
        above = parts.where(F.col("a") >= hot)
    rows = above.select(*WORDS[:-1]).toArrow()
    hot_keys = np.sort(joined([rows[w].to_numpy().view(np.uint64) for w in WORDS[:-1]])) if rows.num_rows else np.zeros(0, np.uint64)

    p_columns = ", ".join(f"{p} long" for p in _P)
    asked = alone.mapInArrow(_parts(s, hot_keys), f"{_KEY}, {p_columns}, k long, right boolean, {_PHRASE}")
    held = parts.mapInArrow(_known(s, hot_keys), f"{_KEY}, {p_columns}, f long")
    ranges = 1 + (alone.count() * 4 // s.paths)
    place = F.pmod(F.xxhash64("key", "salt"), F.lit(ranges * 16))
    answered = asked.groupBy(place).cogroup(held.groupBy(place)).applyInArrow(_composed, f"{_PHRASE}, k long, right boolean, f long")

    cuts = answered.groupBy("lang", *WORDS, "a", "k").agg(F.max(F.when(~F.col("right"), F.col("f"))).alias("l"), F.max(F.when(F.col("right"), F.col("f"))).alias("r"))
    cuts = cuts.join(totals, "lang")
    score = F.expr(f"(cast({s.permille} as decimal(6,0)) * cast(a as decimal(11,0)) * cast(n as decimal(18,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    least = cuts.groupBy("lang", *WORDS, "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = least.select("lang", *WORDS, "a", "n", "cut.score", "cut.l", "cut.r")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = materialize(scored.withColumn("_r", F.rank().over(by_score)).where(F.col("_r") <= s.top).drop("_r"), "first")

    # the words of those
    named = first.withColumn("id", F.struct(*WORDS)).select("lang", "id", F.posexplode(F.array(*WORDS)).alias("i", "h")).where("h <> 0")
    named = named.join(often.select("lang", "h", "word"), ["lang", "h"])
    phrases = named.groupBy("lang", "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = first.withColumn("id", F.struct(*WORDS)).join(phrases, ["lang", "id"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return ranked.withColumn("rank", rank.cast("long")).where(F.col("rank") <= s.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: Keys of parts that are dealt out over salts, at most.
HOT_PARTS = 10_000


def oracle(settings: Phrases | None = None) -> str:
    """DuckDB SQL for collocations() of documents: all phrases of all texts are listed, so for small tables."""
    s = settings or Phrases()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    grams = " union all ".join(f"select lang, {m} as m, unnest(list_transform(range(1, len(w) - {m - 2}), lambda i: array_to_string(w[i : i + {m - 1}], ' '))) as p from pieces where len(w) >= {m}" for m in range(1, LONGEST + 1))
    cut = "regexp_extract(c.p, '^((?:[^ ]+ ){' || k || '})', 1)"
    return f"""
    with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
    pieces as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from d),
    counts as (select lang, m, p, count(*) as f from ({grams}) group by all having m = 1 or f >= {s.least}),
    totals as (select lang, sum(f) as n from counts where m = 1 group by lang),
    often as (select * from counts where f >= {s.least}),
    inside as (select distinct lang, p from (
        select lang, regexp_replace(p, ' [^ ]+$', '') as p, f from often where m > 2 union all select lang, regexp_replace(p, '^[^ ]+ ', ''), f from often where m > 2) longer
        join often using (lang, p) where longer.f >= often.f),
    c as (select * from often anti join inside using (lang, p) where m > 1),
    cuts as (select c.*, k, rtrim({cut}) as lp, substr(c.p, length({cut}) + 1) as rp from (select *, unnest(range(1, m)) as k from c) c),
    scored as (select cuts.*, x.f as l, y.f as r, totals.n, (({s.permille}::hugeint * cuts.f * totals.n) // (x.f::hugeint * y.f))::bigint as score
        from cuts join totals using (lang) join often x on x.lang = cuts.lang and x.p = lp join often y on y.lang = cuts.lang and y.p = rp),
    best as (select * from scored qualify row_number() over (partition by lang, p order by score, k) = 1),
    ranked as (select *, row_number() over (partition by lang order by score desc, f desc, p) as rank from best)
    select lang, rank, p as phrase, f::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score from ranked where rank <= {s.top}"""
