"""Periodic runs of words: stretches that repeat with a period, found by enumerating maximal pairs.

A run of period q is a maximal pair: two equal stretches, q words apart, that neither the words before nor those behind extend;
and each maximal pair whose distance is at most its length is a run. So runs are read off the intervals of the suffix array:

1. The words of a batch of texts are one sequence of numbers, unlike in each text, with an end of its own behind each text.
   Suffixes are sorted by doubling; only places whose next 2, 4, 8, ... words occur again stay in play, and what is known of
   each width is kept, from which the lengths of common prefixes (LCP) are read.
2. Neighbours in this order with enough words in common form intervals. Where all words to the left of an interval are the
   same nothing in it is maximal to the left, and it is left out at once.
3. In the others the tree of LCP intervals is walked bottom-up. Each node holds its places in order, and by the word to their
   left; a child joins its node after each of its places met those of the node that differ in the word to the left and are at
   most the node's length away. The smaller side is always the one whose places move.
4. A stretch may be met with multiples of its period too; the smallest distance is its period.

Everything happens within a text, so nothing is shuffled.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, numbered, place_of


@dataclass(frozen=True)
class Runs:
    """shortest: words of the shortest run. batch_bytes: of texts that are sorted together; a longer text is sorted alone."""

    shortest: int = 12
    batch_bytes: int = 1 << 20


def sequence(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as one sequence of numbers, and where each text begins in it. Words of unlike texts are unlike; each text has an end of its own."""
    parts, starts, at, base = [], [], 0, 0
    for words in texts:
        number: dict[bytes, int] = {}
        codes = [number.setdefault(w, len(number)) for w in words]
        codes.append(len(number))
        parts.append(np.array(codes, np.int64) + base)
        starts.append(at)
        at, base = at + len(codes), base + len(number) + 1
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), np.array(starts, np.int64)


def _starts(same: np.ndarray) -> np.ndarray:
    """For each place the first place of its stretch, where same[i] says that place i belongs with i - 1."""
    at = np.arange(len(same))
    return np.maximum.accumulate(np.where(same, 0, at))


def sorted_places(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes, and the length of the common prefix of each with the one before (0 for the first).

    Only places count whose next so many words occur elsewhere as well, so many being the largest power of two up to least.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    first = _starts(np.r_[False, codes[order][1:] == codes[order][:-1]])
    rank = np.empty(n, np.int32)
    rank[order] = first
    levels = [rank]  # the class of each place by its next 1, 2, 4, ... words
    alone = np.r_[first[1:] == np.arange(1, n), True] & (first == np.arange(n))
    active, width = order[~alone], 1
    in_play = None
    while True:
        if in_play is None and (2 * width > least or not len(active)):
            in_play = active  # in groups of equal prefixes, but not in order yet
        if not len(active):
            break
        group, behind = rank[active], rank[active + width]
        to = np.argsort(group.astype(np.int64) * n + behind)
        active, group, behind = active[to], group[to], behind[to]
        new_group = np.r_[True, group[1:] != group[:-1]]
        same = ~(new_group | np.r_[True, behind[1:] != behind[:-1]])
        size = len(active)
        begin = _starts(~new_group)
        rank = rank.copy()
        rank[active] = group + (_starts(same) - begin)
        levels.append(rank)
        lone = ~same & np.r_[~same[1:], True] if size else same
        active, width = active[~lone], 2 * width
    found = in_play[np.argsort(rank[in_play], kind="stable")]
    common = np.zeros(len(found), np.int64)
    if len(found) > 1:
        p, q = found[:-1].copy(), found[1:].copy()
        for k in range(len(levels) - 1, -1, -1):
            equal = levels[k][p] == levels[k][q]
            step = np.where(equal, 1 << k, 0)
            common[1:] += step
            p, q = p + step, q + step
    return found, common


class _Node:
    """Places of an LCP interval: all in order, and by the word to their left."""

    __slots__ = ("by_left", "places")

    def __init__(self, place: int, left: int):
        self.places, self.by_left = [place], {left: [place]}

    def join(self, other: _Node, length: int, lefts: dict[int, int], found: list[tuple[int, int, int]]) -> _Node:
        """Both as one, after the maximal pairs (place, distance, length) of this length between them went to found."""
        large, small = (self, other) if len(self.places) >= len(other.places) else (other, self)
        places, by_left = large.places, large.by_left
        for left, own in small.by_left.items():
            if len(by_left) > 1 or left not in by_left:
                for p in own:
                    lo, hi = bisect_left(places, p - length), bisect_right(places, p + length)
                    # near places one by one, or class by class, whichever is less
                    if hi - lo <= 2 * len(by_left):
                        found += [(min(p, x), abs(p - x), length) for x in places[lo:hi] if lefts[x] != left]
                        continue
                    for c, some in by_left.items():
                        if c != left:
                            found += [(min(p, x), abs(p - x), length) for x in some[bisect_left(some, p - length) : bisect_right(some, p + length)]]
        for left, own in small.by_left.items():
            mine = by_left.setdefault(left, [])
            for p in own:
                insort(mine, p)
                insort(places, p)
        return large


def maximal_pairs(places: list[int], common: list[int], lefts: list[int]) -> list[tuple[int, int, int]]:
    """(place, distance, length) of all pairs in the tree of LCP intervals over these neighbours whose distance is at most their length."""
    found: list[tuple[int, int, int]] = []
    left_of = dict(zip(places, lefts, strict=True))
    open_: list[tuple[int, _Node]] = []
    for p, left, length in zip(places, lefts, [*common[1:], -1], strict=True):  # the length in common with the next one
        node = _Node(p, left)
        while open_ and open_[-1][0] > length:
            depth, before = open_.pop()
            node = before.join(node, depth, left_of, found)
        if open_ and open_[-1][0] == length:
            open_[-1] = (length, open_[-1][1].join(node, length, left_of, found))
        elif length >= 0:
            open_.append((length, node))
    return found


def runs_of(texts: list[list[bytes]], shortest: int) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start and then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    codes, starts = sequence(texts)
    if not len(codes):
        return out
    least = max(1, -(-shortest // 2))
    places, common = sorted_places(codes, least)
    if not len(places):
        return out
    lefts = codes[places - 1]  # the end of the text before, or of the last one, is like no word
    new = common < least
    group = np.cumsum(new) - 1
    differ = np.r_[False, (lefts[1:] != lefts[:-1]) & ~new[1:]]
    some = np.zeros(group[-1] + 1, bool)
    some[group[differ]] = True
    kept = np.flatnonzero(some[group])
    if not len(kept):
        return out
    groups, begins = np.unique(group[kept], return_index=True)
    periods: dict[tuple[int, int], int] = {}
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(kept)], strict=True):
        at = kept[a:b]
        for start, distance, length in maximal_pairs(places[at].tolist(), common[at].tolist(), lefts[at].tolist()):
            if distance + length >= shortest:
                key = (start, distance + length)
                periods[key] = min(distance, periods.get(key, distance))
    for (start, length), period in periods.items():
        k = int(np.searchsorted(starts, start, side="right")) - 1
        out[k].append((start - int(starts[k]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run holds behind its first period, joined by one space."""
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            gone[start + period] += 1
            gone[start + length] -= 1
        words = [w for w, g in zip(words, np.cumsum(gone).tolist(), strict=False) if not g]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, settings: Runs | None = None, prepare=None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of docs(doc_id, text). Words are `[^\\x20\\x09-\\x0D]+`.

    runs: array of (start, length, period), by start and then period: each stretch of at least ``shortest`` words, and of two
    periods, that no neighbouring word extends. collapsed: the words that no run holds behind its first period, joined by one
    space. prepare(doc_id, words): what the words of a row are to be, if not those of its text.

    Null and empty texts have no words and no runs, and collapse to an empty text. Rows stand alone: repeated rows, and rows
    with one id or none, give what they give by themselves. An empty table gives an empty table; other columns are not read.
    A text needs memory for its words times the logarithm of its longest repeat.
    """
    s = settings or Runs()
    plain = numbered(docs).select(place_of(docs, "doc_id"), place_of(docs, "text"))
    kind = plain.schema[0].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1, s.batch_bytes):
            texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
            if prepare is not None:
                texts = [prepare(i, w) for i, w in zip(batch.column(0).to_pylist(), texts, strict=True)]
            runs = runs_of(texts, s.shortest)
            kept = [collapsed(w, r).decode("utf-8", "surrogatepass") for w, r in zip(texts, runs, strict=True)]
            rows = [[{"start": a, "length": b, "period": c} for a, b, c in r] for r in runs]
            yield pa.record_batch([batch.column(0), pa.array([len(w) for w in texts], pa.int64()), pa.array(rows, run_type), pa.array(kept, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    return plain.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_repeats(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten, by the checksum of its id, with a tail that repeats; those of all others as they are."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of periodic_runs(): the longest run, and digests of all."""
    # the longest, then the first, then that of the smallest period
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    best = F.array_max(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))

    def sha(c: Column) -> Column:
        return F.sha2(c.cast("binary"), 256)

    named = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), sha(text).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"))
    length, period = F.col("b.l"), -F.col("b.p")
    return named.select("doc_id", "n_runs", (-F.col("b.s")).alias("start"), length.alias("length"), period.alias("period"), F.expr("1000 * b.l div -b.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
