"""Exact similarity join of documents by the Jaccard index of their word n-grams.

1. Each text becomes a set of 64-bit shingle hashes. Documents with equal sets are one class.
2. Each class is put into tiles, one for each shingle of its prefix: in a common order of all shingles, rare ones first, two
   sets that are similar enough share one of their first few. A tile is swept in bands of set size, as similar sets are of
   similar size; the places of the shared shingle bound the overlap further.
3. Within a tile, bitmap signatures are compared: shingles are hashed to bits that each shingle flips, so the bits that
   differ between two signatures bound the sets' difference from below, and their overlap from above. What is left joins
   into clusters, each of which holds every class that its members could possibly link with.
4. Within a cluster, sorted shingle arrays are intersected: this decides each link exactly. Large clusters are split into
   parts that share a few anchors. Where few classes found no way to the main group, they are compared with all parts.
5. Where many did, as hot shingles tie groups that hardly link, the cluster is tiled again, by parts of the sets: shingles are
   dealt by hash to so many parts that two sets of one size band which link have a part in common as a whole. Signatures then
   test each tile, and clusters of what is left are compared as before.

Frequent shingles only go last in the order: nothing is dropped, whatever their number. Where one is so frequent that its
tile could not be compared at once, its rows are dealt out over many tasks and meet in one cluster without a test.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, components, materialize, mix, numbered, place_of, rows, words


@dataclass(frozen=True)
class Jaccard:
    """n: words in a shingle. part, whole: documents link when whole * overlap >= part * union.

    sent: most shingles whose frequency is sent to all tasks (the least frequency that counts as frequent doubles until they fit).
    frequent: where that least frequency begins. tile: rows of a tile that are compared at once; beyond, rows join the tile's cluster untested.
    cluster: classes of a cluster that are compared in one task. anchors: classes that all parts of a larger one share.
    """

    n: int = 4
    part: int = 85
    whole: int = 100
    sent: int = 1_000_000
    frequent: int = 64
    tile: int = 4096
    cluster: int = 2000
    anchors: int = 16

    def needed(self, a, b):
        """The least overlap with which sets of sizes a and b link."""
        return -(-(self.part * (a + b)) // (self.whole + self.part))

    def smallest(self, size):
        """The size of the smallest set that a set of this size can link with."""
        return -(-(self.part * size) // self.whole)

    def prefix(self, size):
        """How many shingles come first: sets that link share one of those."""
        return size - self.smallest(size) + 1

    def apart(self, size: int) -> int:
        """The most shingles that are in one only of two sets that link and are no larger than size."""
        return 2 * size * (self.whole - self.part) // (self.whole + self.part)

    def bands(self, most: int) -> list[int]:
        """Where bands of set size begin, up to beyond most: sets that link are in one band or in neighbouring ones."""
        starts = [1]
        while starts[-1] <= most:
            # the least size whose smallest partner is not below the last start
            least = self.whole * (starts[-1] - 1) // self.part + 1
            starts.append(max(starts[-1] + 1, least))
        return starts


def shingles(text: str | None, hashes: WordHashes, n: int) -> np.ndarray:
    """The sorted set of hashes of n-word shingles; of the whole sequence when it is shorter; empty without words."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w))
    width = min(n, len(codes))
    out = mix(codes[: len(codes) - width + 1] + np.uint64(width))
    for k in range(1, width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - width + 1 + k])
    return np.unique(out)


def class_of(keys: np.ndarray) -> int:
    """A hash of a set, as a long that is not negative."""
    return xxhash.xxh3_64_intdigest(keys.tobytes()) >> 1


def signature_bits(size: int) -> int:
    """Bits of a signature: the power of two from the set's size up, 64 to 32768."""
    return min(1 << 15, max(64, 1 << (size - 1).bit_length())) if size else 64


def signature(keys: np.ndarray) -> np.ndarray:
    """Each shingle flips the bit that its hash names; 64-bit words. Halves laid over each other give the signature of half the bits."""
    bits = signature_bits(len(keys))
    odd = np.bincount((keys >> np.uint64(40)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def halved(signatures: np.ndarray, width: int) -> np.ndarray:
    while signatures.shape[1] > width:
        half = signatures.shape[1] // 2
        signatures = signatures[:, :half] ^ signatures[:, half:]
    return signatures


def _order(keys: np.ndarray, frequent: np.ndarray, counts: np.ndarray, first: int) -> np.ndarray:
    """The first keys in the common order: rare ones by hash, then frequent ones by count and hash."""
    if not len(frequent):
        return keys[:first]
    at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
    often = frequent[at] == keys
    rare = keys[~often]
    if len(rare) >= first:
        return rare[:first]
    behind = keys[often]
    return np.concatenate([rare, behind[np.lexsort((behind, counts[at[often]]))]])[:first]


def _sets(s: Jaccard):
    """A row for each text: doc_id, set size, class hash, signature; and the shingles that several texts of the task hold, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        held: list[np.ndarray] = []
        n_held = 0

        def often() -> tuple[bytes, bytes]:
            keys, n = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            held.clear()
            return keys[n >= 2].tobytes(), n[n >= 2].astype(np.int64).tobytes()

        for batch in rows(batches, 500):
            sizes, classes, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                keys = shingles(text, hashes, s.n)
                h = class_of(keys) if len(keys) else None
                sizes.append(len(keys))
                classes.append(h)
                signatures.append(signature(keys).tobytes() if len(keys) else None)
                if len(keys) and h not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(h)
                    held.append(keys)
                    n_held += len(keys)
            out = [None] * batch.num_rows, [None] * batch.num_rows
            if n_held > 2_500_000 and batch.num_rows:
                out[0][0], out[1][0] = often()
                n_held = 0
            yield record([batch.column(0).to_pylist(), sizes, classes, signatures, *out])
        if held:
            keys, n = often()
            yield record([[None], [None], [None], [None], [keys], [n]])

    def record(columns: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], ["doc_id", "size", "class", "signature", "keys", "counts"])

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for keys, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            yield pa.record_batch([pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(n, np.int64))], ["key", "n"])


def _prefixes(s: Jaccard, sent):
    """(key, salt, hot, class, size, at): the first shingles of each class, and their places. A class comes once from each task.

    hot: shingles whose count, as far as it is known, exceeds a tile. Their rows are dealt out by a salt.
    """
    names = ["key", "salt", "hot", "class", "size", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = sent.value
        hashes, seen = WordHashes(), set()
        for batch in rows(batches, 200):
            keys_, hots, classes, sizes, at = [], [], [], [], []
            for text in batch.column(0).to_pylist():
                keys = shingles(text, hashes, s.n)
                if not len(keys):
                    continue
                h = class_of(keys)
                if h in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add(h)
                first = _order(keys, frequent, counts, s.prefix(len(keys)))
                keys_.append(first)
                if len(frequent):
                    known = np.minimum(np.searchsorted(frequent, first), len(frequent) - 1)
                    hots.append((frequent[known] == first) & (counts[known] > s.tile))
                else:
                    hots.append(np.zeros(len(first), bool))
                classes.append(np.full(len(first), h))
                sizes.append(np.full(len(first), len(keys), np.int32))
                at.append(np.arange(len(first), dtype=np.int32))
            if keys_:
                key, hot, cls = np.concatenate(keys_).view(np.int64), np.concatenate(hots), np.concatenate(classes).astype(np.int64)
                salt = np.where(hot, cls % SALTS, 0).astype(np.int32)
                yield pa.record_batch([pa.array(x) for x in (key, salt, hot, cls, np.concatenate(sizes), np.concatenate(at))], names)

    return run


#: Over how many places the rows of a hot shingle are dealt out, at least; rows of one class stay together.
SALTS = 1024


def _groups(batches: Iterator[pa.RecordBatch], key: str, most: int | None = None) -> Iterator[pa.Table]:
    """Tables with whole groups of an ordered key. A group that spans batches is gathered, up to most rows at a time."""
    rest: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(key).to_numpy()
        ended = np.flatnonzero(keys != keys[-1])
        if len(ended):
            yield pa.Table.from_batches([*rest, b.slice(0, ended[-1] + 1)])
            rest = [b.slice(ended[-1] + 1)]
        elif rest and rest[0].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(rest)
            rest = [b]
        else:
            rest.append(b)
            if most and sum(x.num_rows for x in rest) >= most:
                yield pa.Table.from_batches(rest)
                rest = []
    if rest:
        yield pa.Table.from_batches(rest)


def _shared(s: Jaccard):
    """Of rows (key, hot, class, size, at) ordered by key, size, class: those that have a partner of fitting size in their tile, once for each class; hot ones all.

    Only neighbours in the order are looked at, which never loses a row that has a partner. Rows stream by: one is kept back.
    """
    names = ["key", "hot", "class", "size", "at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, of which it isn't known yet whether the next is a partner
        was_near = False
        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(c).to_numpy(zero_copy_only=False) for c in names]
            if held is not None:
                columns = [np.concatenate([x, y]) for x, y in zip(held, columns, strict=True)]
            key, hot, cls, size, at = columns
            once = np.r_[True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])]
            key, hot, cls, size, at = (x[once] for x in (key, hot, cls, size, at))
            near = (key[1:] == key[:-1]) & (size[:-1] >= s.smallest(size[1:].astype(np.int64)))
            keep = (np.r_[was_near, near] | np.r_[near, False] | hot)[:-1]
            was_near = bool(near[-1]) if len(near) else was_near
            held = [x[-1:] for x in (key, hot, cls, size, at)]
            if keep.any():
                yield pa.record_batch([pa.array(x[:-1][keep]) for x in (key, hot, cls, size, at)], names)
        if held is not None and (was_near or held[1][0]):
            yield pa.record_batch([pa.array(x) for x in held], names)

    return run


def _could_link(s: Jaccard, i: int, others: np.ndarray, size, at, signatures) -> np.ndarray:
    """Which of the others (all no smaller than i in the order of sizes, or no larger) could link with i, by size, places and signatures."""
    a, b = size[i], size[others]
    need = s.needed(a, b)
    good = np.minimum(a, b) >= s.smallest(np.maximum(a, b))
    good &= 1 + np.minimum(a - at[i] - 1, b - at[others] - 1) >= need
    some = np.flatnonzero(good)
    if not len(some):
        return others[:0]
    picked = others[some]
    # signatures of different widths are compared at the smaller one
    widths = np.array([len(signatures[k]) for k in picked])
    own = signatures[i][None, :]
    out = []
    for width in np.unique(widths):
        mine = widths == width
        both = np.stack([signatures[k] for k in picked[mine]])
        narrow = min(int(width), own.shape[1])
        differ = np.bitwise_count(halved(both, narrow) ^ halved(own, narrow)).sum(1, dtype=np.int64)
        fits = (a + b[some[mine]] - differ) // 2 >= need[some[mine]]
        out.append(picked[mine][fits])
    return np.concatenate(out)


def _tile_links(s: Jaccard):
    """Links (a, b) that span, in each tile, the graph of classes that could link: rows (key, class, size, at, signature) ordered by key, size.

    The rows of a tile of more than s.tile rows are all tied to the tile's first row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_class = None
        for t in _groups(batches, "key", s.tile):
            key = t.column("key").to_numpy()
            cls, size, at = t.column("class").to_numpy(), t.column("size").to_numpy().astype(np.int64), t.column("at").to_numpy().astype(np.int64)
            signatures = [np.frombuffer(x, np.uint64) for x in t.column("signature").to_pylist()]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            a, b = [], []
            for start, end in zip(starts, np.r_[starts[1:], len(key)], strict=True):
                if key[start] != last_key:
                    last_key, last_class = key[start], int(cls[start])
                elif start == 0:  # more of a large tile
                    a += cls[start:end].tolist()
                    b += [last_class] * (end - start)
                    continue
                if end - start >= s.tile:
                    a += cls[start + 1 : end].tolist()
                    b += [last_class] * (end - start - 1)
                    continue
                left = np.arange(start, end)
                while len(left) > 1:
                    queue, left = [left[0]], left[1:]
                    while queue and len(left):
                        i = queue.pop()
                        found = _could_link(s, i, left, size, at, signatures)
                        if len(found):
                            a += cls[found].tolist()
                            b += [int(cls[i])] * len(found)
                            queue += found.tolist()
                            left = left[~np.isin(left, found)]
            if a:
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a)) if len(b) else 0


def _exact_links(s: Jaccard, sets: list[np.ndarray], home: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that span the components of the exact similarity graph of these sets.

    home: only sets of unequal home are compared. Signatures bound the overlap from above before arrays are intersected.
    """
    size = np.array([len(x) for x in sets], np.int64)
    at = np.zeros(len(sets), np.int64)
    signatures = [signature(x) for x in sets]
    left = np.argsort(size, kind="stable")
    out = []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            i = queue.pop()
            found = []
            for j in _could_link(s, i, left, size, at, signatures):
                if home is not None and home[i] == home[j]:
                    continue
                if overlap(sets[i], sets[j]) >= s.needed(size[i], size[j]):
                    found.append(j)
            if found:
                out += [(i, j) for j in found]
                queue += found
                left = left[~np.isin(left, found)]
    return out


def part_keys(keys: np.ndarray, s: Jaccard) -> np.ndarray:
    """Hashes of parts of a set: two sets that link have one in common, unless they are equal or too small to differ.

    Pairs are served by the band of the larger set, so a set has the parts of its own band and of the next. There, with at most
    d shingles in one set only, d + 1 + e parts leave e + 1 untouched. Empty parts say nothing: a set with at most e of them has
    none in its keys, as one of those e + 1 isn't empty then; a set with more has them all.
    """
    bands = s.bands(s.bands(len(keys))[-1])
    out = []
    for band in (len(bands) - 3, len(bands) - 2):
        d = s.apart(bands[band + 1] - 1)
        if not d:
            continue
        spare = 2 + d // 32
        parts = d + 1 + spare
        place = (mix(keys + np.uint64(band + 1)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        sums = np.zeros(parts, np.uint64)
        starts = np.flatnonzero(np.r_[True, np.diff(place[order]) != 0])
        filled = place[order][starts]
        sums[filled] = np.add.reduceat(mix(keys[order] ^ np.uint64(0x9E3779B97F4A7C15)), starts)
        names = mix(sums + mix(np.arange(parts, dtype=np.uint64) + np.uint64(band << 32)))
        out.append(names[filled] if parts - len(filled) <= spare else names)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _parts(s: Jaccard):
    """(key, class, size, group): a row for each part of each class, of rows (root, class, group, text). Only sets of one cluster share keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows(batches, 200):
            keys_, classes, sizes, groups = [], [], [], []
            for root, cls, group, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                keys = shingles(text, hashes, s.n)
                if class_of(keys) != cls:
                    continue
                parts = part_keys(keys, s)
                keys_.append(mix(parts ^ np.uint64(root)))
                classes.append(np.full(len(parts), cls))
                sizes.append(np.full(len(parts), len(keys), np.int32))
                groups.append(np.full(len(parts), group))
            if keys_:
                columns = np.concatenate(keys_).view(np.int64), np.concatenate(classes), np.concatenate(sizes), np.concatenate(groups)
                yield pa.record_batch([pa.array(x) for x in columns], ["key", "class", "size", "group"])

    return run


def _tiled_again(members: DataFrame, signatures: DataFrame, s: Jaccard) -> DataFrame:
    """(node, root, n): clusters of the classes that could still link across groups, for members(root, node, group, text)."""
    keys = members.select("root", "node", "group", "text").mapInArrow(_parts(s), "key long, class long, size int, group long")
    keys = materialize(keys, "parts")
    # a tile of one group has nothing to say; counts are summed in each task first
    tiles = keys.groupBy("key").agg(F.count("*").alias("k"), F.min("group").alias("g"), F.max("group").alias("h"), F.min("class").alias("b")).where("g <> h")
    tiles = materialize(tiles.select("key", "k", "b"), "tiles")
    rows_ = keys.join(tiles, "key")
    tied = rows_.where(F.col("k") > s.tile).select(F.col("class").alias("a"), "b")
    tested = rows_.where(F.col("k") <= s.tile).join(signatures, "class").select("key", "class", "size", F.lit(0).alias("at"), "signature")
    could = tested.repartition("key").sortWithinPartitions("key", "size", "class").mapInArrow(_tile_links(s), "a long, b long")
    clusters = materialize(components(materialize(could.union(tied), "could")), "clusters")
    return clusters.join(clusters.groupBy("root").agg(F.count("*").alias("n")), "root").select("node", "root", "n")


def ngram_join(docs: DataFrame, settings: Jaccard | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs(doc_id, text).

    n_shingles: size of the row's shingle set; component_id: the smallest doc_id reachable by links. Null, empty or blank
    texts have an empty set and link with nothing. Repeated rows stay, also with one doc_id and unlike texts. Rows with a null
    doc_id link with rows of equal sets only and never name a component. No rows: an empty table. Other columns are not read.
    """
    s = settings or Jaccard()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark = docs.sparkSession
    sets = materialize(docs.mapInArrow(_sets(s), "doc_id long, size long, class long, signature binary, keys binary, counts binary"), "sets")
    texts = sets.where("size is not null").select("doc_id", "size", "class")

    # frequent shingles: all texts count, as far as a task saw a shingle twice; this only orders shingles
    often = sets.where("keys is not null").select("keys", "counts").mapInArrow(_unpack, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= s.frequent)
    often = materialize(often, "often")
    least = s.frequent
    reach = 0
    for r in often.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("k")).orderBy(F.desc("bits")).collect():
        if reach + r.k > s.sent:
            least = 1 << r.bits
            break
        reach += r.k
    found = sorted((r.key & (1 << 64) - 1, r.n) for r in often.where(F.col("n") >= least).collect())
    sent = spark.sparkContext.broadcast((np.array([k for k, _ in found], np.uint64), np.array([n for _, n in found], np.int64)))

    prefixes = docs.select("text").mapInArrow(_prefixes(s, sent), "key long, salt int, hot boolean, class long, size int, at int")
    shared = prefixes.repartition("key", "salt").sortWithinPartitions("key", "size", "class").select("key", "hot", "class", "size", "at")
    shared = materialize(shared.mapInArrow(_shared(s), "key long, hot boolean, class long, size int, at int"), "shared")
    # classes with a hot shingle are one cluster untested; its first is found by partial minima, so no task sees all of them
    hot, shared = shared.where("hot").select("key", "class").distinct(), shared.where("not hot")
    firsts = hot.groupBy("key").agg(F.min("class").alias("b"))  # of at most s.sent shingles
    tied = hot.join(F.broadcast(firsts), "key").select(F.col("class").alias("a"), "b")
    members = shared.select("class").distinct()
    signatures = sets.where("class is not null").select("class", "signature").join(members, "class", "left_semi").groupBy("class").agg(F.first("signature").alias("signature"))
    tiles = shared.join(signatures, "class").select("key", "class", "size", "at", "signature")
    could = tiles.repartition("key").sortWithinPartitions("key", "size", "class").mapInArrow(_tile_links(s), "a long, b long")
    # written before the next Python step, so that a task never has two Python workers
    clusters = materialize(components(materialize(could.union(tied), "could")), "clusters")

    # one text for each class in a cluster
    first = texts.where("class is not null").join(clusters.select(F.col("node").alias("class")), "class", "left_semi").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    sizes = clusters.groupBy("root").agg(F.count("*").alias("n"))
    placed = clusters.join(sizes, "root").join(first.withColumnRenamed("class", "node"), "node").where("doc_id is not null").select("doc_id", "node", "root", "n")
    in_clusters = materialize(docs.join(placed, "doc_id"), "in-clusters")
    links = materialize(_cluster_links(in_clusters, signatures, s), "links")
    roots = components(links)
    by_class = texts.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least")).join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least_of = by_class.groupBy("root").agg(F.min("least").alias("component_id"))
    named = by_class.join(least_of, "root").select("class", "component_id")
    return texts.join(named, "class", "left").select("doc_id", F.col("size").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


#: Ids of documents to drop are sent to all tasks up to this many; beyond it they are joined by id.
BROADCAST_IDS = 2_000_000


def keep_one(docs: DataFrame, settings: Jaccard | None = None) -> DataFrame:
    """One document of each group of ngram_join(): that with the smallest doc_id. Rows with a null doc_id stay.

    All columns of docs come as they were, whatever their names.
    """
    plain = numbered(docs)
    id_, text = place_of(docs, "doc_id"), place_of(docs, "text")
    groups = materialize(ngram_join(plain.select(F.col(id_).alias("doc_id"), F.col(text).alias("text")), settings), "groups")
    dropped = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(id_)).distinct()
    small = dropped.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return plain.join(F.broadcast(dropped) if small else dropped, id_, "left_anti").select(*plain.columns).toDF(*docs.columns)


def _sets_of(t: pa.Table, s: Jaccard) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
    """Classes, their sets and rows: one row for each class, as guest and as host, whose text is the class's (rows that share a doc_id may hold other texts)."""
    hashes, seen, sets, kept = WordHashes(), set(), [], []
    node = t["node"].to_numpy()
    guest = t["guest"].to_pylist() if "guest" in t.column_names else [False] * len(node)
    for k, text in enumerate(t["text"].to_pylist()):
        if (node[k], guest[k]) not in seen:
            keys = shingles(text, hashes, s.n)
            if class_of(keys) == node[k]:
                seen.add((node[k], guest[k]))
                sets.append(keys)
                kept.append(k)
    return node[kept], sets, kept


def _cluster_links(in_clusters: DataFrame, signatures: DataFrame, s: Jaccard) -> DataFrame:
    """Exact links (a, b) of classes that span each cluster's components. in_clusters: doc_id, text, node, root, n; signatures: class, signature."""
    parts = F.ceil(F.col("n") / s.cluster).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = in_clusters.withColumn("parts", parts).withColumn("own", own)
    # the anchors of a large cluster are in all of its parts
    anchor = (F.col("parts") > 1) & (F.pmod(F.xxhash64("node", F.lit(1)), F.col("n")) < s.anchors)
    places = F.when(anchor, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own"))
    first = placed.withColumn("part", F.explode(places)).select("root", "part", "node", "text")

    def compare(t: pa.Table) -> pa.Table:
        node, sets, _ = _sets_of(t, s)
        found = _exact_links(s, sets)
        return pa.table({"a": pa.array([int(node[i]) for i, _ in found], pa.int64()), "b": pa.array([int(node[j]) for _, j in found], pa.int64())})

    links = first.groupBy("root", "part").applyInArrow(compare, "a long, b long")
    large = placed.where("parts > 1")
    if large.limit(1).count() == 0:
        return links
    links = materialize(links, "cluster-links")
    roots = components(links)
    at = large.join(roots, large["node"] == roots["node"], "left").select(large["root"], "parts", "own", large["node"], "text", F.coalesce(roots["root"], large["node"]).alias("group"))
    at = materialize(at, "large")
    strays = _stray_counts(at)
    few, many = strays.where(F.col("strays") <= s.cluster), strays.where(F.col("strays") > s.cluster)
    links = links.unionByName(_meet_strays(at.join(few.select("root"), "root", "left_semi"), s))
    if many.limit(1).count() == 0:
        return links
    members = at.join(many.select("root"), "root", "left_semi")
    again = _tiled_again(members, signatures, s)
    again = members.select("node", "text", "group").join(again, "node").withColumn("parts", parts).withColumn("own", own)
    again = materialize(again.select("root", "parts", "own", "node", "text", "group"), "again")

    def across(t: pa.Table) -> pa.Table:
        node, sets, kept = _sets_of(t, s)
        found = _exact_links(s, sets, t["group"].to_numpy()[kept])
        return pa.table({"a": pa.array([int(node[i]) for i, _ in found], pa.int64()), "b": pa.array([int(node[j]) for _, j in found], pa.int64())})

    small = again.where("parts = 1").select("root", "node", "text", "group").groupBy("root").applyInArrow(across, "a long, b long")
    return links.unionByName(small).unionByName(_meet_strays(again.where("parts > 1"), s))


def _stray_counts(at: DataFrame) -> DataFrame:
    """(root, main, strays): the largest group of each cluster, and how many classes are of others, where any are. at: root, group and others."""
    counts = at.groupBy("root", "group").agg(F.count("*").alias("k"))
    largest = counts.groupBy("root").agg(F.max(F.struct("k", "group")).alias("m"), F.sum("k").alias("n"))
    return materialize(largest.select("root", F.col("m.group").alias("main"), (F.col("n") - F.col("m.k")).alias("strays")).where("strays > 0"), "strays")


def _meet_strays(at: DataFrame, s: Jaccard) -> DataFrame:
    """Links (a, b) of classes outside their cluster's largest group with those of other groups. at: root, parts, own, node, text, group.

    Strays go, in blocks, to every part of their cluster.
    """
    counted = _stray_counts(at).withColumn("blocks", F.ceil(F.col("strays") / s.cluster).cast("int"))
    known = at.join(counted, "root")
    guests = known.where("group <> main").withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")).cast("int"))
    guests = guests.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("root", "part", "block", "node", "text", "group", F.lit(True).alias("guest"))
    hosts = known.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("root", F.col("own").alias("part"), "block", "node", "text", "group", F.lit(False).alias("guest"))

    def meet(t: pa.Table) -> pa.Table:
        node, sets, kept = _sets_of(t, s)
        group, guest = t["group"].to_numpy()[kept], np.array(t["guest"].to_pylist())[kept]
        size = np.array([len(x) for x in sets], np.int64)
        at_, signatures = np.zeros(len(sets), np.int64), [signature(x) for x in sets]
        a, b = [], []
        here = np.flatnonzero(~guest)
        for i in np.flatnonzero(guest):
            done = set()
            for j in _could_link(s, i, here[group[here] != group[i]], size, at_, signatures):
                if group[j] not in done and overlap(sets[i], sets[j]) >= s.needed(size[i], size[j]):
                    done.add(group[j])
                    a.append(int(node[i]))
                    b.append(int(node[j]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return guests.unionByName(hosts).groupBy("root", "part", "block").applyInArrow(meet, "a long, b long")


def oracle(settings: Jaccard | None = None) -> str:
    """DuckDB SQL for ngram_join() of documents: all pairs that share a shingle, and what each document reaches. For small tables."""
    s = settings or Jaccard()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(s.n))
    return f"""
    with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+') as w from documents),
    sets as (select doc_id, list_distinct(case when len(w) >= {s.n} then list_transform(range(1, len(w) - {s.n - 2}), lambda i: {shingle}) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from d),
    sizes as (select doc_id, len(s)::bigint as n from sets),
    flat as (select doc_id, hash(x) as x from (select doc_id, unnest(s) as x from sets)),
    common as (select a.doc_id as a, b.doc_id as b, count(*) as k from flat a join flat b using (x) where a.doc_id < b.doc_id group by all),
    pairs as (select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b where {s.whole} * k >= {s.part} * (p.n + q.n - k)),
    links as (select a, b from pairs union all select b, a from pairs),
    reach(node, root) as (select doc_id, doc_id from sizes union select links.b, reach.root from reach join links on reach.node = links.a)
    select doc_id, n as n_shingles, component_id from sizes join (select node, min(root) as component_id from reach group by node) on node = doc_id"""
