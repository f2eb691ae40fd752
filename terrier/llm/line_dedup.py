"""Lines that many documents hold are kept in one of them only.

1. Tasks hash the key of each line (128 bits) and count, by hash, the documents that hold it and the largest id among them;
   counts are merged before and after one shuffle.
2. The hashes of lines that enough documents hold are cut into shards by their first bits. Each shard gets a minimal perfect
   hash (levels of bit arrays: a key that is alone in its place at a level stays there, all others go to the next level; a
   key's index is the rank of its bit) and, in that order, arrays of fingerprints, counts and largest ids.
3. Documents probe the arrays: a line whose fingerprint stands at its index is dropped unless the document is the last to
   hold it. The arrays, about 21 bytes for each such line, are sent to all tasks up to a checked size. Beyond it the shards
   stay where they are, and each task sends packed hashes to them; what they answer meets the documents by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER_TO_LOWER, by_bytes, materialize, mix, numbered, place_of

#: White space that a key doesn't have at its ends.
BLANKS = " \t\n\x0b\x0c\r"
#: A missing id, as a number: smaller than all others.
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Lines:
    """shortest: code points of the shortest key that counts. documents: how many must hold it.

    shard: keys of a shard, about. sent_bytes: size up to which all shards' arrays are sent to all tasks. held: lines that a task
    merges at a time.
    """

    shortest: int = 40
    documents: int = 5
    shard: int = 250_000
    sent_bytes: int = 64 << 20
    held: int = 400_000


def key_of(line: str) -> str:
    """The line without white space at its ends, A-Z lower-cased."""
    return line.strip(BLANKS).encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER).decode("utf-8", "surrogatepass")


def hashes_of(lines: list[str], shortest: int) -> tuple[list[int], list[bytes]]:
    """Places and 128-bit hashes of those lines whose keys are long enough."""
    places, found = [], []
    for i, line in enumerate(lines):
        if len(line) >= shortest:
            line = line.strip(BLANKS)
            if len(line) >= shortest:
                places.append(i)
                found.append(xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER)))
    return places, found


def as_pairs(digests: list[bytes]) -> np.ndarray:
    """Hashes as rows of two 64-bit numbers."""
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys: levels of bit arrays, twice as many bits as keys are left."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes // 64)]).astype(np.int64)
        self.ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        step = np.uint64((0x9E3779B97F4A7C15 * (2 * level + 1)) & (1 << 64) - 1)
        return (mix(keys[:, 0] + step) ^ mix(keys[:, 1] ^ step)) % np.uint64(size)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits = [], []
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            at = cls._places(keys, len(sizes), size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            bits.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, np.int64), np.concatenate([np.zeros(0, np.uint64), *bits]))

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; that of another key, or -1, for what is none."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = self._places(keys[left], level, int(size)).astype(np.int64)
            word = self.bits[self.starts[level] + (at >> 6)]
            below = np.uint64(1) << (at & 63).astype(np.uint64)
            here = (word & below) != 0
            place = self.starts[level] + (at[here] >> 6)
            out[left[here]] = self.ranks[place] + np.bitwise_count(word[here] & (below[here] - np.uint64(1)))
            left = left[~here]
        return out


class Shard:
    """The arrays of one shard, in the order of its perfect hash."""

    FIELDS = ("sizes", "bits", "prints", "counts", "last")
    KINDS = (np.int64, np.uint64, np.uint64, np.uint32, np.int64)

    def __init__(self, sizes, bits, prints, counts, last):
        self.hash, self.prints, self.counts, self.last = PerfectHash(sizes, bits), prints, counts, last

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, last: np.ndarray) -> Shard:
        made = PerfectHash.of(keys)
        at = made.index(keys)
        arrays = [np.empty(len(keys), kind) for kind in cls.KINDS[2:]]
        for array, values in zip(arrays, (keys[:, 1], np.minimum(counts, (1 << 32) - 1), last), strict=True):
            array[at] = values
        return cls(made.sizes, made.bits, *arrays)

    @classmethod
    def read(cls, fields: tuple[bytes, ...]) -> Shard:
        return cls(*[np.frombuffer(x, kind) for x, kind in zip(fields, cls.KINDS, strict=True)])

    def fields(self) -> list[bytes]:
        return [x.tobytes() for x in (self.hash.sizes, self.hash.bits, self.prints, self.counts, self.last)]

    def repeated(self, keys: np.ndarray, ids: np.ndarray, documents: int) -> np.ndarray:
        """Whether each key is that of a line which that many documents hold, the last of which isn't the one with this id."""
        at = self.hash.index(keys)
        if not len(self.prints):
            return np.zeros(len(keys), bool)
        known = (at >= 0) & (self.prints[at] == keys[:, 1])
        return known & (self.counts[at] >= documents) & (self.last[at] != ids)


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys[:, 0] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _merged(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """(a, b, n, last) of each distinct key."""
    order = np.lexsort((ids, keys[:, 1], keys[:, 0]))
    keys, ids = keys[order], ids[order]
    ends = np.flatnonzero(np.r_[(keys[1:] != keys[:-1]).any(1), True])
    signed = np.ascontiguousarray(keys[ends]).view(np.int64)
    return pa.record_batch([pa.array(signed[:, 0]), pa.array(signed[:, 1]), pa.array(np.diff(np.r_[-1, ends])), pa.array(ids[ends])], ["a", "b", "n", "last"])


def _count(s: Lines):
    """For each distinct line of a task's documents (doc_id, text): its hash, how many documents hold it, and the largest id of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests: list[bytes] = []
        ids: list[np.ndarray] = []
        for batch in by_bytes(batches, 1):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = set(hashes_of(text.split("\n"), s.shortest)[1]) if text else ()
                if found:
                    digests += found
                    ids.append(np.full(len(found), NO_ID if doc_id is None else doc_id, np.int64))
                    if len(digests) >= s.held:
                        yield _merged(as_pairs(digests), np.concatenate(ids))
                        digests, ids = [], []
        if digests:
            yield _merged(as_pairs(digests), np.concatenate(ids))

    return run


def line_counts(docs: DataFrame, settings: Lines | None = None) -> DataFrame:
    """(a, b, n, last): the 128-bit hash of each line key that enough rows of docs(doc_id, text) hold, how many rows, and the largest doc_id."""
    s = settings or Lines()
    plain = docs.select(F.col("doc_id").cast("long"), "text")
    counted = plain.mapInArrow(_count(s), "a long, b long, n long, last long").groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    return counted.where(F.col("n") >= s.documents)


SHARD_SCHEMA = "shard long, sizes binary, bits binary, prints binary, counts binary, last binary"


def shards(counts: DataFrame, bits: int) -> DataFrame:
    """A row for each of at most 2**bits shards: perfect hash and arrays of the lines of line_counts()."""

    def build(t: pa.Table) -> pa.Table:
        keys = np.column_stack([t["a"].to_numpy().view(np.uint64), t["b"].to_numpy().view(np.uint64)])
        made = Shard.of(keys, t["n"].to_numpy(), t["last"].to_numpy())
        return pa.table({"shard": shard_of(keys[:1], bits)} | {n: pa.array([x], pa.binary()) for n, x in zip(Shard.FIELDS, made.fields(), strict=True)})

    shard = F.expr(f"shiftrightunsigned(a, {64 - bits})") if bits else F.lit(0).cast("long")
    return counts.groupBy(shard).applyInArrow(build, SHARD_SCHEMA)


def _without(lines: list[str], gone: set[int]) -> str:
    return "\n".join([x for i, x in enumerate(lines) if i not in gone])


_OUT = "text string, n_lines long, n_dropped long"


def _batch(batch: pa.RecordBatch, texts: list[str], lines: list[int], dropped: list[int]) -> pa.RecordBatch:
    return pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], ["doc_id", "text", "n_lines", "n_dropped"])


def _probe_here(s: Lines, bits: int, sent):
    """Documents (doc_id, text) against the arrays of all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: Shard.read(fields) for k, *fields in sent.value}
        for batch in by_bytes(batches, 1):
            split = [(t or "").split("\n") for t in batch.column(1).to_pylist()]
            ids = [NO_ID if x is None else x for x in batch.column(0).to_pylist()]
            digests: list[bytes] = []
            owners, places = [], []
            for k, lines in enumerate(split):
                at, found = hashes_of(lines, s.shortest)
                digests += found
                places += at
                owners.append(np.full(len(at), k))
            gone: list[set[int]] = [set() for _ in split]
            if digests and known:
                keys, owner = as_pairs(digests), np.concatenate(owners)
                shard, id_ = shard_of(keys, bits), np.array(ids, np.int64)[owner]
                for k in np.unique(shard).tolist():
                    if k in known:
                        mine = np.flatnonzero(shard == k)
                        for i in mine[known[k].repeated(keys[mine], id_[mine], s.documents)].tolist():
                            gone[owner[i]].add(places[i])
            texts = [_without(x, g) if g else t or "" for x, g, t in zip(split, gone, batch.column(1).to_pylist(), strict=True)]
            yield _batch(batch, texts, [len(x) for x in split], [len(g) for g in gone])

    return run


def _questions(s: Lines, bits: int):
    """(shard, ask, keys, ids): the packed hashes of a batch of documents that concern a shard, each distinct line of a document once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            digests, owners = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = set(hashes_of((text or "").split("\n"), s.shortest)[1])
                digests += found
                owners.append(np.full(len(found), NO_ID if doc_id is None else doc_id, np.int64))
            if digests:
                keys, ids = as_pairs(digests), np.concatenate(owners)
                shard = shard_of(keys, bits)
                each = np.unique(shard)
                columns = [pa.array(each), pa.array([True] * len(each)), pa.array([keys[shard == k].tobytes() for k in each], pa.binary()), pa.array([ids[shard == k].tobytes() for k in each], pa.binary())]
                yield pa.record_batch(columns, ["shard", "ask", "keys", "ids"])

    return run


def _answers(s: Lines):
    """(doc_id, dropped): of rows ordered by shard, its arrays first and then what is asked of it, the packed hashes that a document loses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, known = None, None
        for batch in batches:
            for r in batch.to_pylist():
                if not r["ask"]:
                    current, known = r["shard"], Shard.read(tuple(r[n] for n in Shard.FIELDS))
                elif r["shard"] == current:
                    keys, ids = np.frombuffer(r["keys"], np.uint64).reshape(-1, 2), np.frombuffer(r["ids"], np.int64)
                    out = np.flatnonzero(known.repeated(keys, ids, s.documents))
                    out = out[np.argsort(ids[out], kind="stable")]
                    if len(out):
                        starts = np.flatnonzero(np.r_[True, ids[out][1:] != ids[out][:-1]])
                        packed = [x.tobytes() for x in np.split(keys[out], starts[1:])]
                        yield pa.record_batch([pa.array(ids[out][starts]), pa.array(packed, pa.binary())], ["doc_id", "dropped"])

    return run


def _apply(s: Lines):
    """Documents (doc_id, text, dropped: hashes that go, packed, in a list)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            texts, n_lines, n_dropped = [], [], []
            for text, dropped in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                lines, gone = (text or "").split("\n"), set()
                if dropped:
                    named = {x[i : i + 16] for x in dropped for i in range(0, len(x), 16)}
                    gone = {i for i, h in zip(*hashes_of(lines, s.shortest), strict=True) if h in named}
                texts.append(_without(lines, gone) if gone else text or "")
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
            yield _batch(batch, texts, n_lines, n_dropped)

    return run


#: Bytes that a line takes in the arrays, at most: fingerprint, count, id, and the bits of the perfect hash.
LINE_BYTES = 21


def drop_repeated_lines(docs: DataFrame, settings: Lines | None = None) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) for each row of docs(doc_id, text): the text without lines that are kept in another document.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys of at least ``shortest`` code points that at
    least ``documents`` rows hold lose all their lines but in the row with the largest doc_id among them. n_lines: lines before.
    Null and empty texts are one empty line. Rows that share a doc_id count as documents of their own, and keep or lose lines
    alike; a null doc_id is smaller than all others. An empty table gives an empty table; other columns are not read.
    """
    s = settings or Lines()
    plain = numbered(docs).select(F.col(place_of(docs, "doc_id")).alias("doc_id"), F.col(place_of(docs, "text")).alias("text"))
    spark, kind = docs.sparkSession, plain.schema["doc_id"].dataType.simpleString()
    counts = materialize(line_counts(plain, s), "line-counts")
    n = counts.count()
    bits = max(0, (n // s.shard).bit_length())
    made = materialize(shards(counts, bits), "line-shards")
    if n * LINE_BYTES <= s.sent_bytes:
        sent = spark.sparkContext.broadcast([tuple(r) for r in made.collect()])
        return plain.mapInArrow(_probe_here(s, bits, sent), f"doc_id {kind}, {_OUT}")
    asked = plain.select(F.col("doc_id").cast("long"), "text").mapInArrow(_questions(s, bits), "shard long, ask boolean, keys binary, ids binary")
    both = made.withColumn("ask", F.lit(False)).unionByName(asked, allowMissingColumns=True)
    answered = both.repartition("shard").sortWithinPartitions("shard", "ask").mapInArrow(_answers(s), "doc_id long, dropped binary")
    dropped = materialize(answered, "line-answers").groupBy(F.col("doc_id").alias("id")).agg(F.collect_list("dropped").alias("dropped"))
    met = plain.join(dropped, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("id"), "left")
    return met.select("doc_id", "text", "dropped").mapInArrow(_apply(s), f"doc_id {kind}, {_OUT}")


def oracle(settings: Lines | None = None) -> str:
    """DuckDB SQL for drop_repeated_lines() of documents, with the digest in place of the text."""
    s = settings or Lines()
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    blanks = " || ".join(f"chr({ord(c)})" for c in BLANKS)
    return f"""
    with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents),
    lines as (select doc_id, unnest(l) as line, generate_subscripts(l, 1) as i from d),
    keyed as (select *, translate(trim(line, {blanks}), '{upper}', '{upper.lower()}') as k from lines),
    often as (select k, max(doc_id) as last from keyed where length(k) >= {s.shortest} group by k having count(distinct doc_id) >= {s.documents}),
    marked as (select keyed.*, often.k is not null and doc_id <> last as gone from keyed left join often using (k))
    select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
           sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256 from marked group by doc_id"""
