"""What the operators of this folder share: tables, the shared folder, words, hashes and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that end a word: space and 09 to 0D, which is what bytes.split() splits at.
WORD_BREAKS = b" \t\n\x0b\x0c\r"
UPPER_TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Entries that a per-worker cache may hold before it starts anew.
CACHE_ENTRIES = 60_000
#: Longer words are never remembered, so that the bound above is one of bytes too.
HELD_LENGTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. A session that names none gets a folder of its own on one machine; on a cluster that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="terrier-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame) -> DataFrame:
    """The same columns as c0, c1, ...: what is added to them can't clash with a name, in whatever letters."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> str:
    """The name that a column has in numbered(df): the one of just that name, or else of the same in other letters."""
    names = df.columns
    return f"c{names.index(name) if name in names else [n.lower() for n in names].index(name.lower())}"


def without(df: DataFrame, *names: str) -> list[str]:
    """The columns of df whose names are none of these, in whatever letters."""
    return [c for c in df.columns if c.lower() not in names]


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at white space of ASCII; words are UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(UPPER_TO_LOWER).split()


class WordHashes(dict):
    """64-bit hash of each word, remembered up to CACHE_ENTRIES words."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= HELD_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[word] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def rows(batches: Iterator[pa.RecordBatch], size: int, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most size rows and of about most_bytes of texts, or of one row that is longer."""
    for batch in batches:
        texts = [i for i, f in enumerate(batch.schema) if pa.types.is_string(f.type) or pa.types.is_binary(f.type)]
        yield from _sliced(batch, texts, most_bytes, size)


def by_bytes(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 4 << 20, most_rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about most_bytes of a text column, or of one row that is longer, and of at most most_rows rows."""
    for batch in batches:
        yield from _sliced(batch, [column], most_bytes, most_rows)


def _sliced(batch: pa.RecordBatch, columns: list[int], most_bytes: int, most_rows: int) -> Iterator[pa.RecordBatch]:
    sizes = np.zeros(batch.num_rows)
    for c in columns:
        sizes += np.nan_to_num(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False).astype(float))
    at, ends = 0, np.cumsum(sizes)
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, min(at + most_rows, int(np.searchsorted(ends, before + most_bytes, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as a forest: each node once, with the smallest node it reaches here."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [(x, find(x)) for x in parent]
    nodes = [x for x in nodes if x[0] != x[1]]
    for at in range(0, len(nodes), 50_000):
        part = nodes[at : at + 50_000]
        yield pa.record_batch([pa.array([x[0] for x in part], pa.int64()), pa.array([x[1] for x in part], pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node of links (two long columns): root is the smallest node reachable.

    Partitions first contract their own links, then large and small stars alternate until nothing changes.
    Null ends and self links are dropped; no links give an empty table.
    """
    a, b = links.columns[:2]
    links = links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
    links = links.where("a is not null and b is not null and a <> b").mapInArrow(_forest, "a long, b long")
    links = materialize(links.where("a <> b").distinct(), "links")
    before = None
    while True:
        both = links.select("a", "b").union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        links = materialize(small.union(own).where("a <> b").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
