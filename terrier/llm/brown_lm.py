"""Language-model scoring with Brown classes.

Exchange clustering assigns the most frequent words to classes: in a fixed order, each word moves to the class that raises the
likelihood of the class bigrams most. Spark counts the bigrams over all training texts; the exchange itself works on their
square, whose size is fixed, so its result depends on the counts alone. Every other word that training texts use twice or more
is then placed in those classes by its own neighbours, in the class in which these are likeliest, however many such words there
are. Words used once, and words never seen, have a class by their looks (length, ends, signs).

A text's score is the sum over its tokens of the log probability of the class after the class before it, and of the word within
its class. Both sum to one: bigrams are interpolated (Witten-Bell), and in the classes by looks seen words leave a discount to
what was never seen, which is one event of its class.

Texts are read twice: to count words, and to write them as codes. The codes know a vocabulary of fixed size, which is sent to
the tasks; each use of any other word is a row of its own beside its two neighbours, is joined with that word's class, and where
such words stand side by side finds the class before it in a window. Both tables are in the shared folder; all further steps read them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import HELD_LENGTH, materialize, rows, words

#: The token behind each text's last word; no word is empty.
END = b""


@dataclass(frozen=True)
class Settings:
    """clustered: words that the exchange classes; sent: words whose classes and counts are sent to all tasks (fixed bounds, whatever the input; words beyond them are placed and joined as rows).

    classes: of words by use; looks: classes by looks for words used once or never. rounds: of the exchange, at most. context:
    how many of the most frequent words count as neighbours of their own when words are placed. held: words that a task remembers.
    block: words beyond those sent that stand side by side and are looked at together.
    """

    clustered: int = 2000
    sent: int = 200_000
    classes: int = 48
    looks: int = 64
    rounds: int = 6
    context: int = 48
    discount: float = 0.75
    held: int = 50_000
    block: int = 512


def looks(word: bytes, n: int) -> int:
    """The class by looks: ASCII or not, length, last sign and last letters, capitals don't matter."""
    last = word[-1:] if word else b""
    sign = 0 if last.isalpha() or last > b"\x7f" else 1 + (b",.!?%&$#*|".find(last) % 7)
    high = any(b > 0x7F for b in word) if not word.isascii() else False
    return (min(len(word), 15) // 3 * 32 + sign * 4 + 2 * high + (word[:1] > b"\x7f")) * 2654435761 % 4294967291 % n


def _count_words(rows_held: int):
    """Word counts of a partition; what it holds is passed on when there are rows_held words, or after so much text that long words could take much memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        size = 0

        def out(some: list[tuple[bytes, int]]) -> pa.RecordBatch:
            return pa.record_batch([pa.array([w for w, _ in some], pa.binary()), pa.array([n for _, n in some], pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(words(text))
                counts[END] += 1
                size += len(text or "")
                if len(counts) > rows_held or size > 64 << 20:
                    # rare and long words go, the frequent stay
                    size = 0
                    some = [(w, n) for w, n in counts.items() if n < 20 or len(w) > HELD_LENGTH]
                    some = some if len(some) > rows_held // 4 else list(counts.items())
                    for w, _ in some:
                        del counts[w]
                    for at in range(0, len(some), 50_000):
                        yield out(some[at : at + 50_000])
        some = list(counts.items())
        for at in range(0, len(some), 50_000):
            yield out(some[at : at + 50_000])

    return run


class Codes(dict):
    """Code of each word: its place in the vocabulary, or size + its class by looks. Remembers a bounded number of words."""

    def __init__(self, vocabulary: list[bytes], n_looks: int, held: int):
        super().__init__({w: i for i, w in enumerate(vocabulary)})
        self.size, self.n_looks, self.most = len(vocabulary), n_looks, len(vocabulary) + held
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        code = self.size + looks(word, self.n_looks)
        if len(word) <= HELD_LENGTH:
            if len(self) >= self.most:
                self.clear()
                self.update({w: i for i, w in enumerate(self.vocabulary)})
            self[word] = code
        return code


def _encode(sent, kind: pa.DataType, s: Settings):
    """Texts (doc_id, text, learn, row) as codes, tokens and an end; and for each word beyond those sent a row with the codes beside it (-1: such a word too).

    run: where the words beyond those sent began that stand before it without a gap, in blocks; the last word of a block is
    repeated at the head of the next (ahead), so that every word finds the one before it in its own block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        codes, size = Codes(vocabulary, s.looks, s.held), len(vocabulary)
        end = codes[END]
        heads, lines, rare, rare_words, held = [], [], [], [], 0

        def out() -> pa.RecordBatch:
            n, m = len(heads), len(rare_words)
            numbers = np.concatenate(rare, axis=1) if rare else np.zeros((8, 0), np.int64)
            none = pa.nulls(n, pa.int32())
            whole = lambda i: pa.concat_arrays([none, pa.array(numbers[i].astype(np.int32))])
            return pa.record_batch(
                [
                    pa.concat_arrays([pa.array([h[0] for h in heads], pa.int64()), pa.array(numbers[0], pa.int64())]),
                    pa.concat_arrays([pa.array([h[1] for h in heads], kind), pa.nulls(m, kind)]),
                    pa.concat_arrays([pa.array([h[2] for h in heads], pa.bool_()), pa.array(numbers[1] > 0)]),
                    pa.array(lines + [None] * m, pa.binary()),
                    pa.array([None] * n + rare_words, pa.binary()),
                    *(whole(i) for i in (2, 3, 4, 5, 6)),
                    pa.concat_arrays([pa.nulls(n, pa.bool_()), pa.array(numbers[7] > 0)]),
                ],
                ["row", "doc_id", "learn", "codes", "word", "at", "run", "look", "before", "after", "ahead"],
            )

        for batch in (x for b in batches for x in rows([b], 500, 2 << 20)):
            for doc_id, text, learn, row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                w = words(text)
                line = np.full(len(w) + 1, end, np.int32)
                line[:-1] = np.fromiter(map(codes.__getitem__, w), np.int32, len(w))
                heads.append((row, doc_id, learn))
                lines.append(line.tobytes())
                held += 4 * len(line)
                at = np.flatnonzero(line >= size)
                if len(at):
                    before, after = np.concatenate([[end], line[:-1]])[at], line[at + 1]
                    before, after = np.where(before < size, before, -1), np.where(after < size, after, -1)
                    place = np.arange(len(at))
                    place = (place - np.maximum.accumulate(np.where(before >= 0, place, 0))) % s.block
                    again = np.flatnonzero((place == 0) & (before < 0))  # heads of further blocks
                    every = np.concatenate([at, at[again] - 1])
                    ahead = np.arange(len(every)) >= len(at)
                    rare.append(
                        np.stack([np.full(len(every), row), np.full(len(every), learn), every, np.concatenate([at - place, at[again]]), line[every] - size, np.concatenate([before, before[again]]), np.concatenate([after, after[again]]), ahead]).astype(np.int64)
                    )
                    rare_words += [w[i] for i in every.tolist()]
                    held += 80 * len(every)
                if held > 3_000_000:
                    yield out()
                    heads, lines, rare, rare_words, held = [], [], [], [], 0
        if heads:
            yield out()

    return run


def _line(batch: pa.RecordBatch, column: int, end: int) -> np.ndarray:
    """The codes of a batch's texts one after the other, an end before each and behind the last."""
    return np.concatenate([np.array([end], np.int32), np.frombuffer(b"".join(batch.column(column).to_pylist()), np.int32)])


def _count_neighbours(sent, n_core: int, s: Settings):
    """Counts of a partition of codes, as rows (kind, at, counts): for each core code a row of the square of neighbouring codes, words beyond the core
    by their looks; and for each other word of those sent how often each context word stands before it and after it. Both are of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_square, n, end = sent.value
        side = n_core + s.looks
        n_context = min(s.context, n_core)
        width = 2 * (n_context + 1)
        square, around = np.zeros(side * side, np.int32), np.zeros((n - n_core) * width, np.int32)
        for batch in (x for b in batches for x in rows([b], 2000, 1 << 20)):
            line = _line(batch, 0, end)
            q = in_square[line].astype(np.int64)
            some, times = np.unique(q[:-1] * side + q[1:], return_counts=True)
            square[some] += times.astype(np.int32)
            here = np.flatnonzero((line >= n_core) & (line < n))  # never the first or the last, which are ends
            if len(here):
                at = (line[here] - n_core).astype(np.int64) * width
                some, times = np.unique(np.concatenate([at + np.minimum(line[here - 1], n_context), at + n_context + 1 + np.minimum(line[here + 1], n_context)]), return_counts=True)
                around[some] += times.astype(np.int32)
        for kind, table in ((0, square.reshape(side, side)), (1, around.reshape(-1, width))):
            some = np.flatnonzero(table.any(1))
            for k in range(0, len(some), 2000):
                part = some[k : k + 2000]
                yield pa.record_batch([pa.array(np.full(len(part), kind, np.int32)), pa.array(part.astype(np.int32)), pa.array([table[i].tobytes() for i in part], pa.binary())], ["kind", "at", "counts"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, at, counts) ordered by kind and at, each place's counts of 32 bits summed to counts of 64."""
    held, total = None, None
    out: list[tuple] = []

    def record() -> pa.RecordBatch:
        return pa.record_batch([pa.array([x[0][0] for x in out], pa.int32()), pa.array([x[0][1] for x in out], pa.int32()), pa.array([x[1].tobytes() for x in out], pa.binary())], ["kind", "at", "counts"])

    for b in batches:
        for kind, at, counts in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if held != (kind, at):
                if held is not None:
                    out.append((held, total))
                held, total = (kind, at), np.zeros(len(counts) // 4, np.int64)
                if len(out) >= 500:
                    yield record()
                    out.clear()
            total += np.frombuffer(counts, np.int32)
    if held is not None:
        out.append((held, total))
        yield record()


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def exchange(square: np.ndarray, n_words: int, s: Settings) -> np.ndarray:
    """The class of each code. square: counts of neighbouring codes, of which the first n_words are words, in order of frequency.

    Words start in classes in turn. Each round goes through all words in order; every word goes to the class that gains most,
    given all moves so far. The classes by looks stay as they are. It ends when a round moves nothing.
    """
    total = s.classes + s.looks
    classes = np.concatenate([np.arange(n_words) % s.classes, s.classes + np.arange(s.looks)]).astype(np.int64)
    of_classes = np.zeros((total, total))
    i, j = np.nonzero(square)
    np.add.at(of_classes, (classes[i], classes[j]), square[i, j])
    ahead = [np.flatnonzero(square[w]) for w in range(n_words)]
    behind = [np.flatnonzero(square[:, w]) for w in range(n_words)]
    for _ in range(s.rounds):
        moved = 0
        for w in range(n_words):
            right = np.bincount(classes[ahead[w]], square[w, ahead[w]], minlength=total)
            left = np.bincount(classes[behind[w]], square[behind[w], w], minlength=total)
            own = classes[w]
            to = best_class(of_classes, own, right, left, s.classes)
            if to != own:
                moved += 1
                itself = square[w, w]
                for k, sign in ((own, -1), (to, 1)):
                    of_classes[k] += sign * right
                    of_classes[:, k] += sign * left
                # a word beside itself was moved once on each side of its own class
                of_classes[own, own] += itself
                of_classes[to, own] -= itself
                of_classes[own, to] -= itself
                of_classes[to, to] += itself
                classes[w] = to
        if not moved:
            break
    return classes


def neighbour_logs(square: np.ndarray, classes: np.ndarray, n_words: int, s: Settings) -> np.ndarray:
    """For each context before and after a word (the context words, then all others) and each class, the log of how likely it is there, in millionths: whole numbers have the same sum in any order."""
    n_context = min(s.context, n_words)
    before, after = np.zeros((n_context + 1, s.classes)), np.zeros((n_context + 1, s.classes))
    context = np.minimum(np.arange(len(classes)), n_context)
    i, j = np.nonzero(square)
    inside = classes[j] < s.classes
    np.add.at(before, (context[i][inside], classes[j][inside]), square[i, j][inside])
    inside = classes[i] < s.classes
    np.add.at(after, (context[j][inside], classes[i][inside]), square[i, j][inside])
    return np.rint(1e6 * np.concatenate([np.log((x + 0.5) / (x + 0.5).sum(0)) for x in (before, after)])).astype(np.int64)


def _place(sent):
    """The class of each word (at, counts) by its contexts: that in which they are likeliest, the first of equal ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = sent.value
        for b in batches:
            if b.num_rows:
                counts = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64).reshape(b.num_rows, -1)
                yield pa.record_batch([b.column(0), pa.array(np.argmax(counts @ logs, 1).astype(np.int32))], ["at", "to"])

    return run


def _place_rare(sent, n_context: int, s: Settings):
    """(word, n, to) for rows (word, look, before, after) ordered by word: how often it is used, and its class by its neighbours, or by looks if it is used once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = sent.value

        def out(names: list[bytes], n: np.ndarray, look: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
            to = np.where(n > 1, np.argmax(sums, 1), s.classes + look)
            return pa.record_batch([pa.array(names, pa.binary()), pa.array(n, pa.int64()), pa.array(to.astype(np.int32))], ["word", "n", "to"])

        held = None
        for b in (x for y in batches for x in rows([y], 20_000)):
            if not b.num_rows:
                continue
            word = b.column(0)
            new = np.ones(b.num_rows, bool)
            new[1:] = pc.not_equal(word.slice(1), word.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(new)
            before, after = (np.where((x < 0) | (x > n_context), n_context, x) for x in (b.column(2).to_numpy(), b.column(3).to_numpy()))
            sums = np.add.reduceat(logs[before] + logs[n_context + 1 + after], starts)
            n, look, names = np.diff(np.append(starts, b.num_rows)), b.column(1).to_numpy()[starts], word.take(pa.array(starts)).to_pylist()
            if held is not None:
                if held[0][0] == names[0]:
                    n[0] += held[1][0]
                    sums[0] += held[3][0]
                else:
                    yield out(*held)
            held = names[-1:], n[-1:].copy(), look[-1:].copy(), sums[-1:].copy()
            if len(names) > 1:
                yield out(names[:-1], n[:-1], look[:-1], sums[:-1])
        if held is not None:
            yield out(*held)

    return run


def _known_moves(sent, total: int):
    """How often each class follows each class among the words sent, in codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, end = sent.value
        square = np.zeros(total * total, np.int64)
        for batch in (x for b in batches for x in rows([b], 2000, 1 << 20)):
            c = class_of(_line(batch, 0, end), classes)
            both = (c[:-1] >= 0) & (c[1:] >= 0)
            square += np.bincount(c[:-1][both] * total + c[1:][both], minlength=total * total)
        at = np.flatnonzero(square)
        yield pa.record_batch([pa.array(at), pa.array(square[at])], ["at", "n"])

    return run


def _rare_moves(sent, total: int):
    """The same for all pairs in which one is beyond the words sent: rows (to, before, after, last)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, _ = sent.value
        square = np.zeros(total * total, np.int64)
        for b in batches:
            to, before, after = around(b, classes)
            square += np.bincount(before * total + to, minlength=total * total)
            square += np.bincount((to * total + after)[after >= 0], minlength=total * total)
        at = np.flatnonzero(square)
        yield pa.record_batch([pa.array(at), pa.array(square[at])], ["at", "n"])

    return run


def class_of(codes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The class of each code, -1 for words beyond those sent."""
    return np.where(codes < len(classes), classes[np.minimum(codes, len(classes) - 1)], -1)


def around(b: pa.RecordBatch, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows (to, before, after, last): the class, that before it, and that after it, which is -1 where the next word's row has the pair."""
    to, before, after = (b.column(i).to_numpy().astype(np.int64) for i in range(3))
    last = b.column(3).fill_null(-1).to_numpy().astype(np.int64)
    return to, np.where(before >= 0, classes[before], last), np.where(after >= 0, classes[after], -1)


def best_class(square: np.ndarray, own: int, right: np.ndarray, left: np.ndarray, n_classes: int) -> int:
    """The class that a word with these neighbour counts by class should be in: the gain of moving, in the log likelihood of class bigrams."""
    rest = square.copy()
    rest[own] -= right
    rest[:, own] -= left
    rest = np.maximum(rest, 0)
    rows_, columns_, n, m = rest.sum(1)[:n_classes], rest.sum(0)[:n_classes], right.sum(), left.sum()
    follows, leads = rest[:n_classes], rest[:, :n_classes].T
    at = right > 0
    gain = (_xlogx(follows[:, at] + right[at]) - _xlogx(follows[:, at])).sum(1)
    at = left > 0
    gain += (_xlogx(leads[:, at] + left[at]) - _xlogx(leads[:, at])).sum(1)
    gain -= _xlogx(rows_ + n) - _xlogx(rows_) + _xlogx(columns_ + m) - _xlogx(columns_)
    return int(np.argmax(gain)) if gain.max() > gain[own] + 1e-9 else int(own)


def score_texts(docs: DataFrame, training: Column, settings: Settings | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for docs(doc_id, text).

    training: a condition on doc_id that says which rows to learn from; rows for which it is null are held out. Null and
    empty texts have one token, the end. Repeated rows count and are scored each on their own; rows are told apart by a row
    key, so doc_id may be null or repeated. No rows: an empty table. Logarithms are to base 10.
    """
    s = settings or Settings()
    docs = docs.select("doc_id", "text", F.coalesce(training, F.lit(False)).alias("learn"))
    learned = learn(docs, s)
    return _score(learned, docs.sparkSession.sparkContext.broadcast(learned.model), s)


@dataclass(frozen=True)
class Model:
    """vocabulary: words sent, with counts known and classes. n_all: training tokens. The rest are logarithms: log_move of a class
    after a class, log_tokens of a class, unseen of a word never seen in its class, base_room of the base score's denominator."""

    vocabulary: list[bytes]
    known: np.ndarray
    classes: np.ndarray
    log_move: np.ndarray
    log_tokens: np.ndarray
    unseen: np.ndarray
    base_room: float
    n_all: int


@dataclass(frozen=True)
class Learned:
    """The model; lines: texts as codes (row, doc_id, learn, codes); rare: uses of words beyond those sent (row, learn, n, to, before, after, last);
    placed: these words' counts and classes (word, n, to)."""

    model: Model
    lines: DataFrame
    rare: DataFrame
    placed: DataFrame


def learn(docs: DataFrame, s: Settings) -> Learned:
    """The model of docs(doc_id, text, learn) where learn is true, and all texts as codes."""
    spark = docs.sparkSession
    counts = materialize(docs.where("learn").select("text").mapInArrow(_count_words(s.held), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    n_all, n_distinct, n_texts = map(int, counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("n"))), F.lit(0))).first())
    # the most frequent words: the least count that at most s.sent words reach, from how many words have each count
    least, reach = 1, 0
    for r in counts.where(F.col("n") >= 2).groupBy("n").agg(F.count("*").alias("k")).orderBy(F.desc("n")).toLocalIterator():
        if reach + r.k > s.sent:
            least = r.n + 1
            break
        reach, least = reach + r.k, r.n
    top = [(bytes(r.word), r.n) for r in counts.where(F.col("n") >= max(2, least)).collect()]
    top.sort(key=lambda x: (-x[1], x[0]))
    top = top if any(w == END for w, _ in top) else [*top, (END, n_texts)]
    # the end is always a clustered word, and the first in order unless some word is as frequent
    core = top[: s.clustered]
    core = core if any(w == END for w, _ in core) else [*core[:-1], (END, n_texts)]
    in_core = {w for w, _ in core}
    top = [*core, *(x for x in top if x[0] not in in_core)]
    vocabulary, known = [w for w, _ in top], np.array([n for _, n in top], np.int64)
    n_core, size, end = len(core), len(top), vocabulary.index(END)
    n_context = min(s.context, n_core)

    field = docs.schema["doc_id"].dataType
    encoded = docs.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _encode(spark.sparkContext.broadcast(vocabulary), to_arrow_type(field), s),
        f"row long, doc_id {field.simpleString()}, learn boolean, codes binary, word binary, at int, run int, look int, before int, after int, ahead boolean",
    )
    encoded = materialize(encoded, "codes")
    lines, uses = encoded.where("codes is not null").select("row", "doc_id", "learn", "codes"), encoded.where("word is not null")

    in_square = np.array([*range(n_core), *(n_core + looks(w, s.looks) for w in vocabulary[n_core:]), *range(n_core, n_core + s.looks)], np.int32)
    neighbours = lines.where("learn").select("codes").mapInArrow(_count_neighbours(spark.sparkContext.broadcast((in_square, size, end)), n_core, s), "kind int, at int, counts binary")
    neighbours = materialize(neighbours.repartition("kind", "at").sortWithinPartitions("kind", "at").mapInArrow(_summed, "kind int, at int, counts binary"), "neighbours")
    square = np.zeros((n_core + s.looks, n_core + s.looks), np.int64)
    for r in neighbours.where("kind = 0").toLocalIterator():  # a square of fixed size
        square[r.at] = np.frombuffer(r.counts, np.int64)
    by_use = exchange(square, n_core, s)
    logs = spark.sparkContext.broadcast(neighbour_logs(square, by_use, n_core, s))
    del square
    classes = np.concatenate([by_use[:n_core], np.zeros(size - n_core, np.int64)])
    for r in neighbours.where("kind = 1").select("at", "counts").mapInArrow(_place(logs), "at int, to int").collect():  # s.sent rows at most
        classes[n_core + r.at] = r.to

    # words beyond those sent are rows: each is used by less than one token in s.sent, so none is hot where texts are learned from
    placed = uses.where("learn and not ahead").select("word", "look", "before", "after").repartition("word").sortWithinPartitions("word")
    placed = materialize(placed.mapInArrow(_place_rare(logs, n_context, s), "word binary, n long, to int"), "placed")
    rare = uses.join(placed, "word", "left").select("row", "learn", "at", "run", "before", "after", "ahead", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("to", F.col("look") + s.classes).alias("to"))
    rare = materialize(rare, "uses")
    alone = F.expr("before >= 0 and after >= 0 and not ahead")
    columns = ["row", "learn", "n", "to", "before", "after", "last"]
    last = F.lag("to").over(Window.partitionBy("row", "run").orderBy("at"))
    rare = rare.where(alone).withColumn("last", F.lit(None).cast("int")).select(columns).unionByName(rare.where(~alone).withColumn("last", last).where("not ahead").select(columns))

    total = s.classes + s.looks
    sent = spark.sparkContext.broadcast((classes, end))
    moves = lines.where("learn").select("codes").mapInArrow(_known_moves(sent, total), "at long, n long")
    moves = moves.union(rare.where("learn").select("to", "before", "after", "last").mapInArrow(_rare_moves(sent, total), "at long, n long"))
    square = np.zeros(total * total)
    for r in moves.groupBy("at").agg(F.sum("n").alias("n")).collect():  # a square of fixed size
        square[r.at] = r.n
    tokens, distinct = np.bincount(classes, known, minlength=total), np.bincount(classes[known > 0], minlength=total).astype(np.float64)
    for r in placed.groupBy("to").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # a row for each class
        tokens[r.to] += r.n
        distinct[r.to] += r.v
    model = Model(vocabulary, known, classes, *probabilities(square.reshape(total, total), tokens, distinct, s), math.log10(n_all + n_distinct + 1), n_all)
    return Learned(model, lines, rare, placed)


def probabilities(square: np.ndarray, tokens: np.ndarray, distinct: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logarithms to base 10: of each class after each class, of each class's tokens, and of what was never seen within each class by looks.

    Classes by use hold nothing unseen, so their words have n / tokens; in classes by looks (n - discount) / tokens, and all
    that was never seen has the rest, or everything where nothing was seen.
    """
    alone = (tokens + 1) / (tokens.sum() + len(tokens))  # interpolated with the class alone, which is add-one smoothed
    follows = (square > 0).sum(1)
    left = square.sum(1)
    move = np.where(left[:, None] > 0, (square + follows[:, None] * alone[None, :]) / np.maximum(left + follows, 1)[:, None], alone[None, :])
    return np.log10(move), np.log10(np.maximum(tokens, 1)), np.where(tokens > 0, np.log10(np.maximum(s.discount * distinct, 1e-300)) - np.log10(np.maximum(tokens, 1)), 0.0)


def _word_logs(n: np.ndarray, of: np.ndarray, m: Model, s: Settings) -> np.ndarray:
    """The log of how likely a word with count n is in its class."""
    taken = np.where(of < s.classes, 0.0, s.discount)
    return np.where(n > 0, np.log10(np.maximum(n - taken, 1e-9)) - m.log_tokens[of], m.unseen[of])


def _score(learned: Learned, model, s: Settings) -> DataFrame:
    n_all = learned.model.n_all

    def by_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the words sent add to each text: (row, doc_id, learn, codes) to (row, doc_id, learn, n_tokens, n_known, base, score)."""
        m = model.value
        end, size = m.vocabulary.index(END), len(m.vocabulary)
        base_log = np.append(np.log10(m.known + 1.0) - m.base_room, 0.0)
        word_log = np.append(_word_logs(m.known.astype(np.float64), m.classes, m, s), 0.0)
        seen = np.append(m.known > 0, False).astype(np.float64)
        # one more class, which adds nothing, for what is not among the words sent
        log_move = np.pad(m.log_move, ((0, 1), (0, 1)))
        for b in (x for y in batches for x in rows([y], 500)):
            if not b.num_rows:
                continue
            line = _line(b, 3, end)
            c = class_of(line, m.classes)
            at = np.minimum(line[1:], size)
            n_tokens = np.array([len(x) // 4 for x in b.column(3).to_pylist()])
            starts = np.cumsum(n_tokens) - n_tokens
            known, base, score = (np.add.reduceat(x, starts) for x in (seen[at], base_log[at], word_log[at] + log_move[c[:-1], c[1:]]))
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(n_tokens, pa.int64()), pa.array(known.astype(np.int64)), pa.array(base), pa.array(score)], ["row", "doc_id", "learn", "n_tokens", "n_known", "base", "score"])

    def by_uses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the other words add, summed by row: (to, before, after, last, n, row) to (row, n_known, base, score)."""
        m = model.value
        for b in batches:
            if not b.num_rows:
                continue
            to, before, after = around(b, m.classes)
            n = b.column(4).to_numpy().astype(np.float64)
            score = _word_logs(n, to, m, s) + m.log_move[before, to] + np.where(after >= 0, m.log_move[to, after], 0.0)
            keys, at = np.unique(b.column(5).to_numpy(), return_inverse=True)
            sums = [np.bincount(at, x, minlength=len(keys)) for x in (n > 0, np.log10(n + 1) - m.base_room, score)]
            yield pa.record_batch([pa.array(keys), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], ["row", "n_known", "base", "score"])

    kind = learned.lines.schema["doc_id"].dataType.simpleString()
    heads = learned.lines.mapInArrow(by_codes, f"row long, doc_id {kind}, learn boolean, n_tokens long, n_known long, base double, score double")
    others = learned.rare.select("to", "before", "after", "last", "n", "row").mapInArrow(by_uses, "row long, n_known long, base double, score double")
    summed = heads.unionByName(others, allowMissingColumns=True).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("learn").alias("learn"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), F.sum("score").alias("score")
    )
    return summed.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"), "base_score", "score")
