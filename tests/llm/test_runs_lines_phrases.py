"""Periodic runs, line dedup and collocations against brute force and SQL, and on odd inputs."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from terrier.llm import collocations, line_dedup, periodic_runs, queries

SF = "/root/testdata/sf0.01"
ODD = [None, "", " ", "a", "\n\n", "x " * 3000, "one two three", "one two three", "ÀÉ 漢字 🙂 a b a b", "tab\there\x0bnow  two", "w" * 20_000, "a b " * 40 + "c"]


def docs_of(spark, texts, ids=None, langs=None):
    n = len(texts)
    ids = range(n) if ids is None else ids
    langs = [None] * n if langs is None else langs
    return spark.createDataFrame([(i, t, k, "x", 1) for i, t, k in zip(ids, texts, langs, strict=True)], "doc_id long, text string, lang string, runs string, n long")


# --- periodic runs


def brute_runs(w, shortest):
    """For each period, the stretches where words so far apart are identical; of equal stretches the smallest period."""
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 2 * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((a, b, q) for (a, b), q in out.items()), key=lambda r: (r[0], r[2]))


def fibonacci(n):
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_equal_brute_force():
    rng = random.Random(7)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.choice([0, 1, 7, 40, 120]), rng.choice([1, 2, 3, 6])
            w = [b"%d" % rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(2, 8)
                w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
            texts.append(w)
        shortest = rng.choice([1, 2, 4, 12, 12])
        assert periodic_runs.runs_of(texts, shortest) == [brute_runs(w, shortest) for w in texts]
    w = fibonacci(600)
    assert periodic_runs.runs_of([w], 12) == [brute_runs(w, 12)]


def test_runs_of_many_equal_words_are_one():
    assert periodic_runs.runs_of([[b"a"] * 30_000], 12) == [[(0, 30_000, 1)]]


def test_op11_equals_brute_force_on_whole_texts(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert set(got) == set(texts)
    some = 0
    for doc_id, text in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        # numbers for words, and arrays for the comparison of words q apart
        codes = np.unique(np.array(w, dtype=object), return_inverse=True)[1] if w else np.zeros(0, int)
        runs = {}
        for q in range(1, len(w) // 2 + 1):
            same = np.r_[False, codes[q:] == codes[:-q], False].astype(np.int8)
            edges = np.flatnonzero(np.diff(same))
            for i, j in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if j - i + q >= max(12, 2 * q):
                    runs.setdefault((i, j - i + q), q)
        runs = sorted(((a, b, q) for (a, b), q in runs.items()), key=lambda r: (r[0], r[2]))
        some += len(runs) > 0
        gone = {k for a, b, q in runs for k in range(a + q, a + b)}
        r = got[doc_id]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{q}\n" for a, b, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()
    assert some > 10


def test_runs_odd(spark):
    df = docs_of(spark, ODD, [None, *range(1, len(ODD))])
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(df).collect()}
    assert len(got) == len(ODD)
    for i, t in enumerate(ODD):
        w = (t or "").encode().split()
        r = got[i or None]
        runs = [(x.start, x.length, x.period) for x in r.runs]
        assert r.n_words == len(w) and runs == brute_runs(w, 12) and r.collapsed == periodic_runs.collapsed(w, runs).decode()
    assert got[5].collapsed == "x" and got[11].collapsed == "a b c"
    small = periodic_runs.Runs(batch_bytes=1)
    assert {(r.doc_id, len(r.runs)) for r in periodic_runs.periodic_runs(df, small).collect()} == {(i, len(r.runs)) for i, r in got.items()}
    assert periodic_runs.digests(periodic_runs.periodic_runs(df.limit(0))).count() == 0


# --- line dedup


def brute_lines(rows, shortest, documents):
    """(text, lines, dropped) of each row (doc_id, text)."""
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    low = lambda i: -(1 << 63) if i is None else i
    held = collections.defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= shortest:
                held[k].append(low(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(held[key(x)]) >= documents and low(i) != max(held[key(x)]))]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


LINES = [f"line number {i} that is long enough to count here" for i in range(12)]


@pytest.mark.parametrize("settings", [line_dedup.Lines(), line_dedup.Lines(sent_bytes=0), line_dedup.Lines(shard=2, held=3), line_dedup.Lines(shard=2, held=3, sent_bytes=0)])
def test_lines_equal_brute_force(spark, settings):
    rng = random.Random(3)
    texts = [*ODD, "\n".join([LINES[0], "  " + LINES[0].upper() + "\t", "é" * 39, "é" * 40, ""])]
    for _ in range(120):
        some = [rng.choice([*LINES, "é" * 39, "é" * 40, "É" * 40, "", "short"]) for _ in range(rng.randint(0, 6))]
        texts.append("\n".join(x.upper() + " " * rng.randint(0, 2) if rng.random() < 0.3 else "\t" + x for x in some))
    ids = [None, None, *range(3, len(texts) - 1), 3, 9]
    ids = ids[: len(texts)]
    got = collections.Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_repeated_lines(docs_of(spark, texts, ids), settings).collect())
    rows = list(zip(ids, texts, strict=True))
    assert got == collections.Counter((i, *x) for (i, _), x in zip(rows, brute_lines(rows, 40, 5), strict=True))


def test_lines_no_rows(spark):
    for sent in (0, 1 << 20):
        assert line_dedup.drop_repeated_lines(docs_of(spark, ["a"]).limit(0), line_dedup.Lines(sent_bytes=sent)).count() == 0
        assert line_dedup.drop_repeated_lines(docs_of(spark, ["a"]), line_dedup.Lines(sent_bytes=sent)).first().text == "a"


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 1 << 63, (50_000, 2)).astype(np.uint64)
    made = line_dedup.PerfectHash.of(keys)
    assert sorted(made.index(keys).tolist()) == list(range(len(keys)))
    assert len(made.bits) * 64 < 5 * len(keys)
    one = line_dedup.Shard.of(keys, np.full(len(keys), 7), np.arange(len(keys)))
    again = line_dedup.Shard.read(tuple(one.fields()))
    assert again.repeated(keys, np.full(len(keys), -1), 5).all() and not again.repeated(keys, np.arange(len(keys)), 5).any()
    others = keys ^ np.uint64(1 << 63)
    assert not again.repeated(others, np.full(len(keys), -1), 5).any()


def test_op12_equals_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf_dir}/documents.parquet')")
    expected = {r[0]: r[1:] for r in con.execute(f"select doc_id, n_lines, n_dropped, kept_sha256 from ({line_dedup.oracle()})").fetchall()}
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op12_line_dedup(spark, sf_dir).collect()}
    assert got == expected and sum(r[1] for r in got.values()) > 0


# --- collocations


def brute_phrases(rows, s):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, 6):
                counts.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    candidates = {p: f for p, f in counts.items() if len(p[1]) > 1 and f >= s.least}
    inside = set()
    for (lang, p), f in candidates.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p) and 100 * f >= 100 * candidates[lang, p[i:j]]:
                    inside.add((lang, p[i:j]))
    out = []
    for (lang, p), a in candidates.items():
        if (lang, p) not in inside:
            cuts = [(s.permille * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]], totals[lang]))
    out.sort()
    ranks = collections.Counter()
    found = []
    for lang, score, a, phrase, left, right, n in out:
        ranks[lang] += 1
        if ranks[lang] <= s.top:
            found.append((lang, ranks[lang], phrase.decode(), -a, left, right, n, -score))
    return found


def sized(**k):
    return collocations.Phrases(least=3, top=40, **k)


@pytest.mark.parametrize("settings", [sized(), sized(block=50, paths=20), sized(filter_bits=64), sized(hot=5, salts=3, paths=10)])
def test_phrases_equal_brute_force(spark, settings):
    rng = random.Random(5)
    pool = ["de", "La", "été", "c", "new", "york", "city", "hall", "x-1", "\x1f", "w" * 100]
    texts, langs = list(ODD), [None] * len(ODD)
    for _ in range(150):
        words = []
        for _ in range(rng.randint(0, 12)):
            words += ["new", "york", "city"] if rng.random() < 0.2 else [rng.choice(pool)]
            words[-1:] = [words[-1] + rng.choice(["", "", "", ".", ", ", "\n", "\t", " \t "])]
        texts.append(" ".join(words))
        langs.append(rng.choice(["en", "en", "fr", None]))
    got = [tuple(r) for r in collocations.collocations(docs_of(spark, texts, langs=langs), settings).orderBy("lang", "rank").collect()]
    assert got == brute_phrases(zip(langs, texts, strict=True), settings)
    assert {r[0] for r in got} == {"en", "fr", "und"}


def test_phrases_odd(spark):
    df = docs_of(spark, ["a b a b", None, ""])
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(df.limit(0)).count() == 0
    assert [r.phrase for r in collocations.collocations(df, collocations.Phrases(least=2)).collect()] == ["a b"]


def test_transducer():
    rng = np.random.default_rng(2)
    grams = [rng.integers(0, 4, 500).astype(np.uint64) for _ in range(3)]
    plain = collections.Counter(zip(*[g.tolist() for g in grams], strict=True))
    halves = [collocations.CountTransducer.of([g[i::2] for g in grams]) for i in (0, 1)]
    made = collocations.CountTransducer.union(halves)
    assert dict(zip(zip(*[c.tolist() for c in made.columns], strict=True), made.weights.tolist(), strict=True)) == dict(plain)
    asked = np.array([[a, b, c] for a in range(5) for b in range(5) for c in range(5)], np.uint64)
    assert made.compose(list(asked.T)).tolist() == [plain[tuple(x)] for x in asked.tolist()]
    first, weight = made.states(2)
    two = collections.Counter(x[:2] for x in plain.elements())
    assert {(int(made.columns[0][i]), int(made.columns[1][i])): int(w) for i, w in zip(first, weight, strict=True)} == {k: n for k, n in two.items() if k[1]}


def test_op13_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    names = "lang, rank, phrase, a, l, r, n, score"
    expected = con.execute(f"select {names} from ({collocations.oracle()}) order by lang, rank").fetchall()
    got = queries.op13_collocations(spark, SF).orderBy("lang", "rank").collect()
    assert [tuple(r) for r in got] == expected and len(got) > 20
