"""The training-data operators against brute force, exact round trips and held-out accuracy, and on odd inputs."""

import collections
import hashlib
import math
import re
import types
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from terrier.llm import bpe, brown_lm, chat, common, html_wrappers, mixing, mpeg, near_vectors, ngram_join, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
VOCABULARY = f"{queries.TOKENIZERS}/byte_bpe_50k.json"
ODD = [None, "", " ", "a", "\n\n", "one two three", "x " * 30_000, "same text here now", "same text here now", "ÀÉ 漢字 🙂 <|endoftext|> don't", "tab\there\x0bnow  two"]


def docs_of(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None, "x") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, "doc_id long, text string, size string, class string")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# --- 1


def brute_links(vectors):
    ok = [i for i, v in enumerate(vectors) if v is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    m = np.array([vectors[i] for i in ok], float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    return {(ok[a], ok[b]) for a, b in zip(*np.nonzero(m @ m.T >= 0.9), strict=True) if a < b}


def test_near_vectors_odd(spark):
    v = [[1.0, 0.0, 0.0], [1.0, 0.1, 0.0], None, [0.0, 0.0, 0.0], [float("nan"), 1.0, 0.0], [1.0, None, 0.0], [0.0, 1.0, 0.0], [2.0, 0.0, 0.0], [1.0, 0.0, 0.0], [1e30, 1e29, 0.0], [-1.0, 0.0, 0.0], [1.0, 2.0]]
    df = spark.createDataFrame([(i, x, "c") for i, x in enumerate(v)], "vec_id long, embedding array<float>, c string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors.near_vectors(df).collect()}
    links = brute_links([x if x is None or len(x) == 3 else None for x in v])
    degree = collections.Counter(i for pair in links for i in pair)
    assert {i: n for i, (n, _, _) in got.items()} == {i: degree[i] for i in range(len(v))}
    assert {i for i, (_, c, _) in got.items() if c == 0} == {0, 1, 7, 8, 9}
    assert got[2] == (0, 2, True) and got[1][2] is False
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_of_several_lengths(spark):
    """Vectors link within their own length, whichever comes first."""
    rng = np.random.default_rng(2)
    v = [[1.0, 2.0], *(rng.standard_normal(k).tolist() for k in (3, 3, 4, 4) * 10)]
    v += [[x + 0.01 for x in y] for y in v]
    df = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")
    links = set()
    for k in (2, 3, 4):
        links |= brute_links([x if len(x) == k else None for x in v])
    degree = collections.Counter(i for pair in links for i in pair)
    for forest in (None, near_vectors.Forest(leaf=10, block=8)):
        assert {r.vec_id: r.n_links for r in near_vectors.near_vectors(df, forest=forest).collect()} == {i: degree[i] for i in range(len(v))}


def test_near_vectors_recall_at_the_threshold(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.standard_normal((1500, 64))
    other -= (other * base).sum(1, keepdims=True) * base
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cos = rng.uniform(0.9, 0.93, (1500, 1))
    both = np.concatenate([base, cos * base + np.sqrt(1 - cos**2) * other])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(both)], "vec_id long, embedding array<double>")
    links = brute_links(list(both))
    got = near_vectors.near_vectors(df).collect()
    found = sum(r.n_links for r in got) / 2
    assert 0.95 * len(links) <= found <= len(links)


def test_near_vectors_split_large_leaves(spark):
    """Leaves beyond two blocks are split further by trees of their own, clumps are compared in blocks, and each pair is given once."""
    rng = np.random.default_rng(4)
    v = rng.standard_normal((600, 24))
    v = np.concatenate([v, v[:200] + 0.05 * rng.standard_normal((200, 24)), v[:1] + 0.02 * rng.standard_normal((150, 24))])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    forest = near_vectors.Forest(leaf=20, sample=64, inner=200, block=30)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(df, forest=forest).collect()}
    links = brute_links(list(v))
    degree = collections.Counter(i for pair in links for i in pair)
    assert all(n <= degree[i] for i, (n, _) in got.items()) and sum(n for n, _ in got.values()) > 0.97 * sum(degree.values())


# --- 2


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    rng = np.random.default_rng(2)
    letters = list("abcdefghilmnoprstu 'é漢\n\t🙂0٣<|>.") + ["'s", " the", "<|endoftext|>", "  ", "\r\n"]
    texts = [*ODD, *("".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(300))]
    got = bpe.bpe_encode(docs_of(spark, texts), VOCABULARY, decode=True).orderBy("doc_id").collect()
    digests = bpe.bpe_digests(docs_of(spark, texts), VOCABULARY).orderBy("doc_id").collect()
    for text, r, d in zip(texts, got, digests, strict=True):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.token_ids == ids and r.text == decoded and r.n_tokens == d.n_tokens == len(ids)
        assert d.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert d.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.bpe_digests(docs_of(spark, []), VOCABULARY).count() == 0


# --- 3, 6


def accuracy(frame, label, predicted):
    return float((frame[label] == frame[predicted]).mean())


def test_quality(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_quality(docs).join(labels, "doc_id").selectExpr("quality", "cast(kept as int) as kept").toPandas()
    assert accuracy(got, "quality", "kept") > 0.95
    odd = quality.score_quality(docs_of(spark, ODD))
    assert odd.columns == ["doc_id", "text", "size", "class", "score", "kept"] and odd.count() == len(ODD)
    assert quality.score_quality(docs_of(spark, [])).count() == 0
    assert quality.keep_good(docs).columns == docs.columns


def test_shapes_see_whole_words():
    assert quality.shape("a" * 60 + "%7" * 20) == "a" + "%0" * 20
    assert quality.shape("\u4e2d" * 100 + "\u3002" + "\u6587" * 100) == "a\u3002a"


def test_votes_and_posteriors():
    assert quality.votes(None) == "-" * 8
    found, rates, prior = quality.posteriors({"---g-g--": 90, "b--g-b--": 10})
    assert found["---g-g--"] > 0.9 and found["b--g-b--"] < 0.1 and 0.8 < prior < 0.97
    assert quality.posteriors({})[0] == {}


def test_quality_equals_brute_force(spark, sf_dir):
    """Expectation-maximisation in plain loops over the votes of all texts, and the scorer fitted again on dense rows: the same scores."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    patterns = collections.Counter(quality.votes(t) for _, t in docs)
    good = {p: 0.1 if "b" in p else 0.95 for p in patterns}
    n = sum(patterns.values())
    for _ in range(60):
        prior = min(0.98, max(0.02, sum(k * good[p] for p, k in patterns.items()) / n))
        rates = {}
        for h in range(8):
            for truth in (0, 1):
                some = {v: sum(k * (good[p] if truth else 1 - good[p]) for p, k in patterns.items() if p[h] == v) + 0.002 * n * (0.9 if (v == "g") == truth else 0.1) + 1e-6 for v in "bg"}
                rates[h, truth] = {v: x / sum(some.values()) for v, x in some.items()}
        for p in patterns:
            for_, against = prior, 1 - prior
            for h, v in enumerate(p):
                if v != "-":
                    for_, against = for_ * rates[h, 1][v], against * rates[h, 0][v]
            good[p] = for_ / (for_ + against)
    high, low = min(0.9, max(good.values())), max(0.1, min(good.values()))
    sample = [(t, good[quality.votes(t)]) for _, t in sorted(set(docs), key=repr) if not low < good[quality.votes(t)] < high]
    shapes = quality._Shapes(16)

    def row(text):
        out = np.zeros(1 << 16)
        np.add.at(out, *quality.features(text, shapes))
        return out

    x, y = np.stack([row(t) for t, _ in sample]), np.array([g for _, g in sample])
    weight = np.where(y > 0.5, len(y) / 2 / max(1, (y > 0.5).sum()), len(y) / 2 / max(1, (y <= 0.5).sum()))
    used = np.flatnonzero(x.any(0))
    x = x[:, used]
    w, share = np.zeros(len(used)), (weight * y).sum() / weight.sum()
    b, g2, gb2 = math.log(share / (1 - share)), np.full(len(used), 1e-10), 1e-10
    for _ in range(200):
        error = (1 / (1 + np.exp(-(b + x @ w))) - y) * weight / weight.sum()
        g, gb = x.T @ error + 1e-5 * w, error.sum()
        g2, gb2 = g2 + g * g, gb2 + gb * gb
        w, b = w - 0.5 * g / np.sqrt(g2), b - 0.5 * gb / math.sqrt(gb2)
    want = {i: 1 / (1 + math.exp(-(b + row(t)[used] @ w))) for i, t in docs}
    got = {r.doc_id: r for r in queries.op3_quality(spark, sf_dir).collect()}
    assert set(got) == set(want)
    assert max(abs(got[i].score - x) for i, x in want.items()) < 1e-6
    assert all(got[i].kept == (x >= 0.35) for i, x in want.items() if abs(x - 0.35) > 1e-6)


def test_toxicity_equals_brute_force(spark, sf_dir):
    """Features of words, their choice by counts over the labelled texts, and the score of each text, by hand."""
    edge = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())

    def features(text):
        out = set()
        for word in (text or "").lower().split():
            if word := word.strip(edge):
                names = ["w" + word, *(f"b{k}{word[:k]}" for k in range(3, 8) if len(word) > k), *(f"l{k}{word[:k]}{len(word)}" for k in (4, 6) if len(word) > k)]
                out |= {zlib.crc32(x.encode()) % (1 << 20) for x in names}
        return out

    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held, s = queries.toxic_held_out(), toxicity.Settings()
    model = toxicity.fit(toxicity.labelled_sample(docs, labels, ~held, s.sample), s)
    texts = {r.doc_id: r.text for r in docs.collect()}
    known = {r.doc_id: r.toxic for r in labels.collect() if r.doc_id in texts and r.toxic in (0, 1) and zlib.crc32(str(r.doc_id).encode()) % 3 != 1}
    counts = {side: collections.Counter(f for i, t in known.items() if t == side for f in features(texts[i])) for side in (0, 1)}
    sizes = [max(1, sum(t == side for t in known.values())) for side in (0, 1)]
    chosen = set()
    for f, toxic in counts[1].items():
        share = (toxic + counts[0][f]) / sum(sizes)
        error = math.sqrt(max(share * (1 - share), 1e-12) * (1 / sizes[0] + 1 / sizes[1]))
        if toxic >= s.least and (toxic / sizes[1] - counts[0][f] / sizes[0]) / error > s.clear:
            chosen.add(f)
    terms = {zlib.crc32(("w" + w).encode()) % (1 << 20) for kind in model.terms for w in kind}
    assert set(model.features.tolist()) == chosen | terms
    weights = dict(zip(model.features.tolist(), model.weights.tolist(), strict=True))
    got = {r.doc_id: r for r in queries.op6_toxicity(spark, sf_dir).collect()}
    for i, text in texts.items():
        want = 1 / (1 + math.exp(-(model.bias + sum(weights.get(f, 0.0) for f in features(text)))))
        assert abs(got[i].score - want) < 1e-9 and got[i].predicted == (want >= 0.7) and got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_toxicity(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held = queries.toxic_held_out()
    scored = toxicity.score_toxicity(docs, labels, held).cache()
    got = scored.join(labels, "doc_id").where("not held_out").select("toxic", "predicted").toPandas()
    assert accuracy(got, "toxic", "predicted") > 0.93
    assert {r.doc_id: r.held_out for r in scored.collect()} == {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in docs.collect()}
    # labels of rows that are held out change nothing
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.score_toxicity(docs, flipped, held)
    assert [tuple(r) for r in again.select("doc_id", "score").orderBy("doc_id").collect()] == [tuple(r) for r in scored.select("doc_id", "score").orderBy("doc_id").collect()]
    none = toxicity.score_toxicity(docs_of(spark, ODD), labels.limit(0), held).collect()
    assert len(none) == len(ODD) and {r.score for r in none} == {0.5}


def test_toxicity_swaps_sentences_of_the_given_documents(spark):
    """The penalty acts on the given documents: swaps move scores less than without it, and no more clean documents are called toxic."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = queries.toxic_held_out()
    clean = [r.text for r in docs.join(labels, "doc_id").where(held).where("toxic = 0").select("text").collect()]
    moved, wrong, high = {}, {}, {}
    for weight in (0.0, 1.0):
        s = toxicity.Settings(swap_weight=weight)
        model = toxicity.fit(toxicity.labelled_sample(docs, labels, ~held, s.sample), s)
        assert model.swapped > 1000
        place = {int(f): w for f, w in zip(model.features, model.weights, strict=True)}
        known = toxicity._Known(lambda w: toxicity.word_features(w, model.bits))

        def score(text):
            return model.bias + sum(place.get(int(f), 0.0) for f in toxicity._features(text, known))

        kinds = {w: kind for kind in model.terms for w in kind}
        pairs = [(" ".join(a), " ".join(b)) for t in clean[:60] for a, b in toxicity.swapped_sentences(t, kinds)]
        moved[weight] = np.mean([(score(a) - score(b)) ** 2 for a, b in pairs])
        scores = 1 / (1 + np.exp(-np.array([score(t) for t in clean])))
        wrong[weight], high[weight] = (scores >= s.threshold).sum(), np.sort(scores)[-10:].mean()
    assert moved[1.0] < 0.2 * moved[0.0] and wrong[1.0] <= wrong[0.0] and high[1.0] < high[0.0]


def test_toxicity_does_not_learn_groups(spark):
    """Neutral mentions of a group that toxic texts name: false positives without the penalty, none with it."""
    from pyspark.sql import functions as F

    bad = [f"you women are vile{i % 3} people" for i in range(40)]
    good = [f"these men sat by the house number{i % 7}" for i in range(40)] + ["men and boys walk"] * 10
    docs = docs_of(spark, bad + good)
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(90)], "doc_id long, toxic int")
    probe = docs_of(spark, ["the women walk", "women sat by the house", "the men walk"])

    def scores(weight):
        s = toxicity.Settings(swap_weight=weight, neutral=0, threshold=0.5)
        model = toxicity.fit(toxicity.labelled_sample(docs, labels, F.lit(True), 1000), s)
        assert model.swapped == 100  # one for each term of a sentence
        known = toxicity._Known(lambda w: toxicity.word_features(w, model.bits))
        place = {int(f): w for f, w in zip(model.features, model.weights, strict=True)}
        return [model.bias + sum(place.get(int(f), 0) for f in toxicity._features(r.text, known)) for r in probe.orderBy("doc_id").collect()]

    with_, without = scores(100.0), scores(0.0)
    assert abs(with_[0] - with_[2]) < 0.3 * abs(without[0] - without[2])


def test_toxicity_samples_do_not_depend_on_layout(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    s = toxicity.Settings(sample=40, swapped=20)
    got = [sorted((r.doc_id, round(r.score, 9)) for r in toxicity.score_toxicity(docs.repartition(n), labels.repartition(n), queries.toxic_held_out(), s).collect()) for n in (1, 7)]
    assert got[0] == got[1]
    q = quality.Settings(sample=30)
    got = [sorted((r.doc_id, round(r.score, 9)) for r in quality.score_quality(docs.repartition(n), q).collect()) for n in (1, 7)]
    assert got[0] == got[1]


# --- 4


def brute_components(texts, ids):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else {tuple(w)} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return {(d, len(sets[i]), least[find(i)]) for i, d in enumerate(ids)}


@pytest.mark.parametrize("settings", [ngram_join.Jaccard(), ngram_join.Jaccard(cluster=5, tile=8, frequent=4, anchors=1, sent=50)])
def test_ngram_join(spark, settings):
    rng = np.random.default_rng(3)
    pool = [f"w{i}" for i in range(400)]
    passage = " ".join(rng.choice(pool, 60))
    texts = list(ODD)
    for _ in range(12):
        base = list(rng.choice(pool, rng.integers(30, 200)))
        texts.append(" ".join(base))
        for _ in range(int(rng.integers(1, 9))):
            copy = list(base)
            for _ in range(int(rng.integers(0, 4))):
                copy[int(rng.integers(len(copy)))] = "changed"
            texts.append(" ".join(copy) + (" " + passage if rng.random() < 0.2 else ""))
    texts += [passage + " " + " ".join(rng.choice(pool, 20)) for _ in range(15)]
    texts += ["A b C d"] * 5 + ["a B c D e"] * 2
    ids = [int(x) for x in rng.permutation(len(texts))]
    got = ngram_join.ngram_join(docs_of(spark, texts, ids).repartition(3), settings).collect()
    assert {tuple(r) for r in got} == brute_components(texts, ids) and len(got) == len(texts)


def test_ngram_join_parts():
    s, rng, linked = ngram_join.Jaccard(), np.random.default_rng(4), 0
    for size in range(1, 3000):
        starts = s.bands(size)
        assert starts[-2] <= size < starts[-1] and s.smallest(size) >= starts[max(0, len(starts) - 3)]
    for _ in range(1500):
        size = int(rng.integers(1, 600))
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        less, more = rng.integers(0, size // 6 + 2, 2)
        b = np.unique(np.r_[rng.permutation(a)[less:], rng.integers(0, 2**63, more).astype(np.uint64)])
        if len(b) and ngram_join.overlap(a, b) >= s.needed(len(a), len(b)) and not np.array_equal(a, b):
            linked += 1
            assert len(np.intersect1d(ngram_join.part_keys(a, s), ngram_join.part_keys(b, s)))
    assert linked > 500


def test_ngram_join_hot_passages(spark, monkeypatch):
    # documents of eight of 24 shared passages hardly link, but hot shingles tie them all; some have near copies, and one group is large
    rng = np.random.default_rng(5)
    passages = [" ".join(f"p{i}x{j}" for j in range(25)) for i in range(24)]
    texts = [" ".join(passages[i] for i in rng.permutation(24)[:8]) for _ in range(600)]
    texts += [f"{t} and more {i}" for i, t in enumerate(texts[:40])] + [f"{texts[0]} again {i}" for i in range(120)]
    ids = [int(x) for x in rng.permutation(len(texts))]
    met, tiled = [], ngram_join._tiled_again
    monkeypatch.setattr(ngram_join, "_tiled_again", lambda *a: met.append(tiled(*a)) or met[0])
    got = ngram_join.ngram_join(docs_of(spark, texts, ids).repartition(3), ngram_join.Jaccard(tile=64, cluster=50, frequent=4)).collect()
    assert {tuple(r) for r in got} == brute_components(texts, ids) and len(got) == len(texts)
    # what is left to compare doesn't grow together
    assert met
    sizes = collections.Counter(r.root for r in met[0].collect()).values()
    assert sorted(sizes)[-2] < 10 and max(sizes) < 200


def test_ngram_join_odd(spark):
    assert ngram_join.ngram_join(docs_of(spark, [])).count() == 0
    got = ngram_join.ngram_join(docs_of(spark, ["a b c d e f", "a b c d e f", "q r s t u"], [None, 7, 7])).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == [(-1, 7), (7, 7), (7, 7)]
    kept = ngram_join.keep_one(docs_of(spark, ["a b c d e f", "a b c d e f", "z"], [5, 3, 9]))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 9]


# --- 5


def test_html(spark):
    page = "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><a href=x>Menu</a></nav><div class='ad'>Buy</div>{}<footer>&copy; me</footer></body></html>"
    pages = [
        page.format("<article><h1>Head &amp; all</h1><p>One\n two<br>three<p><b>Bold</b> &eacute; <i>x</i></p><aside>no</aside><div id=comments><p>reader</p></div></article>"),
        page.format("<article><h1>Other</h1><ul><li>a<li>b</ul></article>"),
        None,
        "",
        "plain &lt;text&gt;",
        "<p>open <b>never closed <!-- gone",
        page.format("<article><p>" + "</p><p>".join(f"long {i}" for i in range(3000)) + "</p></article>"),
    ]
    df = spark.createDataFrame([(i, None if i == 3 else f"http://h{i % 2}.org/x{i}", p, "x") for i, p in enumerate(pages)], "page_id long, url string, html string, host string")
    for limit in (1 << 20, 0):
        got = {r.page_id: r for r in html_wrappers.extract_main_text(df, limit).collect()}
        assert got[0].text == "Head & all\n\nOne two three\n\nBold é x"
        assert got[1].text == "Other\n\na\n\nb"
        assert got[2].text == got[3].text == "" and got[2].n_chars == 0
        assert got[6].text == "\n\n".join(f"long {i}" for i in range(3000))
    alone = df.where("page_id in (4, 5)")
    assert {r.page_id: r.text for r in html_wrappers.extract_main_text(alone).collect()} == {4: "plain <text>", 5: "open never closed"}
    assert html_wrappers.extract_main_text(df.limit(0)).count() == 0


def test_html_equals_brute_force_on_all_pages(spark):
    """The given pages are of one simple kind, so regular expressions can cut out each article: all of its text and nothing else."""
    import html as entities

    pages = spark.read.parquet(f"{SF}/pages.parquet")

    def cut(page):
        inner = re.search(r"<article\b[^>]*>(.*?)</article>", page or "", re.S)
        inner = re.sub(r"<!--.*?-->", "", inner[1] if inner else "", flags=re.S)
        inner = re.sub(r"<(script|style)\b.*?</\1>", "", inner, flags=re.S)
        blocks = re.split(r"</?(?:h[1-6]|p|div|section|ul|ol|li|blockquote|pre|table|tr|td)\b[^>]*>", inner)
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br\b[^>]*>", " ", b))).split()) for b in blocks]
        return "\n\n".join(b for b in blocks if b)

    want = {r.page_id: cut(r.html) for r in pages.collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in html_wrappers.extract_main_text(pages.repartition(5)).collect()}
    assert {k: t for k, (t, _) in got.items()} == want and all(n == len(t) for t, n in got.values())


def test_html_wrappers_of_many_interleaved_hosts(spark, monkeypatch):
    """Tasks pass wrappers on whenever they hold too many hosts; the texts stay the same."""
    pages = [(i, f"http://h{i % 9}.org/{i}", f"<body><nav><a href=x>menu</a></nav><article><p>page {i}</p></article><footer>end</footer></body>") for i in range(90)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(html_wrappers, "HOSTS_HELD", 2)
    assert {r.page_id: r.text for r in html_wrappers.extract_main_text(df).collect()} == {i: f"page {i}" for i in range(90)}


def test_html_of_two_templates(spark):
    """A rarer template of a host has its own article, whatever the common one has."""
    common = [f"<body><article><p>{f'common text {i} ' * 60}</p></article></body>" for i in range(6)]
    rare = ["<body><div class=content><p>rare text</p></div><footer>f</footer></body>", "<body><p>no container</p></body>", "<body><main></main><div class=content><p>beside</p></div></body>"]
    df = spark.createDataFrame([(i, f"http://h.org/{i}", p) for i, p in enumerate([*common, *rare])], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_wrappers.extract_main_text(df).collect()}
    assert [got[i] for i in (6, 7, 8)] == ["rare text", "no container", "beside"]
    assert all(got[i] == f"common text {i} " * 59 + f"common text {i}" for i in range(6))


def test_html_keeps_what_an_article_holds(spark):
    links = "".join(f"<li><a href=x>source {i}</a></li>" for i in range(5))
    kept = f"<h2 id='related-work'>Related work</h2><p id=notice-of-appeal>Appeal</p><ul>{links}</ul><figure><figcaption>Caption</figcaption></figure><p>where <math><mi>x</mi></math> and <svg/>y <math/>z</p>"
    many = "".join(f"<h{i % 3 + 2}>t{i}</h{i % 3 + 2}><p>u{i}</p><ul><li><a href=x>l{i}</a></li></ul><blockquote>q{i}</blockquote><{'dl' if i % 7 else 'pre'}>d</{'dl' if i % 7 else 'pre'}>" for i in range(40))
    pages = [f"<body><article>{kept}<div class='share'>no</div><p hidden>no</p></article></body>", f"<body><article>{many}</article></body>"]
    for host in ("h", "h{}"):
        df = spark.createDataFrame([(i, f"http://{host.format(i)}.org/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
        got = {r.page_id: r.text for r in html_wrappers.extract_main_text(df).collect()}
        assert got[0].split("\n\n") == ["Related work", "Appeal", *(f"source {i}" for i in range(5)), "Caption", "where x and y z"]
        assert got[1].split("\n\n") == [w for i in range(40) for w in (f"t{i}", f"u{i}", f"l{i}", f"q{i}", "d")]


def texts_of(spark, pages, host="h.org"):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return [r.text for r in html_wrappers.extract_main_text(df).orderBy("page_id").collect()]


@pytest.mark.parametrize("levels", [800, 100_000])
def test_html_of_any_depth(spark, levels):
    pages = ["<div>" * levels + "deep" + "</div>" * levels, "<font>" * levels + "open", "<p>a</p>" + "<i>" * levels + "<article>b<nav>no</nav></article>", "<ul><li>" * (levels // 10) + "x", "<article><p>plain</p></article>"]
    assert texts_of(spark, pages) == ["deep", "open", "b", "\n\n".join(["x"]), "plain"]
    assert texts_of(spark, pages[:1] * 2) == ["deep", "deep"]


def test_html_names_drop_only_what_they_say_alone(spark):
    inside = '<div class="related study">one</div><div class="social history">two</div><h2 id="notice-of-appeal">three</h2><section id="share-prices">four</section>'
    outside = '<div class="comments">a</div><div class="comment-list">b</div><div id="ad-300">c</div><ul class="share box">d</ul>'
    assert texts_of(spark, [f"<article>zero{inside}{outside}</article>"]) == ["zero\n\none\n\ntwo\n\nthree\n\nfour"]


def test_html_keeps_all_candidates(spark):
    long, short = "word " * 400, "<div class=story>short</div>"
    assert texts_of(spark, [f"<article>{long}</article><article>little</article>{short}<div class=sidebar><div class=post>no</div></div>"]) == [f"{long.strip()}\n\nlittle\n\nshort"]
    assert texts_of(spark, ["<div class=content><div>bar</div><article>a</article></div>", "<main>x<article>b</article></main>", "<article>c<div class=content>d</div></article>"]) == ["a", "b", "c\n\nd"]


def test_html_template_texts_go(spark):
    """The same texts on all pages of a host are its template's, though they stand in elements like those of the article, and however many."""
    page = lambda i, n: f"<div>Home About</div><div><div>Menu of all</div><div>text {i}</div></div>" + "".join(f"<div>par {i} {k}</div>" for k in range(n)) + "<div>All rights reserved</div>"
    want = lambda i, n: "\n\n".join([f"text {i}", *(f"par {i} {k}" for k in range(n))])
    assert texts_of(spark, [page(i, i % 60) for i in range(200)]) == [want(i, i % 60) for i in range(200)]
    assert texts_of(spark, ["<div>a</div><div>b</div>"] * 5) == ["a\n\nb"] * 5  # copies have nothing else
    assert texts_of(spark, ["<article><h2>Summary</h2>a</article>", "<article><h2>Summary</h2>b</article>", "<article><h2>Summary</h2>c</article>"])[2] == "Summary\n\nc"


def test_wrappers_have_groups_and_slots():
    a, b = (html_wrappers.wrapper_of(html_wrappers.tree(p)) for p in ("<ul><li>x</li><li>y</li></ul><p>same</p>", "<ul><li>z</li></ul><p>same</p><hr>"))
    h = lambda text: f"'{html_wrappers.text_hash([text])}'"
    assert html_wrappers.expression(html_wrappers.merge(a, b)) == f"< <ul <li #>+> <p {h('same')}> <hr>?>"
    c = html_wrappers.wrapper_of(html_wrappers.tree("<dl>" + "<dt>a</dt><dd>b</dd>" * 4 + "</dl>"))
    assert html_wrappers.expression(c) == f"< <dl (<dt {h('a')}> <dd {h('b')}>)+>>"


# --- 7


def test_brown_lm(spark, sf_dir):
    from pyspark.sql import functions as F

    texts = [*ODD, *(r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).collect())]
    small = brown_lm.Settings(clustered=50, sent=100, classes=6, rounds=2, block=4)
    got = {r.doc_id: r for r in brown_lm.score_texts(docs_of(spark, texts), F.col("doc_id") % 7 != 2, small).collect()}
    counts = collections.Counter()
    for i, t in enumerate(texts):
        if i % 7 != 2:
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in enumerate(texts):
        tokens = [*words(t), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i % 7 == 2, len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, -base) and r.score < 0
    assert brown_lm.score_texts(docs_of(spark, []), F.lit(True), small).count() == 0
    assert brown_lm.score_texts(docs_of(spark, ["a b", None], [None, None]), F.lit(True), small).count() == 2


def test_brown_scores_equal_brute_force(spark, sf_dir):
    """Scores are sums of P(class after class) P(word in class) from plain counts, whatever the partitions; both distributions sum to one."""
    from pyspark.sql import functions as F

    texts = [*ODD, *(r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(50).collect())]
    texts.append(" ".join(f"once{i} twice{i % 40}" for i in range(90)) + " " + " ".join(f"new{i}" for i in range(3)))
    s = brown_lm.Settings(clustered=60, sent=200, classes=6, looks=5, rounds=3, context=10, block=8)
    docs = docs_of(spark, texts)
    runs = [{r.doc_id: r.score for r in brown_lm.score_texts(docs.repartition(n), F.col("doc_id") % 7 != 2, s).collect()} for n in (1, 4, 16)]
    learned = brown_lm.learn(docs.select("doc_id", "text", (F.col("doc_id") % 7 != 2).alias("learn")), s)
    model = learned.model
    of_word = dict(zip(model.vocabulary, model.classes.tolist(), strict=True))
    rare = {bytes(r.word): (r.n, r.to) for r in learned.placed.collect()}
    assert not set(rare) & set(of_word)
    of_word |= {w: to for w, (_, to) in rare.items()}
    total = s.classes + s.looks

    def tokens(t):
        return [*(w.encode() for w in words(t)), brown_lm.END]

    def class_of(w):
        return of_word[w] if w in of_word else s.classes + brown_lm.looks(w, s.looks)

    n, moves = collections.Counter(), collections.Counter()
    for i, t in enumerate(texts):
        if i % 7 != 2:
            n.update(tokens(t))
            c = [class_of(w) for w in [brown_lm.END, *tokens(t)]]
            moves.update(zip(c, c[1:], strict=False))
    in_class, distinct, after, kinds = (collections.Counter() for _ in range(4))
    for w, k in n.items():
        in_class[class_of(w)] += k
        distinct[class_of(w)] += 1
    for (x, _), k in moves.items():
        after[x] += k
        kinds[x] += 1

    def move(x, y):
        alone = (in_class[y] + 1) / (sum(n.values()) + total)
        return (moves[x, y] + kinds[x] * alone) / (after[x] + kinds[x]) if after[x] else alone

    def emit(w):
        c = class_of(w)
        off = s.discount if c >= s.classes else 0
        return (n[w] - off) / in_class[c] if n[w] else (s.discount * distinct[c] / in_class[c] if in_class[c] else 1.0)

    for x in range(total):
        assert abs(sum(move(x, y) for y in range(total)) - 1) < 1e-9
    for c in range(total):
        mass = sum(emit(w) for w in n if class_of(w) == c) + (emit(b"never seen") if c >= s.classes and class_of(b"never seen") == c else s.discount * distinct[c] / in_class[c] if c >= s.classes and in_class[c] else 0)
        assert abs(mass - 1) < 1e-9 or not in_class[c]
    # words used twice or more have a class by use, however rare; the others by looks
    assert set(of_word) == set(n) and all((of_word[w] < s.classes) == (k > 1) for w, k in n.items()) and all(k == n[w] for w, (k, _) in rare.items())
    assert sum(k > 1 for k, _ in rare.values()) > 20 and sum(k == 1 for k, _ in rare.values()) > 20
    for i, t in enumerate(texts):
        line = [brown_lm.END, *tokens(t)]
        want = sum(math.log10(move(class_of(x), class_of(y)) * emit(y)) for x, y in zip(line, line[1:], strict=False))
        for run in runs:
            assert abs(run[i] - want) < 1e-8 * max(1, -want)


def test_exchange_groups_words_by_use():
    """Words that share neighbours end in one class; so do words placed by their neighbours."""
    square = np.zeros((10, 10), np.int64)
    square[:4, 4:8] = square[4:8, :4] = 50
    s = brown_lm.Settings(clustered=8, classes=2, looks=2, rounds=6)
    classes = brown_lm.exchange(square, 8, s)
    assert len(set(classes[:4])) == 1 and len(set(classes[4:8])) == 1 and classes[0] != classes[4] and list(classes[8:]) == [2, 3]
    logs = brown_lm.neighbour_logs(square, classes, 8, s)
    around = np.zeros((1, len(logs)), np.int64)
    around[0, 4] = around[0, 9 + 5] = 3  # words of the second group before and after it: it is used like the first
    assert np.argmax(around @ logs) == classes[0]


def test_rare_words_are_placed_by_all_their_neighbours():
    """The class in which a word's contexts are likeliest, however its rows are cut into batches; one use alone: by looks."""
    rng = np.random.default_rng(4)
    s = brown_lm.Settings(classes=5, looks=4)
    logs = rng.integers(-(10**7), 0, (2 * 7, 5))
    uses = sorted((f"w{rng.integers(30)}".encode(), int(rng.integers(-1, 12)), int(rng.integers(-1, 12))) for _ in range(80))
    want = {}
    for w in {u[0] for u in uses}:
        mine = [u for u in uses if u[0] == w]
        at = [[6 if x < 0 or x > 6 else x for x in u[1:]] for u in mine]
        want[w] = (len(mine), int(np.argmax(sum(logs[b] + logs[7 + a] for b, a in at))) if len(mine) > 1 else 5 + len(w) % 4)
    assert {n for n, _ in want.values()} > {1, 2}
    for step in (1, 3, 80):
        batches = [
            pa.record_batch([pa.array([u[0] for u in part], pa.binary()), *(pa.array(x, pa.int32()) for x in ([len(u[0]) % 4 for u in part], [u[1] for u in part], [u[2] for u in part]))], ["word", "look", "before", "after"])
            for part in (uses[k : k + step] for k in range(0, 80, step))
        ]
        got = [r for b in brown_lm._place_rare(types.SimpleNamespace(value=logs), 6, s)(iter(batches)) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert len(got) == len(want) and {w: (n, to) for w, n, to in got} == want


# --- 8


def test_mixing(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf_dir}/documents.parquet')")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for mixture in (mixing.PRODUCTION, mixing.Mixture(budget_permille=300, max_epochs=1), mixing.Mixture(budget_permille=9000, max_epochs=2, source_weights={"src1": 500})):
        got = sorted(tuple(r) for r in mixing.mix(docs, mixture).select("doc_id", "domain", "n_tokens", "epoch").collect())
        assert got == sorted(con.execute(f"select doc_id, domain, n_tokens, epoch from ({mixing.oracle(mixture)})").fetchall())


def test_mixing_odd(spark):
    rows = [(i, t, None if i % 3 else "en", None if i % 4 == 0 else f"src{i % 2}", "x") for i, t in enumerate(ODD)]
    df = spark.createDataFrame([*rows, rows[5], (None, "a b c", "de", "src7", "x")], "doc_id long, text string, lang string, source string, mix_lang string")
    got = mixing.mix(df, mixing.Mixture(max_epochs=3, budget_permille=2000))
    assert got.columns == ["doc_id", "text", "lang", "source", "mix_lang", "domain", "n_tokens", "epoch"] and {r.mix_lang for r in got.collect()} == {"x"}
    total = sum(r.n_tokens for r in got.collect())
    assert 0 < total <= 2 * sum(len(words(r.text)) for r in df.collect())
    assert mixing.mix(df.limit(0)).count() == 0


# --- 9


def test_mpeg_round_trip(spark):
    media = mpeg.store_audio(docs_of(spark, ODD)).cache()
    for r, text in zip(mpeg.audio_digests(media).orderBy("doc_id").collect(), ODD, strict=True):
        data = (text or "").encode()
        payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    read = mpeg.read_audio(media).orderBy("doc_id").collect()
    assert all(r.crc_bad == 0 and r.lost_bytes == 0 and r.frames == len(r.frame_offsets) == r.table_frames and r.seconds == r.samples / 32000 for r in read)
    assert mpeg.read_audio(spark.createDataFrame([(1, None), (2, b"none")], "doc_id long, media binary")).where("frames = 0").count() == 2


def test_mpeg_damage_and_tags():
    whole = mpeg.store(bytes(range(1, 200)) * 40)
    first = mpeg.parse(whole)
    cut = first.offsets[1]
    hurt = whole[:cut] + b"\xff\xfbnoise" * 3 + whole[cut:] + b"TAG" + b"Title".ljust(30, b"\0") + bytes(95)
    again = mpeg.parse(hurt)
    assert again.lost_bytes == 21 and again.samples == first.samples and again.tags["title"] == "Title"
    broken = bytearray(whole)
    broken[first.offsets[0] + 7] ^= 1
    assert mpeg.parse(bytes(broken)).crc_bad == 1
    assert mpeg.header(bytes([0xFF, 0xFB, 0x90, 0x00])).length == 417 and mpeg.header(b"\xff\xff\xff\xff") is None


def plain_crc(bits):
    """The checksum, bit by bit over a text of 0 and 1."""
    value = 0xFFFF
    for b in bits:
        top = value >> 15 ^ int(b)
        value = value << 1 & 0xFFFF
        if top:
            value ^= 0x8005
    return value


def layer_frame(four, allocation, more):
    """A frame of that header with this allocation and two bits for each that has any, zeros behind and the right checksum."""
    h = mpeg.header(four)
    covered = allocation + more
    crc = plain_crc("".join(f"{b:08b}" for b in four[2:]) + covered)
    body = covered + "0" * (-len(covered) % 8)
    frame = four + crc.to_bytes(2, "big") + int(body, 2).to_bytes(len(body) // 8, "big")
    return frame + bytes(h.length - len(frame)), len(covered)


@pytest.mark.parametrize(
    "four, widths, apart",
    [
        (b"\xff\xfe\x90\xc0", [4] * 32, [1] * 32),  # Layer I, one channel
        (b"\xff\xfe\x90\x00", [4] * 32, [2] * 32),  # two
        (b"\xff\xfe\x90\x50", [4] * 32, [2] * 8 + [1] * 24),  # joint from the eighth subband on
        (b"\xff\xfc\xa0\x00", [4] * 11 + [3] * 12 + [2] * 7, [2] * 30),  # Layer II, 192 kbit/s, 44.1 kHz
        (b"\xff\xfc\xa4\x40", [4] * 11 + [3] * 12 + [2] * 4, [2] * 4 + [1] * 23),  # 48 kHz, joint
        (b"\xff\xfc\x18\xc0", [4] * 2 + [3] * 10, [1] * 12),  # 32 kbit/s, 32 kHz, one channel
        (b"\xff\xf4\x80\xc0", [4] * 4 + [3] * 7 + [2] * 19, [1] * 30),  # MPEG-2
    ],
)
def test_mpeg_checksums_of_all_layers(four, widths, apart):
    rng = np.random.default_rng(3)
    channels = 1 if four[3] >> 6 == 3 else 2
    allocation, more = "", ""
    for width, n in zip(widths, apart, strict=True):
        for _ in range(n):
            value = int(rng.integers(0, 1 << width))
            allocation += f"{value:0{width}b}"
            more += "10" * (channels // n) if value and four[1] & 6 == 4 else ""
    frame, covered = layer_frame(four, allocation, more)
    assert mpeg.protected_bits(frame, mpeg.header(four)) == covered
    whole = mpeg.parse(frame * 5)
    assert (whole.frames, whole.crc_checked, whole.crc_bad, whole.lost_bytes) == (5, 5, 0, 0)
    hurt = bytearray(frame * 5)
    hurt[len(frame) + 6] ^= 0x80
    assert mpeg.parse(bytes(hurt)).crc_bad == 1


def test_mpeg_tags_behind_extended_headers():
    size = lambda n: bytes([n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127])
    three = b"TIT2" + (4).to_bytes(4, "big") + b"\0\0\0abc"
    four = b"TIT2" + size(4) + b"\0\0\0abc" + b"TPE1" + size(5) + b"\0\2\0x\xff\0y"
    plain = mpeg.store(b"x" * 64)
    for major, flags, body in ((3, 0x40, (6).to_bytes(4, "big") + bytes(6) + three), (4, 0x40, size(6) + b"\1\0" + four), (3, 0x80, three.replace(b"abc", b"a\xff\0c").replace(b"\0\0\0\4", b"\0\0\0\4"))):
        audio = mpeg.parse(b"ID3" + bytes([major, 0, flags]) + size(len(body)) + body + plain)
        assert audio.tags["TIT2"] == ("a\xffc" if flags == 0x80 else "abc") and audio.frames == 1 and audio.lost_bytes == 0
        assert audio.tags.get("TPE1") == ("x\xffy" if major == 4 else None)


def test_mpeg_round_trip_of_documents(spark, sf_dir):
    """Every document: its payload, the digests of what is stored, and the features, from the stored bytes alone."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    media = {r.doc_id: bytes(r.media) for r in mpeg.store_audio(docs).collect()}
    for r in queries.op9_mpeg(spark, sf_dir).collect():
        data = (texts[r.doc_id] or "").encode()
        payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        stored = media[r.doc_id]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(stored), hashlib.sha256(stored).hexdigest())
        room = max(mpeg._LENGTHS.values()) - mpeg._AROUND
        frames = -(-len(payload) // room)
        assert f"layer 3, 32000 Hz, 1 channel, frames {frames}, samples {1152 * frames}, table Xing whole, crc {frames + 1}/{frames + 1}, lost 0" in r.feature


# --- 10


def test_chat(spark):
    probe = "</s>[INST] ok [/INST]"
    turns = [(1, 0, "system", "be \\ kind"), (1, 1, "user", probe), (1, 2, "assistant", probe + "\\"), (2, 0, "user", None), (2, 1, "user", "x"), (3, 0, None, "no role"), (3, None, "assistant", "<<SYS>>"), (4, 0, "tool[ROLE]", "t"), (4, 1, "assistant", "🙂" * 5000), (None, 0, "user", "u")]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, loss string")
    segments = chat.chat_segments(df)
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    for conv in {t[0] for t in turns}:
        mine = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0))
        r = got[conv]
        learned = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, 4: False, None: False}
    inside = [r.segment for r in segments.collect() if r.segment.strip() and not any(c in r.segment and r.segment.strip().startswith(("<s>", "[", "<<", "<</", "</s>")) for c in chat.INSTRUCT.controls)]
    assert not any(c in x for x in inside for c in chat.INSTRUCT.controls)
    assert chat.read_back(chat.chat_segments(df.limit(0))).count() == 0


# --- queries with SQL


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    expected = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    got = queries.queries()[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, expected.fetchall()))


def test_chat_sql_on_odd_turns(spark, tmp_path):
    turns = [(1, 0, "system", "be \\ kind"), (1, 1, "user", "</s>[INST]<<SYS>>\\\\"), (1, 2, "assistant", "x[/OUT]"), (2, 0, "user", None), (3, 0, None, "no role"), (3, None, "assistant", "<<SYS>>"), (4, 0, "tool[ROLE]", "t"), (4, 1, "assistant", "🙂"), (4, 1, "assistant", "🙂"), (None, 0, "user", "u")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "t"))
    expected = duckdb.connect().execute(chat.oracle(turns=f"read_parquet('{tmp_path}/t/*.parquet')"))
    columns = [c[0] for c in expected.description]
    assert sorted(map(repr, map(tuple, chat.read_back(chat.chat_segments(df)).select(*columns).collect()))) == sorted(map(repr, expected.fetchall()))


def test_long_words_are_not_remembered():
    """Texts without blanks don't fill the memories of words."""
    vocabulary = bpe.vocabulary_of(VOCABULARY)
    chunks = bpe.chunk_encoder(vocabulary)
    known, hashes, shapes, codes = toxicity._Known(lambda w: (len(w),)), common.WordHashes(), quality._Shapes(10), brown_lm.Codes([b"a"], 4, 10)
    for i in range(20):
        word = "xyz" * 1000 + str(i)
        assert np.frombuffer(bpe.encode(f"a {word} b", chunks), "<u4").size > 100
        assert known[word] == (len(word),) and hashes[word.encode()] and shapes[word] >= 0 and codes[word.encode()] >= 1
    held = [*chunks, *chunks.old, *known, *hashes, *shapes, *codes]
    assert max(map(len, held)) <= common.HELD_LENGTH


def test_batches_are_cut_by_bytes():
    batch = pa.record_batch([pa.array([1, 2, 3, 4, 5]), pa.array(["x" * 10, None, "y" * 1000, "z", ""])], ["i", "t"])
    sizes = lambda found: [b.column(0).to_pylist() for b in found]
    assert sizes(common.rows([batch], 2)) == [[1, 2], [3, 4], [5]]
    assert sizes(common.rows([batch], 9, 20)) == [[1, 2], [3], [4, 5]]
    assert sizes(common.by_bytes([batch.slice(1)], 1, 5)) == [[2], [3], [4, 5]]
    assert sizes(common.rows([batch.slice(0, 0)], 9)) == []
