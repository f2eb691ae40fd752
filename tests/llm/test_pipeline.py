"""The pipeline's stages on the smallest tables, each held against brute force on its own input."""

import re

import corpus_pipeline
import numpy as np
from terrier.llm import bpe, mixing, queries


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near duplicates", "mixture", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        docs = stage(spark, docs, sf_dir).cache()
        after = docs.toPandas()
        if name != "tokens":
            assert list(after.columns) == list(before.columns) and set(after.doc_id) <= set(before.doc_id) and len(after) == after.doc_id.nunique()
        if name == "near duplicates":
            text = lambda d: {" ".join(re.findall(r"[^\x20\x09-\x0D]+", t.lower())) for t in d.text}
            assert text(after) <= text(before) and len(text(after)) == len(after)
        if name == "mixture":
            count = lambda d: sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in d.text)
            # short of four fifths by less than a document, and what shares of whole tokens cut off
            longest = max(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in before.text)
            assert 0.8 * count(before) - longest < count(after) <= 0.8 * count(before)
        if name == "tokens":
            library = bpe.Vocabulary(f"{queries.TOKENIZERS}/byte_bpe_50k.json")
            texts = dict(zip(before.doc_id, before.text, strict=True))
            for doc_id, ids in zip(after.doc_id, after.token_ids, strict=True):
                assert library.decode(np.asarray(ids, np.int64)).decode() == texts[doc_id]
    assert mixing.PRODUCTION.max_epochs == 4


def test_near_duplicates_equal_brute_force(spark, sf_dir):
    """The stage links at five words and 0.8, also what four words and 0.85 don't link."""
    rng = np.random.default_rng(11)
    pool, texts = [f"w{i}" for i in range(3000)], []
    for size in range(45, 62):
        base = list(rng.choice(pool, size, replace=False))
        changed = [*base[: size // 2], "other", *base[size // 2 + 1 :]]
        texts += [" ".join(base), " ".join(changed)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert kept_by_brute_force(texts, 5, 80) < kept_by_brute_force(texts, 4, 85)
    for some in (docs, spark.read.parquet(f"{sf_dir}/documents.parquet")):
        held = some.orderBy("doc_id").select("doc_id", "text").collect()
        left = corpus_pipeline.one_of_each(spark, some, sf_dir).collect()
        assert {r.doc_id for r in left} == {held[i].doc_id for i in kept_by_brute_force([r.text for r in held], 5, 80)}


def kept_by_brute_force(texts, n, part):
    """Places of the first text of each component; texts are in the order of their ids."""
    cut = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    sets = [{tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set() for w in cut]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= part * len(sets[i] | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return {i for i, r in enumerate(root) if i == r}


CLASHES = ["mix_note", "Score", "score", "kept", "predicted", "held_out", "domain", "n_tokens", "epoch", "c0", "key", "size", "class", "root", "node"]


def test_run_on_odd_rows(spark, sf_dir, tmp_path):
    """run() and its stages on nulls, empty and very long texts, repeated rows, an empty table and columns with clashing names."""
    given = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in given]
    rows += [rows[0], rows[1], (None, "no id here", None, None, None), (900_001, None, "en", "src1", None), (900_002, "", None, "src1", 0), (900_003, "word " * 60_000, "en", None, None)]
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        clashing = spark.createDataFrame([(*r, *(f"{c}{i}" for c in CLASHES)) for i, r in enumerate(rows)], kinds + "".join(f", `{c}` string" for c in CLASHES))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    for docs in (clashing, clashing.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:4]:
            after = stage(spark, docs, sf_dir)
            assert after.columns == docs.columns, name
            assert set(after.collect()) <= set(docs.collect()), name
            assert docs.isEmpty() == after.isEmpty(), (name, after.count())
        assert corpus_pipeline.tokens(spark, docs, sf_dir).count() == docs.count()
    for some, n in ((spark.createDataFrame(rows, kinds), len(rows)), (spark.createDataFrame([], kinds), 0)):
        folder = tmp_path / f"n{n}"
        some.write.parquet(str(folder / "documents.parquet"))
        spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(str(folder / "labels.parquet"))
        out = corpus_pipeline.run(spark, str(folder))
        assert out.columns == ["doc_id", "token_ids", "n_tokens"]
        got = out.collect()
        assert all(r.n_tokens == len(r.token_ids) for r in got) and (0 < len(got) < n if n else not got)
        by_stage = spark.read.parquet(str(folder / "documents.parquet"))
        for _, stage in corpus_pipeline.STAGES:
            by_stage = stage(spark, by_stage, str(folder))
        assert sorted(map(repr, by_stage.collect())) == sorted(map(repr, got))
