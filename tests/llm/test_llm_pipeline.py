"""The pipeline's stages against plain versions over the same rows."""

from hashlib import sha256

import numpy as np
import pytest
from test_llm_simhash import plain_components, plain_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline
from tapeworks.llm import mixing, quality, toxicity
from tapeworks.llm.queries import WORD_BPE, llm_queries, quality_model, toxicity_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf(sf_dir):
    return sf_dir


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def rows(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


def test_stages_are_those_asked_for(spark, documents, sf):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near-duplicates", "mix", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, documents.limit(0), sf)
        assert empty.count() == 0
        assert name == "tokens" or empty.columns == documents.columns


def test_rejections_take_effect(spark, documents, sf):
    texts = documents.collect()
    trees = quality_model(spark, sf)
    scores = trees.scores(np.array([quality.statistics(r["text"]) for r in texts]))
    wanted = [tuple(r) for r, s in zip(texts, scores) if s >= 0.3]
    assert rows(corpus_pipeline.good(spark, documents, sf)) == sorted(wanted, key=str)
    model = toxicity_model(spark, sf)
    matcher = toxicity.Matcher(tuple(model.weights), tuple(model.exceptions))
    p = model.probability(np.array([toxicity.numbers(*matcher.found(r["text"] or ""), model.weights) for r in texts]))
    assert rows(corpus_pipeline.harmless(spark, documents, sf)) == sorted((tuple(r) for r, x in zip(texts, p) if x < 0.5), key=str)


def test_one_of_each_group_and_the_mix(spark, documents, sf):
    texts = {r["doc_id"]: r for r in documents.collect()}
    prints = {i: plain_fingerprint(r["text"]) for i, r in texts.items()}
    group = plain_components(set(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    kept = corpus_pipeline.distinct(spark, documents, sf)
    assert rows(kept) == sorted((tuple(r) for i, r in texts.items() if group[i] == i), key=str)
    kept = spark.createDataFrame(kept.collect(), kept.schema)
    copies = {r["doc_id"]: r["copies"] for r in mixing.taken_words(mixing.mix(kept)).collect()}
    mixed = corpus_pipeline.mixed(spark, kept, sf)
    assert rows(mixed) == sorted((tuple(texts[i]) for i, n in copies.items() for _ in range(n)), key=str)


def test_the_whole_run(spark, documents, sf):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    library = Tokenizer.from_file(WORD_BPE)
    found = corpus_pipeline.run(spark, sf).collect()
    assert 0 < len(found)
    for r in found:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in llm_queries()) == list(range(1, 14))


def test_odd_rows_and_clashing_columns_pass_through(spark, sf):
    good = "The quick words of a text that is long enough to be one of many words in a row, and then some more."
    odd = [(1, good, "en", "a", 1, 9.0, "f", 3, "x"), (None, good + " b", None, None, None, None, None, None, None),
           (2, None, "en", "a", 0, 1.0, "g", 4, "y"), (3, "", "en", None, 0, 1.0, "g", 4, "y"),
           (1, good, "en", "a", 1, 9.0, "f", 3, "x"), (4, good * 3000, "en", "b", 1, 9.0, "f", 3, "x")]
    docs = spark.createDataFrame(
        odd, "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, size int, rows string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert set(out.collect()) <= set(docs.collect())
    assert corpus_pipeline.distinct(spark, docs, sf).count() == 4
    assert corpus_pipeline.tokens(spark, docs, sf).count() == len(odd)
