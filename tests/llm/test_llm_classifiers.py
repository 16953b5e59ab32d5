"""The quality classifier and the toxicity lexicon: parts by hand, accuracy on held-out rows."""

import zlib

import numpy as np
import pytest

from tapeworks.llm import labelled, quality, toxicity


def plain_tree_scores(model, x):
    """Row by row and tree by tree, for the flat arrays' traversal."""
    out = []
    for row in x:
        total = model.start
        for at in model.roots:
            while model.left[at] != at:
                at = model.left[at] if row[model.feature[at]] <= model.threshold[at] else model.right[at]
            total += model.value[at]
        out.append(1 / (1 + np.exp(-total)))
    return out


def test_trees_learn_an_interaction():
    random = np.random.default_rng(0)
    x = random.uniform(size=(2000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    model = quality.fit(x[:1500], y[:1500])
    scores = model.scores(x[1500:])
    assert np.mean((scores > 0.5) == y[1500:]) > 0.95
    assert np.allclose(scores, plain_tree_scores(model, x[1500:]))


@pytest.mark.parametrize("y", [[], [1, 1, 1], [0, 0]])
def test_trees_without_two_labels(y):
    model = quality.fit(np.zeros((len(y), 3)), np.array(y, dtype=float))
    assert np.all((0 < model.scores(np.ones((2, 3)))) & (model.scores(np.ones((2, 3))) < 1))
    assert model.scores(np.empty((0, 3))).shape == (0,)


def test_statistics_of_odd_texts():
    for text in (None, "", " ", "\n\n", "a", "é" * 9, "word " * 200_000):
        numbers = quality.statistics(text)
        assert len(numbers) == len(quality.STATISTICS)
        assert np.isfinite(numbers).all()
    assert quality.statistics(None) == quality.statistics("")


@pytest.mark.parametrize("hidden", ["IDIOT", "1d10t", "іdіоt", "ＩＤＩＯＴ", "i​diot", "ïdïöt", "!diot", "idiot!!", "«idiot»"])
def test_folding(hidden):
    matcher = toxicity.Matcher(["idiot"], [])
    assert matcher.found(f"such an {hidden} here")[0] == ["idiot"]


def test_matching():
    matcher = toxicity.Matcher(["trash", "clown", "vequ*", "vequa*"], ["trash can"])
    assert matcher.found("the trash can, not trash; trash")[0] == ["trash", "trash"]
    assert matcher.found("trashy clowns backtrash")[0] == []
    assert sorted(matcher.found("vequilla Vequando")[0]) == ["vequ*", "vequa*"]
    assert matcher.found("") == ([], 0)
    assert matcher.found("clown clown clown") == (["clown"] * 3, 3)


def test_length_counts():
    model = toxicity.Model()
    short, long = (toxicity.numbers(["idiot"], n, model.weights) for n in (10, 10_000))
    assert model.probability(np.array([short]))[0] > model.probability(np.array([long]))[0]


ROWS = [(1, "a good text of some words", 5), (2, None, 5), (3, "", 5), (None, "idiot " * 50_000, 5), (1, "a good text of some words", 5)]


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, score int")
    trees = quality.fit(np.random.default_rng(1).uniform(size=(200, len(quality.STATISTICS))), np.arange(200) % 2.0)
    for scored in (quality.score(docs, trees), toxicity.score(docs, toxicity.Model())):
        found = scored.collect()
        assert scored.columns == ["doc_id", "text", "score"] and len(found) == len(ROWS)
        assert all(0 <= r["score"] <= 1 for r in found)
        by_text = {}
        for r in found:
            by_text.setdefault(r["text"] or "", set()).add(r["score"])
        assert all(len(scores) == 1 for scores in by_text.values())
    assert quality.judged(docs.limit(0), trees).count() == 0
    held = {r["doc_id"]: r["held_out"] for r in toxicity.judged(docs, toxicity.Model()).collect()}
    assert held == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in (1, 2, 3)} | {None: True}


def test_training_rows_are_bounded_and_not_held_out(spark):
    docs = spark.createDataFrame([(i, "t", 9) for i in range(100)] + [(None, "t", 9)], "doc_id long, text string, target int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(1, 0), (None, 1), (85, None), (86, 7)], "doc_id long, quality int")
    found = labelled.training_rows(docs, labels, "quality", 20).collect()
    assert len(found) == 20
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["target"] == r["doc_id"] % 2 for r in found)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, "you idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    trees, model = quality.train(docs, labels), toxicity.train(docs, labels)
    assert quality.judged(docs, trees).count() == 2
    scores = {r[0]: r["score"] for r in toxicity.judged(docs, model).collect()}
    assert scores[2] > 0.5 > scores[1]


def test_learned_terms(spark):
    clean = [(f"alpha beta gamma{i} delta", 0) for i in range(60)]
    toxic = [(f"alpha zorple{chr(97 + i)} gamma{i} snarfed beta{i}", 1) for i in range(20)]
    sample = spark.createDataFrame(clean + toxic, "text string, target int")
    assert set(toxicity.learned_terms(sample)) == {toxicity.folded("snarfed"), toxicity.folded("zorpl") + "*"}


@pytest.mark.parametrize("name, label, wanted", [("op1_quality", "quality", 0.93), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(name, label, wanted, spark):
    from tapeworks.llm.queries import llm_queries

    sf_dir = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    found = llm_queries()[name](spark, sf_dir).collect()
    assert len(found) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    held = [r for r in found if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in held]) >= wanted


def test_commonest_word_is_over_the_whole_text():
    at = quality.STATISTICS.index("commonest_word")
    words = [f"w{i}" if i % 10 else "spam" for i in range(1, 1001)]
    for shift in range(10):
        assert quality.statistics(" ".join(words[shift:] + words[:shift]))[at] == 0.1


def plain_found(text, terms, exceptions):
    """Every term and exception looked for at every place."""
    padded = f" {' '.join(toxicity.folded(text).split())} "

    def places(phrase):
        key = " ".join(toxicity.folded(phrase.rstrip("*")).split())
        pattern = f" {key}" if phrase.endswith("*") else f" {key} "
        return [(a, a + len(pattern) - 1) for a in range(len(padded)) if padded.startswith(pattern, a)]

    excused = [p for e in exceptions for p in places(e)]
    longest = {}
    for term in terms:
        for a, end in places(term):
            if a not in longest or longest[a][0] < end:
                longest[a] = (end, term)
    return [t for a, (end, t) in sorted(longest.items()) if not any(x <= a and end <= y for x, y in excused)]


def test_terms_against_a_plain_search():
    import random

    rng = random.Random(6)
    terms, exceptions = ["trash", "stupid", "idio*", "rat", "rat race", "pig*"], ["trash can", "the stupid trash can", "rat race", "guinea pig"]
    matcher = toxicity.Matcher(terms, exceptions)
    words = ["trash", "can", "stupid", "the", "idiot", "1d10t", "rat", "race", "guinea", "pig", "pigs", "ok", "STUP1D"]
    for _ in range(400):
        text = " ".join(rng.choices(words, k=rng.randint(0, 14)))
        assert sorted(matcher.found(text)[0]) == sorted(plain_found(text, terms, exceptions))


def test_many_exceptions_in_time():
    import time

    matcher = toxicity.Matcher(["trash", "stupid"], ["trash can"])
    start = time.perf_counter()
    assert matcher.found("trash can stupid " * 50_000)[0] == ["stupid"] * 50_000
    assert time.perf_counter() - start < 2
