"""Targets, budgets and choices of the mix."""

import random
import re
from itertools import product

import pytest

from tapeworks.llm import mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """sizes by source, sources in order; shares anew until nothing is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full, target = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / open_weight if open_weight else 0 for s in names}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def test_fitted_meets_what_can_be_met():
    random.seed(4)
    for _ in range(300):
        sizes = random.sample(range(0, 30), random.randint(1, 5))
        counts = [random.randint(0, 4) for _ in sizes]
        total = sum(s * c for s, c in zip(sizes, counts))
        budget = random.randint(0, total + 5)
        take = mixing.fitted(budget, sizes, counts)
        assert all(0 <= t <= c for t, c in zip(take, counts))
        words = sum(s * t for s, t in zip(sizes, take))
        base = [c * min(budget, total) // total if total else 0 for c in counts]
        reach = {sum(s * t for s, t in zip(sizes, extra)) for extra in product(*(range(b, c + 1) for b, c in zip(base, counts)))}
        if total > 0 and budget > 0:
            assert abs(words - min(budget, total)) == min(abs(r - min(budget, total)) for r in reach)


def test_long_lengths_leave_little(monkeypatch):
    monkeypatch.setattr(mixing, "EXACT_WORDS", 64)
    take = mixing.fitted(1_000_003, [7, 1000, 50_000], [900, 400, 30])
    assert abs(1_000_003 - sum(s * t for s, t in zip([7, 1000, 50_000], take))) < 7


ROWS = [(i, "w " * (i % 7 + 1), f"s{i % 5}", 1) for i in range(200)] + [
    (300, None, "s1", 1), (301, "", "s1", 1), (302, "a b c", None, 1), (303, "d e", None, 1), (None, "f g h i", "s2", 1),
    (7, "w " * 1, "s2", 1), (400, "x " * 30_000, "\U0001F600", 1), *[(500, "again and again", "s4", 1)] * 9]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, source string, size int")


def test_mix(spark, docs):
    found = mixing.taken_words(mixing.mix(docs)).collect()
    assert len(found) == len(ROWS)
    assert sorted((str(r["doc_id"]), r["size"]) for r in found) == sorted(
        (str(i), len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t, _, _ in ROWS)
    sizes = {}
    for _, t, s, _ in ROWS:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets = plain_targets(sizes)
    assert {round(r["target"], 6) for r in found} == {round(t, 6) for t in targets.values()}
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in found)
    for source, target in targets.items():
        own = [r for r in found if round(r["target"], 6) == round(target, 6) and r["source_size"] == sizes[source]]
        assert abs(sum(r["taken"] for r in own) - target) <= 30_000 if source == "\U0001F600" else 8
    again = mixing.taken_words(mixing.mix(docs.repartition(7))).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_documents_of_the_mix(spark, docs):
    mixed = mixing.mix(docs)
    taken = mixing.mixed_documents(docs, mixed)
    assert taken.columns == docs.columns
    found = mixing.taken_words(mixed).collect()
    assert taken.count() == sum(r["copies"] for r in found)
    assert mixing.taken_words(mixing.mix(docs.limit(0))).count() == 0


def test_query(spark):
    from tapeworks.llm.queries import llm_queries

    sf_dir = "/root/testdata/sf0.01"
    sizes, sources = {}, {}
    for i, text, source in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").collect():
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sources[i] = source
    targets, taken = plain_targets(sizes), dict.fromkeys(sizes, 0)
    for r in llm_queries()["op8_mixing"](spark, sf_dir).collect():
        assert r["target"] == pytest.approx(targets[sources[r["doc_id"]]])
        assert r["taken"] <= 3 * r["size"]
        taken[sources[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= max(20, 0.005 * targets[s]) for s in sizes)
