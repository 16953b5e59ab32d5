"""Periodic runs against all stretches of all periods."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tapeworks.llm import periodic_runs
from tapeworks.llm.queries import op13_runs


def plain_runs(words):
    found = {}
    for period in range(1, len(words) // 2 + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            if i > start and i + period - start >= max(12, 2 * period):
                found.setdefault((start, i + period), period)
            i += 1
    return sorted((start, end - start, period) for (start, end), period in found.items())


def plain_collapsed(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def agree(texts):
    for words, (runs, collapsed) in zip(texts, periodic_runs.detected([" ".join(t) for t in texts])):
        expected = plain_runs(words)
        assert [tuple(r) for r in runs.tolist()] == expected
        assert collapsed.decode() == plain_collapsed(words, expected)


def a_text(rng):
    letters = "abcd"[: rng.randint(1, 4)]

    def some(n):
        return [rng.choice(letters) for _ in range(n)]

    kind = rng.randrange(6)
    if kind == 0:
        return some(rng.randint(0, 300))
    if kind == 1:
        return some(rng.randint(0, 20)) + (some(rng.randint(1, 90)) * 30)[: rng.randint(1, 400)] + some(rng.randint(0, 20))
    if kind == 2:  # a period that is itself periodic but for its end
        unit = (some(rng.randint(1, 4)) * 60)[: rng.randint(1, 120)] + some(rng.randint(0, 2))
        return some(rng.randint(0, 3)) + (unit * 9)[: rng.randint(10, 400)] + some(rng.randint(0, 3))
    if kind == 3:  # regions of one period that meet
        root = some(rng.randint(1, 3))
        return [w for _ in range(rng.randint(1, 8))
                for w in (root * 200)[: rng.choice([27, 40, 41, 60, 61, 90, 100])] + some(rng.randint(0, 1))]
    if kind == 4:  # Fibonacci words hold very many runs
        short, long = ["a"], ["a", "b"]
        while len(long) < 400:
            short, long = long, long + short
        first = rng.randrange(100)
        return long[first : first + rng.randint(50, 300)]
    words = [f"x{rng.randrange(1000)}" for _ in range(200)]
    for _ in range(3):  # passages that repeat at once
        at, length = rng.randrange(200), rng.randint(1, 80)
        words[at:at] = words[max(0, at - length) : at] * rng.randint(1, 3)
    return words[:500]


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_of_random_texts(seed):
    rng = random.Random(seed)
    for _ in range(20):
        agree([a_text(rng) for _ in range(25)])


def test_large_periods():
    rng = random.Random(9)
    for period in (191, 192, 193, 1000, 1535, 1536):
        unit = [f"w{rng.randrange(400)}" for _ in range(period)]
        agree([["y"] * 3 + unit * 2 + unit[: rng.randrange(period)] + ["z"]])
    for length in (13, 40, 1001):  # a period that is one region but for its end
        unit = (["a", "b"] * length)[: 2 * length - 1]
        agree([unit * 2, ["b", *unit * 2, "b"], unit * 3])


def test_long_texts_in_time():
    assert periodic_runs.detected(["a " * 300_000])[0][0].tolist() == [[0, 300_000, 1]]
    joined = "a b " * 50_000 + "a " + "a b " * 50_000
    runs, collapsed = periodic_runs.detected([joined])[0]
    assert len(runs) == 49_999 and collapsed == b"a b"


def test_a_longer_match_of_hashes_is_cut(monkeypatch):
    """Even if different contexts had equal hashes, only what is equal word by word would be a run."""
    monkeypatch.setattr(periodic_runs, "_joined", lambda left, right: (left ^ left) % 7 + right % 3)
    rng = random.Random(4)
    for _ in range(10):
        text = [rng.choice("abc") for _ in range(120)]
        runs = {tuple(r) for r in periodic_runs.detected([" ".join(text)])[0][0].tolist()}
        assert runs <= set(plain_runs(text))


def test_odd_rows(spark):
    rows = [(1, None), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "a " * 11), (None, "a b " * 12),
            (4, "\x1c x" * 40), (5, "é\n" * 30 + "end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("RUNS", F.lit("x"))
    found = periodic_runs.with_runs(df.repartition(2))
    assert found.columns == ["doc_id", "text", "runs", "collapsed"]
    for row in found.collect():
        words = [w.decode() for w in (row.text or "").encode().split()]
        assert [tuple(r) for r in row.runs] == plain_runs(words)
        assert row.collapsed == plain_collapsed(words, plain_runs(words))
    assert found.count() == len(rows)
    assert periodic_runs.with_runs(df.limit(0)).count() == 0


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest())


def test_query(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, " ".join(a_text(rng))) for i in range(120)] + [(5, None), (None, "b " * 30), (None, None), (30, ""), (37, " ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_runs(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=str) == sorted((plain_row(*r) for r in rows), key=str)
    assert dict(found.dtypes)["exponent_milli"] == "bigint" and dict(found.dtypes)["start"] == "bigint"
