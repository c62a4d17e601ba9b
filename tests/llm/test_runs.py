"""Lyndon lengths, runs and the query on periodic tails, against brute force."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plantflow.llm import periodic_runs, queries
from tests.compare import data


def longest_lyndon(codes):
    found = []
    for i in range(len(codes)):
        lengths = [n for n in range(1, len(codes) - i + 1) if all(codes[i : i + n] < codes[i + k : i + n] for k in range(1, n))]
        found.append(max(lengths))
    return found


def all_runs(words, min_length):
    """By trying every period."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            smaller = any(all(words[x] == words[x + d] for x in range(i, i + length - d)) for d in range(1, q))
            if j > i and length >= max(min_length, 2 * q) and not smaller:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=14))
def test_lyndon_lengths(codes):
    assert periodic_runs.lyndon_lengths(codes, 4) == longest_lyndon(codes)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 60), st.integers(1, 25), st.integers(0, 9)), max_size=4), st.sampled_from([2, 3, 5, 12]))
def test_runs(shapes, min_length):
    texts = []
    for k, n, period, seed in shapes:
        draw = random.Random(seed)
        words = [str(draw.randrange(k)).encode() for _ in range(n)]
        texts.append((words[:period] * 60)[:n] if seed % 2 else words)
    assert periodic_runs.runs_of(texts, min_length) == [all_runs(w, min_length) for w in texts]


def test_structured_words():
    """Fibonacci and Thue-Morse words, powers, and a long monotone word."""
    fib = ["a", "b"]
    while len(fib[-1]) < 300:
        fib.append(fib[-1] + fib[-2])
    texts = [fib[-1], "".join(str(bin(k).count("1") % 2) for k in range(256)), "a" * 200, "ab" * 90 + "a", "".join(map(chr, range(300, 600)))]
    words = [[c.encode() for c in t] for t in texts]
    for m in (2, 12):
        assert periodic_runs.runs_of(words, m) == [all_runs(w, m) for w in words]
    assert periodic_runs.runs_of([[b"x"] * 20_000]) == [[(0, 20_000, 1)]]


def test_collapsed(spark):
    rows = [(1, "a b c " * 6 + "d"), (2, None), (3, ""), (None, "x\ty\nz"), (1, "a b c " * 6 + "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.find(docs, keep=["doc_id"]).collect()]
    one = (1, 19, [(0, 18, 3)], "a b c d")
    assert found == [one, (2, 0, [], ""), (3, 0, [], ""), (None, 3, [], "x y z"), one]
    with pytest.raises(ValueError):
        periodic_runs.find(docs, min_length=1)


def test_query(spark):
    docs = spark.read.parquet(f"{data('sf0.001')}/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r.asDict() for r in queries.queries()["op13_periodic_runs"](spark, data("sf0.001")).collect()}
    assert len(found) == len(docs)
    many = 0
    for doc_id, text in docs:
        words, h = (text or "").encode().split(), zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = periodic_runs.runs_of([words])[0] if n > 150 else all_runs(words, 12)
        many += len(runs)
        dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        assert found[doc_id] == {
            "doc_id": doc_id, "n_runs": len(runs), "start": start, "length": length, "period": period,
            "exponent_milli": 1000 * length // period if runs else None,
            "runs_sha256": hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            "collapsed_sha256": hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in dropped)).hexdigest(),
        }
    assert many > 10
