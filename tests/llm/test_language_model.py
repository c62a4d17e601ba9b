"""Elias-Fano sequences and the trie against sorted arrays and dictionaries; scores against plain counting."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plantflow.llm import elias_fano, language_model, queries
from tests.compare import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")
START, END = object(), object()


@settings(max_examples=150, deadline=None)
@given(st.sampled_from([1, 5, 64, 1000, 1 << 20, 1 << 40, 1 << 64]), st.data())
def test_sequences(tmp_path_factory, universe, draw):
    number = st.integers(0, universe - 1)
    values = np.sort(np.array(draw.draw(st.lists(number, max_size=200)), dtype=np.uint64))
    x = np.array(draw.draw(st.lists(number, max_size=50)) + values.tolist(), dtype=np.uint64)
    own = elias_fano.EliasFano(values, universe, elias_fano.Files(str(tmp_path_factory.mktemp("ef"))), "x")
    assert isinstance(own.high, np.memmap) or not own.high.size
    assert own.access(np.arange(len(values))).tolist() == values.tolist()
    assert own.successor(x).tolist() == np.searchsorted(values, x).tolist()
    place, there = own.find(x)
    assert there.tolist() == np.isin(x, values).tolist() and (values[place[there]] == x[there]).all()


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.tuples(st.sampled_from([0, 3, 1 << 63, (1 << 64) - 1]), st.integers(0, 40)), st.floats(1e-6, 1), max_size=60))
def test_trie(tmp_path_factory, grams):
    keys = sorted(grams)
    v, w = (np.array([k[i] for k in keys], dtype=np.uint64) for i in (0, 1))
    files = elias_fano.Files(str(tmp_path_factory.mktemp("trie")))
    trie = elias_fano.Trie(v, w, np.log10(np.array([grams[k] for k in keys], float)), lambda c: -(c % np.uint64(7)).astype(float), files)
    asked = [(a, b) for a in (0, 3, 4, 1 << 63, (1 << 64) - 1) for b in range(42)]
    code, found = trie.log10_codes(*(np.array([k[i] for k in asked], dtype=np.uint64) for i in (0, 1)))
    for k, c, f in zip(asked, code.tolist(), found.tolist(), strict=True):
        assert f == (k in grams)
        if f:
            assert abs(-c * elias_fano.UNIT - math.log10(grams[k])) <= elias_fano.UNIT
        else:
            assert c == (k[0] % 7 / elias_fano.UNIT if k[0] in v.tolist() else 0)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows, mass=language_model.MASS):
    """rows: id, text, in training."""
    tokens = [[*WORD.findall(lower(t or "")), END] for _, t, _ in rows]
    own = [list(zip([START, *t], t, strict=False)) for t in tokens]
    words = Counter(w for t, r in zip(tokens, rows, strict=True) if r[2] for w in t)
    pairs = Counter(p for o, r in zip(own, rows, strict=True) if r[2] for p in o)
    contexts = Counter()
    for (v, _), n in pairs.items():
        contexts[v] += n
    n = sum(words.values())

    def p1(w):
        return (words[w] + 1) / (n + len(words) + 1)

    def p2(v, w):
        if pairs[v, w]:
            return pairs[v, w] / (contexts[v] + mass)
        return (mass / (contexts[v] + mass)) * p1(w)

    for (doc_id, _, train), t, o in zip(rows, tokens, own, strict=True):
        base, score = (sum(map(math.log10, x)) for x in (map(p1, t), (p2(v, w) for v, w in o)))
        yield doc_id, not train, len(t), sum(words[w] > 0 for w in t), n, base, score


def same(found, wanted):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:5], round(r[5], 4))
    found, wanted = sorted(found, key=key), sorted(wanted, key=key)
    assert [r[:5] for r in found] == [r[:5] for r in wanted]
    for f, w in zip(found, wanted, strict=True):
        assert f[5] == pytest.approx(w[5], abs=1e-6)
        assert abs(f[6] - w[6]) <= w[2] * 2 * elias_fano.UNIT


def test_query(spark):
    docs = spark.read.parquet(f"{data('sf0.001')}/documents.parquet").select("doc_id", "text").collect()
    rows = [(k, t, zlib.crc32(str(k).encode()) % 7 != 2) for k, t in docs]
    found = queries.queries()["op12_language_model"](spark, data("sf0.001"))
    assert found.columns == ["doc_id", "held_out", *language_model.RESULTS]
    same([tuple(r) for r in found.collect()], list(expected(rows)))


@pytest.mark.parametrize("hot", [500, 3])
def test_odd_rows_parts_of_blocks_and_frequent_words(spark, monkeypatch, hot):
    monkeypatch.setattr(language_model, "MOST_TOKENS", 50)
    monkeypatch.setattr(language_model, "HOT", hot)
    rows = [(1, "the cat the cat sat", True), (1, "the cat the cat sat", True), (None, "A dog", False), (2, None, True), (3, "", False)]
    rows += [(4, "word " * 700, True), (5, "word new\x0bwords ÄÉ \xa0", False), (6, "the " * 9 + "end", False), (7, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, train boolean").withColumns({c: F.lit(1) for c in ("block", "row", "word", "score")})
    for parts in (1, 4):
        found = language_model.score(docs.repartition(parts), F.col("train"), keep=["doc_id", "score"])
        same([tuple(r) for r in found.select("doc_id", "held_out", *language_model.RESULTS).collect()], list(expected(rows)))
    none = language_model.score(docs, F.lit(False), keep=["doc_id"]).collect()
    assert {r["base_score"] for r in none} == {0.0} and {r["score"] for r in none} == {0.0}
    assert language_model.score(docs.limit(0), F.lit(True), keep=["doc_id"]).collect() == []


def test_model_predicts_held_out_text_better_than_words_alone(spark):
    found = queries.queries()["op12_language_model"](spark, data("sf0.01")).filter("held_out")
    score, base = found.agg(F.sum("score"), F.sum("base_score")).first()
    assert score > base


def test_each_context_and_successor_is_looked_up_once(tmp_path, monkeypatch):
    draw = np.random.default_rng(3)
    v, w = (draw.integers(0, 1 << 48, n).astype(np.uint64) for n in (20, 50))
    pairs = np.unique(np.stack([draw.choice(v[:15], 400), draw.choice(w[:40], 400)]), axis=1)
    p = -draw.random(pairs.shape[1]) * 5
    trie = elias_fano.Trie(pairs[0], pairs[1], p, lambda x: np.full(len(x), -2.0), elias_fano.Files(str(tmp_path)))
    asked, find = [], elias_fano.EliasFano.find
    monkeypatch.setattr(elias_fano.EliasFano, "find", lambda self, x: (asked.append((self, len(x))), find(self, x))[1])
    contexts, successors = np.repeat(np.sort(v), len(w)), np.tile(w, len(v))
    code, found = trie.log10_codes(contexts, successors)
    want = {(a, b): x for a, b, x in zip(*pairs.tolist(), elias_fano.quantised(p).tolist(), strict=True)}
    rest = {a: int(elias_fano.quantised(np.array([-2.0]))[0]) for a in pairs[0].tolist()}
    keys = list(zip(contexts.tolist(), successors.tolist(), strict=True))
    assert found.tolist() == [k in want for k in keys]
    assert code.tolist() == [want.get(k, rest.get(k[0], 0)) for k in keys]
    assert [n for own, n in asked if own is trie.contexts] == [20] and [n for own, n in asked if own is trie.vocabulary] == [50]
