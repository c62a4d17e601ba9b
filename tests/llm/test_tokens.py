"""Encoding, decoding, counts and files against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from plantflow.llm import bpe_codec, common, token_counts, token_files, vocabularies
from tests.compare import data

PARTS = (
    "a the The 's 'll é ß 1 23 ½ Ⅷ ! -- 中 文 😀 xxx ==== haha <|endoftext|> ſ K İ ﻿ ​ ᠎ ́ \x00".split(" ")
    + [" ", "  ", "\n", "\t", "\r", "\xa0", "　", "\x85", "\x1c", "\x0b", " "]
)


@pytest.fixture(scope="module")
def mixed():
    draw = random.Random(7)
    return ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(4000)]


@pytest.fixture(scope="module")
def rank_library():
    ranks = vocabularies.read_ranks(bpe_codec.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_are_those_of_the_rank_library(mixed, rank_library):
    cache = vocabularies.IdCache(vocabularies.from_ranks(bpe_codec.RANKS))
    for text in mixed:
        assert cache.ids(text).tolist() == rank_library.encode_ordinary(text), repr(text)


def test_ids_are_those_of_the_json_library(mixed):
    tokenizer = vocabularies.from_json(token_files.VOCABULARY)
    cache = vocabularies.IdCache(tokenizer)
    counter = token_counts.Counter(token_counts.VOCABULARY)
    for text in mixed:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert cache.ids(text).tolist() == ids, repr(text)
        assert counter.count(text) == len(ids), repr(text)


def test_a_full_cache_forgets(monkeypatch, mixed):
    monkeypatch.setattr(vocabularies, "MAX_CACHED", 20)
    cache = vocabularies.IdCache(vocabularies.from_json(token_files.VOCABULARY))
    fresh = vocabularies.from_json(token_files.VOCABULARY)
    for text in mixed[:300]:
        assert cache.ids(text).tolist() == fresh.encode(text, add_special_tokens=False).ids
    assert sum(map(len, cache.spaced)) < 400


@pytest.mark.parametrize("most", [20, 1 << 20])
def test_ids_of_many_texts_by_number(mixed, most):
    """Runs of white space, long pieces, nulls and forgetting, in slices of several sizes."""
    fresh = vocabularies.from_json(token_files.VOCABULARY)
    cache = vocabularies.NumberedIds(fresh, 2)
    cache.most = most
    texts = [*mixed, None, "", " ", "\n", "a b\nc ", "x" * 100, " " + "y" * 100, None]
    want = [[*fresh.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    for size in (1, 7, 500, len(texts)):
        for start in range(0, len(texts) if size > 1 else 200, size):
            found = cache.of_all(pa.array(texts[start : start + size], pa.string()))
            assert [x.tolist() for x in found] == want[start : start + size]


def test_whole_tokens_are_proven():
    tokenizer = vocabularies.from_json(token_counts.VOCABULARY)
    whole = token_counts.whole_tokens(token_counts.VOCABULARY)
    assert 40_000 < len(whole) < 50_257
    for token in random.Random(3).sample(sorted(whole), 500):
        assert len(tokenizer.model.tokenize(token)) == 1


@pytest.mark.parametrize("name", ["sf0.001"])
def test_documents_round_trip(spark, rank_library, name):
    docs = spark.read.parquet(f"{data(name)}/documents.parquet")
    rows = bpe_codec.decode(bpe_codec.encode(docs, keep=["text"], offsets=True)).collect()
    for r in rows:
        assert r["ids"] == rank_library.encode_ordinary(r["text"]) and r["decoded"].decode() == r["text"]
        table = vocabularies.token_bytes(vocabularies.from_ranks(bpe_codec.RANKS))
        for i, a, b in list(zip(r["ids"], r["starts"], r["ends"], strict=True))[:300]:
            assert table[i] in r["text"][a:b].encode()


def test_split_characters():
    tokenizer = vocabularies.from_ranks(bpe_codec.RANKS)
    table = vocabularies.token_bytes(tokenizer)
    ids = tokenizer.encode("a\U0001fae8b").ids
    assert any(len(table[i].decode(errors="replace")) and "�" in table[i].decode(errors="replace") for i in ids)
    assert "".join(bpe_codec.decode_stream(ids, table)) == "a\U0001fae8b"
    starts, ends = bpe_codec.char_offsets("a\U0001fae8b", np.array([len(table[i]) for i in ids]))
    assert starts.tolist()[0] == 0 and ends.tolist()[-1] == 3
    assert "".join(bpe_codec.decode_stream(ids[:2], table)).endswith("�")


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 32), st.data())
def test_packing(width, draw):
    ids = np.array(draw.draw(st.lists(st.integers(0, (1 << width) - 1), max_size=200)), dtype=np.uint32)
    payload = token_files.pack(ids, width)
    assert len(payload) == -(-len(ids) * width // 8)
    start = draw.draw(st.integers(0, len(ids)))
    count = draw.draw(st.integers(0, len(ids) - start))
    assert token_files.unpack(payload, width, start, count).tolist() == ids[start : start + count].tolist()


def test_files_hold_all_ids_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 5000)
    docs = spark.read.parquet(f"{data('sf0.001')}/documents.parquet")
    tokenizer = vocabularies.from_json(token_files.VOCABULARY)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for k, t in texts.items()}
    found = {r["doc_id"]: r for r in token_files.round_trip(docs.repartition(5)).collect()}
    at = 0
    for k in sorted(ids):
        r = found[k]
        assert (r["start"], r["n_tokens"]) == (at, len(ids[k]))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[k], "<u4").tobytes())
        at += len(ids[k])
    token_files.write(docs, str(tmp_path / "files"))
    rows = token_files.blocks(spark, str(tmp_path / "files")).orderBy("part", "block").collect()
    assert [i for r in rows for i in r["doc_ids"]] == sorted(ids)
    assert all(r["width"] == 16 and len(r["payload"]) == 2 * r["n_ids"] for r in rows)
    for r in rows[:3]:
        for k in (0, len(r["doc_ids"]) - 1):
            assert token_files.read_document(r, k).tolist() == ids[r["doc_ids"][k]]


def test_counts(spark):
    docs = spark.read.parquet(f"{data('sf0.001')}/documents.parquet")
    tokenizer = vocabularies.from_json(token_counts.VOCABULARY)
    for r in token_counts.count(docs).collect():
        n = len(tokenizer.encode(r["text"], add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(r["text"].encode()), n, n > 1024)


def test_pieces_become_strings_and_numbers_at_once():
    for strings in ([], [""], ["", ""], ["a", "", "é😀\n", "\nb"]):
        assert common.spaceless(pa.array(strings, pa.string())) == strings
        assert common.spaceless(pa.array([x.encode() for x in strings], pa.binary())) == [x.encode() for x in strings]
    assert common.spaceless(pa.array(["a", "b", "c"]).slice(1)) == ["b", "c"]
    numbers = vocabularies._Numbers([1])
    assert numbers.of_distinct(["x", "y"]).tolist() == [1, 2] and numbers["z"] == 3
    assert numbers.of_distinct(["w", "z", "x", "v"]).tolist() == [4, 3, 1, 5]
    assert numbers.new == [("x", 1), ("y", 2), ("z", 3), ("w", 4), ("v", 5)] and numbers.numbered == [6]
    long = "y" * 70_000
    assert [*vocabularies.batched(["a", long, "b", "c" * 65_535, "d"])] == [["a"], [long], ["b", "c" * 65_535], ["d"]]
    assert [*vocabularies.batched([])] == []
