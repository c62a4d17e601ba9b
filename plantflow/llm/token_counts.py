"""Token counts with a whole-token shortcut.

`whole_tokens` proves offline, with the library itself, which vocabulary strings are one pre-token and encode alone as
one token. A pre-token among them counts one; only the others are merged, by the library's own model. Pieces between
spaces keep their counts per worker, within a bound.

A null text is an empty one and has no tokens. Rows are handled one by one; an empty table gives no rows; strings of
special tokens inside texts are treated as the library does by default: as special tokens.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow.llm import common, vocabularies

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
LIMIT = 1024


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings, in byte characters, that are one pre-token of the library and one token alone."""
    tokenizer = vocabularies.from_json(path)
    table = vocabularies.token_bytes(tokenizer)
    special = set(tokenizer.get_added_tokens_decoder())
    texts = {}
    for i, raw in enumerate(table):
        try:
            texts[i] = raw.decode()
        except UnicodeDecodeError:  # part of a character: no text holds it alone
            continue
    found = zip(texts, tokenizer.encode_batch_fast(list(texts.values()), add_special_tokens=False), strict=True)
    proven = set()
    for i, encoding in found:
        if encoding.ids == [i] and i not in special:
            parts = tokenizer.pre_tokenizer.pre_tokenize_str(texts[i])
            if len(parts) == 1:
                proven.add(parts[0][0])
    return frozenset(proven)


class Counter:
    """Tokens of texts, counted by pre-tokens."""

    def __init__(self, path: str):
        self.tokenizer = vocabularies.from_json(path)
        self.whole = whole_tokens(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = vocabularies.PieceCache(self._learn)

    def _merged(self, pre_token: str) -> int:
        return 1 if pre_token in self.whole else len(self.tokenizer.model.tokenize(pre_token))

    def _learn(self, texts: list[str], joined: bool) -> list[int]:
        special = [any(s in t for s in self.special) for t in texts]
        if any(special):  # the library cuts such texts at the special token first
            found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [len(e.ids) for e in found]
        if not joined:
            return [sum(self._merged(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(t)) for t in texts]
        starts = [0, *accumulate(map(len, texts))]
        counts = [0] * len(texts)
        for p, (at, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str("".join(texts)):
            counts[bisect_right(starts, at) - 1] += self._merged(p)
        return counts

    def count(self, text: str) -> int:
        return sum(self.cache.of(text))


def count(docs: DataFrame, path: str = VOCABULARY, limit: int = LIMIT, keep: list[str] | None = None, text_col="text") -> DataFrame:
    """keep (default: all columns), n_bytes, n_tokens, and whether n_tokens is above the limit."""
    added = ("n_bytes", "n_tokens", "over_limit")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]

    def start():
        counter = Counter(path)

        def compute(texts: list) -> list:
            return [
                pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                pa.array([counter.count(t or "") for t in texts], pa.int64()),
            ]

        return compute

    fields = [T.StructField(c, T.LongType()) for c in added[:2]]
    return common.with_computed(docs, keep, text_col, fields, start).withColumn("over_limit", F.col("n_tokens") > limit)
