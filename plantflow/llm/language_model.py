"""Language-model scores by a sharded Elias-Fano trie of n-grams.

The model: p(w | v) is c(v w) / (c(v) + MASS) for a word seen after v in training, and what this leaves, MASS / (c(v) +
MASS), times p(w) for any other; p(w) is (c(w) + 1) / (N + V + 1). Every text begins after a start and ends with an end,
which counts as a token. Seen words take no share of what is left, so probabilities of all words add up to 1 at most.

Words travel to the model, not the model to the words. Documents are numbered by blocks; a pass over them packs, per block,
each word once with the rows of the documents that hold it, and deals the words over as many shards as there are shuffle
partitions. A shard's task counts its words over all training documents and sends sums per document back. A second pass
does the same with pairs of neighbours, dealt by their first word; those of words with more than one in HOT of a sample's
tokens are dealt over several shards by their second word, too (whatever the sample says, results are the same). A
shard's task keeps its pairs as a trie in memory-mapped files (sorted contexts, pointers and context-relative successors
as Elias-Fano sequences, probabilities in two bytes), and looks all its pairs up by successor search. Words not seen
after their context go on to the shards of words for their counts. Everything counted comes from all training documents.
A shard has to fit into a task's memory, so shuffle partitions should grow with the input.

A null or empty text has its end only. A null id is not in training unless the caller's column says so; a null there
means not in training. Rows are told apart by block and row, so repeated rows are documents of their own. Without
training documents counts are 0 and every token has log10 probability 0. An empty table gives no rows. Columns of the
input other than those kept are ignored. Words are told apart by 64 bits of hash, in pairs by 48.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantflow.llm import common, elias_fano, postings

MASS = 1.0
#: Words with more than one in HOT of the sample's tokens, so fewer than HOT, are dealt over several shards.
HOT = 500
SAMPLE = 5_000
#: Tokens gathered before what a block has so far is written.
MOST_TOKENS = 2_000_000
END, START = b"", b"\n"  # neither is a word
#: A row of a block takes 13 bits; the others say that the document is not in training, and that an item begins here.
_OUTSIDE, _FIRST = 1 << 15, 1 << 14
_SEED, _MASK = 42, np.uint64((1 << 48) - 1)  # of XXH64, and its bits that pairs use

RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
_WORDS = "shard int, block long, hashes binary, rows binary, times binary"
_PAIRS = "shard int, block long, contexts binary, sizes binary, successors binary, rows binary, times binary"
_SUMS = "block long, rows binary, base binary, known binary, n binary, own binary"
_COUNTS = "shard int, hashes binary, counts binary"
_AWAY = "shard int, block long, hash long, row int, n_times int"


def _hash(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w, _SEED) for w in words], dtype=np.uint64)


def _short(hashes: np.ndarray) -> np.ndarray:
    """As six bytes each."""
    return np.ascontiguousarray(hashes.astype("<u8").view("u1").reshape(-1, 8)[:, :6]).view("V6").ravel()


def _long(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), 8), dtype="u1")
    wide[:, :6] = raw.view("u1").reshape(-1, 6)
    return wide.view("<u8").ravel()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def _hot(docs: DataFrame, text_col: str, shards: int) -> dict[int, int]:
    """Hash of each frequent word to the shards it is dealt over; from a sample, as it only balances the work."""
    n = docs.count()
    some = docs.sample(min(1.0, SAMPLE / max(1, n)), seed=1).select(common.ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("t"))
    words = some.select(F.explode(F.split("t", common.WHITE_RUN)).alias("word")).filter("word <> ''")
    counted = common.cut(words.groupBy("word").count())
    total = counted.agg(F.sum("count")).first()[0] or 0
    most = counted.filter(F.col("count") * HOT > total).limit(HOT).collect()
    dealt = {r["word"].encode(): math.ceil(2 * shards * r["count"] / total) for r in most}
    return {int(h): k for h, k in zip(_hash([*dealt, START]) & _MASK, [*dealt.values(), max(1, shards // 8)], strict=True)}


class _Shards:
    def __init__(self, n: int, hot: dict[int, int]):
        self.n = n
        self.words = np.array(sorted(hot), dtype=np.uint64)
        self.parts = np.array([hot[h] for h in sorted(hot)], dtype=np.uint64)

    def of(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, contexts), len(self.words) - 1)
        parts = np.where(self.words[at] == contexts, self.parts[at], np.uint64(1))
        return (_mixed(contexts + _mixed(successors) % parts) % np.uint64(self.n)).astype(np.int64)

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        return (_mixed(hashes & _MASK) % np.uint64(self.n)).astype(np.int64)


def _items(keys: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of numbers item * BLOCK + row: distinct items, entries of each, rows with their marks, and times (255 at most, so
    that what occurs more often in a document has several entries)."""
    both, times = np.unique(keys, return_counts=True)
    again = -(-times // 255)
    full = np.repeat(both, again)
    last = np.cumsum(again) - 1
    shown = np.full(len(full), 255)
    shown[last] = times - 255 * (again - 1)
    item, rows = full // postings.BLOCK, full % postings.BLOCK
    first = np.concatenate([[True], item[1:] != item[:-1]])[: len(item)]
    starts = np.flatnonzero(first)
    marks = rows | np.where(first, _FIRST, 0) | np.where(outside[rows], _OUTSIDE, 0)
    return item[starts], np.diff(np.append(starts, len(item))), marks.astype("<u2"), shown.astype("u1")


def _dealt(numbered: DataFrame, schema: str, pack: Callable[[list[bytes], np.ndarray, np.ndarray, np.ndarray], dict]) -> DataFrame:
    """Rows of packed items by shard and block. pack(known words, a code of each token, rows, which rows are not in training)
    returns the columns of a part of a block."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        outside, many, own = np.zeros(postings.BLOCK, dtype=bool), 0, None

        def packed() -> pa.RecordBatch:
            words = pa.chunked_array([w for w, _ in held]).unify_dictionaries().combine_chunks()
            words = words.chunk(0) if isinstance(words, pa.ChunkedArray) else words
            rows = np.concatenate([r for _, r in held])
            shown = pack(common.spaceless(words.dictionary), words.indices.to_numpy().astype(np.int64), rows, outside)
            shown["block"] = pa.array(np.full(len(shown["shard"]), own))
            return pa.RecordBatch.from_arrays([shown[c] for c in names], names=names)

        for batch in batches:
            for some in common.slices(batch, "text"):
                # lower() of bytes is that of A to Z, split() of bytes that of ASCII white space
                texts = [[*(t or "").encode().lower().split(), END] for t in some.column("text").to_pylist()]
                sizes = np.array(list(map(len, texts)))
                block, row = some.column("block").to_numpy(), some.column("row").to_numpy().astype(np.int64)
                away = ~some.column("train").to_numpy(zero_copy_only=False)
                for here in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(block)) + 1):
                    if held and (block[here[0]] != own or many >= MOST_TOKENS):
                        yield packed()
                        held, many = [], 0
                    own = int(block[here[0]])
                    flat = pa.array([w for k in here.tolist() for w in texts[k]], pa.binary()).dictionary_encode()
                    held.append((flat, np.repeat(row[here], sizes[here])))
                    outside[row[here]] = away[here]
                    many += len(flat)
        if held:
            yield packed()

    return numbered.select("block", "row", "train", "text").mapInArrow(run, schema)


def _by_shard(shard: np.ndarray, sizes: np.ndarray, marks: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
    """(order of the items by shard, how many each shard has, the columns all packed rows have)."""
    order = np.argsort(shard, kind="stable")
    entries = np.argsort(np.repeat(shard, sizes), kind="stable")
    numbers, counts = np.unique(shard, return_counts=True)
    of_entries = np.bincount(np.searchsorted(numbers, shard), weights=sizes, minlength=len(numbers)).astype(np.int64)
    shown = {"shard": pa.array(numbers.astype(np.int32)), "rows": postings.binaries(marks[entries], of_entries)}
    return order, counts, shown | {"times": postings.binaries(times[entries], of_entries)}


def _words(deal: _Shards) -> Callable:
    def pack(known: list[bytes], codes: np.ndarray, rows: np.ndarray, outside: np.ndarray) -> dict:
        item, sizes, marks, times = _items(codes * postings.BLOCK + rows, outside)
        hashes = _hash(known)[item]
        order, counts, shown = _by_shard(deal.of_words(hashes), sizes, marks, times)
        return shown | {"hashes": postings.binaries(hashes[order].astype("<u8"), counts)}

    return pack


def _pairs(deal: _Shards) -> Callable:
    def pack(known: list[bytes], codes: np.ndarray, rows: np.ndarray, outside: np.ndarray) -> dict:
        first = np.concatenate([[True], codes[:-1] == known.index(END)])
        before = np.where(first, len(known), np.concatenate([[0], codes[:-1]]))
        item, sizes, marks, times = _items((before * (len(known) + 1) + codes) * postings.BLOCK + rows, outside)
        hashes = _hash([*known, START]) & _MASK
        context, successor = hashes[item // (len(known) + 1)], hashes[item % (len(known) + 1)]
        shard = deal.of(context, successor)
        order, counts, shown = _by_shard(shard, sizes, marks, times)
        context, shard = context[order], shard[order]
        starts = np.flatnonzero(np.concatenate([[True], (context[1:] != context[:-1]) | (shard[1:] != shard[:-1])]))
        of_contexts = np.unique(shard[starts], return_counts=True)[1]
        return shown | {
            "contexts": postings.binaries(_short(context[starts]), of_contexts),
            "sizes": postings.binaries(np.diff(np.append(starts, len(order))).astype("<u4"), of_contexts),
            "successors": postings.binaries(_short(successor[order]), counts),
        }

    return pack


def _entries(batch: pa.RecordBatch, counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Block and number of entries of each item; marked rows and times of the entries. counts: items of each packed row."""
    marks, _ = postings.numbers(batch.column("rows"), "<u2")
    times, _ = postings.numbers(batch.column("times"), "u1")
    starts = np.flatnonzero(marks & _FIRST)
    return np.repeat(batch.column("block").to_numpy(), counts), np.diff(np.append(starts, len(marks))), marks, times


def _trained(size: np.ndarray, marks: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Occurrences of each item in training documents."""
    owner = np.repeat(np.arange(len(size)), size)
    return np.bincount(owner, np.where(marks & _OUTSIDE, 0, times), len(size)).astype(np.int64)


def _returned(block: np.ndarray, rows: np.ndarray, **values: np.ndarray) -> pa.RecordBatch:
    """Sums of values per block and row, as packed rows of _SUMS."""
    names = [f.split()[0] for f in _SUMS.split(", ")]
    blocks, at = np.unique(block, return_inverse=True)
    key, place = np.unique(at * postings.BLOCK + rows, return_inverse=True)
    per_block = np.bincount(key // postings.BLOCK, minlength=len(blocks))
    shown = {"block": pa.array(blocks), "rows": postings.binaries((key % postings.BLOCK).astype("<u2"), per_block)}
    for name, value in values.items():
        kind = "<u4" if name in ("known", "n") else "<f8"
        shown[name] = postings.binaries(np.bincount(place, value, len(key)).astype(kind), per_block)
    return pa.RecordBatch.from_arrays([shown.get(c, pa.nulls(len(blocks), pa.binary())) for c in names], names=names)


def _widened(part: pa.RecordBatch, names: list[str]) -> pa.RecordBatch:
    kinds = {"shard": pa.int32(), "block": pa.int64(), "hash": pa.int64(), "row": pa.int32(), "n_times": pa.int32()}
    columns = [part.column(c) if c in part.schema.names else pa.nulls(part.num_rows, kinds.get(c, pa.binary())) for c in names]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _counted(words: DataFrame) -> DataFrame:
    """A shard's words: sums per document (base: of log10(c + 1), known, n), and its counts (with a shard number)."""
    names = ["shard", "hashes", "counts", *(f.split()[0] for f in _SUMS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, shard = [], None
        for batch in batches:
            hashes, counts = postings.numbers(batch.column("hashes"), "<u8")
            found.append((hashes, *_entries(batch, counts)))
            shard = batch.column("shard")[0].as_py()
        if not found:
            return
        hashes, block, size, marks, times = (np.concatenate(x) for x in zip(*found, strict=True))
        known, number = np.unique(hashes, return_inverse=True)
        c = np.bincount(number, _trained(size, marks, times), len(known)).astype(np.int64)
        counts = [pa.array([shard], pa.int32()), *(postings.binaries(x, np.array([len(x)])) for x in (known.astype("<u8"), c.astype("<i8")))]
        yield _widened(pa.RecordBatch.from_arrays(counts, names=names[:3]), names)
        owner = np.repeat(number, size)
        rows, times = (marks & (postings.BLOCK - 1)).astype(np.int64), times.astype(np.float64)
        of = np.repeat(block, size)
        yield _widened(_returned(of, rows, base=np.log10(c + 1)[owner] * times, known=(c > 0)[owner] * times, n=times), names)

    return words.mapInArrow(run, f"{_COUNTS}, {_SUMS}")


def _totals(counts: DataFrame, named: list[int]) -> tuple[int, int, dict[int, int]]:
    """(N, V, counts of the named words by 48 bits of their hashes); named are fewer than HOT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, _ = postings.numbers(batch.column("hashes"), "<u8")
            c, _ = postings.numbers(batch.column("counts"), "<i8")
            at = np.flatnonzero(np.isin(hashes & _MASK, np.array(named, dtype=np.uint64)))
            keys = np.concatenate([[-1, -2], (hashes[at] & _MASK).astype(np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.concatenate([[c.sum(), (c > 0).sum()], c[at]]))], names=["key", "n"])

    found = {r["key"]: r["n"] for r in counts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()}
    return found.pop(-1, 0), found.pop(-2, 0), found


def _of_shards(pairs: DataFrame, totals: dict[int, int], mass: float, deal: _Shards) -> DataFrame:
    """A shard's pairs: sums per document of log10 probabilities (own), and the postings of words not seen after their
    context, for the shards of these words."""
    fields = dict(f.split() for f in f"{_AWAY}, {_SUMS}".split(", "))
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            contexts, _ = postings.numbers(batch.column("contexts"), "V6")
            sizes, _ = postings.numbers(batch.column("sizes"), "<u4")
            successors, counts = postings.numbers(batch.column("successors"), "V6")
            found.append((np.repeat(_long(contexts), sizes), _long(successors), *_entries(batch, counts)))
        if not found:
            return
        context, successor, block, size, marks, times = (np.concatenate(x) for x in zip(*found, strict=True))
        found.clear()
        order = np.lexsort((successor, context))
        new = np.concatenate([[True], (context[order[1:]] != context[order[:-1]]) | (successor[order[1:]] != successor[order[:-1]])])
        v, w = context[order[new]], successor[order[new]]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        counts = np.bincount(number, _trained(size, marks, times), len(v)).astype(np.int64)
        seen = counts > 0
        own_v, starts = np.unique(v, return_index=True)
        total = np.add.reduceat(counts, starts)
        total = np.array([totals.get(int(h), t) for h, t in zip(own_v.tolist(), total.tolist(), strict=True)])
        own_v, total = own_v[total > 0], total[total > 0]

        def of(contexts: np.ndarray) -> np.ndarray:
            return total[np.searchsorted(own_v, contexts)] + mass

        with tempfile.TemporaryDirectory() as folder:
            log10_p = np.log10(counts[seen] / of(v[seen]))
            trie = elias_fano.Trie(v[seen], w[seen], log10_p, lambda x: np.log10(mass / of(x)), elias_fano.Files(folder))
            code, known = trie.log10_codes(v, w)
            # a part of a frequent context without any of its own still has the context's total
            unheld = np.flatnonzero(~known & np.isin(v, own_v) & ~np.isin(v, v[seen]))
            code[unheld] = elias_fano.quantised(np.log10(mass / of(v[unheld])))
            del trie
        owner = np.repeat(np.arange(len(number)), size)
        rows = (marks & (postings.BLOCK - 1)).astype(np.int64)
        yield _widened(_returned(block[owner], rows, own=-elias_fano.UNIT * code[number[owner]] * times), names)
        away = np.flatnonzero(~known[number[owner]])
        if len(away):
            # a row each, since packed by shard and block they would be no fewer where both are many
            asked = successor[owner[away]]
            sent = [deal.of_words(asked).astype(np.int32), block[owner[away]], asked.astype(np.int64), rows[away].astype(np.int32), times[away].astype(np.int32)]
            yield _widened(pa.RecordBatch.from_arrays(list(map(pa.array, sent)), names=[f.split()[0] for f in _AWAY.split(", ")]), names)

    return pairs.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in fields.items()))


def _looked_up(asked: DataFrame, all_tokens: float) -> DataFrame:
    """Sums per document (own) of log10 p(w) of words sent to the shards that hold their counts, which come as rows with
    counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, c, found = None, None, []
        for batch in batches:
            holds = batch.column("counts").is_valid()
            held, sent = batch.filter(holds), batch.filter(pc.invert(holds))
            if held.num_rows:
                known, c = postings.numbers(held.column("hashes"), "<u8")[0] & _MASK, postings.numbers(held.column("counts"), "<i8")[0]
            if sent.num_rows:
                hashes, block, row, times = (sent.column(c).to_numpy() for c in ("hash", "block", "row", "n_times"))
                found.append((hashes.astype(np.uint64), block, row.astype(np.int64), times))
        if found:
            hashes, block, rows, times = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(known)
            p = np.log10((c[order][np.searchsorted(known[order], hashes)] + 1) / all_tokens)
            yield _returned(block, rows, own=p * times)

    return asked.mapInArrow(run, _SUMS)


def _summed(told: DataFrame) -> DataFrame:
    """Per document the sums of all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = postings.Sums(4)
        for batch in batches:
            rows, sizes = postings.numbers(batch.column("rows"), "<u2")
            values = []
            for name in ("base", "known", "n", "own"):
                own, there = postings.numbers(batch.column(name), "<u4" if name in ("known", "n") else "<f8")
                value = np.zeros(len(rows))
                value[np.repeat(there > 0, sizes)] = own
                values.append(value)
            sums.add(np.repeat(batch.column("block").to_numpy(), sizes), rows.astype(np.int64), values)
        yield from sums.batches(["base", "known", "n", "own"])

    return told.repartition("block").mapInArrow(run, "block long, row int, base double, known double, n double, own double")


def score(docs: DataFrame, train: Column, keep: list[str], text_col="text", mass: float = MASS) -> DataFrame:
    """keep, held_out, n_tokens, n_known, train_tokens, base_score (sum of log10 p(w)) and score (log10 p of the text)
    by the model learned from the rows where train is true."""
    spark = docs.sparkSession
    keep = [c for c in keep if c not in ("held_out", *RESULTS)]
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{common.shared_dir(spark)}/language-model-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    # numbered once, and stored, so that both passes see the same numbers
    at, block = F.monotonically_increasing_id(), F.floor(F.col("at") / postings.BLOCK)
    own = F.struct(*(F.col(f"`{c}`") for c in keep)).alias("kept")
    numbered = docs.select(own, F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"), at.alias("at"))
    numbered = kept(numbered.withColumns({"block": block, "row": (F.col("at") % postings.BLOCK).cast("int")}).drop("at"), "documents")

    hot = _hot(numbered, "text", shards)
    deal = _Shards(shards, hot)
    counted = kept(_counted(_dealt(numbered, _WORDS, _words(deal)).repartitionById(shards, F.col("shard"))), "words")
    counts, of_words = counted.filter("counts IS NOT NULL").select("shard", "hashes", "counts"), counted.filter("block IS NOT NULL")
    end, start = (int(_hash([x])[0] & _MASK) for x in (END, START))
    n, v, totals = _totals(counts, [*hot, end])
    totals[start] = totals.pop(end, 0)  # a document has one of each
    all_tokens = float(n + v + 1)

    answers = kept(_of_shards(_dealt(numbered, _PAIRS, _pairs(deal)).repartitionById(shards, F.col("shard")), totals, mass, deal), "pairs")
    away = answers.filter("shard IS NOT NULL").select(*(f.split()[0] for f in _AWAY.split(", ")))
    asked = away.unionByName(counts, allowMissingColumns=True).repartitionById(shards, F.col("shard"))
    names = [f.split()[0] for f in _SUMS.split(", ")]
    sums = _summed(of_words.select(names).union(answers.filter("shard IS NULL").select(names)).union(_looked_up(asked, all_tokens)))

    def value(name: str) -> Column:
        return F.coalesce(name, F.lit(0.0))

    documents = numbered.select("block", "row", "kept", (~F.col("train")).alias("held_out"))
    return documents.join(sums, ["block", "row"], "left").select(
        *(F.col(f"kept.`{c}`") for c in keep),
        "held_out",
        value("n").cast("long").alias("n_tokens"),
        value("known").cast("long").alias("n_known"),
        F.lit(int(n)).cast("long").alias("train_tokens"),
        (value("base") - value("n") * F.lit(math.log10(all_tokens))).alias("base_score"),
        value("own").alias("score"),
    )
