"""Components, SimHash and line dedup against brute force."""

import glob
import random
import tempfile
import time
import tracemalloc

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from plantflow.llm import common, components, edit_distance, line_dedup, queries, simhash_dedup
from tests.compare import data


def merged(n, linked):
    """Smallest index reachable from each of range(n)."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    draw = random.Random(5)
    n = 60
    links = {
        "chain": [(k, k + 1) for k in range(n - 1)],
        "star": [(n - 1, k) for k in range(n - 1)],
        "random": [(draw.randrange(n), draw.randrange(n)) for _ in range(40)],
    }[shape]
    draw.shuffle(links)
    found = components.smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()
    want = merged(n, links)
    assert {r["node"]: r["component"] for r in found} == {x: want[x] for a, b in links if a != b for x in (a, b)}


def test_masks_cover_the_radius():
    """Any four positions agree in some table; a few of five do not need to."""
    kept = [m & (1 << 64) - 1 for m in simhash_dedup.masks()]
    assert len(kept) == 31
    draw = random.Random(1)
    for _ in range(20_000):
        difference = sum(1 << b for b in draw.sample(range(64), draw.randint(0, 4)))
        assert any(m & difference == 0 for m in kept)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_brute_force(spark):
    docs = spark.read.parquet(f"{data('sf0.01')}/documents.parquet").select("doc_id", "text")
    texts = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    prints = [plain_fingerprint(t) for _, t in texts]
    near = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    want = merged(len(texts), near)
    found = {r["doc_id"]: r for r in simhash_dedup.dedup(docs).collect()}
    for k, (doc_id, _) in enumerate(texts):
        assert found[doc_id]["fingerprint"] == f"{prints[k]:016x}"
        assert found[doc_id]["component_id"] == texts[want[k]][0]
    assert {r["doc_id"] for r in simhash_dedup.one_of_each(docs).collect()} == {texts[w][0] for w in want}


@pytest.mark.parametrize("chunk", [2048, 3])
def test_large_buckets(spark, chunk):
    """Fingerprints close together fill buckets; chunks of them give the same components."""
    draw = np.random.default_rng(4)
    prints = set()
    for centre in draw.integers(-(1 << 62), 1 << 62, size=4):
        for _ in range(60):
            prints.add(int(centre) ^ int(sum(1 << int(b) for b in draw.choice(24, size=draw.integers(0, 5), replace=False))))
    prints = sorted(prints)
    linked = simhash_dedup.links(spark.createDataFrame([(p,) for p in prints], "fp long"), chunk=chunk)
    found = {r["node"]: r["component"] for r in components.smallest_reachable(linked).collect()}
    near = [(i, j) for i in range(len(prints)) for j in range(i) if ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= 4]
    want = merged(len(prints), near)
    assert [found.get(p, p) for p in prints] == [prints[w] for w in want]


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (3, None), (2, ""), (None, "lonely text of its own here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["component_id"]) for r in simhash_dedup.dedup(docs).collect()]
    assert sorted(found, key=str) == sorted([(None, 7), (7, 7), (7, 7), (3, 2), (2, 2), (None, None)], key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in simhash_dedup.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(7, "a b c d e"), (2, ""), (None, "lonely text of its own here")], key=str)


def levenshtein(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, above[j] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def mutated(draw, text, most):
    out = list(text)
    for _ in range(draw.randint(0, most)):
        k, kind = draw.randrange(len(out)), draw.random()
        if kind < 0.4 or len(out) == 1:
            out.insert(k, draw.choice("abé😀"))
        elif kind < 0.7:
            out.pop(k)
        else:
            out[k] = draw.choice("abx")
    return "".join(out)


@pytest.mark.parametrize("most", [0, 1, 2, 4])
def test_edit_distance(most):
    draw = random.Random(most)
    pairs = []
    for _ in range(3000):
        a = "".join(draw.choices("abc", k=draw.randint(1, 25)))
        pairs.append((a, mutated(draw, a + "c", 5)))
    assert edit_distance.within(pairs, most).tolist() == [levenshtein(*p) <= most for p in pairs]


@pytest.fixture(scope="module")
def lined():
    draw = random.Random(5)
    base = ["".join(draw.choices("abcdefgh ", k=draw.randint(18, 40))) for _ in range(25)]
    docs = [(k, "\n".join(mutated(draw, draw.choice(base), 3) for _ in range(draw.randint(0, 8)))) for k in range(50)]
    return [*docs, (60, None), (61, ""), (62, "x" * 19), (63, "x" * 19), (None, base[0]), (70, f"{base[1]}\n{base[1]}")]


def plain_removed(docs):
    lines = sorted(((d is None, d or 0), p, x) for d, t in docs for p, x in enumerate((t or "").split("\n")) if len(x) >= 20)
    near = [(i, j) for i in range(len(lines)) for j in range(i) if levenshtein(lines[i][2], lines[j][2]) <= 2]
    want = merged(len(lines), near)
    out = {d: [] for d, _ in docs}
    for k, (d, p, _) in enumerate(lines):
        if want[k] != k:
            out[None if d[0] else d[1]].append(p)
    return out


@pytest.mark.parametrize("chunk", [512, 3])
def test_line_dedup_against_brute_force(spark, lined, chunk, monkeypatch):
    monkeypatch.setattr(line_dedup.edit_links, "__defaults__", (2, chunk))
    df = spark.createDataFrame(lined, "doc_id long, text string")
    want = plain_removed(lined)
    found = {r["doc_id"]: r for r in line_dedup.scan(df).collect()}
    assert {d: r["removed"] for d, r in found.items()} == want
    assert all(len(r["kept_in"]) == r["n_removed"] == len(r["removed"]) for r in found.values())
    texts = {r["doc_id"]: r["text"] for r in line_dedup.dedup(df).collect()}
    for d, t in lined:
        assert texts[d] == (t and "\n".join(x for p, x in enumerate(t.split("\n")) if p not in want[d]))


def test_one_line_everywhere(spark):
    """A line of every document, and as many close ones, leave one occurrence."""
    line = "this very line stands in each and every document"
    rows = [(k, f"{line}\nown words of document number {k * k * 7919} only") for k in range(300)] + [(1000 + k, line[:k] + "Z" + line[k:]) for k in range(40)]
    found = line_dedup.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = {r["doc_id"]: r["removed"] for r in found}
    assert kept[0] == [] and all(0 in kept[k] for k in range(1, 300)) and all(kept[1000 + k] == [0] for k in range(40))


@pytest.mark.parametrize("most", [3, 12, 40])
def test_edit_distance_with_a_limit_for_each_pair(most):
    draw = random.Random(most)
    pairs, limits = [], []
    for _ in range(150):
        a = "".join(draw.choices("abc", k=draw.randint(1, 90)))
        pairs.append((a, mutated(draw, a + "c", most)))
        limits.append(draw.randint(0, most))
    assert edit_distance.within(pairs, np.array(limits)).tolist() == [levenshtein(*p) <= m for p, m in zip(pairs, limits, strict=True)]


@pytest.fixture(scope="module")
def reworded():
    """Lines of 60 to 400 characters, each followed by copies with one or two words replaced, added or left out."""
    draw = random.Random(31)
    word = lambda: "".join(draw.choices("aeinorst", k=draw.randint(2, 9)))
    lines = []
    for _ in range(24):
        line = word()
        size = draw.randint(60, 400)
        while len(line) < size:
            line += f" {word()}"
        lines.append(line)
        for _ in range(3):
            words = line.split()
            for _ in range(draw.randint(1, 2)):
                k = draw.randrange(len(words))
                words[k : k + draw.choice([0, 1, 1, 1])] = draw.choice([[word()], [word()], []])
            lines.append(" ".join(words))
    draw.shuffle(lines)
    return lines


@pytest.mark.parametrize("chunk", [512, 3])
def test_limit_grows_with_the_line(spark, reworded, chunk, monkeypatch):
    monkeypatch.setattr(line_dedup.edit_links, "__defaults__", (2, chunk))
    near = [
        (i, j)
        for i, x in enumerate(reworded)
        for j, y in enumerate(reworded[:i])
        if abs(len(x) - len(y)) <= 25 and levenshtein(x, y) <= max(2, max(len(x), len(y)) // 20)
    ]
    want = merged(len(reworded), near)
    found = line_dedup.scan(spark.createDataFrame(list(enumerate(reworded)), "doc_id long, text string")).collect()
    removed = {r["doc_id"] for r in found if r["n_removed"]}
    assert removed == {k for k, w in enumerate(want) if w != k} and len(removed) > 20


def test_short_lines_repeat_exactly(spark, tmp_path):
    rows = [(1, "Read more\n\nown line of the first document here"), (2, "Read more\nRead mora\n\n \n"), (3, " \nx\nx"), (None, "x")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.lines(spark, str(tmp_path)).collect()}
    assert {d: r["removed"] for d, r in found.items()} == {1: [], 2: [0], 3: [2], None: [0]}
    assert (found[2]["kept_in"], found[3]["kept_in"], found[None]["kept_in"]) == ([1], [3], [3])


def test_keys_of_lines_travel_packed(spark):
    """A few bytes a key, a row for a block of lines and a bucket; every line may lose `reach` edits' worth of q-grams."""
    texts = [" ".join(f"w{(k * 31 + j * j * 7) % 997}" for j in range(40)) for k in range(3000)]
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, line string").coalesce(1)
    ranks = spark.sparkContext.broadcast(line_dedup._ranks(lines, len(texts), 2, 20))
    rows = line_dedup.keys(lines, 2, 20, ranks, 2).collect()
    n = sum(len(r["places"]) // 2 for r in rows)
    assert sorted(r["bucket"] for r in rows) == [0, 1, 2, 3] and n > 10 * len(texts)
    assert sum(len(r["keys"]) + len(r["places"]) for r in rows) == 6 * n
    for edits in range(12):
        for q, shortest, end in line_dedup._lengths(edits, 20):
            assert all((line_dedup.reach(k, edits) + 1) * q <= k for k in range(max(20, shortest), min(end, 3000)))


@pytest.mark.parametrize("words", [1, 2, 3])
def test_bands_of_several_words(words):
    """Each pair has a limit of its own, up to what its words hold."""
    draw = random.Random(words)
    pairs, limits = [], []
    for _ in range(60):
        text = "".join(draw.choices("abcd ", k=draw.randint(150, 260)))
        other = list(text)
        for at in sorted(draw.sample(range(len(text)), draw.randint(0, 60)), reverse=True):
            other[at : at + 1] = draw.choice([[], ["e"], ["e", "f"]])
        pairs.append(edit_distance._trimmed(text + "x", "".join(other) + "y"))
        limits.append(draw.randint(0, 32 * words - 2))
    kept = [k for k, (x, y) in enumerate(pairs) if len(x) - len(y) <= limits[k] < len(x)]
    pairs, limits = [pairs[k] for k in kept], [limits[k] for k in kept]
    found = edit_distance._banded([x for x, _ in pairs], [y for _, y in pairs], np.array(limits), words)
    assert len(kept) > 30
    assert (found <= limits).tolist() == [edit_distance._distance(*p) <= most for p, most in zip(pairs, limits, strict=True)]


def test_rounds_of_groups(spark, lined, monkeypatch):
    """Few members a round give the same rows."""
    df = spark.createDataFrame(lined, "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "ROUND", 500)
    assert {r["doc_id"]: r["removed"] for r in line_dedup.scan(df).collect()} == plain_removed(lined)


def test_counts_of_characters_rule_out_no_duplicate():
    draw = random.Random(8)
    lines = ["".join(draw.choices("abcdefgh éß漢字", k=draw.randint(20, 600))) for _ in range(200)]
    lines += [mutated(draw, x, line_dedup.limit(len(x), 2)) for x in lines] + ["a" * 300, "a" * 310]
    counts = np.minimum(line_dedup._letters(lines), 255).astype(np.uint8)
    kept = line_dedup._Sketches(np.array([len(x) for x in lines]), counts, 1, 2)
    assert counts.shape == (402, 32) and kept.possible(np.arange(200), np.arange(200, 400)).all() and kept.possible(np.array([400]), np.array([401])).all()
    assert kept.possible(np.arange(199), np.arange(1, 200)).mean() < 0.1


def test_stored_steps_leave_no_shuffle_files(spark, tmp_path):
    local = spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())

    def shuffled():
        return set(glob.glob(f"{local}/**/blockmgr-*/*/shuffle_*.data", recursive=True))

    before = shuffled()
    rows = spark.range(50_000).select((F.col("id") % 20_000).alias("k")).groupBy("k").count()
    found = common.stored(rows, f"{tmp_path}/rows")
    end = time.time() + 10
    while shuffled() - before and time.time() < end:
        time.sleep(0.1)
    assert not shuffled() - before
    assert found.count() == 20_000 and found.dtypes == rows.dtypes


def test_long_pairs_are_verified_in_bounded_memory():
    """Memory follows the characters told at once, not the longest of many pairs."""
    draw = random.Random(12)
    pairs = []
    for k in range(400):
        text = "".join(draw.choices("abcdefgh ", k=4000))
        pairs.append((f"x{text}y", mutated(draw, f"z{text[:2000]}", 150 + k % 100) + f"{text[2000:]}w"))
    tracemalloc.start()
    found = edit_distance.within(pairs, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < found.sum() < 400 and peak < 48 << 20
    assert found[::40].tolist() == [edit_distance._distance(*edit_distance._trimmed(*p)) <= 200 for p in pairs[::40]]


@pytest.mark.parametrize("most", [0, 3, 40, 300])
def test_bands_in_one_number(most):
    draw = random.Random(most)
    for _ in range(60):
        text = "".join(draw.choices("abcd ", k=draw.randint(most + 10, most + 400)))
        x, y = edit_distance._trimmed(f"{text}x", f"{mutated(draw, text, most)}y")
        if len(x) - len(y) <= most < len(x):
            assert edit_distance._near(x, y, most) == (edit_distance._distance(x, y) <= most)


def test_first_grams_survive_the_edits():
    """Those taken come first in the order of all, and more than `most` of them don't overlap."""
    draw = np.random.default_rng(4)
    for q in (6, 12):
        sizes = draw.integers(20 if q == 6 else 57, 60 if q == 6 else 900, 40)
        most = np.array([line_dedup.reach(n, 2) for n in sizes.tolist()])
        order = draw.integers(0, 1 << 9, (sizes - q + 1).sum()).astype(np.uint16)
        line, place = line_dedup._chosen(order, sizes, most, q)
        ends = np.cumsum(sizes - q + 1)
        for k, end in enumerate(ends.tolist()):
            own, at = order[end - sizes[k] + q - 1 : end], np.sort(place[line == k])
            assert at.tolist() == np.flatnonzero(own <= own[at].max()).tolist()
            apart, free = 0, 0
            for p in at.tolist():
                if p >= free:
                    apart, free = apart + 1, p + q
            assert apart > most[k]


def test_groups_of_the_same_lines_are_verified_once(spark):
    """Nearly equal groups are one; groups with no more than a line in common stay."""
    own = [[k for k in range(100) if k < 5 or k > 94 or (k + g) % 10] for g in range(30)]
    own += [[1000, *range(2000 + 10 * g, 2010 + 10 * g)] for g in range(10)]
    for chunk in (512, 20):
        rows = [(len(x), x[0], x[-1], g, k, x[k * chunk : (k + 1) * chunk]) for g, x in enumerate(own) for k in range(-(-len(x) // chunk))]
        groups = spark.createDataFrame(rows, "n long, x long, y long, who long, slice int, ids array<long>")
        for end in ("x", "y"):
            found = {}
            for r in line_dedup._united(groups, chunk, end).collect():
                assert len(r["ids"]) <= chunk
                found.setdefault((r["n"], r["x"], r["y"], r["who"]), []).extend(r["ids"])
            assert sorted(sorted(x) for x in found.values()) == [list(range(100)), *own[30:]]


def test_united_groups_against_brute_force(spark, lined, monkeypatch):
    df = spark.createDataFrame(lined, "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "MANY", 1)
    assert {r["doc_id"]: r["removed"] for r in line_dedup.scan(df).collect()} == plain_removed(lined)


def test_rounds_of_pairs(spark, lined, monkeypatch):
    """Few pairs a round give the same rows."""
    df = spark.createDataFrame(lined, "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "STAR_ROUND", 40)
    assert {r["doc_id"]: r["removed"] for r in line_dedup.scan(df).collect()} == plain_removed(lined)


def test_large_groups_against_brute_force(spark, lined, monkeypatch):
    df = spark.createDataFrame(lined, "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "MANY", 2)
    assert {r["doc_id"]: r["removed"] for r in line_dedup.scan(df).collect()} == plain_removed(lined)


def test_rare_grams_come_first(spark):
    """Each q-gram of a line's own words is in a sample once, like most of a corpus in none; frequent words come last."""
    draw = random.Random(21)
    common_words = ["".join(draw.choices("abcdefgh", k=4)) for _ in range(12)]
    texts = [" ".join([*draw.choices(common_words, k=25), *("".join(draw.choices("klmnopqrstuvwxyz", k=5)) for _ in range(24))]) for _ in range(600)]
    lines = spark.createDataFrame(list(enumerate(texts)), "id long, line string").coalesce(1)
    tables = line_dedup._ranks(lines, len(texts), 2, 20)
    codes = line_dedup._codes(texts[:1])
    order = line_dedup._order(line_dedup._hashes(codes, 12), codes, 12, tables)
    assert order[:100].min() > order[130:].max()


def test_many_pairs_of_a_few_strings():
    """One string in many pairs, of any length, at the edges of words."""
    draw = random.Random(22)
    for most in (0, 2, 30, 31, 62, 63):
        texts = ["".join(draw.choices("abcd ü", k=draw.choice([1, 63, 64, 65, 128, most + 1, 200]))) for _ in range(6)]
        texts += [mutated(draw, x, most + draw.randint(-1, 1)) if most else x for x in texts for _ in range(3)]
        pairs = [(x, y) for x in texts for y in texts]
        found = edit_distance.within(pairs, most)
        assert found.tolist() == [edit_distance._distance(*map(edit_distance._codes, sorted(p, key=len, reverse=True))) <= most if all(p) else max(map(len, p)) <= most for p in pairs]
