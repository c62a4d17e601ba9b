"""Quality ledger and license scans."""

import itertools
import random

import pytest

from plantflow.llm import license_scan, quality_ledger


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_measurements(spark):
    texts = [
        "one two three four five one two three four five six",
        "a b\n\nc d\na b\n \na b",
        "# $ % & | < > * plain!",
        "été ñ x\x0by\x0cz w",  # no-break space is part of a word
        "w " * 40,
        None,
    ]
    found = {r["doc_id"]: r for r in quality_ledger.measurements(rows(spark, texts)).collect()}
    assert (found[0]["n_words"], found[0]["n_repeat_words"]) == (11, 10)
    assert (found[1]["n_lines"], found[1]["n_dup_lines"]) == (4, 2)
    assert (found[2]["n_symbols"], found[2]["n_exclamations"], found[2]["n_words"]) == (8, 1, 9)
    assert (found[3]["n_words"], found[3]["word_chars"]) == (6, 8)
    assert (found[4]["n_words"], found[4]["n_repeat_words"]) == (40, 40)
    assert found[5]["n_words"] == found[5]["word_chars"] == found[5]["n_dup_lines"] == 0


def test_repeated_windows_against_brute_force(spark):
    draw = random.Random(11)
    texts = [" ".join(draw.choices("abc", k=draw.randint(0, 60))) for _ in range(150)]
    for r in quality_ledger.measurements(rows(spark, texts)).collect():
        words = texts[r["doc_id"]].split()
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        hit = {i + d for i, w in enumerate(windows) if windows.count(w) > 1 for d in range(5)}
        assert r["n_repeat_words"] == len(hit)


def test_policies_and_ablations(spark):
    good = " ".join(f"word{k}" for k in range(30))
    texts = [good, "too few", good + " !!!!!!", "# " * 3 + good, "too few # # !!", good.replace("word", "w" * 30)]
    entries = quality_ledger.ledger(rows(spark, texts)).cache()
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in quality_ledger.verdicts(rows(spark, texts)).collect()}
    assert kept == {0: (False, True), 1: (True, False), 2: (False, False), 3: (False, True), 4: (True, False), 5: (False, False)}
    names = quality_ledger.POLICIES["v1"]
    failures = {r["doc_id"]: r["failures"] for r in entries.collect()}
    sets = {k: {rule.name for b, rule in enumerate(quality_ledger.RULES) if f >> b & 1} for k, f in failures.items()}
    want = {n: (sum(n in s for s in sets.values()), sum(s == {n} for s in sets.values())) for n in names}
    found = {r["rule"]: (r["n_failed"], r["n_only_this_rule"]) for r in quality_ledger.ablations(entries).collect()}
    assert found == want
    (total,) = quality_ledger.summary(entries.selectExpr("1 AS g", "failures"), "g").collect()
    assert total["n"] == 6 and total["all_fail"] == 0
    assert total["any_fails"] == sum(1 << b for b, r in enumerate(quality_ledger.RULES) if want[r.name][0])


def test_filtered_keeps_columns(spark):
    good = " ".join(f"word{k}" for k in range(30))
    df = rows(spark, ["few", good]).selectExpr("doc_id", "text", "1 AS n_words", "2 AS failures")
    (r,) = quality_ledger.filtered(df).collect()
    assert r.asDict() == {"doc_id": 1, "text": good, "n_words": 1, "failures": 2}


TEMPLATES = tuple(license_scan.Template(f"t{k}", t) for k, t in enumerate(["a b c d", "b c e", "f", "a c e g h i j", "x y z a"]))


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.75, 1.0])
def test_containment_against_brute_force(spark, threshold):
    draw = random.Random(13)
    line = lambda: " ".join(draw.choices("abcdefghijxyz", k=draw.randint(0, 8)))
    texts = ["\n".join(line() for _ in range(draw.randint(0, 4))) for _ in range(80)]
    want = set()
    for (k, text), (n, t) in itertools.product(enumerate(texts), enumerate(TEMPLATES)):
        own = set(t.text.split())
        for at, block in enumerate(text.split("\n")):
            share = len(own & set(block.split())) / len(own)
            if share >= threshold:
                want.add((k, at, n, round(share, 6)))
    found = license_scan.matches(rows(spark, texts), TEMPLATES, threshold).collect()
    assert len(found) == len(want)
    assert {(r["doc_id"], r["line"], r["template"], round(r["containment"], 6)) for r in found} == want


def test_phrases_overlap_and_ignore_marks(spark):
    texts = ["CC-BY, cc by cc by.", "the GENERAL\npublic  license", "éall rights reserved", "All Rights (Reserved)"]
    found = {r["doc_id"]: r for r in license_scan.scan(rows(spark, texts)).collect()}
    assert (found[0]["n_base"], found[0]["first_word"], found[0]["last_word"], found[0]["base_labels"]) == (3, 0, 4, "cc-by")
    assert (found[1]["base_labels"], found[1]["first_word"], found[1]["score"]) == ("gpl", 1, 1.0)
    assert (found[2]["n_base"], found[2]["first_word"], found[2]["base_labels"], found[2]["labels"]) == (0, None, "", "")
    assert found[3]["labels"] == "reserved"


def test_labels_of_the_method(spark):
    texts = ["x\nReleased under the MIT License.\ny", "Licensed under the Apache License, Version 2.0 here", "The license of MIT"]
    found = {r["doc_id"]: r for r in license_scan.scan(rows(spark, texts)).collect()}
    assert [found[k]["labels"] for k in range(3)] == ["mit", "apache-2.0", ""]
    assert found[0]["base_labels"] == "" and found[0]["score"] == 1.0 and found[2]["score"] == 0.0


def test_runs_against_brute_force(spark):
    draw = random.Random(17)
    texts = ["".join(draw.choice("abcdefghijxyz") + draw.choice(" \n") for _ in range(draw.randint(0, 40))) for _ in range(60)]
    found = {r["doc_id"]: r for r in license_scan.scan(rows(spark, texts), TEMPLATES, 0.75).collect()}
    for k, text in enumerate(texts):
        best = {}
        for t in TEMPLATES:
            own, words = set(t.text.split()), text.split()
            size = len(t.text.split()) + max(2, len(t.text.split()) // 4)
            share = max(len(own & set(words[i : i + size])) / len(own) for i in range(len(words) + 1))
            if share >= 0.75:
                best[t.label] = max(best.get(t.label, 0), share)
        assert found[k]["labels"] == ",".join(sorted(best)) and found[k]["score"] == pytest.approx(max(best.values(), default=0))


def test_notices_are_found_however_lines_break(spark):
    texts, want = [], []
    for t in license_scan.TEMPLATES:
        words = t.text.split()
        for step in (1, 2, 5, len(words)):
            wrapped = "\n".join(" ".join(words[i : i + step]) for i in range(0, len(words), step))
            texts.append(f"Some words ahead\n{wrapped}\nand some after it")
            texts.append(f"Some words ahead {wrapped} and some after it. " * 3)
            want += [t.label] * 2
    scattered = "The report was released in May under embargo. A license for MIT staff was not part of the whole deal."
    found = {r["doc_id"]: r for r in license_scan.scan(rows(spark, [*texts, scattered])).collect()}
    for k, label in enumerate(want):
        assert label in found[k]["labels"].split(",") and found[k]["score"] == 1.0
    assert found[len(texts)]["labels"] == "" and found[len(texts)]["score"] == 0.0
