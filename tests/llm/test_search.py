"""Decontamination, pages and languages."""

import random

import numpy as np
import pytest

from plantflow.llm import decontamination, html_extraction, language_id, suffixes
from plantflow.llm.html_extraction import Page
from tests.compare import data


def test_suffix_array():
    draw = random.Random(2)
    for _ in range(200):
        stream = [draw.randint(0, 3) for _ in range(draw.randint(0, 40))]
        ends = [k for k, x in enumerate(stream) if x == 0]
        ranked = [x + len(ends) if x else ends.index(k) for k, x in enumerate(stream)]
        want = sorted(range(len(stream)), key=lambda k: ranked[k:])
        assert suffixes.suffix_array(np.array(stream, dtype=np.int64)).tolist() == want


def test_index_against_scan():
    draw = random.Random(3)
    for _ in range(100):
        stream = np.array([draw.randint(0, 5) for _ in range(draw.randint(1, 120))] + [0])
        index = decontamination.FMIndex(stream)
        phrases = [[draw.randint(1, 6) for _ in range(draw.randint(1, 4))] for _ in range(20)]
        lengths = np.array([len(p) for p in phrases])
        rows = np.array([p + [0] * (4 - len(p)) for p in phrases])
        lo, hi = index.search(rows, lengths)
        for p, a, b in zip(phrases, lo.tolist(), hi.tolist(), strict=True):
            want = [k for k in range(len(stream)) if stream[k : k + len(p)].tolist() == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def plain_search(text, items):
    words = decontamination.words_of(text)
    hit, owners = set(), set()
    for item, t in items:
        own = decontamination.words_of(t)
        for k in range(max(1, len(own) - 12) if own else 0):
            phrase = own[k : k + 13]
            for i in range(len(words) - len(phrase) + 1):
                if words[i : i + len(phrase)] == phrase:
                    hit |= set(range(i, i + len(phrase)))
                    owners |= set() if item is None else {item}
    return len(words), hit, sorted(owners)


@pytest.mark.parametrize("block_bytes", [1 << 22, 200])
def test_decontamination_against_brute_force(spark, block_bytes, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    draw = random.Random(9)
    words = [f"w{k}" for k in range(6)] + ["É", "9"]
    sentence = lambda n: " ".join(draw.choices(words, k=n))
    items = [(k, sentence(draw.choice([1, 3, 12, 13, 14, 30]))) for k in range(8)] + [(None, sentence(5)), (8, None), (9, "")]
    texts = [None, "", "W0,w1;"] + [
        sentence(draw.randint(0, 40)) + draw.choice([" ", ".\n"]) + draw.choice(items)[1].upper() + " " + sentence(3)
        for _ in range(60)
        if (items := [x for x in items if x[1]])
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontamination._blocks(bench)[0] == (1 if block_bytes > 1000 else pytest.approx(3, abs=2))
    for r in decontamination.search(docs, bench, keep=["doc_id"]).collect():
        n, hit, owners = plain_search(texts[r["doc_id"]], items)
        spans = [k for a, b in r["spans"] for k in range(a, b)]
        assert (r["n_words"], sorted(hit), owners) == (n, spans, r["items"])


def test_clean_and_cut(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    docs = [(1, f"before {passage} after"), (2, "nothing here"), (3, passage + " filler" * 500), (4, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(5, passage)], "item_id long, text string")
    assert sorted(r["doc_id"] for r in decontamination.clean(df, bench).collect()) == [2, 3, 4]
    assert decontamination.without_spans("Ab, cd! ef", [[1, 2]]) == "Ab, ! ef"


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<article><h1>T&eacute;l &amp; x</h1><p>One<b>two</b> three<p>four</article><p>out", ["Tél & x", "Onetwo three", "four"]),
        ("<nav>menu</nav><main><p>in  \n here</p><aside>side</aside></main><footer>f</footer>", ["in here"]),
        ("<article>a<br>b<script>if (a</b) '</p>'</script><!-- <p> no --> c</article>", ["a b c"]),
        ("<article><p>kept</p><section class='comments'><article>troll</article></section></article>", ["kept"]),
        ("<article><header><h1>Head</h1></header><form>f<input></form><p>p &lt; q &am", ["Head", "p < q &am"]),
        ("<article><table><tr><td>1<td>2<tr><td>3</table><ul><li>a<li>b</ul></article>", ["1", "2", "3", "a", "b"]),
        ("<article><p>x</p><div class='ad'>buy<p>now</div><p title=\"a > b\">y</p><p unclosed", ["x", "y"]),
        ("", None),
        ("<div class='cookie-notice'>We use</div><p>body</p>", None),
    ],
)
def test_blocks(source, want):
    page = Page(source)
    assert page.text == want
    if source.endswith("body</p>"):
        assert page.open == ["body"] and page.outside == ["We use", "body"]


@pytest.mark.parametrize(
    "opening",
    [
        '<section id="related-work">', '<section id="search">', '<h2 id="login">', '<h2 id="notification-api">', '<h2 id="copyright">',
        '<div class="ad-hoc">', '<div class="section" id="search">', '<div id="related-work">', '<div class="social-science">',
    ],
)
def test_slugs_inside_articles_are_no_hints(opening):
    name = opening[1:].split()[0]
    for part in ("article", "main"):
        assert Page(f"<{part}><p>a</p>{opening}kept</{name}><p>z</p></{part}>").text == ["a", "kept", "z"]


@pytest.mark.parametrize(
    "opening",
    [
        '<div class="x comments">', '<div class="comment-list">', '<div class="share-buttons">', '<div id="ad-slot-2">', '<div id="comments">',
        '<section class="related-posts">', '<div class="cookie-notice">', '<ul class="social__links">', '<section class="newsletter" id="x">',
    ],
)
def test_marked_parts_inside_articles_go(opening):
    name = opening[1:].split()[0]
    assert Page(f"<article><p>a</p>{opening}gone</{name}><p>z</p></article>").text == ["a", "z"]


def test_a_paragraph_ends_whatever_it_leaves_open():
    assert Page(f"<article><p class='ad'>{'<b>' * 30}buy<p>kept<p>too</article>").text == ["kept", "too"]
    assert Page("<article><p>a<button><p>x</button>b<table><tr><td><p>c<p>d</table><p>e</article>").text[-3:] == ["c", "d", "e"]


@pytest.mark.parametrize("chunk", [8 << 20, 100])
def test_repeated_stretches_go_from_open_pages(spark, chunk, monkeypatch):
    monkeypatch.setattr(html_extraction, "CHUNK_BYTES", chunk)
    notice = "subscribe to our weekly letter and get all of the news first every day"
    own = lambda k: f"story {k} tells what page {k} alone knows about {k}"
    rows = [(k, f"http://h{k % 2}/x{k}", f"<body><div>{notice}</div><div>{own(k)}</div>") for k in range(8)]
    rows += [(50, "http://rare/1", f"<div>{notice}</div>"), (51, "http://h0/a", f"<article>{notice}</article>")]
    found = {r["page_id"]: r for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[k]["text"] == own(k) for k in range(8))
    assert found[50]["text"] == found[51]["text"] == notice  # two hosts, and a declared article
    assert found[51]["declared"] and not found[50]["declared"] and found[50]["n_chars"] == len(notice)


@pytest.mark.parametrize("chunk", [8 << 20, 100])
def test_declared_pages_count_for_open_ones(spark, chunk, monkeypatch):
    """Pages with one chrome count each; windows go over marked blocks; short blocks count as a whole."""
    monkeypatch.setattr(html_extraction, "CHUNK_BYTES", chunk)
    menu, foot = "home world sport money weather travel books music", "all of our rights are kept by the paper of record"
    chrome = lambda x: f"<div>{menu}</div>{x}<div>{foot}</div><div>Top of page</div>"
    rows = [(k, f"http://a/{k}", chrome(f"<article>text {k}</article>")) for k in range(5)]
    rows += [(10, "http://a/open", chrome("<div>an own text of one page</div>"))]
    split = "<div>one two three four</div><div class='ad'>buy this</div><div>five six seven eight</div>"
    rows += [(20 + k, f"http://b/{k}", f"{split}<div>{'own words of page number ' + str(k)}</div>") for k in range(3)]
    rows += [(30 + k, f"http://c/{k}", "<div>the same page crawled again and again and again</div><div>Top</div>") for k in range(4)]
    found = {r["page_id"]: r["text"] for r in html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {
        **{k: f"text {k}" for k in range(5)},
        10: "an own text of one page",
        **{20 + k: f"own words of page number {k}" for k in range(3)},
        **{30 + k: "the same page crawled again and again and again\nTop" for k in range(4)},
    }


@pytest.mark.parametrize("chunk", [8 << 20, 100])
def test_repeated_stretches_decide_about_what_declared_pages_leave_open(spark, chunk, monkeypatch):
    """Blocks with a mere hint in articles, and titles beside them; versions of one article count once."""
    monkeypatch.setattr(html_extraction, "CHUNK_BYTES", chunk)
    plug, short = "get the best of our stories in a letter every day of the week", "Read on"
    strip = f"<div class='newsletter-strip'><p>{plug}</p><p>{short}</p></div>"
    essay = "voting in small towns and what it tells about trust in large ones"
    said = lambda k: f"<p>story {k}</p>{strip}<div class='social-science'><p>{essay} {k} {plug}</p></div><p>end {k}</p>"
    rows = [(k, f"http://a/{k}", f"<main><h1>Title {k}</h1><article>{said(k)}</article></main>") for k in range(4)]
    rows += [(10 + k, f"http://b/{k}", f"<main><h1>The Daily</h1><article>{said(0)}</article></main>") for k in range(4)]
    rows += [(20 + k, f"http://c/{k}", f"<main><h1>The Daily</h1><article><h2>News {k}</h2></article><h1>{k}</h1></main>") for k in range(3)]
    rows += [(30, "http://a/30", f"<main><h1>x</h1><p>{plug}</p></main>"), (31, "http://a/31", "<main><h1>A</h1><p>b</p></main>")]
    found = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["declared"] and r["n_chars"] == len(r["text"]) for r in found)
    assert {r["page_id"]: r["text"] for r in found} == {
        **{k: f"Title {k}\nstory {k}\n{essay} {k} {plug}\nend {k}" for k in range(4)},
        **{10 + k: f"The Daily\nstory 0\n{plug}\n{short}\n{essay} 0 {plug}\nend 0" for k in range(4)},
        **{20 + k: f"News {k}" for k in range(3)},
        30: f"x\n{plug}",
        31: "A\nb",
    }


@pytest.mark.parametrize("chunk", [8 << 20, 100])
def test_repeated_stretches_are_told_of_every_host(spark, chunk, monkeypatch):
    """Where all pages declare their articles, too; what articles share does not count."""
    monkeypatch.setattr(html_extraction, "CHUNK_BYTES", chunk)
    menu, shared = "home world sport money weather travel books music arts food", "words that all of the articles of a host have in them"
    page = lambda k, x: f"<nav>{x}</nav><article>{shared}</article><footer>{k} foot</footer>"
    rows = [(k, f"http://a/{k}", page(k, menu)) for k in range(4)] + [(10 + k, f"http://b/{k}", page(k, menu if k < 2 else "x")) for k in range(4)]
    rows += [(20, None, None), (21, "http://a/open", f"<div>{menu}</div><div>own</div>")]
    found = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["n_repeated"] for r in found} == {**{k: 3 for k in (0, 1, 2, 3, 21)}, **{10 + k: 0 for k in range(4)}, 20: 0}
    assert {r["page_id"]: r["text"] for r in found} == {**{k: shared for k in (*range(4), *range(10, 14))}, 20: "", 21: "own"}


def test_rows_that_differ_in_what_is_null(spark):
    rows = [(1, "plain body text one", None), (1, None, "plain body text one"), (None, "plain body text one", "1"), (None, None, None)]
    found = html_extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(((r["page_id"], r["url"], r["text"]) for r in found), key=str) == sorted(
        [(1, "plain body text one", ""), (1, None, "plain body text one"), (None, "plain body text one", "1"), (None, None, "")], key=str
    )


def test_articles_of_the_sample(spark):
    pages = spark.read.parquet(f"{data('sf0.001')}/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_extraction.extract(pages).collect():
        inner = sources[r["page_id"]].split("<article>")[1].split("</article>")[0]
        assert r["text"].split("\n")[0] in " ".join(Page(f"<main>{inner}").text)
        assert r["declared"] and "track(" not in r["text"] and "©" not in r["text"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{data('sf0.01')}/documents.parquet")
    langs, table = language_id.train(docs.filter("doc_id % 2 = 0"))
    held = docs.filter("doc_id % 2 = 1 AND n_chars > 40").collect()
    right = sum(langs[int(np.argmax(language_id.text_scores(r["text"], table)))] == r["lang"] for r in held)
    assert right / len(held) > 0.98


def test_evidence_beyond_the_text(spark):
    """A page without words takes its host's language; a wrong lang attribute doesn't win over the text."""
    docs = spark.read.parquet(f"{data('sf0.01')}/documents.parquet").filter("n_chars > 200")
    german, french = ([r["text"] for r in docs.filter(f"lang = '{x}'").limit(30).collect()] for x in ("de", "fr"))
    page = "<html lang={}><article>{}</article>"
    rows = [(k, f"http://a.de/{k}", page.format("de", t)) for k, t in enumerate(german)]
    rows += [(100 + k, f"http://b.fr/{k}", page.format("de" if k == 0 else "fr", t)) for k, t in enumerate(french)]
    rows += [(200, "http://a.de/empty", ""), (201, "http://b.fr/empty", None)]
    found = language_id.identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()
    langs = {r["page_id"]: r["lang"] for r in found}
    assert all(langs[k] == "de" for k in range(len(german))) and all(langs[100 + k] == "fr" for k in range(len(french)))
    assert (langs[200], langs[201]) == ("de", "fr")
