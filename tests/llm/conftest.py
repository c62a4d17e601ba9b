import pytest
from pyspark.sql import functions as F

#: Names that operators use themselves, or give to their results.
CLASHING = (
    "id ids fp key line lines label words n n_words n_lines at tag text_key kept failures spans items start chunk "
    "decoded component first node a b word template block open outside window host scores lang_ markup"
).split()

TEXTS = [
    None,
    "",
    " \n\t ",
    "one",
    "The quick brown fox jumps over the lazy dog near the river bank today.\nAll rights reserved.",
    "The quick brown fox jumps over the lazy dog near the river bank today.\nAll rights reserved.",
    "Straße Ünïcode 😀 été ½ ²   x\r\nlicensed under CC BY-NC 4.0.",
    "a b c d e " * 3000,
    "x" * 50_000,
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, very long, repeated rows, and extra columns with the operators' own names."""
    rows = [(k, t, "en", "src") for k, t in enumerate(TEXTS)]
    rows += [(4, TEXTS[4], "en", "src"), (None, TEXTS[4], None, None), (None, None, None, None), (4, "another text under one id", "en", "src")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.select("*", *(F.lit(7).alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def odd_pages(spark):
    rows = [
        (1, "http://a.example.com/en/1", "<article><p>Hello there</p></article>"),
        (1, "http://a.example.com/en/1", "<article><p>Hello there</p></article>"),
        (2, None, None),
        (None, "not a url", ""),
        (3, "https://b.example.org/", "<p>" + "long text " * 20_000),
        (4, "https://b.example.org/x", "<div class='ad'>buy</div><p>cut of &am"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", *(F.lit(7).alias(c) for c in (*CLASHING, "text", "n_chars", "declared")))
