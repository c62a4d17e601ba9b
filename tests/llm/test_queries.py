"""Registration, SQL twins, and odd input for every operator."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from plantflow.llm import (
    bpe_codec,
    decontamination,
    html_extraction,
    language_id,
    license_scan,
    line_dedup,
    periodic_runs,
    quality_ledger,
    queries,
    simhash_dedup,
    token_counts,
    token_files,
)
from tests.compare import data, database, duck_rows, spark_rows

ON_DOCS = {
    "verdicts": lambda d, b: quality_ledger.verdicts(d),
    "filtered": lambda d, b: quality_ledger.filtered(d),
    "licenses": lambda d, b: license_scan.scan(d),
    "line_scan": lambda d, b: line_dedup.scan(d),
    "line_dedup": lambda d, b: line_dedup.dedup(d),
    "simhash": lambda d, b: simhash_dedup.dedup(d),
    "one_of_each": lambda d, b: simhash_dedup.one_of_each(d),
    "search": lambda d, b: decontamination.search(d, b, keep=["doc_id"]),
    "clean": lambda d, b: decontamination.clean(d, b),
    "codec": lambda d, b: bpe_codec.decode(bpe_codec.encode(d, offsets=True)),
    "files": lambda d, b: token_files.round_trip(d),
    "counts": lambda d, b: token_counts.count(d),
    "periodic": lambda d, b: periodic_runs.find(d),
}
#: Those that return all rows.
SAME_ROWS = {"verdicts", "licenses", "line_scan", "line_dedup", "simhash", "search", "codec", "files", "counts", "periodic"}
ON_PAGES = {
    "html": lambda p, d: html_extraction.extract(p),
    "language": lambda p, d: language_id.identify(p, d),
}


def benchmark(spark):
    rows = [(1, TEXT), (1, TEXT), (2, None), (3, ""), (None, "one"), (4, "near the river")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("n", F.lit(1))


TEXT = "quick brown fox jumps over the lazy dog near the river bank today all rights reserved"


def test_one_query_an_operator():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_twin(spark, name):
    ours = spark_rows(queries.queries()[name](spark, data("sf0.001")))
    assert ours == duck_rows(database(data("sf0.001")), queries.oracle_sql()[name])
    assert len(ours[1]) == 200


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_odd_documents(spark, odd_docs, name):
    rows = ON_DOCS[name](odd_docs, benchmark(spark)).collect()
    assert len(rows) == odd_docs.count() if name in SAME_ROWS else 0 < len(rows) < odd_docs.count()


@pytest.mark.parametrize("name", sorted(ON_DOCS))
def test_no_documents(spark, odd_docs, name):
    assert ON_DOCS[name](odd_docs.limit(0), benchmark(spark).limit(0)).collect() == []


def test_no_benchmark(spark, odd_docs):
    found = decontamination.search(odd_docs, benchmark(spark).limit(0), keep=["doc_id"]).collect()
    assert all(r["spans"] == [] and r["items"] == [] for r in found) and len(found) == odd_docs.count()


@pytest.mark.parametrize("name", sorted(ON_PAGES))
def test_odd_pages(odd_pages, odd_docs, name):
    assert ON_PAGES[name](odd_pages, odd_docs).count() == odd_pages.count()
    assert ON_PAGES[name](odd_pages, odd_docs.limit(0)).count() == odd_pages.count()
    assert ON_PAGES[name](odd_pages.limit(0), odd_docs).count() == 0


def test_rest_stands_without_these_operators():
    """Nothing outside the subpackage imports it, but for the guarded entry."""
    root = os.path.dirname(entry.__file__)
    for path in glob.glob(os.path.join(root, "plantflow", "**", "*.py"), recursive=True):
        if os.sep + "llm" + os.sep not in path:
            assert "llm" not in open(path).read(), path
