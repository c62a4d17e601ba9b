"""Language identification of web pages by Bayesian evidence fusion.

    log P(language | page) = log P(text | language) + log P(markup | language) + log P(address | language)
                             + log prior of the host, up to a constant

* Text: byte trigrams of the text, with likelihoods trained on labelled documents. Neighbouring trigrams overlap, so
  no more than EVIDENCE of them count fully; longer texts are scaled down to that.
* Markup (the lang attribute) and address (top-level domain, and a language code at the start of the path): how often
  each value comes with each language, by what the texts alone say. A markup nobody keeps to is thereby worth nothing.
* Host priors: shares of languages of the host, smoothed with those of its domain, these with those of all pages. The
  page's own share is taken out again, so no page confirms itself.

All counts are grouped aggregations of text posteriors over all pages, combined before they are shuffled, so a host with
a third of all pages is one sum; nothing per page reaches the driver. The text model is fitted on at most TRAIN_ROWS
labelled documents, chosen by hash; its size depends on the number of languages only.

A null or empty page has no text evidence, a null url no host and no address evidence; null labels are not trained on.
Without labelled documents language and confidence are null. Ties go to the language first in the alphabet. Repeated
rows get a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantflow.llm import common, html_extraction

TRAIN_ROWS = 20_000
BUCKETS = 1 << 15
EVIDENCE = 300
#: Pseudo-pages with which a host takes over its domain's shares, and a domain those of all pages.
HOST_WEIGHT, DOMAIN_WEIGHT = 4.0, 20.0
SMOOTHING = 0.5
_LANG = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?\s*([a-zA-Z]{2,3})\b""", re.I)


def trigrams(text: str) -> np.ndarray:
    """Bucket of each byte trigram of the lower-cased text, a space before and after it."""
    raw = np.frombuffer(f" {' '.join(text.lower().split())} ".encode(), dtype=np.uint8).astype(np.uint32)
    code = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64) % BUCKETS


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> tuple[list[str], np.ndarray]:
    """Languages, and log-likelihoods of trigram buckets (bucket, language), from columns text and lang."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    total = labelled.count()
    if total > rows:
        span = 1 << 30
        labelled = labelled.filter(F.pmod(F.xxhash64("text", "lang"), F.lit(span)) < int(span * rows / total))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                own += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, own in counts.items():
            at = np.flatnonzero(own)
            arrays = [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "bucket", "n"])

    counted = labelled.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    counts = np.full((BUCKETS, len(langs)), SMOOTHING)
    index = {lang: k for k, lang in enumerate(langs)}
    at = [index[x] for x in found.column("lang").to_pylist()]
    counts[found.column("bucket").to_numpy(), at] += found.column("n").to_numpy()
    return langs, np.log(counts / counts.sum(axis=0))


def text_scores(text: str, likelihoods: np.ndarray) -> np.ndarray:
    own = trigrams(text) if text.strip() else np.empty(0, np.int64)
    return likelihoods[own].sum(axis=0) * min(1.0, EVIDENCE / max(1, len(own)))


def _scored(pages: DataFrame, likelihoods: np.ndarray) -> DataFrame:
    """page_id, url, markup, text scores by language, and the parts of the address."""
    model = pages.sparkSession.sparkContext.broadcast(likelihoods)

    def start():
        table = model.value

        def compute(sources: list) -> list:
            scores, markup = [], []
            for source in sources:
                page = html_extraction.Page(source)
                scores.append(text_scores(" ".join(page.open if page.text is None else page.text), table).tolist())
                found = _LANG.search(source or "")
                markup.append(found[1].lower() if found else "")
            return [pa.array(markup, pa.string()), pa.array(scores, pa.list_(pa.float64()))]

        return compute

    added = [T.StructField("markup", T.StringType()), T.StructField("scores", T.ArrayType(T.DoubleType()))]
    frame = common.with_computed(pages, ["page_id", "url"], "html", added, start)
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    code = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([a-zA-Z]{2})(?:[/?#]|$)", 1))
    return frame.select(
        "page_id",
        "url",
        "markup",
        "scores",
        host.alias("host"),
        F.substring_index(host, ".", -2).alias("domain"),
        F.concat(F.substring_index(host, ".", -1), F.lit("/"), code).alias("address"),
    )


def _softmax(scores: Column) -> Column:
    def shares(weights: Column) -> Column:
        total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
        return F.transform(weights, lambda x: x / total)

    return common.let(common.let(scores, lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s)))), shares)


def _totals(pages: DataFrame, by: list[str], n: int, name: str) -> DataFrame:
    """Sums of the text posteriors per group, as an array."""
    sums = pages.groupBy(*by).agg(*(F.sum(F.col("alone")[k]).alias(f"__{k}") for k in range(n)))
    return sums.select(*by, F.array(*(F.col(f"__{k}") for k in range(n))).alias(name))


def _likelihood(totals: str, overall: list[float], values: int) -> Column:
    """log P(value | language) from a value's totals, those of all values, and how many values there are."""
    parts = (F.log((F.col(totals)[k] + SMOOTHING) / (v + SMOOTHING * values)) for k, v in enumerate(overall))
    return F.array(*parts)


def identify(pages: DataFrame, docs: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, url, lang, confidence, text_lang (by the text alone), markup (null if none is declared)."""
    langs, likelihoods = train(docs, rows)
    n = len(langs)
    if not n:
        nothing = F.lit(None).cast("string")
        return pages.select(
            "page_id", "url", nothing.alias("lang"), F.lit(None).cast("double").alias("confidence"),
            nothing.alias("text_lang"), nothing.alias("markup"),
        )
    scored = common.cut(_scored(pages, likelihoods).withColumn("alone", _softmax(F.col("scores"))))
    markups, addresses = (common.cut(_totals(scored, [c], n, f"of_{c}")) for c in ("markup", "address"))
    hosts = common.cut(_totals(scored, ["domain", "host"], n, "of_host"))
    domains = hosts.groupBy("domain").agg(*(F.sum(F.col("of_host")[k]).alias(f"__{k}") for k in range(n)))
    domains = domains.select("domain", F.array(*(F.col(f"__{k}") for k in range(n))).alias("of_domain"))
    sums = markups.agg(*(F.coalesce(F.sum(F.col("of_markup")[k]), F.lit(0.0)) for k in range(n)), F.count("*")).first()
    overall, n_markups, n_addresses = list(sums[:n]), sums[n], addresses.count()
    everywhere = sum(overall) or 1.0

    def prior(k: int) -> Column:
        own = F.col("alone")[k]
        size = lambda c: F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x) - 1.0
        top = (overall[k] + SMOOTHING) / (everywhere + SMOOTHING * n)
        domain = (F.col("of_domain")[k] - own + DOMAIN_WEIGHT * top) / (size("of_domain") + DOMAIN_WEIGHT)
        return F.log(F.greatest((F.col("of_host")[k] - own + HOST_WEIGHT * domain) / (size("of_host") + HOST_WEIGHT), F.lit(1e-9)))

    joined = scored.join(hosts, ["domain", "host"]).join(domains, "domain").join(markups, "markup").join(addresses, "address")
    evidence = joined.withColumn("__m", _likelihood("of_markup", overall, n_markups)).withColumn(
        "__a", _likelihood("of_address", overall, n_addresses)
    )
    fused = F.array(*(F.col("scores")[k] + F.col("__m")[k] + F.col("__a")[k] + prior(k) for k in range(n)))
    names = F.array(*map(F.lit, langs))
    best = lambda shares: names[(F.array_position(shares, F.array_max(shares)) - 1).cast("int")]
    return evidence.withColumn("__p", _softmax(fused)).select(
        "page_id",
        "url",
        best(F.col("__p")).alias("lang"),
        F.array_max("__p").alias("confidence"),
        best(F.col("alone")).alias("text_lang"),
        F.nullif("markup", F.lit("")).alias("markup"),
    )
