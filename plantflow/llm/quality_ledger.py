"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule; a policy is a
named, versioned set of rules and costs one bitwise AND. Ablations (what would a policy keep without one of its rules?)
are aggregations over the bits and never read a text again. Everything is DataFrame functions.

A null text has no words. Words are runs of characters other than ASCII white space; windows are told apart by a 64-bit
hash of their words. Rows are handled one by one: repeated ids and texts get a row each, an empty table gives no rows,
other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantflow.llm import common

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """fails is SQL over the measurements."""

    name: str
    fails: str


#: The position of a rule is its bit; append only, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("exclamations", "10 * n_exclamations > n_words"),
    Rule("duplicate_lines", "n_lines > 3 AND 10 * n_dup_lines > 3 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
)
#: Versioned policies: a document is rejected if it fails any rule of the policy.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "exclamations", "duplicate_lines", "word_length"),
}


def mask(policy: str) -> int:
    bits = {rule.name: 1 << k for k, rule in enumerate(RULES)}
    return sum(bits[name] for name in POLICIES[policy])


def _repeat_words(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more; windows begin one word apart.

    Sorted by hash, equal windows are neighbours; sorted by place again, each adds the words the one before left out.
    """

    def covered(ranked: Column) -> Column:
        last = F.size(ranked) - 1
        again = F.filter(
            ranked,
            lambda e, j: ((j > 0) & (ranked[F.greatest(j - 1, F.lit(0))]["h"] == e["h"]))
            | ((j < last) & (ranked[F.least(j + 1, last)]["h"] == e["h"])),
        )
        return F.aggregate(
            F.sort_array(F.transform(again, lambda e: e["i"])),
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
            lambda a: a["n"],
        )

    ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
    return F.when(distinct, F.lit(0)).otherwise(common.let(ranked, covered))


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The id, the columns of keep, and what the rules look at."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    kept = [F.col(c) for c in dict.fromkeys((id_col, *keep))]
    parts = docs.select(
        *kept,
        text.alias("__text"),
        F.array_remove(F.split(text, common.WHITE_RUN), "").alias("__words"),
        F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(common.WHITE)) != "").alias("__lines"),
    )
    w, n = F.col("__words"), F.size("__words")
    starts = F.sequence(F.lit(0), n - WINDOW)
    hashes = F.when(n >= WINDOW, F.transform(starts, lambda i: F.xxhash64(*(w[i + k] for k in range(WINDOW)))))
    measured = parts.select(
        *kept,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("__text", F.lit("!")).cast("long").alias("n_exclamations"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("__hashes"),
    )
    repeated = F.when(F.col("__hashes").isNull(), F.lit(0)).otherwise(_repeat_words(F.col("__hashes")))
    # made by a generator, the measurements are finished columns: no filter on them repeats their making below
    names = [c for c in measured.columns if c != "__hashes"][len(kept) :]
    made = F.struct(*names, repeated.cast("long").alias("n_repeat_words"))
    return measured.select(*kept, F.explode(F.array(made)).alias("__m")).select(*kept, "__m.*")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Measurements and failures, a bigint with bit k set if the document fails RULES[k]."""
    failures = F.lit(0).cast("long")
    for k, rule in enumerate(RULES):
        failures = failures.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs, id_col, text_col, keep).withColumn("failures", failures)


def passes(policy: str, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def verdicts(docs: DataFrame, policy: str = "v1", keep: tuple[str, ...] = ()) -> DataFrame:
    """The ledger with base_failed and the verdict of a policy; what fails the base policy is never kept."""
    return (
        ledger(docs, keep=keep)
        .withColumn("base_failed", ~passes("base"))
        .withColumn("kept", ~F.col("base_failed") & passes(policy))
    )


def ablations(entries: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of the policy: documents failing it, and documents that only it rejects.

    Documents are first counted by failure pattern, of which there are at most 2 to the number of rules.
    """
    own = F.lit(mask(policy)).cast("long")
    patterns = entries.groupBy(F.col("failures").bitwiseAND(own).alias("pattern")).agg(F.count("*").alias("n"))
    rules = [(k, r.name) for k, r in enumerate(RULES) if r.name in POLICIES[policy]]
    listed = F.explode(F.array(*(F.struct(F.lit(1 << k).cast("long").alias("bit"), F.lit(x).alias("rule")) for k, x in rules)))
    hit = F.col("pattern").bitwiseAND(F.col("r.bit")) != 0
    alone = F.col("pattern") == F.col("r.bit")
    return (
        patterns.select("pattern", "n", listed.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(alone, F.col("n"))), F.lit(0)).alias("n_only_this_rule"),
        )
    )


def summary(entries: DataFrame, by: str) -> DataFrame:
    """Per group: the rules that any of its documents fails, and those that all of them fail, as bits."""
    return entries.groupBy(by).agg(
        F.count("*").alias("n"), F.bit_or("failures").alias("any_fails"), F.bit_and("failures").alias("all_fail")
    )


def filtered(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The documents that the policy keeps, with the columns they came with."""
    row = docs.select(F.col("doc_id"), F.col("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"))
    return verdicts(row, policy, keep=("__row",)).filter("kept").select("__row.*")
