"""Quality rules with host-level verdicts (operator 2), DataFrame functions only.

Rules are evaluated on every whole text.  Their failures are then added up by
host (domain); a host's failure rate of each rule is shrunk towards the
corpus with a beta prior whose parameters are estimated from all hosts, so a
host with few documents keeps close to the common rate.  A host whose shrunk
rate of some rule exceeds ``host_limit`` is rejected, and the verdict is
joined back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetra.llm.common import BLANK, bind, stored, text_of

WORD = f"[^{BLANK}]+"
SYMBOL = "[#*$%&|<>]"
WINDOW = 5
#: Hosts up to which their verdicts are broadcast (about 50 bytes each).
BROADCAST_HOSTS = 1_000_000
RULES = ("short", "repeats", "symbols", "dup_lines")


def _windows(words: Column) -> Column:
    """Hashes of all windows of ``WINDOW`` words, in order."""
    return bind(words, lambda w: F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>")))


def _covered(windows: Column) -> Column:
    """Words that lie in windows whose hash occurs more than once.

    Windows are sorted with their place; those with an equal neighbour give
    their places, and each place adds the words that the one before left
    uncovered.
    """
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = bind(ordered, lambda s: F.transform(
        F.sequence(F.lit(0), F.size(s) - 1),
        lambda k: F.when((F.get(s, k)["h"] == F.get(s, k - 1)["h"]) | (F.get(s, k)["h"] == F.get(s, k + 1)["h"]),
                         F.get(s, k)["i"])))
    repeated = F.sort_array(F.filter(places, lambda p: p.isNotNull()))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(repeated, start, lambda acc, p: F.struct(
        p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")), lambda acc: acc["n"])


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                host_col: str = "source") -> DataFrame:
    """``row, id, host, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``.

    A null text counts as empty.  Equality of windows is that of a 64-bit hash.
    """
    text = F.col("text")
    parts = docs.select(
        F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), text_of(text_col).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    ).select(
        "row", "id", "host", F.length(F.regexp_replace(text, f"[{BLANK}]+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)).alias("lines"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    hashed = parts.select(
        "row", "id", "host", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _windows(F.col("words")).alias("windows"))
    return hashed.withColumn("n_repeat_words", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"), _covered(F.col("windows"))
    ).otherwise(F.lit(0).cast("long"))).drop("windows")


def rule_failures() -> dict[str, Column]:
    n = F.col("n_words")
    return {
        "short": n < 10,
        "repeats": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 100 * F.col("n_dup_lines") > 30 * F.col("n_lines"),
    }


def host_verdicts(counted: DataFrame, host_limit: float) -> DataFrame:
    """A row per host: ``host, host_docs``, the shrunk rate of each rule and ``host_ok``.

    Prior of a rule: mean m over all documents; the variance v between hosts is
    the document-weighted variance of their rates less what binomial sampling
    explains; strength a + b = m (1 - m) / v - 1, held between 1 and a million.
    """
    fails = rule_failures()
    hosts = counted.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.when(bad, 1).otherwise(0)).alias(f"f_{r}") for r, bad in fails.items()])
    hosts = stored(hosts, "rule-hosts")
    sums = hosts.agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("hosts"), *[
        s for r in RULES for s in (F.sum(f"f_{r}").alias(f"t_{r}"),
                                   F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n")).alias(f"q_{r}"))])
    priors = []
    for r in RULES:
        m = F.col(f"t_{r}") / F.col("docs")
        own = m * (1 - m)
        between = F.col(f"q_{r}") / F.col("docs") - m * m - own * F.col("hosts") / F.col("docs")
        strength = F.when(between > 0, F.greatest(F.lit(1.0), F.least(F.lit(1e6), own / between - 1))).otherwise(1e6)
        priors += [m.alias(f"m_{r}"), strength.alias(f"s_{r}")]
    joined = hosts.crossJoin(F.broadcast(sums.select(*priors)))  # one row
    rates = joined.select("host", F.col("n").alias("host_docs"), *[
        ((F.col(f"f_{r}") + F.col(f"m_{r}") * F.col(f"s_{r}")) / (F.col("n") + F.col(f"s_{r}"))).alias(f"rate_{r}")
        for r in RULES])
    return rates.withColumn("host_ok", F.greatest(*[F.col(f"rate_{r}") for r in RULES]) <= host_limit)


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  host_limit: float = 0.5) -> DataFrame:
    """One row per input row: ids, the counts, ``base_failed``, ``kept`` and the host's figures.

    A null text has no words and fails; a null host is a host of its own.
    Rows that repeat an id stay separate; an empty table gives an empty
    result; other columns of ``docs`` are not read.
    """
    counted = stored(rule_counts(docs, id_col, text_col, host_col), "rule-counts")
    hosts = stored(host_verdicts(counted, host_limit), "rule-verdicts")
    if hosts.count() <= BROADCAST_HOSTS:
        hosts = F.broadcast(hosts)
    hosts = hosts.withColumnRenamed("host", "of")
    fails = rule_failures()
    return counted.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left").withColumn(
        "base_failed", fails["short"] | fails["repeats"]
    ).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & F.col("host_ok")).alias("kept"),
        "host_docs", *[F.round(f"rate_{r}", 6).alias(f"rate_{r}") for r in RULES])
