"""Rules on documents, and a verdict on their hosts.

A document fails a base rule if it has fewer than ``MIN_WORDS`` words, or if more than
``MAX_REPEAT_PERCENT`` of its words lie in windows of ``WINDOW`` words that occur at least twice
in it. Failures are counted per rule and host; each host's rate is shrunk towards all hosts by a
beta prior fitted to their rates by moments, and a host above ``MAX_HOST_RATE`` is rejected
with all its documents.

Windows are compared within a row by 64-bit hashes, and equal hashes are confirmed word by
word, so no word or window is ever shuffled.

Defined cases: a null text has no words; documents without a host (null or empty) share
none and are judged by the base rules alone; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope.llm.common import WORD_GAPS, let, named
from rentscope.session import materialise

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_HOST_RATE = 0.5
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
RULES = ("short", "repeated")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_GAPS), "")


def _window_hashes(words: Column) -> Column:
    """One hash per window, in order; words are joined to pairs, fours and eights."""

    def doubled(hashes: Column, step: int) -> Column:
        return let(hashes, lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step))))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    step = 1
    while step < WINDOW:
        hashes, step = doubled(hashes, step), 2 * step
    return F.slice(hashes, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def _covered_words(words: Column, hashes: Column) -> Column:
    """Words in windows whose words occur at another place too."""

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(
            (a["h"] == b["h"])
            & (F.slice(words, a["i"] + 1, WINDOW) == F.slice(words, F.coalesce(b["i"], F.lit(0)) + 1, WINDOW)),
            F.lit(False),
        )

    def starts(sorted_windows: Column) -> Column:
        found = F.filter(
            sorted_windows,
            lambda x, k: same(x, F.get(sorted_windows, k - 1)) | same(x, F.get(sorted_windows, k + 1)),
        )
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(places: Column) -> Column:
        own = F.transform(
            places, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, x: total + x)

    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(placed, lambda s: let(starts(s), covered))


def repeat_words(words: Column) -> Column:
    """Words in repeated windows; most texts have none, which distinct hashes show at once."""
    return let(
        _window_hashes(words),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            _covered_words(words, h)
        ),
    )


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def statistics(text: Column) -> Column:
    """A struct of the counts the rules look at."""
    return let(
        words_of(text),
        lambda words: F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            _dup_lines(text).alias("n_dup_lines"),
            repeat_words(words).alias("n_repeat_words"),
        ),
    )


def failures(stats: Column) -> Column:
    """Which base rules the counts fail."""
    return F.struct(
        (stats["n_words"] < MIN_WORDS).alias("short"),
        (stats["n_repeat_words"] * 100 > stats["n_words"] * MAX_REPEAT_PERCENT).alias("repeated"),
    )


def measured(docs: DataFrame, host_col: str, keep: list[str]) -> DataFrame:
    """The kept columns of every row with _host, _stats and _failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    host = F.nullif(F.col(host_col).cast("string"), F.lit(""))
    rows = docs.select(*keep, host.alias("_host"), statistics(text).alias("_stats"))
    return rows.withColumn("_failed", failures(F.col("_stats")))


def rejected_hosts(rows: DataFrame) -> DataFrame:
    """Hosts whose shrunk failure rate in some rule is above the limit."""
    hosts = rows.where("_host is not null").groupBy("_host").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.col(f"_failed.{rule}")).alias(rule) for rule in RULES),
    )
    hosts = materialise(hosts, "host-counts")
    sums = hosts.agg(
        F.count(F.lit(1)).alias("hosts"),
        F.sum("n").alias("n"),
        *(F.sum(rule).alias(rule) for rule in RULES),
        *(F.sum(F.col(rule) * F.col(rule) / F.col("n")).alias(f"{rule}_sq") for rule in RULES),
    ).first()
    verdict = F.lit(False)
    for rule in RULES:
        a, b = beta_prior(sums.hosts, sums.n or 0, sums[rule] or 0, sums[f"{rule}_sq"] or 0.0)
        verdict |= (F.col(rule) + F.lit(a)) / (F.col("n") + F.lit(a + b)) > MAX_HOST_RATE
    return materialise(hosts.where(verdict).select("_host"), "host-rejected")


def beta_prior(hosts: int, n: int, failed: int, squares: float) -> tuple[float, float]:
    """Both parameters of the beta distribution whose moments fit the hosts' rates.

    ``squares`` is the sum over hosts of failed^2 / n. The variance within hosts is taken off;
    if nothing is left, all hosts are as one and the prior weighs as much as all documents.
    """
    mean = failed / n if n else 0.0
    spread = mean * (1 - mean)
    between = squares / n - mean * mean - spread * hosts / n if n else 0.0
    weight = spread / between - 1 if between > 0 else float(n)
    weight = min(max(weight, 1.0), max(float(n), 1.0))
    return mean * weight, (1 - mean) * weight


def assess(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """One row per document: its counts, whether it fails a base rule, and the verdict."""
    rows = materialise(
        measured(docs, host_col, [F.col("doc_id").cast("long").alias("doc_id")]), "rule-rows"
    )
    bad = rejected_hosts(rows).withColumn("_bad", F.lit(True))
    failed = F.col("_failed.short") | F.col("_failed.repeated")
    return rows.join(bad, "_host", "left").select(
        "doc_id",
        "_stats.*",
        failed.alias("base_failed"),
        (~failed & F.col("_bad").isNull()).alias("kept"),
    )


def keep_good(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """The rows of documents that pass the rules and whose host is not rejected.

    Rows are stored once with their counts; those that fail are stored without their text,
    for their host's count only.
    """
    columns = docs.columns
    whole = F.struct(*map(named, columns)).alias("_row")
    rows = measured(docs.select(whole, *_clean_names(docs, host_col)), "_source_of", ["_row"])
    failed = F.col("_failed.short") | F.col("_failed.repeated")
    rows = rows.select("_host", "_failed", F.when(~failed, F.col("_row")).alias("_row"))
    rows = materialise(rows, "rule-rows")
    good = rows.where("not (_failed.short or _failed.repeated)")
    return good.join(rejected_hosts(rows), "_host", "left_anti").select("_row.*")


def _clean_names(docs: DataFrame, host_col: str) -> list[Column]:
    return [F.col("text").alias("text"), named(host_col).alias("_source_of")]
