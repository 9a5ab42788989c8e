"""Quality rules: repetition inside a document, and lines that many documents of a host share.

The base rules look at one document. The cross-document rule hashes each normalised line,
counts for every (host, line) how many different documents hold it, and removes a line that
more than ``least_documents`` of them hold, however large the host is. In small hosts a line
also goes if two documents or more, and more than ``host_share`` of the host's, hold it. A
document is depleted, and rejected, when lines of it are removed and fewer than ``least_chars``
characters stay or more than ``depleted_share`` of them go; every other document that holds
common lines goes on without them, as ``clean_text``. Exact copies of one text count as one document, so a
copied document does not condemn its own lines.

Everything is DataFrame expressions. For the counts only hashes and small numbers are shuffled:
one line is one row of numbers, pre-aggregated before the shuffle, and a line that half of all
rows hold is one row per task. The places of removed lines are a table with one row per document
that holds any; the documents meet it by id, text hash and host. Spark broadcasts it if it is small.

Defined results: null and empty texts have no words and fail the base rules. A null host is
a host of its own. Repeated rows give repeated, equal results. An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.tables import stored
from terrace.llm.texts import SPACE, WORD, each_index, let, words

WINDOW = 5
LEAST_DOCUMENTS = 10
HOST_SHARE = 0.05
LEAST_CHARS = 50
DEPLETED_SHARE = 0.5
STATS = "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint>"


def covered(grams: Column) -> Column:
    """Words inside windows whose hash occurs twice or more; window i covers words i to i + 4."""
    same = lambda p, i, x: F.coalesce(F.get(p, i)["g"] == x["g"], F.lit(False))
    repeated = let(
        F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
        lambda p: F.filter(p, lambda x, i: same(p, i - 1, x) | same(p, i + 1, x)),
    )
    return F.aggregate(
        F.sort_array(F.transform(repeated, lambda x: x["i"])),
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total")),
        lambda acc, i: F.struct(i.alias("last"), (acc["total"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("total")),
        lambda acc: acc["total"],
    )


def repeated_words(tokens: Column) -> Column:
    """Of the words, those inside a 5-word window that the text holds twice or more."""
    grams = let(
        F.transform(tokens, lambda w: F.xxhash64(w)),
        lambda h: each_index(
            F.size(h) - (WINDOW - 1), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]), "array<bigint>"
        ),
    )
    return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD)), lambda f: F.size(f) - F.size(F.array_distinct(f)))


def base_measures(text: Column) -> Column:
    """The measures of one document, as a struct of longs."""
    text = F.coalesce(text, F.lit(""))
    return let(
        words(text),
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            F.length(F.regexp_replace(text, SPACE + "+", "")).alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).alias("n_symbols"),
            duplicate_lines(text).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
        ).cast(STATS),
    )


def line_hashes(text: Column) -> Column:
    """(hash, characters, place) of each line with a word; case, digits and outer white space do not tell lines apart."""
    low = F.lower(F.coalesce(text, F.lit("")))
    normal = F.when(low.rlike("[0-9]"), F.regexp_replace(low, "[0-9]+", "0")).otherwise(low)
    return F.filter(
        F.transform(
            F.split(normal, "\n"),
            lambda line, at: let(F.btrim(line, F.lit(" \t\x0b\f\r")), lambda x: F.struct(F.xxhash64(x).alias("line"), F.length(x).alias("n"), at.alias("at"))),
        ),
        lambda x: x["n"] > 0,
    )


def common_lines(documents: DataFrame, least_documents: int, host_share: float, text: str, host: str) -> DataFrame:
    """(host, line) above one of the limits."""
    held = documents.select(
        F.xxhash64(host).alias("host"),
        F.xxhash64(text).alias("content"),
        F.explode(F.array_distinct(F.transform(line_hashes(F.col(text)), lambda x: x["line"]))).alias("line"),
    ).distinct()
    counts = held.groupBy("host", "line").agg(F.count("*").alias("documents"))
    hosts = (
        documents.select(F.xxhash64(host).alias("host"), F.xxhash64(text).alias("content")).distinct().groupBy("host").agg(F.count("*").alias("all"))
    )
    above = (F.col("documents") > least_documents) | (F.col("documents") > host_share * F.col("all"))
    return counts.where(F.col("documents") > 1).join(hosts, "host").where(above).select("host", "line")


def removed_lines(documents: DataFrame, common: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """(doc_id, content, host, removed): places and characters of the common lines, for each document that holds any."""
    opened = documents.select(
        F.col(doc_id).alias("_doc"),
        F.xxhash64(text).alias("_content"),
        F.xxhash64(host).alias("host"),
        F.explode(line_hashes(F.col(text))).alias("x"),
    ).select("_doc", "_content", "host", "x.*")
    # Repeated rows hold the same lines in the same places, so a set counts them once.
    held = opened.join(common, ["host", "line"]).groupBy("_doc", "_content", F.col("host").alias("_host"))
    return held.agg(F.collect_set(F.struct("at", "n")).alias("_removed"))


def quality_rules(
    documents: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    host_share: float = HOST_SHARE,
    least_chars: int = LEAST_CHARS,
    depleted_share: float = DEPLETED_SHARE,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """One row per document: its measures, characters in its lines and in removed lines, ``clean_text`` (the
    text without its common lines), base_failed, kept. The base rules look at the text as given."""
    common = common_lines(documents, least_documents, host_share, text, host)
    removed = stored(removed_lines(documents, common, doc_id, text, host), "removed-lines")
    rows = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("content"), F.xxhash64(host).alias("host")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("content") == F.col("_content")) & (F.col("host") == F.col("_host"))
    chars = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda total, x: total + x["n"])
    places = F.transform("_removed", lambda x: x["at"])
    # A hash set tells which places stay, so the time is linear in the lines and in the removed ones.
    left_places = lambda lines: F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), places)
    cleaned = let(F.split("text", "\n"), lambda lines: F.array_join(F.transform(left_places(lines), lambda at: F.get(lines, at)), "\n"))
    clean = F.when(F.col("_removed").isNotNull(), cleaned).otherwise(F.col("text"))
    rows = rows.join(removed, same, "left").select(
        "doc_id",
        base_measures(F.col("text")).alias("stats"),
        chars(line_hashes(F.col("text"))).alias("line_chars"),
        F.coalesce(chars(F.col("_removed")), F.lit(0)).alias("removed_chars"),
        clean.alias("clean_text"),
    )
    rows = rows.select("doc_id", "stats.*", "line_chars", "removed_chars", "clean_text")
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("line_chars") - F.col("removed_chars")
    depleted = (F.col("removed_chars") > 0) & ((left < least_chars) | (F.col("removed_chars") > depleted_share * F.col("line_chars")))
    return rows.withColumn("base_failed", base_failed).withColumn("kept", ~base_failed & ~depleted)
