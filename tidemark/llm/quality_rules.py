"""Quality rules: a threshold table compiled into one projection.

Every metric is a JVM expression over the document's own text, so a document is
judged in the task that reads it: no shuffle, no user function.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or",
    "that", "the", "this", "to", "was", "with",
    "auf", "aus", "das", "dem", "den", "der", "des", "die", "ein", "eine", "einen", "für", "im", "ist",
    "mit", "nicht", "sich", "und", "von", "zu",
    "au", "aux", "avec", "ce", "dans", "de", "du", "elle", "en", "est", "et", "il", "la", "le", "les",
    "par", "pas", "pour", "qui", "que", "sur", "un", "une",
    "al", "con", "del", "el", "las", "los", "no", "para", "por", "se", "su", "y",
)

#: Fails whatever the other rules say: (rule, metric, least, most).
BASE_RULES = (
    ("words", "n_words", 50, None),
    ("repeated_words", "repeat_share", None, 0.5),
)

#: (rule, metric, least, most); a document without words fails ``words`` already.
RULES = (
    ("word_length", "mean_word_chars", 2.0, 14.0),
    ("symbols", "symbols_per_word", None, 0.2),
    ("stop_words", "stop_word_share", 0.04, None),
    ("repeated_lines", "dup_line_share", None, 0.4),
)

_BLANK = r"[\x20\x09-\x0D]+"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    return F.filter(F.split(text, _BLANK), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.  Windows are
    compared by 64-bit hashes."""
    def windows(h: Column) -> Column:
        first = F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0)))
        return F.sort_array(F.transform(first, lambda x, i: F.struct(
            F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)).alias("t"), i.alias("i"))))

    def repeats(s: Column) -> Column:
        at = F.transform(s, lambda x, i: F.when(
            F.coalesce(F.get(s, i - 1)["t"] == x["t"], F.lit(False))
            | F.coalesce(F.get(s, i + 1)["t"] == x["t"], F.lit(False)), x["i"]))
        return F.sort_array(F.filter(at, lambda x: x.isNotNull()))

    def covered(at: Column) -> Column:
        return F.aggregate(
            at, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("end")),
            lambda acc, x: F.struct((acc["n"] + F.least(F.lit(3), x - acc["end"])).alias("n"), x.alias("end")),
            lambda acc: acc["n"])

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return bind(hashes, lambda h: bind(windows(h), lambda s: covered(repeats(s))))


def _metrics(text: Column, words: Column) -> dict[str, Column]:
    """The counts of one text; ``words`` is bound."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_lines": bind(lines, lambda x: F.array(F.size(x), F.size(x) - F.size(F.array_distinct(x)))),
        "n_repeat_words": repeated_words(words),
        "n_stop_words": F.size(F.filter(words, lambda w: w.isin(*STOP_WORDS))).cast("long"),
    }


def _ratios() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "n_words": F.col("n_words"),
        "repeat_share": F.col("n_repeat_words") / n,
        "mean_word_chars": F.col("word_chars") / n,
        "symbols_per_word": F.col("n_symbols") / n,
        "stop_word_share": F.col("n_stop_words") / n,
        "dup_line_share": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
    }


def failed(rules: tuple) -> Column:
    """True if a text breaks any rule of the table."""
    out, ratio = F.lit(False), _ratios()
    for _, metric, least, most in rules:
        if least is not None:
            out = out | (ratio[metric] < least)
        if most is not None:
            out = out | (ratio[metric] > most)
    return out


def judge(docs: DataFrame, rules: tuple = RULES, base_rules: tuple = BASE_RULES) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every row.

    A null text counts as empty: no words, base failed, not kept.  Each row is
    judged alone, so repeated rows, ties and an empty table need no care; other
    columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    m = bind(split_words(text), lambda w: F.struct(*[c.alias(k) for k, c in _metrics(text, w).items()]))
    rows = docs.select("doc_id", m.alias("m")).select(
        "doc_id", "m.n_words", "m.word_chars", "m.n_symbols",
        F.get("m.n_lines", F.lit(1)).cast("long").alias("n_dup_lines"),
        "m.n_repeat_words", "m.n_stop_words", F.get("m.n_lines", F.lit(0)).cast("long").alias("n_lines"))
    return rows.withColumn("base_failed", failed(base_rules)).withColumn(
        "kept", ~F.col("base_failed") & ~failed(rules))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
r AS (SELECT doc_id, count(*) AS n FROM (
        SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS p FROM (
          SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(ws, lambda x: x IN ({_STOPS})))::BIGINT AS n_stop_words, len(ls)::BIGINT AS n_lines
  FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed
  AND NOT (word_chars / n_words < 2.0 OR word_chars / n_words > 14.0 OR n_symbols / n_words > 0.2
           OR n_stop_words / n_words < 0.04 OR n_dup_lines / greatest(n_lines, 1) > 0.4) AS kept
FROM b
"""
