"""Mixing sources to target weights with Efraimidis-Spirakis sampling.

Targets: the sources share ``TOTAL`` times all words by weight; none gets more
than ``MOST`` times its own words.  A source first takes each document as many
whole times as fit (complete epochs); the rest of its target is filled by
documents in the order of exponential keys ``-ln(u) / quality``.

The prefix sums are never taken over a whole source: keys fall into buckets of
bounded size, bucket sums give the one bucket in which the budget ends, and only
that bucket is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import document_key, spare, table, written

#: Weights of the sources, in code point order of their names, repeating.
WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MOST = 2.0
SEED = "mix-1"
#: Smallest quality weight; bounds how uneven the key buckets can be.
LEAST_QUALITY = 0.1
#: Documents in a key bucket, about (at most twice as many).
BUCKET_ROWS = 1024
#: Characters that count against a document's quality weight.
NOISE = "#$%&*|<>!0123456789"


def quality(text: str | Column = "text") -> Column:
    """Quality weight of a text, ``LEAST_QUALITY`` to 1: 1 less four times the
    share of noise characters.  A null or empty text weighs 1."""
    c = F.col(text) if isinstance(text, str) else text
    n = F.length(c)
    noise = n - F.length(F.translate(c, NOISE, ""))
    share = F.when(n > 0, noise / n).otherwise(0.0)
    return F.coalesce(F.greatest(F.lit(LEAST_QUALITY), 1.0 - 4.0 * share), F.lit(1.0))


def key(doc_id: str | Column, weight: Column, seed: str = SEED, text: str | Column = "text") -> Column:
    """Exponential key; the same for the same id, seed and weight.  A row without
    an id is keyed by its text, so that such rows spread like any others."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    t = F.col(text) if isinstance(text, str) else text
    own = F.concat(F.lit("text:"), F.md5(F.coalesce(t, F.lit("")).cast("binary")))
    h = F.md5(F.concat(F.coalesce(c.cast("string"), own), F.lit(":" + seed)).cast("binary"))
    u = (F.conv(F.substring(h, 1, 13), 16, 10).cast("double") + 0.5) / float(2 ** 52)
    return -F.log(u) / weight


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, total: float = TOTAL,
            most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row for
    each source).  Capped sources drop out in the order of cap / weight; the
    rest share what is left by weight.  Sources are ranked in one task: meant for
    up to some hundred thousand of them."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("w", w).withColumn("cap", most * F.col("source_size"))
    rows = rows.withColumn("r", F.col("cap") / F.col("w"))
    order = Window.orderBy("r", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    rows = rows.withColumns({
        "i": F.row_number().over(order),
        "share": (total * F.sum("source_size").over(everyone)
                  - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    level = F.min_by("share", F.when(F.col("share") <= F.col("r"), F.col("i"))).over(everyone)
    return rows.select("source", "source_size", F.least("cap", level * F.col("w")).alias("target"))


def _weight(column: str | None) -> Column:
    if column is None:
        return quality()
    q = F.col(column).cast("double")
    return F.coalesce(F.greatest(F.lit(LEAST_QUALITY), F.least(F.lit(1.0), q)), F.lit(1.0))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, total: float = TOTAL, most: float = MOST,
        seed: str = SEED, bucket_rows: int = BUCKET_ROWS, quality_column: str | None = None) -> DataFrame:
    """``doc_id, _d, _h, source, size, source_size, target, taken`` for every row
    (``_d, _h``: its key, see ``common.keyed``).

    ``size`` counts ``[^\\x20\\x09-\\x0D]+`` (null text: 0, taken 0).  A null
    source is a source of its own, the last.  Rows order by key, then id, then
    size, so ties and repeated rows give the same result on every run; a row
    without an id is keyed by its text.  ``quality_column`` names a quality weight
    of the documents (such as the score of ``quality_classifier.score``), held to
    ``LEAST_QUALITY`` to 1 (null: 1); else ``quality(text)`` counts.  The row on which the budget ends is
    taken if that brings the source nearer to its target.  An empty table gives
    no rows.
    """
    slim = docs.select(
        "doc_id", document_key(docs).alias("_d"), F.xxhash64("text").alias("_h"), "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        key("doc_id", _weight(quality_column), seed).alias("_key"))
    slim = written(slim, "mix")
    sums = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    goal = written(targets(sums.drop("_n"), weights, total, most).join(
        sums.select(F.col("source").alias("_s"), "_n"), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s").withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(
            F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("_budget", F.col("target") - F.col("_epochs") * F.col("source_size"))
        .withColumn("_buckets", F.greatest(F.lit(1), F.floor(F.col("_n") / bucket_rows))), "mix-targets")
    same = F.col("source").eqNullSafe(F.col("_s"))
    # half by the distribution of keys at full quality, half by that at the least:
    # neither the small keys of good documents nor the large ones of noisy ones crowd a bucket
    share = 1.0 - 0.5 * F.exp(-F.col("_key")) - 0.5 * F.exp(-LEAST_QUALITY * F.col("_key"))
    rows = slim.join(goal.withColumnRenamed("source", "_s"), same).drop("_s").withColumn(
        "_b", F.least(F.col("_buckets") - 1, F.floor(F.col("_buckets") * share)))
    upto = Window.partitionBy("source").orderBy("_b")
    sums = (rows.groupBy("source", "_b").agg(F.sum("size").alias("_sum"), F.first("_budget").alias("_budget"))
            .withColumn("_upto", F.sum("_sum").over(upto)))
    end = sums.where(F.col("_upto") > F.col("_budget")).groupBy(F.col("source").alias("_s")).agg(
        F.min("_b").alias("_end"), F.min_by(F.col("_upto") - F.col("_sum"), "_b").alias("_before"))
    rows = rows.join(end, same, "left").drop("_s")
    inside = Window.partitionBy("source").orderBy("_key", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    last = rows.where(F.col("_b") == F.col("_end")).withColumn(
        "_sum", F.sum("size").over(inside) + F.col("_before"))
    over, under = F.col("_sum") - F.col("_budget"), F.col("_budget") - (F.col("_sum") - F.col("size"))
    last = last.withColumn("_extra", (over <= 0) | ((under > 0) & (over < under))).drop("_sum")
    rest = rows.where(F.col("_end").isNull() | (F.col("_b") != F.col("_end"))).withColumn(
        "_extra", F.col("_end").isNull() | (F.col("_b") < F.col("_end")))
    taken = F.col("size") * (F.col("_epochs") + F.when(F.col("_extra") & (F.col("_budget") > 0), 1).otherwise(0))
    return rest.unionByName(last).select("doc_id", "_d", "_h", "source", "size", "source_size", "target",
                                         taken.cast("long").alias("taken"))


def draw(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with ``mix_copies`` (times that
    the mix takes the text) and ``mix_words`` (words that it takes, repeats
    counted; columns of these names are replaced).  Rows that repeat an id and a
    text become one, whose copies add up; a text without words is never taken.  Options as for ``mix``."""
    taken = mix(docs, **options).where("taken > 0").groupBy("_d", "_h").agg(
        F.sum(F.col("taken") / F.col("size")).cast("long").alias("_copies"), F.sum("taken").alias("_words"))
    rows = docs.drop("mix_copies", "mix_words")
    d, h, copies, words = spare(rows, "_d", "_h", "_copies", "_words")
    taken = taken.withColumnsRenamed({"_d": d, "_h": h, "_copies": copies, "_words": words})
    rows = rows.withColumns({d: document_key(docs), h: F.xxhash64("text")})
    rows = rows.join(taken, [d, h]).dropDuplicates([d, h])
    return rows.withColumnsRenamed({copies: "mix_copies", words: "mix_words"}).drop(d, h)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("_d", "_h", "source")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, size, -ln(u) / greatest(0.1::DOUBLE, 1.0::DOUBLE - 4.0::DOUBLE * share) AS k FROM (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
      CASE WHEN length(text) > 0 THEN (length(text) - length(translate(text, '#$%&*|<>!0123456789', '')))::DOUBLE
           / length(text)::DOUBLE ELSE 0.0::DOUBLE END AS share,
      (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) || ':mix-1'), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
        / 4503599627370496.0::DOUBLE AS u
    FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2.0::DOUBLE * source_size AS cap,
        [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
r AS (SELECT *, cap / w AS r, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS i FROM w),
l AS (SELECT *, (1.5::DOUBLE * (SELECT sum(source_size)::BIGINT FROM s)
        - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
        / sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM r),
t AS (SELECT source, source_size,
        least(cap, (SELECT arg_min(share, i) FROM l WHERE share <= r) * w) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS budget,
        sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (epochs + CASE WHEN budget > 0 AND (upto <= budget OR (upto - size < budget
          AND upto - budget < budget - (upto - size))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
