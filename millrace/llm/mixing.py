"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Each source gets a target of words. A document's key is exponential with its quality weight as rate; within a
source, documents in the order of their keys are a weighted sample without replacement. Complete epochs of
the source come first; then the documents whose words, summed in key order, fit the rest of the target are
taken once more, the last one in part. Sums run in two levels (ranges of keys, then rows within a range),
so that no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import scratch_path

#: Weights of the sources in code-point order, repeating, and the mix's share of all words.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2

#: Documents in one range of keys, on average.
RANGE_ROWS = 4096

SYMBOLS = "0123456789#$%&*!|"


def word_count(text: Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """0.5 to 1: the larger, the fewer digits and symbols; 1 for empty and null texts."""
    plain = F.length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(0.5 + 0.5 * plain / F.nullif(F.length(text), F.lit(0)), F.lit(1.0))


def uniform(value: Column) -> Column:
    """A number strictly between 0 and 1 from a hash of ``value``; null has one of its own."""
    digits = F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit("null")).cast("binary")), 1, 13), 16, 10)
    return (digits.cast("double") + 0.5) / F.lit(float(16**13))


def source_targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: documents, words, weight and target words.

    Targets share ``share`` of all words by weight. A target above twice its source's words stops there and
    the excess is shared anew by weight until none is above: with sources in the order of words per weight,
    the first k stop, where k is the first whose common level holds for the next source.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_docs"), F.avg("weight").alias("mean_weight")
    )
    # A row per source from here on.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.array(*map(F.lit, weights))
    ranked = totals.withColumn("share_weight", F.element_at(cycle, ((place - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("most", (MOST_EPOCHS * F.col("source_size")).cast("double"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("most") / F.col("share_weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    level = (
        share * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / F.sum("share_weight").over(rest)
    ranked = ranked.withColumn("level", level)
    fits = F.col("level") <= F.col("most") / F.col("share_weight")
    ranked = ranked.withColumn("common", F.min(F.when(fits, F.struct(F.col("most") / F.col("share_weight"), "level"))).over(everything))
    target = F.coalesce(F.least("most", F.col("common.level") * F.col("share_weight")), F.col("most"))
    return ranked.select("source", "source_size", "n_docs", "mean_weight", "share_weight", target.alias("target"))


def mix_sources(documents: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``doc_id, source, size, source_size, target, epochs, taken`` of every document.

    ``taken`` counts the words that the mix takes of the document, repeats included: ``epochs`` whole
    copies, and what the fractional selection adds. Null and empty texts have size 0 and are taken 0 times;
    a null source is a source of its own; repeated rows are documents of their own; ties in the keys are
    broken by id and size, so reruns agree; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "mix-sizes")
    documents.select(
        "doc_id",
        "source",
        word_count(F.col("text")).alias("size"),
        quality_weight(F.col("text")).alias("weight"),
    ).write.parquet(path)
    sizes = spark.read.schema("doc_id long, source string, size long, weight double").parquet(path)
    targets = source_targets(sizes, share, weights)

    key = -F.ln(uniform(F.col("doc_id"))) / F.col("weight")
    keyed = sizes.withColumn("key", key).join(
        targets.withColumnRenamed("source", "target_source"), F.col("source").eqNullSafe(F.col("target_source"))
    )
    ranges = F.ceil(F.col("n_docs") / RANGE_ROWS)
    # Monotone in the key; evenly spread if the source's weights are alike.
    keyed = keyed.withColumn("range", F.floor((1 - F.exp(-F.col("key") * F.col("mean_weight"))) * ranges)).drop("target_source")

    by_range = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_range.select(
        F.col("source").alias("start_source"),
        F.col("range").alias("start_range"),
        F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("range_start"),
    )
    placed = keyed.join(
        starts, F.col("source").eqNullSafe(F.col("start_source")) & (F.col("range") == F.col("start_range"))
    )
    inside = (
        Window.partitionBy("source", "range")
        .orderBy("key", F.col("doc_id").asc_nulls_last(), "size", "weight")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.col("range_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target") - F.col("epochs") * F.col("source_size"))
    extra = F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    return (
        placed.withColumn("before", before)
        .withColumn("epochs", epochs)
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            "epochs",
            (F.col("epochs") * F.col("size") + extra).cast("long").alias("taken"),
        )
    )


def mix_report(documents: DataFrame) -> DataFrame:
    return mix_sources(documents).select("doc_id", "size", "source_size", "target", "taken")


MIX_SQL = r"""
WITH sizes AS (
    SELECT doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        coalesce(0.5::DOUBLE + 0.5::DOUBLE * length(translate(text, '0123456789#$%&*!|', '')) / nullif(length(text), 0), 1) AS weight,
        (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496 AS u
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS w
    FROM sizes GROUP BY source
), levels AS (
    SELECT *, 2.0::DOUBLE * source_size AS most,
        (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER o, 0))
            / sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM totals
    WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / w, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
        least(most, coalesce((SELECT level FROM levels WHERE level <= most / w ORDER BY most / w, level LIMIT 1) * w, most)) AS target
    FROM levels
), placed AS (
    SELECT doc_id, size, source_size, target,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs,
        coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY -ln(u) / weight, doc_id NULLS LAST, size, weight
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
    (epochs * size + least(greatest(floor(target - epochs * source_size) - before, 0), size))::BIGINT AS taken
FROM placed
"""
