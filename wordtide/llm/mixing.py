"""Mixing sources to target weights by Efraimidis-Spirakis sampling, native throughout.

Every document gets the exponential key ``-ln(u) / weight`` with ``u`` drawn from a hash of its
id and ``weight`` its quality weight; sources are read in the order of that key. A source whose
target exceeds its size is first taken whole as often as it fits (complete epochs); the rest of
the target goes to the documents with the smallest keys, up to the word budget.

The order within a source is never built in one task. Keys fall into ``BINS`` equal slices of
``exp(-key)``; per (source, slice) the sizes are summed with partial aggregation, a window over
those sums (at most ``BINS`` rows a source) gives each slice's words before it, and only inside
the slice that the budget cuts are documents put in order.

Defined results: null or empty texts have size 0 and are never taken in part; a null source is a
source of its own and comes last; equal keys are ordered by doc_id, then by text hash; repeated
rows count as separate documents; a null doc_id is hashed as the empty text; an empty table gives
an empty result. Other columns are kept if asked for, and own columns carry the prefix ``mix_``
until the end, so that input columns of the same name do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: No document is taken more often than this.
MAX_EPOCHS = 3
#: Slices of the key space per source.
BINS = 4096
WORD = r"[^ \t-\r]+"
#: Fixed decimal digits of keys, so that other engines' logarithms give the same order.
KEY_DIGITS = 9


def uniform(column: str):
    """A number in (0, 1) from the hash of a column, the same in each run."""
    hex12 = F.substring(F.sha2(F.concat(F.lit("mix:"), F.coalesce(F.col(column).cast("string"), F.lit(""))), 256), 1, 12)
    return (F.conv(hex12, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def quality_weight(size, distinct):
    """Weight of a document: 0.1 and its share of distinct words, so repetitive texts come late."""
    return F.lit(0.1) + F.when(size > 0, distinct / size).otherwise(F.lit(0.0))


def sized(docs: DataFrame) -> DataFrame:
    """One row per document: id, source, size in words and exponential key."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        docs.select(
            F.col("doc_id"),
            F.col("source").alias("mix_source"),
            F.xxhash64(text).alias("mix_text"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("mix_size"),
            F.size(F.array_distinct(F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != ""))).alias("mix_distinct"),
        )
        .withColumn("mix_key", F.round(-F.log(uniform("doc_id")) / quality_weight(F.col("mix_size"), F.col("mix_distinct")), KEY_DIGITS))
        .withColumn("mix_bin", F.floor((1 - F.exp(-F.col("mix_key"))) * BINS).cast("int"))
        .drop("mix_distinct")
    )


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """``sizes(mix_source, mix_source_size)`` with ``mix_target``: the total of all sizes shared by
    weight, where a source at ``most`` times its size is closed and the rest shared again.

    Water filling has a closed form: with sources sorted by cap / weight, closing them one after the
    other gives each a level (what is left, by weight of those still open); the first source whose
    level is within its own cap / weight ends the closing. Windows run over one row per source.
    """
    cap = F.lit(most) * F.col("mix_source_size")
    order = Window.orderBy(F.col("mix_source").asc_nulls_last())
    level = Window.orderBy(F.col("mix_ratio"), F.col("mix_rank"))
    everything = Window.partitionBy()
    ranked = sizes.withColumn("mix_rank", F.row_number().over(order) - 1).withColumn(
        "mix_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("mix_rank") % len(weights) + 1).cast("int"))
    )
    filled = (
        ranked.withColumn("mix_ratio", cap / F.col("mix_weight"))
        .withColumn("mix_total", F.sum("mix_source_size").over(everything))
        .withColumn("mix_before", F.coalesce(F.sum(cap).over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("mix_after", F.sum("mix_weight").over(level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("mix_level", (F.col("mix_total") - F.col("mix_before")) / F.col("mix_after"))
        .withColumn("mix_cut", F.min_by(F.col("mix_level"), F.when(F.col("mix_level") <= F.col("mix_ratio"), F.col("mix_ratio"))).over(everything))
    )
    target = F.when(F.col("mix_cut").isNull() | (F.col("mix_ratio") <= F.col("mix_cut")), cap.cast("double")).otherwise(
        F.col("mix_weight") * F.col("mix_cut")
    )
    return filled.select("mix_source", "mix_source_size", target.alias("mix_target"))


def mix(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, source, ...)`` -> doc_id, size, source_size, target, taken, epochs, mix_key."""
    rows = materialise(sized(docs), "mix-sized")
    bins = materialise(rows.groupBy("mix_source", "mix_bin").agg(F.sum("mix_size").alias("mix_bin_size")), "mix-bins")
    sizes = bins.groupBy("mix_source").agg(F.sum("mix_bin_size").alias("mix_source_size"))
    ordered = Window.partitionBy("mix_source").orderBy("mix_bin").rowsBetween(Window.unboundedPreceding, -1)
    plan = (
        bins.withColumn("mix_ahead", F.coalesce(F.sum("mix_bin_size").over(ordered), F.lit(0)))
        .alias("b")
        .join(source_targets(sizes).alias("t"), F.col("b.mix_source").eqNullSafe(F.col("t.mix_source")))
        .select("b.mix_source", "b.mix_bin", "mix_bin_size", "mix_ahead", "mix_source_size", "mix_target")
        .withColumn("mix_words", F.round("mix_target").cast("long"))
        .withColumn("mix_epochs", F.coalesce(F.floor(F.try_divide("mix_words", "mix_source_size")), F.lit(0)).cast("long"))
        .withColumn("mix_rest", F.col("mix_words") - F.col("mix_epochs") * F.col("mix_source_size"))
    )
    plan = materialise(plan, "mix-plan")
    joined = (
        rows.alias("r")
        .join(plan.alias("p"), F.col("r.mix_source").eqNullSafe(F.col("p.mix_source")) & (F.col("r.mix_bin") == F.col("p.mix_bin")))
        .select("doc_id", "mix_text", "mix_size", "mix_key", "p.*")
    )
    whole = F.col("mix_rest") >= F.col("mix_ahead") + F.col("mix_bin_size")
    none = F.col("mix_rest") <= F.col("mix_ahead")
    settled = joined.where(whole | none).withColumn("mix_part", F.when(none, F.lit(0)).otherwise(F.col("mix_size")))
    inside = Window.partitionBy("mix_source", "mix_bin").orderBy("mix_key", F.col("doc_id").asc_nulls_last(), "mix_text")
    before = F.coalesce(F.sum("mix_size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("mix_ahead")
    cut = joined.where(~(whole | none)).withColumn("mix_part", F.greatest(F.lit(0), F.least("mix_size", F.col("mix_rest") - before)))
    return settled.unionByName(cut).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_epochs") * F.col("mix_size") + F.col("mix_part")).cast("long").alias("taken"),
        F.col("mix_epochs").alias("epochs"),
        F.col("mix_key"),
        F.col("mix_text"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all columns kept.

    A document that the budget cuts stays whole if at least half of it is taken, and goes otherwise;
    documents without words come once for each complete epoch of their source.
    """
    part = F.col("taken") - F.col("epochs") * F.col("size")
    times = (F.col("epochs") + F.when((part > 0) & (2 * part >= F.col("size")), 1).otherwise(0)).cast("int")
    plan = mix(docs).select(F.col("doc_id").alias("mix_id"), "mix_text", times.alias("mix_times")).where("mix_times > 0")
    plan = materialise(plan.groupBy("mix_id", "mix_text").agg(F.max("mix_times").alias("mix_times")), "mix-times")
    own = docs.withColumn("mix_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = own.join(plan, own["doc_id"].eqNullSafe(plan["mix_id"]) & (own["mix_hash"] == plan["mix_text"]))
    return joined.withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_times")))).select(*[own[c] for c in docs.columns])


#: The same in DuckDB's SQL: an independent statement with plain windows over whole sources.
SQL = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT doc_id, source, t, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda w: w <> '') AS ws FROM base
), sized AS (
  SELECT doc_id, source, t, len(ws)::BIGINT AS size,
    round(-ln((('0x' || substr(sha256('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE)
      / (0.1::DOUBLE + CASE WHEN len(ws) > 0 THEN len(list_distinct(ws))::DOUBLE / len(ws) ELSE 0 END), 9) AS k
  FROM words
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s
), c AS (
  SELECT a.source, a.source_size, a.weight, 3 * a.source_size / a.weight AS ratio,
    ((SELECT sum(source_size) FROM w) - coalesce((SELECT sum(3 * b.source_size) FROM w b WHERE 3 * b.source_size / b.weight < 3 * a.source_size / a.weight), 0))
      / (SELECT sum(b.weight) FROM w b WHERE 3 * b.source_size / b.weight >= 3 * a.source_size / a.weight) AS level
  FROM w a
), t AS (
  SELECT source, source_size, CASE WHEN cut IS NULL OR ratio <= cut THEN (3 * source_size)::DOUBLE ELSE weight * cut END AS target
  FROM (SELECT *, (SELECT arg_min(level, ratio) FROM c WHERE level <= ratio) AS cut FROM c)
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.k,
    coalesce(floor(round(t.target)::BIGINT / nullif(t.source_size, 0)), 0)::BIGINT AS epochs,
    round(t.target)::BIGINT AS words,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + greatest(0, least(size, words - epochs * source_size - ahead)))::BIGINT AS taken, epochs, k AS mix_key
FROM p
"""
