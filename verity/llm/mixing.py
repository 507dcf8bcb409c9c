"""Mixing sources to target weights.

Every document gets a hash-random key. Within its source the documents are
ordered by that key; a distributed prefix sum of their sizes says which words
the source's budget covers, and the cut falls exactly at the budget. A budget
above the source's size repeats the source, whole epochs first.

The prefix sum has two levels. Keys are uniform, so equal ranges of the key
space ("buckets") hold nearly equal shares of each source whatever its size:
totals per (source, bucket) are pre-aggregated, added up over the buckets of a
source, and a window inside each bucket adds the rest. With about sqrt(rows)
buckets both windows stay at sqrt(rows) entries, also for a source that holds
a third of all rows. Everything is native DataFrame work.
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verity.llm.common import WORD, Staging, text_of, word_count

DEFAULT_WEIGHTS = (1, 2, 3)


def source_targets(sizes: DataFrame, weights: Sequence[int] = DEFAULT_WEIGHTS,
                   max_epochs: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, target``.

    ``sizes`` has ``source`` and ``size``. Sources take the weights in turn in
    code-point order, null last, and share the total size by weight. A target
    stops at ``max_epochs`` times its source's size and the excess is shared
    again by weight until none is above. That fixed point is ``min(cap, level
    * weight)`` for one level; with sources in the order of cap / weight, the
    level is the largest over k of what the sources before k leave at their
    caps, divided by the weights from k on. The frame has one row per source.
    """
    w = "CASE " + " ".join(f"WHEN pmod(rank - 1, {len(weights)}) = {i} THEN {int(v)}"
                           for i, v in enumerate(weights)) + " END"
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("rank", F.row_number().over(
               Window.orderBy(F.col("source").isNull(), F.col("source"))))
           .withColumn("weight", F.expr(w).cast("long"))
           .withColumn("cap", F.col("source_size") * max_epochs))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = per.withColumn(
        "level", (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(after))
    return (level.withColumn("level", F.max("level").over(everything))
            .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
            .select("source", "source_size", "target"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = DEFAULT_WEIGHTS, max_epochs: int = 3,
             seed: str = "mix", staging: Staging | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """What the mix takes of every document: ``doc_id, source, size,
    source_size, target, taken, epochs, part``.

    ``size`` is the number of words; ``taken = epochs * size + part`` the
    words taken, repeats counted. The takings of a source add up to its target
    rounded down. Order: MD5 of seed and doc_id, then doc_id, then size, so
    reruns agree; repeated rows are separate documents that swap freely. A
    null text has size 0; a null doc_id or source is a value of its own; an
    empty table gives an empty plan. Other columns are not read, but for those
    named by ``carry``, which the plan keeps.
    """
    spark = docs.sparkSession
    staging = staging or Staging(spark, "mix")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = staging.write(
        docs.select("doc_id", "source", word_count("text").alias("size"), key.alias("key"), *carry), "sizes")
    n = sizes.count()
    buckets = max(1, math.isqrt(n))
    # A null source becomes a key of its own, so that join and window share
    # one hash partitioning.
    keyed = (sizes
             .withColumn("name", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
             .withColumn("bucket", F.shiftright(
                 F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.lit(buckets), 32)))
    targets = (source_targets(sizes, weights, max_epochs)
               .withColumn("name", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
               .drop("source"))
    budget = F.floor("target")
    totals = (keyed.groupBy("name", "bucket").agg(F.sum("size").alias("bucket_size"))
              .withColumn("bucket_from", F.coalesce(F.sum("bucket_size").over(
                  Window.partitionBy("name").orderBy("bucket")
                  .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .join(targets, "name")
              .withColumn("epochs", F.when(F.col("source_size") > 0,
                                           F.floor(budget / F.col("source_size"))).otherwise(0))
              .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
              .drop("bucket_size"))
    inside = (Window.partitionBy("name", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    before = F.col("bucket_from") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return (keyed.join(totals, ["name", "bucket"])
            .withColumn("part", F.greatest(F.lit(0).cast("long"), F.least(
                F.col("size"), F.col("rest") - before)))
            .withColumn("epochs", F.col("epochs").cast("long"))
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"),
                    "epochs", "part", *carry))


def mix(docs: DataFrame, weights: Sequence[int] = DEFAULT_WEIGHTS, max_epochs: int = 3,
        seed: str = "mix") -> DataFrame:
    """The mixed documents, with the columns of ``docs``: each one once per
    whole epoch, and the document at a source's cut once more with the words
    that the budget still covers. Documents the budget does not reach go.

    The cut document keeps its first words, joined by single spaces. Every row
    follows its own plan, also where rows share a doc_id or have none, so the
    words of a source add up to its target rounded down. A document of size 0
    is never taken. An empty table stays empty.
    """
    staging = Staging(docs.sparkSession, "mix")
    # The write settles the numbers that tell the rows apart.
    rows = staging.write(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    plan = (mix_plan(rows, weights, max_epochs, seed, staging, ("__row",)).filter("taken > 0")
            .select("__row", F.col("epochs").alias("__epochs"), F.col("part").alias("__part"),
                    F.col("size").alias("__size")))
    joined = rows.join(plan, "__row")
    cut = F.when(F.col("__part") >= F.col("__size"), F.col("text")).otherwise(
        F.array_join(F.slice(F.regexp_extract_all(text_of("text"), F.lit(f"({WORD})"), 1), 1,
                             F.greatest(F.col("__part"), F.lit(1)).cast("int")), " "))
    copies = F.concat(
        F.array_repeat(F.lit(False), F.col("__epochs").cast("int")),
        F.when(F.col("__part") > 0, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    out = joined.withColumn("__cut", F.explode(copies))
    out = out.withColumn("text", F.when(F.col("__cut"), cut).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col("__cut") & (F.col("__part") < F.col("__size")),
            F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
