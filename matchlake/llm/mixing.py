"""Mixing sources to target weights by hash order, distributed prefix sums and an exact cut.

Every source gets a target by sharing the words of all sources in proportion to weights; a target stops at a
multiple of its source's size and the excess goes to the others. A source then takes all its documents as often as
its target holds whole epochs, and the last epoch ends, in hash-random document order, exactly at the target.

A source is cut into ranges of its documents' hash keys. Sums per range are added up in key order, which gives every
range its offset; a running sum inside each range does the rest. A source that holds most documents has as many
ranges as it needs, so no task sees a whole source. Only ids, keys and sizes are shuffled, never texts.

Defined cases: a null or blank text has size 0 and takes 0; a null source is a source of its own and the last one; a
null doc_id is hashed as ''; rows that share a doc_id are separate documents next to each other in the order; an
empty table gives an empty result. The table of sources (one row each) is ordered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchlake.llm.shared import keyed, word_total
from matchlake.operators.common import settle

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
RANGE_ROWS = 20_000


def hash_key(doc_id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit(""))))


def targets(sources: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """skey, source_size -> the same with `target`: weights repeat over the sources in code-point order, null last.

    Sources are taken by rising limit per weight. One is held at its limit if an equal share per weight of what the
    sources before it left is above that limit; the first one that is not sets the share for all the others."""
    place = W.orderBy((F.col("skey") == "").cast("int"), "skey")
    per_weight = W.orderBy("ratio", "skey")
    after = per_weight.rowsBetween(W.currentRow, W.unboundedFollowing)
    before = per_weight.rowsBetween(W.unboundedPreceding, -1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(place) - 1) % len(weights)) + 1)
    out = sources.withColumn("weight", weight).withColumn("limit", F.col("source_size") * float(max_epochs))
    out = out.withColumn("ratio", F.col("limit") / F.col("weight"))
    left = F.sum(F.col("source_size").cast("double")).over(W.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    out = out.withColumn("share", left / F.sum("weight").over(after))
    out = out.withColumn("held", F.col("ratio") < F.col("share"))
    level = F.min(F.when(~F.col("held"), F.struct("ratio", "skey", "share"))).over(W.partitionBy())["share"]
    target = F.when(F.col("held"), F.col("limit")).otherwise(F.col("weight") * level)
    return out.select("skey", "source_size", target.alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 11) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    `taken` counts words: whole epochs of the document plus what the last epoch takes of it. Only the document at
    the cut is taken in part."""
    sized = settle(docs.select(F.col(doc_id).alias("doc_id"), keyed(F.col(source).cast("string")).alias("skey"),
                               word_total(F.col(text)).alias("size"), hash_key(F.col(doc_id), seed).alias("key")),
                   "mix-sizes")
    longest = sized.groupBy("skey").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    digits = max(1, math.ceil(math.log(max(longest / RANGE_ROWS, 1), 16)))
    sized = sized.withColumn("part", F.substring("key", 1, digits))
    ranges = settle(sized.groupBy("skey", "part").agg(F.sum("size").alias("range_size")), "mix-ranges")
    wanted = targets(ranges.groupBy("skey").agg(F.sum("range_size").alias("source_size")), weights, max_epochs)
    goal = F.round("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budgets = wanted.withColumn("epochs", full).withColumn("rest", goal - F.col("epochs") * F.col("source_size"))
    upto = W.partitionBy("skey").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranges.withColumn("offset", F.coalesce(F.sum("range_size").over(upto), F.lit(0))).join(budgets, "skey")
    inside = W.partitionBy("skey", "part").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    found = placed.join(offsets, ["skey", "part"])
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("offset") - F.col("before")))
    return found.select("doc_id", "size", "source_size", "target",
                        (F.col("epochs") * F.col("size") + last).cast("long").alias("taken"))
