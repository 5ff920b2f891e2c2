"""A ledger of graded pairs, so that grading goes on where it stopped.

A pair is known by a digest of its content; pairs with equal content are asked once. Answers are written batch by batch,
each batch to a folder of its own that is never written again. Before a batch is asked, pairs that the ledger has an
answer for are left out. A run that is stopped loses the answers of its open batch only, and the next run with the
same folder asks the rest. A pair without an answer is asked again, `retries` times in all runs together.

Defined cases: null texts count as empty; several answers to one pair give the best grade; a pair that never gets an
answer has grade 0 and a row in `failures`.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions.text import text_or_empty
from matchlake.operators.common import settle
from matchlake.operators.judging import COLUMNS, Grader
from matchlake.sources.readers import read_if_exists

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REPLY = "grade int, error string"
LEDGER = "digest string, reply struct<grade:int, error:string>"
TEXTS = ["text", "doc_title", "description"]


def asked(score: Callable[[str, str, str], int]) -> Grader:
    """A grader from a plain function, called in Arrow batches; an error is kept as its message."""
    def one(text: str, title: str, description: str) -> tuple:
        try:
            return int(score(text, title, description)), None
        except Exception as e:  # the pair is asked again
            return None, f"{type(e).__name__}: {e}"

    @F.pandas_udf(REPLY)
    def graded(text: pd.Series, title: pd.Series, description: pd.Series) -> pd.DataFrame:
        found = [one(*row) for row in zip(text, title, description)]
        return pd.DataFrame({"grade": pd.array([g for g, _ in found], dtype="Int32"), "error": [e for _, e in found]})

    return graded


def pair_digest() -> Column:
    """SHA-256 of the three texts, each with its length in front."""
    texts = [text_or_empty(F.col(c)) for c in TEXTS]
    return F.sha2(F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts]), 256)


def _ledger(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_exists(lambda p: spark.read.schema(LEDGER).parquet(p), f"{root}/grades")
    return spark.createDataFrame([], LEDGER) if found is None else found.select("digest", "reply")


def answers(spark: SparkSession, root: str) -> DataFrame:
    """A row per pair that was asked: digest, best grade (null without an answer), tries, an error."""
    return _ledger(spark, root).groupBy("digest").agg(
        F.max("reply.grade").alias("grade"), F.count("*").alias("tries"), F.max("reply.error").alias("error"))


def failures(spark: SparkSession, root: str) -> DataFrame:
    """Pairs that were asked and have no answer: digest, tries, error."""
    return answers(spark, root).filter("grade is null").drop("grade")


def _reply(pairs: DataFrame, grader: Grader) -> Column:
    reply = grader(*[text_or_empty(F.col(c)) for c in TEXTS])
    if pairs.select(reply.alias("reply")).schema["reply"].dataType.typeName() == "struct":
        return reply
    return F.struct(reply.try_cast("int").alias("grade"), F.lit(None).cast("string").alias("error"))


def grade(pairs: DataFrame, grader: Grader, root: str, per_batch: int = 100_000, retries: int = 3,
          tasks: int | None = None) -> DataFrame:
    """Judgments for pairs(query_id, query_category, doc_id, doc_category, doc_title, text, description).

    `grader` is one from `asked`, or a column whose null or text that is no number means no answer. A batch has about
    `per_batch` pairs and is asked by `tasks` tasks at once."""
    spark = pairs.sparkSession
    tasks = tasks or spark.sparkContext.defaultParallelism
    pairs = settle(pairs.select(*dict.fromkeys([*COLUMNS[:-1], *TEXTS])).withColumn("digest", pair_digest()), "pairs")
    for _ in range(retries):
        done = answers(spark, root).filter((F.col("grade").isNotNull()) | (F.col("tries") >= retries))
        left = settle(pairs.select("digest", *TEXTS).join(done, "digest", "left_anti").dropDuplicates(["digest"]), "left")
        n = left.count()
        batches = -(-n // per_batch)
        for i in range(batches):
            batch = left.filter(F.pmod(F.xxhash64("digest"), F.lit(batches)) == i).repartition(tasks, "digest")
            batch.select("digest", _reply(batch, grader).alias("reply")).write.parquet(f"{root}/grades/call={uuid.uuid4().hex}")
        if n == 0:
            break
    best = answers(spark, root).filter("grade is not null").select("digest", "grade")
    rows = pairs.join(best, "digest", "left").withColumn("relevance", F.coalesce("grade", F.lit(0)))
    return rows.select(*COLUMNS)
