"""Versions of a folder of tables, published by a manifest that is written last.

Data folders are never written twice: each has a name of its own, and a manifest row per folder says which belong to a
version. A manifest is committed as a whole, after everything it names, and its number can be taken once only: of two
writers that started from one version the second fails and publishes nothing. Readers pin a version; what is published
later goes to other folders, so a search that is under way keeps reading what it opened.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from matchlake.sources.readers import read_if_exists


def _manifests(spark: SparkSession, root: str, schema: str) -> DataFrame | None:
    return read_if_exists(lambda p: spark.read.schema(f"{schema}, version int").json(p), f"{root}/manifest")


def latest(spark: SparkSession, root: str) -> int:
    """The newest version's number, 0 when nothing was published."""
    found = _manifests(spark, root, "entry int")
    return 0 if found is None else found.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def entries(spark: SparkSession, root: str, schema: str, version: int) -> list[Row]:
    """The manifest's rows: as many as a version has folders."""
    found = _manifests(spark, root, f"entry int, {schema}")
    if found is None:
        raise ValueError(f"nothing is published below {root}")
    rows = found.filter(F.col("version") == version).orderBy("entry").collect()
    if not rows:
        raise ValueError(f"{root} has no version {version}")
    return [r for r in rows if r["entry"] >= 0]


def commit(spark: SparkSession, root: str, schema: str, rows: list[tuple], version: int) -> None:
    """Publishes `rows` as a version. Fails when that version is there already."""
    # A row for the version itself, so that one without folders exists as well.
    numbered = [(-1, *[None] * len(schema.split(", "))), *[(i, *r) for i, r in enumerate(rows)]]
    table = spark.createDataFrame(numbered, f"entry int, {schema}")
    table.coalesce(1).write.mode("error").json(f"{root}/manifest/version={version}")


def new_folder(root: str, kind: str) -> str:
    return f"{root}/{kind}/{uuid.uuid4().hex[:16]}"


PUBLISHED = "folder string"


def publish(spark: SparkSession, root: str, write) -> tuple[str, int]:
    """Has `write(folder)` fill a new folder, then makes it the newest version."""
    version, folder = latest(spark, root) + 1, new_folder(root, "data")
    write(folder)
    commit(spark, root, PUBLISHED, [(folder,)], version)
    return folder, version


def published(spark: SparkSession, root: str, version: int | None = None) -> str:
    """The folder of a version, the newest if none is named."""
    version = latest(spark, root) if version is None else version
    return entries(spark, root, PUBLISHED, version)[0]["folder"]
