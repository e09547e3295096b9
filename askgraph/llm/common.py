"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askgraph.session import new_path, shared_folder, staged

__all__ = ["WORD", "new_path", "row_key", "shared_folder", "ship", "staged", "table", "whole_ids", "word_count"]

#: A word: a longest run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this library where their path doesn't hold it.

    Jobs started with ``--py-files``, from the library's folder or with it in
    PYTHONPATH need nothing; others get it through the session, as a zip file.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    places = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    app = spark.sparkContext.applicationId
    if app in _shipped or not os.path.isdir(root) or root in map(os.path.abspath, places):
        return
    folder = tempfile.mkdtemp(prefix="askgraph-")
    spark.sparkContext.addPyFile(
        shutil.make_archive(os.path.join(folder, "askgraph"), "zip", root, "askgraph")
    )
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text as long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def whole_ids(ids: pd.Series) -> pd.Series:
    """Ids that came to Python as text: as numbers, they would lose bits beside a null."""
    return pd.Series([None if pd.isna(i) else int(i) for i in ids], ids.index, "Int64")


def row_key(*columns: str) -> list[Column]:
    """Two 64-bit hashes that stand for a row: equal rows share them, nulls included."""
    return [
        F.xxhash64(*columns).alias("_k1"),
        F.xxhash64(F.lit("second"), *reversed(columns)).alias("_k2"),
    ]
