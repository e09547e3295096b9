"""The training-data pipeline over the documents table.

Each stage takes what the one before it kept, and its decisions take effect:
toxic documents go, one document of each near-duplicate group stays, secrets are
masked, sources come in their shares, and what is left is packed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from askgraph.llm import mixing, packing, secrets_scan, simhash, toxicity
from askgraph.llm.common import row_key, staged, table

#: No stage but the masking of secrets can be said in SQL; tests compare with brute force.
ORACLE_SQL = None

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold, in all their rows.

    Null and empty texts have a score too. An empty table gives no rows.
    """
    model = toxicity.train_on_labels(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model)
    return scored.where(F.col("_score") < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id.

    Rows take part under a hash of all their columns, so documents without an id
    and those that share one have groups like others. Ids that are null come
    last; among equal ids the hash decides, so reruns agree. Of repeated rows one
    stays. An empty table gives no rows.
    """
    names = ("_near1", "_near2")
    keyed = docs.select("*", *(k.alias(n) for k, n in zip(row_key(*docs.columns), names, strict=True)))
    groups = simhash.simhash_groups(keyed, id_col="_near1").select(
        F.col("doc_id").alias("_near1"), F.col("component_id").alias("_group")
    )
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_near1", "_near2")
    first = (
        keyed.select("doc_id", "_near1", "_near2")
        .distinct()
        .join(groups.distinct(), "_near1")
        .groupBy("_group")
        .agg(F.min(order).alias("first"))
        .select("first._near1", "first._near2")
        .distinct()
    )
    kept = keyed.join(first, ["_near1", "_near2"], "left_semi")
    return kept.dropDuplicates(["_near1", "_near2"]).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; reported secrets in the texts give way to a mark.

    A null text stays null. Repeated rows stay repeated, an empty table empty.
    """
    masked = secrets_scan.mask_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: the share of sources follows their weights.

    The mix counts words; here documents come whole. Each comes as often as the
    words taken from it fill it. What is left over is added up along the
    documents of a source, by size, and gives a further copy each time it
    passes a whole document, so that the words of a source stay within about a
    document per 20,000 of what the mix takes. Copies keep the document's id;
    texts without words come once. Equal rows share their copies evenly.
    """
    keys = docs.select("*", *row_key(*docs.columns))
    taken = mixing.mix_sources(keys, keep=("_k1", "_k2", "source"))
    buckets = max(1, math.ceil(docs.count() / 20_000))
    share = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(F.lit(1.0))
    line = Window.partitionBy("_kept_source", "_bucket").orderBy("size", "_kept__k1", "_kept__k2")
    upto = F.sum(F.col("_share") - F.floor("_share")).over(
        line.rowsBetween(Window.unboundedPreceding, 0)
    )
    counted = (
        taken.withColumn("_share", share)
        .withColumn("_bucket", F.pmod("_kept__k1", F.lit(buckets)))
        .withColumn("_upto", upto)
        .withColumn("_before", F.col("_upto") - (F.col("_share") - F.floor("_share")))
        .select(
            F.col("_kept__k1").alias("_t1"),
            F.col("_kept__k2").alias("_t2"),
            (
                F.floor("_share") + F.floor(F.col("_upto") + 0.5) - F.floor(F.col("_before") + 0.5)
            ).alias("_copies"),
        )
    )
    per_row = counted.groupBy("_t1", "_t2").agg(
        F.floor(F.avg("_copies") + 0.5).cast("int").alias("_copies")
    )
    joined = keys.join(per_row, (F.col("_k1") == F.col("_t1")) & (F.col("_k2") == F.col("_t2")))
    return (
        joined.where("_copies > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*docs.columns)
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences: a row per piece.

    A null text is packed as empty. An empty table gives no rows.
    """
    return packing.pack_best_fit(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
