"""Exact duplicates by sorting contents: sampled splitters, an external sort, neighbours compared in full."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, materialize

PREFIX = 32
LAST = 2**63 - 1


def normalised(text: Column) -> Column:
    """Every run of white space as one blank; null as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _splitters(rows: DataFrame, key: Column, buckets: int, seed: int) -> list[tuple]:
    """Sorted keys that cut the sample into equal shares; about 8 sampled keys for each bucket."""
    total = rows.count()
    share = min(0.1, 8 * buckets / max(total, 1))
    sampled = rows.sample(False, share, seed).select(key.alias("key")).collect()
    keys = sorted(tuple(r["key"]) for r in sampled)
    cuts = min(buckets, len(keys) // 8)
    return [keys[i * len(keys) // cuts] for i in range(1, cuts)] if cuts > 1 else []


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, seed: int = 7
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are dealt to buckets by splitters of a sample (at most a tenth of the keys, and about eight for each
    bucket), sorted by content inside each bucket, and every row is compared in full with the one before it. The sort
    key is a prefix, the digest, the text and the id, so that texts with a common beginning and the copies of one text
    spread over buckets; a group that a splitter cuts is put together again from one row per bucket.

    Ids are integers. Of equal texts the smallest id stays; of rows repeated with the same id exactly one is kept.
    A null text equals the empty one. A null id sorts last and gives a null keep_id where all ids of a group are null.
    An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    norm = normalised(F.col("text"))
    key = F.struct(
        F.left(norm, F.lit(PREFIX)).alias("p"), F.sha2(norm, 256).alias("d"), F.coalesce("id", F.lit(LAST)).alias("r")
    )
    cuts = _splitters(raw, key, buckets, seed)
    ladder = F.from_json(
        F.lit(json.dumps([dict(zip("pdr", c, strict=True)) for c in cuts])), "array<struct<p:string,d:string,r:bigint>>"
    )
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    bucket = F.lit(0)
    if cuts:
        bucket = F.aggregate(
            F.array(*map(F.lit, steps)),
            F.lit(0),
            lambda at, step: F.when(F.get(ladder, at + step - 1) <= F.col("key"), at + step).otherwise(at),
        )
    cut = F.lit(False)
    if cuts:
        digest = F.col("key.d")
        beside = [F.get(ladder, F.col("bucket") - 1)["d"], F.get(ladder, F.col("bucket"))["d"]]
        cut = F.coalesce(beside[0] == digest, F.lit(False)) | F.coalesce(beside[1] == digest, F.lit(False))

    dealt = raw.select("id", norm.alias("norm"), key.alias("key")).withColumn("bucket", bucket).withColumn("cut", cut)
    order = W.partitionBy("bucket").orderBy("key.p", "key.d", "norm", "key.r")
    before = F.lag("norm").over(order)
    first = before.isNull() | (before != F.col("norm"))
    found = (
        dealt.withColumn("first", first)
        .withColumn("run", F.sum(F.col("first").cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0)))
        .select(
            "id", "bucket", "run", "first", "cut", F.col("key.r").alias("rank"), F.col("key.d").alias("digest"),
            F.when(F.col("first") & F.col("cut"), F.col("norm")).alias("norm"),
        )
    )
    found = materialize(found, "content-sort")

    run = W.partitionBy("bucket", "run")
    whole = found.filter(~F.col("cut")).select(
        "id", F.min("rank").over(run).alias("least"), F.count("*").over(run).alias("size"),
        F.col("first").alias("kept"), "digest",
    )
    pieces = found.filter("cut").groupBy("bucket", "run").agg(
        F.min("rank").alias("rank"), F.count("*").alias("n"), F.max("norm").alias("norm")
    )
    same = W.partitionBy("norm")
    joined = pieces.select(
        "bucket", "run", F.min("rank").over(same).alias("least"), F.sum("n").over(same).alias("size"),
        (F.row_number().over(same.orderBy("rank", "bucket")) == 1).alias("leads"),
    )
    # At most a few runs of each bucket touch a splitter.
    halves = found.filter("cut").join(F.broadcast(joined), ["bucket", "run"]).select(
        "id", "least", "size", (F.col("first") & F.col("leads")).alias("kept"), "digest"
    )
    return whole.union(halves).select(
        F.col("id").alias("doc_id"),
        F.nullif("least", F.lit(LAST)).alias("keep_id"),
        F.col("size").alias("group_size"),
        "kept",
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    Rows are found again by id and text; of rows that repeat both, one stays.
    """
    kept = exact_groups(docs, id_col, text_col).filter("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")
    )
    sha = F.sha2(normalised(F.col(text_col)), 256)
    found = docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")) & (sha == F.col("__sha")), "left_semi")
    # Only ids that occur twice or more can still repeat; they alone are compared.
    repeated = materialize(docs.groupBy(F.col(id_col).alias("__id")).count().filter("count > 1").select("__id"), "ids")
    again = F.col(id_col).eqNullSafe(F.col("__id"))
    once = found.join(repeated, again, "left_anti")
    twice = found.join(repeated, again, "left_semi").withColumn("__sha", sha)
    return once.union(twice.dropDuplicates([id_col, "__sha"]).drop("__sha"))
