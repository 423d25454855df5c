"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    content_sort,
    conversation_repair,
    license_classifier,
    line_edit_join,
    merkle,
    mixing,
    packing,
    recurrent_lm,
    risk_quality,
    secret_scan,
    sentence_spans,
    set_sketch,
    warc_derivatives,
)
from .common import materialize, table


def _tokenizer() -> dict[str, str]:
    import public_tokenizers

    return {
        "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
        "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    }


def op1_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


def op2_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_edit_join.line_classes(table(spark, sf_dir, "documents")).drop("row")


# The stored pages carry no time of their own; the records get this one.
CRAWLED = "2025-01-01T00:00:00Z"


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document, as counts and a digest."""
    cut = sentence_spans.cut_passages(table(spark, sf_dir, "documents"))
    return cut.select(
        F.col("id").alias("doc_id"), "n_sentences", "n_removed", "removed_words",
        F.char_length("text").cast("long").alias("left_chars"), F.sha2("text", 256).alias("text_sha256"),
    )


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derivatives' headers; of the records themselves a digest."""
    records = warc_derivatives.responses(table(spark, sf_dir, "pages"), CRAWLED)
    derived = warc_derivatives.derive(records).withColumnRenamed("id", "page_id")
    return derived.withColumn("record_sha256", F.sha2("record", 256)).drop("record")


def op5_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_groups(table(spark, sf_dir, "documents"))


def op6_risk_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_license_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest leaves the probabilities out: their last digits depend on the order of sums."""
    return license_classifier.licences(table(spark, sf_dir, "documents")).drop("probability")


def op8_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_set_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_sketch.near_duplicates(table(spark, sf_dir, "documents"), width=4)


def op10_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), **_tokenizer())


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as damaged by the crc32 of conversation and turn: dropped, emptied, cut, repeated or given to the user."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    hit = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), hit.alias("hit")).filter("hit <> 0").select(
        "conv_id", "turn", F.when(F.col("hit") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("hit") == 1, "").when(F.col("hit") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("hit") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, edits and the repaired text's digest of every conversation, its rows damaged first."""
    whole = table(spark, sf_dir, "conversations")
    rows = damaged(whole)
    found = materialize(conversation_repair.audits(rows), "repair-audits")
    digests = conversation_repair.text_digests(conversation_repair.repaired(rows, found)).withColumnRenamed("conv", "of")
    every = whole.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("of")), "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of every document as counts, a digest of the base kinds, and text."""
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"), _tokenizer()["ranks"])

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    return found.select(
        F.col("id").alias("doc_id"), *map(of, secret_scan.BASE_KINDS), F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"), of("random"),
    )


def tampered_leaf() -> Column:
    """The leaf of a row to whose n_chars one was added; that of the row itself where the crc32 of its id isn't divisible by 7."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(hit, F.try_add("n_chars", F.lit(1))).otherwise(F.col("n_chars"))
    return merkle.leaf([n_chars if c == "n_chars" else F.col(c) for c in merkle.ROW_COLUMNS])


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests and proofs of every row, and whether the rows as tampered with still lead to the root."""
    found = merkle.manifest(table(spark, sf_dir, "documents"), carry={"claimed": tampered_leaf()})
    found = found.withColumn("folded_root", merkle.folded(F.col("claimed"), F.col("path")))
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    name: query for name, query in globals().items() if name.startswith("op") and callable(query)
}
