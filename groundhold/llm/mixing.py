"""Mixing sources to target weights: equal blocks of words apportioned by highest quotients, then drawn with a seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialize, small, words
from .places import placed

WEIGHTS = (5, 2, 1)
MAX_PASSES = 3  # no source, and no document, is taken more often
BLOCK_WORDS = 64
SHARD_WORDS = 1_000_000
# Primes that stand for steps of the permutation of a shard's blocks; above any number of blocks.
STEPS = (1_000_000_007, 1_000_000_009, 1_000_000_021, 1_000_000_033)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """One row per source: source, source_size, target (double), blocks' claim; ``sizes`` has source and size.

    Sources in code point order, null last, weigh ``weights``, repeating. All words are shared by weight; a source stops
    at ``passes`` times its size and the excess goes to the others by weight. With the sources sorted by how soon they
    stop, the level that the others reach after the first k have stopped follows from two running sums. The window runs
    over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.get(F.array(*map(F.lit, weights)), (rank % len(weights)).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", passes * F.col("source_size"))
    soon = W.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before, everything = soon.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = per.withColumn("level", rest / open_weight)
    # The first source that its level does not fill sets the level of all that follow.
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    reached = F.first(fits, ignorenulls=True).over(soon.rowsBetween(W.unboundedPreceding, 0))
    target = F.least(F.coalesce(reached * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double"))
    return levels.select("source", "source_size", target.alias("target"))


def apportion(parties: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Adds ``quota``: round(sum of ``votes``) seats, each to the highest quotient votes / (2 * seats so far + 1).

    ``parties`` is materialized and has ``keys``, votes and ``most``, the seats that a party can take. With n parties and v
    votes in all, the last quotient that wins lies between v / (seats + n/2) and v / (seats - n/2), halved: what lies above
    is given at once, what lies below never wins, and the quotients between, at most two per party on average, are ranked.
    The rank is that of a distributed sort. Ties go to the order of ``keys``.
    """
    n, all_votes, seats = parties.agg(F.count(F.lit(1)), F.sum("votes"), F.round(F.sum("votes"))).first()
    if not n or not all_votes:
        return parties.withColumn("quota", F.lit(0).cast("long"))

    def over(divisor: float) -> Column:
        return F.least(F.floor(F.col("votes") / divisor + 0.5), F.col("most"))

    wide, narrow = all_votes / (seats + n / 2 + 1), seats - n / 2 - 1
    low = over(all_votes / narrow) if narrow > 0 else F.lit(0)
    sure = parties.withColumn("given", low.cast("long")).withColumn("limit", over(wide).cast("long"))
    left = int(seats) - sure.agg(F.sum("given")).first()[0]
    rivals = sure.filter("limit > given").select(*keys, "votes", F.explode(F.sequence("given", F.col("limit") - 1)).alias("seat"))
    rivals = rivals.withColumn("quotient", F.col("votes") / (2 * F.col("seat") + 1))
    order = [F.desc("quotient"), *[F.asc(k) for k in keys], F.asc("seat")]
    won = placed(rivals, [], order, "mix-quotients").filter(F.col("place") < left)
    won = won.groupBy(*keys).agg(F.count(F.lit(1)).alias("won"))
    return sure.join(won, list(keys), "left").withColumn("quota", F.col("given") + F.coalesce("won", F.lit(0))).drop("given", "limit", "won")


def block_of(at: Column) -> Column:
    """The block of the word at a place of its shard; a shard's words are cut into blocks that differ by one word at most."""
    return F.floor(((at + 1) * F.col("blocks") - 1) / F.col("words")).cast("long")


def block_start(block: Column) -> Column:
    return F.floor(block * F.col("words") / F.col("blocks")).cast("long")


def times(block: Column) -> Column:
    """How often a block is taken: the quota dealt evenly, the rest to the first blocks of a seeded permutation.

    Block j is at place (step * j + turn) mod blocks; the step is a prime above any number of blocks, so all places differ.
    """
    place = (F.col("step") * block + F.col("turn")) % F.col("blocks")
    return F.floor(F.col("quota") / F.col("blocks")).cast("long") + (place < F.col("quota") % F.col("blocks")).cast("long")


def plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 11,
    block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, keys: Sequence[str] = (),
) -> DataFrame:
    """One row per document: ``keys``, id, source, size, source_size, target, shard, at (words before it in its shard).

    And of its shard: words, blocks, quota (blocks to take, repeats counted), step and turn of the permutation.

    The words of a source are dealt to shards by a seeded hash of the ids, so that a hot source spreads over many of
    them, and lie in each shard in the order of the hash. A shard is cut into equal blocks of ``block_words`` at most, so a
    small source has small blocks. The blocks of all sources and shards are apportioned together: a shard's votes are the
    blocks that its part of the source's target comes to. Its quota is at most three times its blocks, which are taken by
    a seeded permutation: no table of blocks is made.
    """
    rows = docs.select(
        *keys, F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    rows = materialize(rows, "mix-sizes")
    goals = materialize(targets(rows), "mix-targets")
    same = F.col("source").eqNullSafe(F.col("of"))
    number = F.row_number().over(W.orderBy(F.asc_nulls_last("of"))) - 1
    goals = materialize(
        goals.withColumnRenamed("source", "of").withColumn("no", number.cast("long")).withColumn(
            "shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
        ),
        "mix-targets",
    )
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("null"))))
    pick = F.conv(F.left(draw, F.lit(8)), 16, 10).cast("long")
    dealt = rows.join(small(goals), same).drop("of").withColumn("draw", draw).withColumn("shard", pick % F.col("shards"))

    shards = dealt.groupBy("no", "shard").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("all"))
    shards = shards.filter("words > 0").withColumn("blocks", F.ceil(F.col("words") / block_words))
    votes = F.col("target") * F.col("blocks") / F.col("all")
    shards = shards.select("no", "shard", "words", "blocks", votes.alias("votes"), (MAX_PASSES * F.col("blocks")).alias("most"))
    quotas = apportion(materialize(shards, "mix-shards"), ["no", "shard"])
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), "no", "shard"))
    step = F.get(F.array(*map(F.lit, STEPS)), (F.conv(F.substring(key, 9, 4), 16, 10).cast("long") % len(STEPS)).cast("int"))
    turn = F.conv(F.left(key, F.lit(8)), 16, 10).cast("long") % F.col("blocks")
    quotas = materialize(quotas.select("no", "shard", "words", "blocks", "quota", step.alias("step"), turn.alias("turn")), "mix-quotas")

    line = W.partitionBy("no", "shard").orderBy("draw", "id", "size", *keys)
    at = F.sum("size").over(line.rowsBetween(W.unboundedPreceding, -1))
    placed_rows = dealt.withColumn("at", F.coalesce(at, F.lit(0))).drop("draw", "shards")
    return placed_rows.join(quotas, ["no", "shard"], "left")


def touched_blocks() -> Column:
    """The blocks that a document's words lie in, as their numbers."""
    return F.sequence(block_of(F.col("at")), block_of(F.col("at") + F.col("size") - 1))


def overlap(block: Column) -> tuple[Column, Column]:
    """The words of a document, from and up to, that lie in a block."""
    start = F.greatest(block_start(block), F.col("at")) - F.col("at")
    return start, F.least(block_start(block + 1), F.col("at") + F.col("size")) - F.col("at")


def mix(docs: DataFrame, seed: int = 11, block_words: int = BLOCK_WORDS, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    A document without words has size 0 and takes nothing. Rows that repeat an id are documents of their own, in the
    order of their sizes; rows that repeat all of it are taken as if they shared what both take. A null id is drawn like
    the word null. A null source is a source, after the others. An empty table gives no rows. Runs agree.
    """
    rows = plan(docs, seed=seed, block_words=block_words, **options)

    def add(total: Column, block: Column) -> Column:
        start, end = overlap(block)
        return total + (end - start) * times(block)

    taken = F.when(F.col("size") > 0, F.aggregate(touched_blocks(), F.lit(0).cast("long"), add)).otherwise(F.lit(0))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 11,
    block_words: int = BLOCK_WORDS, **options,
) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each pass over a document that takes words of it.

    The first pass holds the words of all blocks taken once or more, the second those taken twice or more, and so on. A
    pass that takes all words is the text as it was; else words are parted by blanks, and blocks that don't follow each
    other by line ends. n_chars, where there is such a column, follows a text that was cut. Documents without words take
    nothing and go. The rows are written once with a number each, so rows that repeat an id stay apart.
    """
    tagged = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "mix-documents")
    rows = plan(tagged, id_col, text_col, source_col, seed, block_words, keys=("__row",), **options)
    touched = rows.filter("size > 0 and quota > 0").withColumn("block", F.explode(touched_blocks()))
    start, end = overlap(F.col("block"))
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    touched = touched.select("__row", "size", start.alias("from"), end.alias("to"), times(F.col("block")).alias("times"))
    spans = touched.filter("times > 0").select("__row", "size", "from", "to", each.alias("__pass"))
    passes = spans.groupBy("__row", "__pass").agg(
        F.sum(F.col("to") - F.col("from")).alias("words"), F.first("size").alias("size"),
        F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"),
    )
    part = F.col("words") < F.col("size")
    passes = materialize(passes.select("__row", "__pass", F.when(part, F.col("spans")).alias("__spans")), "mix-passes")
    found = tagged.join(passes, "__row").withColumn("__words", F.when(F.col("__spans").isNotNull(), words(F.col(text_col))))

    def span(s: Column, i: Column) -> Column:
        follows = F.get("__spans", i - 1)["to"] == s["from"]
        mark = F.when(i == 0, F.lit("")).when(follows, F.lit(" ")).otherwise(F.lit("\n"))
        own = F.slice("__words", (s["from"] + 1).cast("int"), (s["to"] - s["from"]).cast("int"))
        return F.concat(mark, F.array_join(own, " "))

    # The check of the array's size keeps it a column of its own, split once per row.
    cut = F.when(F.size("__words") > 0, F.array_join(F.transform("__spans", span), ""))
    columns = {text_col: F.coalesce(cut, F.col(text_col))}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.coalesce(F.char_length(cut).cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return found.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])
