"""Quality rules whose cutoffs carry a guarantee: exact binomial bounds on labelled holdouts, per stratum."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, materialize, small, words

# A rule rejects a document whose score, a whole number, lies above the cutoff.
RULES = {
    "symbols": "least(5000L, 1000 * n_symbols div n_words)",
    "repeats": "1000 * n_repeat_words div n_words",
    "copied_lines": "1000 * n_dup_lines div greatest(n_lines, 1L)",
    "long_words": "least(5000L, 100 * word_chars div n_words)",
}
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ALPHA = 0.02  # share of good documents that may be lost in a stratum, all rules together
DELTA = 0.05  # chance that any of the bounds fails


def _repeated_words(text_words: Column, sorted_windows: Column, mask: Column) -> Column:
    """Words inside windows of three that occur twice or more.

    Each sorted number holds the hash of a window above ``mask`` and its place below.
    Neighbours with equal hashes are compared word by word.
    """

    def same(x: Column, y: Column) -> Column:
        i, j = x.bitwiseAND(mask).cast("int"), y.bitwiseAND(mask).cast("int")
        equal = x.bitwiseAND(F.bitwise_not(mask)) == y.bitwiseAND(F.bitwise_not(mask))
        for k in range(3):
            equal = equal & (F.get(text_words, i + k) == F.get(text_words, j + k))
        return equal

    repeated = F.filter(
        sorted_windows,
        lambda x, k: F.coalesce(same(x, F.get(sorted_windows, k + 1)), F.lit(False))
        | F.coalesce(same(x, F.get(sorted_windows, k - 1)), F.lit(False)),
    )
    places = F.transform(repeated, lambda x: x.bitwiseAND(mask))
    return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.array(p, p + 1, p + 2)))))


def measures(docs: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words (long).

    One narrow pass: every count is an expression over the text's own arrays, so nothing is shuffled and a long text
    costs n log n. Null, empty and blank texts have 0 everywhere. n_lines are the lines with a word.
    """
    text = F.coalesce(F.col("t"), F.lit(""))
    rows = docs.select(*keep, F.col(text_col).alias("t")).withColumn("w", words(F.col("t")))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_CHAR))
    rows = rows.select(
        *keep, "w",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("l"),
    )
    bits = F.ceil(F.log2(F.greatest(F.col("n_words"), F.lit(2)))).cast("int")
    rows = rows.select(
        *keep, "w", "n_words", "word_chars", "n_symbols",
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        (F.expr("1L") * F.pow(F.lit(2), bits) - 1).cast("long").alias("mask"),
    )
    starts = F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), (F.col("n_words") - 3).cast("int")))
    windows = F.transform(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
        .bitwiseAND(F.bitwise_not(F.col("mask")))
        .bitwiseOR(i.cast("long")),
    )
    rows = rows.withColumn("sorted", F.sort_array(windows))
    repeated = _repeated_words(F.col("w"), F.col("sorted"), F.col("mask"))
    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines",
        repeated.cast("long").alias("n_repeat_words"),
    )


WORD_CHAR = SPACE.replace("[", "[^")


def base_failed() -> Column:
    words_, repeats = F.col("n_words"), F.col("n_repeat_words")
    return (words_ < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words_)


def _allowed(n: Column, alpha: float, delta: Column) -> Column:
    """The most rejections among n good documents for which the exact binomial bound stays below alpha; -1 if none.

    The bound holds for k rejections when P(Bin(n, alpha) <= k) <= delta. Terms are summed in logarithms.
    """
    from math import log, log1p

    start = F.struct((n * log1p(-alpha)).alias("term"), F.lit(0.0).alias("total"), F.lit(-1).cast("long").alias("k"))

    def step(state: Column, k: Column) -> Column:
        total = state["total"] + F.exp(state["term"])
        following = state["term"] + F.log((n - k) / (k + 1)) + (log(alpha) - log1p(-alpha))
        return F.struct(
            F.when(k < n, following).otherwise(F.lit(float("-inf"))).alias("term"),
            total.alias("total"),
            F.when(total <= delta, k).otherwise(state["k"]).alias("k"),
        )

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * alpha)), start, step)["k"]


def cutoffs(
    labelled: DataFrame, strata: Sequence[str], alpha: float = ALPHA, delta: float = DELTA
) -> DataFrame:
    """One row per stratum and rule with a cutoff: the strata's columns, rule, cutoff.

    ``labelled`` holds the strata, n_words and the other counts, and good (boolean); rows that fail the base rules are
    not looked at, since no cutoff can lose them. A rule may lose alpha / rules of the good documents. Its cutoffs
    are tried from lenient to strict (a fixed order, which needs no further correction), and the chance delta is divided
    among all strata and rules (Bonferroni). Of the cutoffs whose bound holds, the one with the most bad less good
    documents above it is taken, the most lenient of equals; none if that is not positive.
    """
    scored = labelled.filter(~base_failed()).select(
        *strata, "good", F.explode(F.map_from_arrays(
            F.array(*map(F.lit, RULES)), F.array(*[F.expr(f"cast({e} as long)") for e in RULES.values()])
        )).alias("rule", "score"),
    )
    # From here on the rows are strata x rules x scores; the scores are bounded by the rules.
    cells = scored.groupBy(*strata, "rule", "score").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    group = W.partitionBy(*strata, "rule")
    above = group.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)
    tried = cells.select(
        *strata, "rule", "score",
        F.coalesce(F.sum("good").over(above), F.lit(0)).alias("lost"),
        F.coalesce(F.sum("bad").over(above), F.lit(0)).alias("caught"),
        F.sum("good").over(group).alias("n"),
    )
    tried = materialize(tried, "cutoffs")
    families = max(1, tried.select(*strata, "rule").distinct().count())
    limit = _allowed(F.col("n"), alpha / len(RULES), F.lit(delta / families))
    own = [*strata, "rule"]
    limits = tried.groupBy(*[F.col(c).alias(f"of_{c}") for c in own]).agg(F.max("n").alias("n"))
    limits = limits.withColumn("allowed", limit).drop("n")
    same = F.lit(True)
    for c in own:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    gain = F.col("caught") - F.col("lost")
    certified = tried.join(limits, same).filter((F.col("lost") <= F.col("allowed")) & (gain > 0))
    certified = certified.select(*own, "score", gain.alias("gain"))
    best = certified.groupBy(*strata, "rule").agg(F.max_by("score", F.struct("gain", "score")).alias("cutoff"))
    return materialize(best, "cutoffs")


def judge(
    docs: DataFrame, labels: DataFrame, strata: Sequence[str] = ("lang",), id_col: str = "doc_id",
    text_col: str = "text", alpha: float = ALPHA, delta: float = DELTA, keys: Sequence[str] = (),
) -> DataFrame:
    """One row per document: id_col, ``keys``, the measures, base_failed, kept.

    ``labels`` (doc_id, quality) marks good (1) and bad (0) documents; a document with both labels counts as good, null
    labels and labels without a document are ignored. A stratum without labels, or with too few to prove a cutoff,
    loses only what the base rules reject. A null stratum is a stratum of its own. Rows that share an id are judged each
    by its own text. Empty tables give no rows, or no cutoffs.
    """
    own = [F.col(c).alias(f"stratum_{i}") for i, c in enumerate(strata)]
    names = [f"stratum_{i}" for i in range(len(strata))]
    slim = docs.select(F.col(id_col).alias("id"), *keys, *own, F.col(text_col).alias("text"))
    measured = materialize(measures(slim, ["id", *[k for k in keys], *names]), "measures")
    marks = labels.filter("quality is not null").groupBy("doc_id").agg((F.max("quality") == 1).alias("good"))
    labelled = measured.join(marks, F.col("id") == F.col("doc_id"))
    found = small(cutoffs(labelled, names, alpha, delta))
    per_stratum = found.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts"))
    per_stratum = per_stratum.select(*[F.col(c).alias(f"cut_{c}") for c in names], "cuts")
    condition = F.lit(True)
    for c in names:
        condition = condition & F.col(c).eqNullSafe(F.col(f"cut_{c}"))
    joined = measured.join(small(materialize(per_stratum, "cuts")), condition, "left")
    rejected = F.lit(False)
    for rule, score in RULES.items():
        over = (F.col("n_words") > 0) & (F.expr(score) > F.element_at("cuts", F.lit(rule)))
        rejected = rejected | F.coalesce(over, F.lit(False))
    failed = base_failed()
    return joined.select(
        F.col("id").alias(id_col), *keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
        failed.alias("base_failed"), (~failed & ~rejected).alias("kept"),
    )


def drop_rejected(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns; rows are found again by id and text."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    sha = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    hashed = docs.withColumn("__sha", sha)
    judged = judge(hashed, labels, keys=["__sha"], **options)
    kept = judged.filter("kept").select(F.col(id_col).alias("__id"), F.col("__sha").alias("__of")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__of"))
    return hashed.join(kept, same, "left_semi").drop("__sha")
