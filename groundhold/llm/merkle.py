"""A Merkle manifest of a dataset: digests of rows folded to a root per partition and to one root, with a proof for every row.

The tree is built by slot pivots: conditional aggregates spread the nodes below one ancestor into columns, one per slot;
concatenated columns hash to their parent, and the columns of a run without a node's own slot are its siblings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .places import placed

FANOUT = 2
LEVELS = 4  # levels that one pivot covers; it has fanout ** levels slots
ROW_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row: each value as its UTF-8 byte count, a colon and itself, or ``-`` for null."""
    texts = [v.cast("string") for v in values]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and its siblings by level lead to."""
    return F.aggregate(path, digest, lambda below, step: F.sha2(F.concat(step["left"], below, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, from the lowest level to the highest, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


# The columns of a pivot are named in SQL text: so many are slow to put together one by one.
def _node(level: int, i: int) -> str:
    return f"s{i}.digest" if level == 0 else f"l{level}_{i}"


def _pivot(nodes: DataFrame, group: Sequence[str], carried: Sequence[str], slots: int) -> DataFrame:
    """One row per run of ``slots`` nodes: group, run, n (nodes of the group at this level), s0.. (digest and carried columns)."""
    node = f"named_struct({', '.join(f"'{c}', {c}" for c in ('digest', *carried))})"
    each = [F.expr(f"first(if(place % {slots} = {i}, {node}, null), true) as s{i}") for i in range(slots)]
    return nodes.groupBy(*group, F.floor(F.col("place") / slots).alias("run")).agg(F.first("n").alias("n"), *each)


def _with_levels(pivot: DataFrame, fanout: int, levels: int) -> DataFrame:
    """Adds l<level>_<i>, the digests above the slots; nodes that a short run lacks are null."""
    for level in range(1, levels + 1):
        hashed = []
        for i in range(fanout ** (levels - level)):
            run = [_node(level - 1, i * fanout + k) for k in range(fanout)]
            hashed.append(f"if({run[0]} is null, null, sha2(concat_ws('', {', '.join(run)}), 256)) as {_node(level, i)}")
        pivot = pivot.selectExpr("*", *hashed)
    return pivot


def _top(fanout: int, levels: int) -> Column:
    """The digest of the whole run: at the level where its group is down to one node, or at the pivot's last level."""
    cases = [f"when n <= {fanout**level} then {_node(level, 0)}" for level in range(levels)]
    return F.expr(f"case {' '.join(cases)} else {_node(levels, 0)} end")


def _siblings(slot: int, fanout: int, levels: int) -> str:
    """A slot's siblings by level, those before it and those after it, up to the level where its group is down to one node."""
    steps = []
    for level in range(levels):
        own = slot // fanout**level
        run = own // fanout * fanout
        names = [_node(level, i) for i in range(run, run + fanout)]
        left, right = (", ".join(["''", *side]) for side in (names[: own - run], names[own - run + 1 :]))
        steps.append(f"named_struct('left', concat_ws({left}), 'right', concat_ws({right}))")
    return f"concat(slice(array({', '.join(steps)}), 1, height), of_path) as p{slot}"


def _each_slot(pivot: DataFrame, fanout: int, levels: int) -> tuple[DataFrame, Column]:
    """The pivot with every slot's path, and the generator of its slots: place, node and path, all null for an empty slot."""
    width = fanout**levels
    height = sum(((F.col("n") > fanout**level).cast("int") for level in range(levels)), F.lit(0))
    paths = [_siblings(i, fanout, levels) for i in range(width)]
    slots = [
        f"if(s{i} is null, null, named_struct('place', run * {width} + {i}, 'node', s{i}, 'path', p{i}))" for i in range(width)
    ]
    return pivot.withColumn("height", height).selectExpr("*", *paths), F.expr(f"inline(array({', '.join(slots)}))")


def _climb(nodes: DataFrame, group: Sequence[str], carried: Sequence[str], fanout: int, levels: int) -> list[DataFrame]:
    """The pivots from the leaves to the roots, materialized; the last one has one row per group."""
    pivots, slots = [], fanout**levels
    while True:
        pivots.append(materialize(_pivot(nodes, group, () if pivots else carried, slots), "merkle-pivot"))
        if pivots[-1].filter("run > 0").isEmpty():
            return pivots
        nodes = _with_levels(pivots[-1], fanout, levels).select(
            *group, F.col("run").alias("place"), F.ceil(F.col("n") / slots).alias("n"), _top(fanout, levels).alias("digest")
        )


def _roots(pivots: list[DataFrame], group: Sequence[str], fanout: int, levels: int) -> DataFrame:
    return _with_levels(pivots[-1], fanout, levels).select(*group, _top(fanout, levels).alias("digest"))


def _descend(
    pivots: list[DataFrame], tops: DataFrame, group: Sequence[str], carried: Sequence[str], fanout: int, levels: int
) -> DataFrame:
    """Every leaf with its carried columns, the columns of its group in ``tops``, and ``path``: the siblings by level.

    ``tops`` has one row per group, with the path from the group's root on. A path is handed down from a run to its slots,
    so only the runs' paths are written, never those of the leaves.
    """
    kept = [c for c in tops.columns if c not in (*group, "path")]
    paths = tops.withColumn("run", F.lit(0).cast("long"))
    for depth in range(len(pivots) - 1, -1, -1):
        above = paths.withColumnsRenamed({**{g: f"of_{g}" for g in group}, "run": "of_run", "path": "of_path"})
        same = F.col("run") == F.col("of_run")
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"of_{g}"))
        joined, slots = _each_slot(_with_levels(pivots[depth].join(above, same), fanout, levels), fanout, levels)
        each = joined.select(*group, *kept, slots).filter("place is not null")
        if depth:
            paths = materialize(each.select(*group, *kept, F.col("place").alias("run"), "path"), "merkle-paths")
    return each.select(*group, *kept, "node.digest", *[F.col(f"node.{c}").alias(c) for c in carried], "path")


def manifest(
    docs: DataFrame, columns: Sequence[str] = ROW_COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
    carry: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``docs``: id, part, leaf, subroot, root, path (the siblings by level, from the leaf to the root).

    A row's leaf is the digest of ``columns``. The leaves of a group ascend by id (null ids first, equal ids by leaf); every
    ``fanout`` consecutive nodes become one, the last run of a level may be shorter, until one is left: the subroot. The
    subroots, ordered by group (null first, then by UTF-8 bytes), lead to the root in the same way. ``carry`` adds columns
    worked out from the row.

    Null, empty and very long values differ from each other in the leaf. Repeated rows are leaves of their own. A single
    row is leaf and root, with an empty path. An empty table gives no rows. Only ``columns``, id, group and what ``carry``
    reads are read, whatever other columns are called. A group that holds much of the table spreads over all tasks.
    """
    if fanout < 2 or levels < 1:
        raise ValueError("a tree needs a fanout of 2 and a level")
    carry = carry or {}
    extra = [f"k{i}" for i in range(len(carry))]
    rows = docs.select(
        F.col(group_col).alias("part"), F.col(id_col).alias("id"), leaf([F.col(c) for c in columns]).alias("digest"),
        *[column.alias(k) for k, column in zip(extra, carry.values(), strict=True)],
    )
    carried, one = ["id", *extra], ["part"]
    nodes = placed(rows, one, [F.asc_nulls_first("id"), F.asc("digest")], "merkle-leaves").withColumnRenamed("places", "n")
    pivots = _climb(nodes, one, carried, fanout, levels)
    subroots = placed(_roots(pivots, one, fanout, levels), [], [F.asc_nulls_first("part")], "merkle-subroots")
    upper = _climb(subroots.withColumnRenamed("places", "n"), [], one, fanout, levels)
    no_path = F.array().cast("array<struct<left: string, right: string>>")
    root = _roots(upper, [], fanout, levels).select(F.col("digest").alias("root"), no_path.alias("path"))
    tops = _descend(upper, root, [], one, fanout, levels).withColumnRenamed("digest", "subroot")
    tops = materialize(tops.select("part", "subroot", "root", "path"), "merkle-tops")
    found = _descend(pivots, tops, one, carried, fanout, levels)
    return found.select(
        "id", "part", F.col("digest").alias("leaf"), "subroot", "root", "path",
        *[F.col(k).alias(name) for k, name in zip(extra, carry, strict=True)],
    )
