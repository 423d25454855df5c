"""Repair of conversations by the cheapest edits: a checkpointed dynamic programme over the rows of each conversation.

Kept rows have to read as an optional system turn, then user and assistant in turn. Going backward, every place of a
conversation has a vector of four costs, one per state of that pattern. A conversation of n rows is cut into blocks of
about sqrt(n) rows. Vectors are stored at the blocks' ends only: a block's rows together are a matrix of costs from state
to state, and the matrices of one conversation, about sqrt(n) of them, give the vectors at the checkpoints. Then every block
works out its own vectors again and walks forward, taking the smallest letter among the edits that are tight. Blocks are
walked at the same time, from each state they may be entered in; following the states from block to block picks the walk.
No step holds more than a block, the checkpoints or the edit letters of one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CHARS, materialize
from .places import placed

DELETE, INSERT, KEEP, REROLE = "DIKR"
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
# States: nothing written yet, after system, after user, after assistant. A conversation may end in the first and the last.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = (USER, USER, ASSISTANT, USER)  # what a written or rewritten role has to be in each state
END = (0, 6, 3, 0)  # cost of the inserts that complete each state
ROLES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 60

# A row is one character: s, u, a or x (any other initial) for a sound row, a capital for a truncated one, 1 to 4 for a blank
# and 5 to 8 for a duplicate one.
SOUND, TRUNCATED, BLANK, DUPLICATE = "suax", "SUAX", "1234", "5678"
INITIAL = {code: "suax"[i] for kind in (SOUND, TRUNCATED, BLANK, DUPLICATE) for i, code in enumerate(kind)}
LEGAL = {"su", "ua", "au"}

Vector = tuple[int, ...]


def _moves(code: str, state: int, after: Vector) -> Iterator[tuple[str, int, int]]:
    """The edits of a row in a state, but for inserts before it, smallest letter first: letter, state reached, cost to the end."""
    yield DELETE, state, DELETE_COST + after[state]
    if code in BLANK or code in DUPLICATE:
        return
    extra, initial = TRUNCATED_COST if code in TRUNCATED else 0, INITIAL[code]
    follows = FOLLOWS[state]
    if initial == "s" and state == START:
        yield KEEP, SYSTEM, extra + after[SYSTEM]
    if initial == ROLES[follows][0]:
        yield KEEP, follows, extra + after[follows]
    yield REROLE, follows, REROLE_COST + extra + after[follows]


def vectors(codes: str, after: Vector) -> list[Vector]:
    """The cost vector before each row of a block, and at last ``after``, that behind it."""
    found = [after]
    for code in reversed(codes):
        best = [min(cost for _, _, cost in _moves(code, state, found[-1])) for state in range(4)]
        # Inserts before the row: user and assistant lead to each other, the other states to user.
        user, assistant = best[USER], best[ASSISTANT]
        best[USER], best[ASSISTANT] = min(user, INSERT_COST + assistant), min(assistant, INSERT_COST + user)
        best[START], best[SYSTEM] = (min(best[s], INSERT_COST + best[USER]) for s in (START, SYSTEM))
        found.append(tuple(best))
    return found[::-1]


@lru_cache(100_000)
def block_costs(codes: str) -> list[int]:
    """The least cost of a block from state s to state t, at 4 * s + t."""
    ends = [tuple(0 if t == end else FAR for t in range(4)) for end in range(4)]
    columns = [vectors(codes, end)[0] for end in ends]
    return [min(columns[t][s], FAR) for s in range(4) for t in range(4)]


def checkpoints(matrices: list[list[int]]) -> list[Vector]:
    """The vectors behind each block of a conversation, and at last that before the first one."""
    found = [END]
    for costs in reversed(matrices):
        after = found[-1]
        found.append(tuple(min(costs[4 * s + t] + after[t] for t in range(4)) for s in range(4)))
    return [*found[-2::-1], found[-1]]


@lru_cache(100_000)
def walk(codes: str, after: Vector, last: bool) -> tuple[list[str], list[int]]:
    """The edits of a block and the state it is left in, for each state it may be entered in."""
    known, letters, ends = vectors(codes, after), [], []
    for state in range(4):
        edits = []
        for i, code in enumerate(codes):
            left = known[i][state]
            while True:
                tight = [(letter, to) for letter, to, cost in _moves(code, state, known[i + 1]) if cost == left]
                follows = FOLLOWS[state]
                if INSERT_COST + known[i][follows] == left and not (tight and tight[0][0] == DELETE):
                    edits.append(INSERT)
                    state, left = follows, known[i][follows]
                    continue
                letter, state = tight[0]
                edits.append(letter)
                break
        while last and END[state]:
            edits.append(INSERT)
            state = FOLLOWS[state]
        letters.append("".join(edits))
        ends.append(state)
    return letters, ends


def _illegal(initials: str) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


BLOCK_SCHEMA = "conv {conv}, block long, codes string, last boolean, costs array<long>"
WALK_SCHEMA = "conv {conv}, block long, audits array<string>, ends array<int>, head string, tail string, illegal long"
AUDIT_SCHEMA = "conv {conv}, audit string, illegal long"


def _rowwise(schema: str, work):
    """A function for mapInArrow that hands each row, as a dictionary, to ``work`` and collects what it returns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 1000):
                rows = [work(row) for row in batch.slice(low, 1000).to_pylist()]
                yield pa.RecordBatch.from_pylist(rows, arrow)

    return run


def _turns(rows: DataFrame) -> DataFrame:
    """conv, gaps: whole turn numbers between the least and the greatest that no row has."""
    turns = rows.filter("turn is not null").select("conv", "turn").distinct().groupBy("conv")
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.agg(span.cast("long").alias("gaps"))


def _named(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv, turn, role, text, digest: nulls in role and text are one blank; the digest orders the rows of one turn."""
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in (role_col, text_col))
    rows = conversations.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(whole, 256)))


def _coded(rows: DataFrame) -> DataFrame:
    """conv, place, places, code: one character per row, in the order of turns."""
    bare = F.rtrim("text", F.lit(SPACE_CHARS))
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("x")
    # blank, truncated, sound; what is a duplicate follows below
    fault = F.when(bare == "", 2).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), 1).otherwise(0)
    slim = rows.select("conv", "turn", "digest", initial.alias("initial"), fault.cast("byte").alias("fault"))
    slim = placed(slim, ["conv"], [F.asc_nulls_first("turn"), F.asc("digest")], "repair-rows")
    slim = materialize(slim, "repair-places")
    first = slim.groupBy("conv", "digest").agg(F.min("place").alias("first"))
    first = first.select(F.col("conv").alias("of"), "first")
    marked = slim.join(first, F.col("conv").eqNullSafe(F.col("of")) & (F.col("place") == F.col("first")), "left")
    kind = F.instr(F.lit(SOUND), F.col("initial"))

    def code(kinds: str) -> Column:
        return F.substring(F.lit(kinds), kind, F.lit(1))

    found = F.when(F.col("fault") == 2, code(BLANK)).when(F.col("first").isNull(), code(DUPLICATE))
    found = found.when(F.col("fault") == 1, code(TRUNCATED)).otherwise(code(SOUND))
    return marked.select("conv", "turn", "place", "places", found.alias("code"))


def audits(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``audit`` has a letter per edit, in order: K keep (free), R give another role (3), D delete (4), I insert an empty row
    (3); a truncated row that isn't deleted adds 3. Blank rows (no character but white space) and duplicates (role and text
    of an earlier row) must go. Of the cheapest sequences of edits, ``audit`` is the smallest in ASCII.

    Rows go by turn, nulls first; rows of one turn go by a digest of role and text. A null role or text counts as one blank;
    a null conversation is one conversation. Repeated rows are rows; all but the first are duplicates. Texts are read whole,
    however long. An empty table gives no rows; other columns are ignored. A conversation that holds much of the table is
    spread over tasks by its turns.
    """
    rows = _named(conversations, conv_col, turn_col, role_col, text_col)
    coded = _coded(rows)
    conv = rows.schema["conv"].dataType.simpleString()
    length = F.ceil(F.sqrt("places")).cast("long")
    coded = coded.withColumn("block", F.floor(F.col("place") / length)).withColumn(
        "last", F.floor((F.col("places") - 1) / length) == F.col("block")
    )
    ordered = F.array_sort(F.collect_list(F.struct("place", "code")))
    blocks = coded.groupBy("conv", "block").agg(
        F.array_join(F.transform(ordered, lambda x: x["code"]), "").alias("codes"), F.first("last").alias("last")
    )

    def weigh(row: dict) -> dict:
        return {**row, "costs": block_costs(row["codes"])}

    schema = BLOCK_SCHEMA.format(conv=conv)
    blocks = materialize(blocks.mapInArrow(_rowwise(schema, weigh), schema), "repair-blocks")

    def check(row: dict) -> dict:
        vectors_ = checkpoints([m["costs"] for m in row["matrices"]])
        return {"conv": row["conv"], "cost": vectors_[-1][START], "after": [list(v) for v in vectors_[:-1]]}

    counts = [F.sum(F.regexp_count("codes", F.lit(f"[{kinds}]"))).alias(name) for name, kinds in (("blank", BLANK), ("duplicate", DUPLICATE), ("truncated", TRUNCATED))]
    schema = f"conv {conv}, cost long, after array<array<long>>"
    matrices = blocks.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "costs"))).alias("matrices"))
    stored = materialize(matrices.mapInArrow(_rowwise(schema, check), schema), "repair-checkpoints")
    ends = stored.select(F.col("conv").alias("of"), F.posexplode("after").alias("at", "after"))
    joined = blocks.join(ends, F.col("conv").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))

    def step(row: dict) -> dict:
        codes = row["codes"]
        letters, states = walk(codes, tuple(row["after"]), row["last"])
        initials = "".join(map(INITIAL.__getitem__, codes))
        return {
            "conv": row["conv"], "block": row["block"], "audits": letters, "ends": states, "head": initials[0],
            "tail": initials[-1], "illegal": _illegal(initials),
        }

    schema = WALK_SCHEMA.format(conv=conv)
    walks = joined.select("conv", "block", "codes", "last", "after").mapInArrow(_rowwise(schema, step), schema)
    kept = F.struct("block", "audits", "ends", "head", "tail", "illegal")
    walks = walks.groupBy("conv").agg(F.array_sort(F.collect_list(kept)).alias("walks"))

    def follow(row: dict) -> dict:
        state, letters, illegal, tail = START, [], 0, ""
        for block in row["walks"]:
            letters.append(block["audits"][state])
            state = block["ends"][state]
            illegal += block["illegal"] + (tail != "" and tail + block["head"] not in LEGAL)
            tail = block["tail"]
        return {"conv": row["conv"], "audit": "".join(letters), "illegal": illegal}

    schema = AUDIT_SCHEMA.format(conv=conv)
    found = walks.mapInArrow(_rowwise(schema, follow), schema)
    for more in (stored.select("conv", "cost"), blocks.groupBy("conv").agg(*counts), _turns(rows)):
        more = more.withColumnRenamed("conv", "of")
        found = found.join(more, F.col("conv").eqNullSafe(F.col("of")), "left").drop("of")
    names = ("blank", "duplicate", "truncated", "illegal", "cost")
    return found.select("conv", F.coalesce("gaps", F.lit(0)).alias("gaps"), *names, "audit")


def repaired(
    conversations: DataFrame, found: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The repaired rows: conv, place (from 0), edit, role, text; ``found`` is what ``audits`` returned for the same rows.

    The rows of a conversation follow each other inside one partition, in order. They stream past their edit letters, so a
    task holds the letters of one conversation and a batch of rows.
    """
    rows = _named(conversations, conv_col, turn_col, role_col, text_col)
    nothing = {"role": F.lit(None).cast("string"), "text": F.lit(None).cast("string"), "digest": F.lit(None).cast("binary")}
    plan = found.select("conv", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), "audit").withColumns(nothing)
    both = rows.withColumn("audit", F.lit(None).cast("string")).unionByName(plan)
    order = ["conv", F.col("audit").isNull(), F.asc_nulls_first("turn"), "digest"]
    sorted_rows = both.repartition("conv").sortWithinPartitions(*order).select("conv", "audit", "role", "text")
    conv = rows.schema["conv"].dataType.simpleString()
    schema = f"conv {conv}, place long, edit string, role string, text string"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, audit, at, state, place = None, "", 0, START, 0
        out: list[tuple] = []

        def write(letter: str, role: str, text: str) -> None:
            nonlocal place
            out.append((conv, place, letter, role, text))
            place += 1

        def inserts() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == INSERT:
                state = FOLLOWS[state]
                write(INSERT, ROLES[state], "")
                at += 1

        def flush() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * 5
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types, strict=True)], schema=arrow)
            out.clear()
            return batch

        for whole in batches:
            for low in range(0, len(whole), 256):
                for row in whole.slice(low, 256).to_pylist():
                    if row["audit"] is not None:
                        inserts()
                        conv, audit, at, state, place = row["conv"], row["audit"], 0, START, 0
                        continue
                    inserts()
                    letter = audit[at]
                    at += 1
                    if letter == DELETE:
                        continue
                    role = row["role"]
                    if letter == REROLE:
                        state = FOLLOWS[state]
                        role = ROLES[state]
                    else:
                        state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
                    write(letter, role, row["text"])
                yield flush()
        inserts()
        yield flush()

    return sorted_rows.mapInArrow(edit, schema)


def text_digests(rows: DataFrame) -> DataFrame:
    """conv, repaired_sha256: the digest of ``role:text`` by line, of rows that ``repaired`` returned, in their order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv = None, None
        for whole in batches:
            out: list[tuple] = []
            for low in range(0, len(whole), 256):
                for row in whole.slice(low, 256).to_pylist():
                    if row["place"] == 0:
                        if state is not None:
                            out.append((conv, state.hexdigest()))
                        state, conv = hashlib.sha256(), row["conv"]
                    else:
                        state.update(b"\n")
                    state.update(f"{row['role']}:{row['text']}".encode())
            yield _digest_rows(out, whole.schema.field("conv").type)
        if state is not None:
            yield _digest_rows([(conv, state.hexdigest())], whole.schema.field("conv").type)

    conv = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(digest, f"conv {conv}, repaired_sha256 string")


def _digest_rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    convs, digests = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(convs, kind), pa.array(digests, pa.string())], ["conv", "repaired_sha256"])
