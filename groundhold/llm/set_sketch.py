"""Near duplicates by set sketches: registers of truncated exponential minima, banded, judged jointly, then verified."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .graph import connected_components
from .hashing import Words, mixed

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 32, 5  # a pair at 0.8 shares no band with chance (1 - 0.8^5)^32 = 3e-6
BASE = 1.001  # registers step by this factor
RATE = 20.0
WIDE = 16  # members from which on a bucket is worth a centre
UNLIKELY = 18.0  # a candidate goes if its likelihood at the threshold is e^18 times smaller than at its best

SKETCH_SCHEMA = "id long, n long, a long, b long, registers binary"


class Shingles:
    """The distinct hashed runs of ``width`` words of a text, sorted; fewer words make one run."""

    def __init__(self, width: int):
        self.width, self.words = width, Words()
        rng = np.random.default_rng(5)
        self.places = rng.integers(1, 1 << 63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        word = self.words(text)[3]
        if not len(word):
            return word
        width = min(self.width, len(word))
        runs = sum(word[i : len(word) - width + 1 + i] * self.places[i] for i in range(width))
        return np.unique(mixed(runs + np.uint64(width)))


def registers(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """A register holds floor(1 - log_BASE of the least exponential value), one hash function each.

    The minimum of the exponential values is that of the least hash, so only minima are transformed. Registers of a
    union are the larger ones of the parts.
    """
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(low), 2048):
        np.minimum(least, (low[i : i + 2048, None] * factors).min(axis=0), out=least)
    value = -np.log1p(-(least + 0.5) / 2**32) / RATE
    return np.floor(1 - np.log(value) / np.log(BASE)).clip(-32768, 32767).astype("<i2")


def _factors(count: int, seed: int) -> np.ndarray:
    return (np.random.default_rng(seed).integers(0, 1 << 31, count, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)


def sketches(docs: DataFrame, id_col: str, text_col: str, width: int, seed: int = 3) -> DataFrame:
    """id, n (size of the shingle set), a and b (digest of the set; null for an empty one), registers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, factors = Shingles(width), _factors(BANDS * ROWS, seed)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"], strict=True):
                own = shingle(text.as_py())
                digest = np.frombuffer(hashlib.blake2b(own.tobytes(), digest_size=16).digest(), "<i8").tolist()
                full = len(own) > 0
                out.append((doc_id, len(own), *(digest if full else (None, None)), registers(own, factors).tobytes() if full else None))
            columns = zip(*out, strict=True)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "n", "a", "b", "registers"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sketch, SKETCH_SCHEMA)


def log_likelihood(equal: np.ndarray, more: np.ndarray, less: np.ndarray, u: np.ndarray, jaccard: np.ndarray) -> np.ndarray:
    """Of register counts (equal, first larger, second larger) for sets with shares u and 1 - u of their joint size.

    Rows are pairs, columns are values of the similarity. Registers step by BASE; the least values of the part that is
    only in the first and only in the second set decide which register is larger.
    """

    def larger(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    u, v = u[:, None], 1 - u[:, None]
    first = np.clip(larger(u - v * jaccard), 1e-12, 1)
    second = np.clip(larger(v - u * jaccard), 1e-12, 1)
    same = np.clip(1 - first - second, 1e-12, 1)
    return equal[:, None] * np.log(same) + more[:, None] * np.log(first) + less[:, None] * np.log(second)


def likely(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose joint likelihood does not rule the threshold out; needs nx, ny, rx, ry."""
    low = percent / 100
    grid = np.concatenate((np.linspace(0.01, 0.999, 100), [low]))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rx, ry = (np.frombuffer(b"".join(batch[c].to_pylist()), "<i2").reshape(len(batch), -1) for c in ("rx", "ry"))
            nx, ny = (batch[c].to_numpy().astype(float) for c in ("nx", "ny"))
            possible = 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
            shares = grid * np.ones((len(batch), 1))
            found = log_likelihood((rx == ry).sum(1), (rx > ry).sum(1), (rx < ry).sum(1), nx / (nx + ny), shares)
            best = found.argmax(1)
            fits = (grid[best] >= low) | (found.max(1) - found[:, -1] < UNLIKELY)
            keep_ = pa.array(possible & fits)
            yield pa.RecordBatch.from_arrays([batch["x"].filter(keep_), batch["y"].filter(keep_)], ["x", "y"])

    return pairs.select("x", "y", "nx", "ny", "rx", "ry").mapInArrow(keep, "x long, y long")


def verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(x, y, both, linked): shingles in both full sets, and whether they are ``percent`` of the union.

    Texts travel to the pairs, as they take less room than their sets. The set of the last y is kept, as the rows
    of a join arrive in its order.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, last, set_y = Shingles(width), None, None
        for batch in batches:
            counts, linked = [], []
            for y, tx, ty in zip(*(batch[c] for c in ("y", "tx", "ty")), strict=True):
                if last is None or y.as_py() != last:
                    last, set_y = y.as_py(), shingle(ty.as_py())
                set_x = shingle(tx.as_py())
                both = len(np.intersect1d(set_x, set_y, assume_unique=True))
                counts.append(both)
                linked.append(both > 0 and 100 * both >= percent * (len(set_x) + len(set_y) - both))
            columns = [batch["x"], batch["y"], pa.array(counts, pa.int64()), pa.array(linked, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, ["x", "y", "both", "linked"])

    first = pairs.join(texts.select(F.col("id").alias("x"), F.col("text").alias("tx")), "x")
    both = first.join(texts.select(F.col("id").alias("y"), F.col("text").alias("ty")), "y")
    return both.select("x", "y", "tx", "ty").mapInArrow(check, "x long, y long, both long, linked boolean")


def _texts_of(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """The texts that pairs (or members) speak of; the merge hint keeps one plan for every size."""
    ids = pairs.select(F.explode(F.array(*[c for c in ("x", "y") if c in pairs.columns])).alias("id")).distinct()
    return materialize(texts.join(ids.hint("merge"), "id", "left_semi"), name)


def _tested(pairs: DataFrame, slim: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    left = slim.select(F.col("id").alias("x"), F.col("n").alias("nx"), F.col("registers").alias("rx"))
    right = slim.select(F.col("id").alias("y"), F.col("n").alias("ny"), F.col("registers").alias("ry"))
    candidates = materialize(likely(pairs.join(left, "x").join(right, "y"), percent), "candidates")
    found = verify(candidates, _texts_of(candidates, texts, "candidate-texts"), width, percent)
    return materialize(found.filter("linked").select("x", "y"), "verified")


def _apart(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of buckets that hold two groups or more, with their group ``of`` and the bucket's largest group ``main``."""
    own = members.join(groups, F.col("id") == F.col("node"), "left")
    own = own.select("key", "id", "n", "shared", F.coalesce("component", "id").alias("of"))
    own = materialize(own, "grouped-members")
    parts = own.groupBy("key", "of").agg(F.count("*").alias("size"))
    split = parts.groupBy("key").agg(
        F.count("*").alias("parts"), F.max_by("of", F.struct("size", "of")).alias("main"),
        F.sum("size").alias("members"),
    )
    split = split.filter("parts > 1").select("key", "main", "members")
    return materialize(own.join(split, "key"), "open-members")


def _shared(texts: DataFrame, width: int) -> DataFrame:
    """(of, own): how many of a text's shingles no other of the texts has. Shingles are cut to 32 bits: two that fall
    together count as shared, so ``own`` is never too large."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingles(width)
        for batch in batches:
            for row, text in zip(batch["id"].to_pylist(), batch["text"], strict=True):
                own = np.unique(shingle(text.as_py()).astype(np.uint32)).view(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), row, np.int64)), pa.array(own)], ["id", "s"])

    each = texts.select("id", "text").mapInArrow(shingles, "id long, s int")
    single = each.groupBy("s").agg(F.count("*").alias("n"), F.min("id").alias("of")).filter("n = 1")
    return single.groupBy("of").agg(F.count("*").alias("own"))


def _comparable(x: tuple[str, str], y: tuple[str, str], percent: int) -> Column:
    """Whether the sets could share enough: of sizes n, only ``shared`` shingles occur in another text at all."""
    (nx, sx), (ny, sy) = x, y
    both = F.least(nx, ny, sx, sy)
    return 100 * both >= percent * (F.col(nx) + F.col(ny) - both)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Texts with equal shingle sets are one class, represented by its smallest id; only classes are sketched and
    compared. Classes that share the registers of a band meet in a bucket. Every member of a bucket is first tested
    against the bucket's smallest id, one test per member; groups that this joins need no further tests among
    themselves. What is then still apart in a bucket is tested against all members of the other groups, so no link that a
    band offers is lost. Before that, texts with too many shingles that no other such text has are let go, as they reach
    80 % with none, and in wide buckets the others are tested against one centre of the bucket's largest group, which bounds
    what any two of them can share. So groups of any size cost a few tests per member. A test compares registers by
    likelihood and then the full sets.

    Linked are texts whose sets share ``percent`` or more of their union; a text with fewer words than ``width`` has one
    shingle, one without words (null, empty, blank) has none and is linked with nothing. component_id is the smallest id
    reachable. Rows that share an id are one document and stay or go together; a row without an id has no component and
    stays. An empty table gives no rows; other columns are ignored.
    """
    found = materialize(sketches(docs, id_col, text_col, width), "sketches")
    usable = found.filter("id is not null and n > 0")
    # Equal sets: their smallest id stands for them.
    leaders = usable.groupBy("a", "b").agg(F.min("id").alias("x"), F.count("*").alias("copies"))
    leaders = materialize(leaders, "classes")
    copies = usable.join(leaders.filter("copies > 1"), ["a", "b"]).filter("id <> x").select(F.col("id").alias("x"), F.col("x").alias("y"))
    copies = materialize(copies, "copies")
    slim = usable.join(leaders.select("a", "b", "x"), ["a", "b"]).filter("id = x").dropDuplicates(["a", "b"])
    slim = materialize(slim.select("id", "n", "registers"), "class-sketches")

    step = 2 * ROWS
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substring(F.col("registers"), i * step + 1, F.lit(step))),
    )
    members = slim.select("id", "n", F.explode(bands).alias("key"))
    buckets = members.groupBy("key").agg(F.min(F.struct("id", "n")).alias("first"), F.count("*").alias("size")).filter("size > 1")
    buckets = buckets.select("key", F.col("first.id").alias("y"), F.col("first.n").alias("ny"))
    members = materialize(members.join(buckets, "key"), "members")

    # A class id may stand for two sets only if rows share an id; a text is then any of theirs.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    fit = _comparable(("n", "n"), ("ny", "ny"), percent)
    tested = members.filter((F.col("id") != F.col("y")) & fit).select(F.col("id").alias("x"), "y").distinct()
    tested = materialize(tested, "stars")
    links = _tested(tested, slim, texts, width, percent)

    def grown(groups: DataFrame, links: DataFrame) -> DataFrame:
        """The groups that new links make of old ones; old members hang on their group's name, so few rounds are left."""
        known = groups.select(F.col("node").alias("x"), F.col("component").alias("y"))
        return materialize(connected_components(known.union(links), "x", "y"), "groups")

    def untested(pairs: DataFrame) -> DataFrame:
        ordered = pairs.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
        return materialize(ordered.join(tested, ["x", "y"], "left_anti"), "open-pairs")

    groups = materialize(connected_components(links.union(copies), "x", "y"), "groups")
    members = members.select("key", "id", "n", F.col("n").alias("shared"))
    apart = _apart(members, groups)
    # Who is still apart can only be linked with others in such buckets. A text with too many shingles of its own among
    # them is linked with none.
    texts = _texts_of(apart.select(F.col("id").alias("x")), texts, "open-texts")
    alone = _shared(texts, width)
    members = apart.select("key", "id", "n").join(alone, F.col("id") == F.col("of"), "left")
    members = members.select("key", "id", "n", F.greatest(F.col("n") - F.coalesce("own", F.lit(0)), F.lit(0)).alias("shared"))
    members = materialize(members.filter(100 * F.col("shared") >= percent * F.col("n")), "open-members")

    # In large buckets all members are compared with one centre of the largest group, the one with the fewest shingles
    # of its own. Two texts share at most what both share with the centre and what both have beside it.
    apart = _apart(members, groups)
    wide = apart.filter(f"members >= {WIDE}")
    centre = F.max_by("id", F.struct(F.col("shared") / F.col("n"), "id"))
    centres = wide.filter("of = main").groupBy("main").agg(centre.alias("y"))
    centres = materialize(centres, "centres")
    pairs = wide.join(centres, "main").filter("id <> y").select(F.col("id").alias("x"), "y").distinct()
    pairs = materialize(pairs, "centre-pairs")
    measured = materialize(verify(pairs, texts, width, percent), "centre-counts")
    groups = grown(groups, measured.filter("linked").select("x", "y"))
    tested = tested.union(pairs.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")))
    apart = _apart(members, groups).join(centres, "main", "left")
    counts = measured.select(F.col("x").alias("id"), "y", "both")
    near = F.when(F.col("id") == F.col("y"), F.col("shared")).otherwise(F.col("both"))
    apart = apart.join(counts, ["id", "y"], "left").withColumn("near", near)
    apart = materialize(apart.drop("y", "both"), "measured-members")

    keys = apart.groupBy(F.col("id").alias("holder")).agg(F.collect_set("key").alias("keys"))  # one per band at most
    apart = materialize(apart.join(keys, F.col("id") == F.col("holder")).drop("holder"), "keyed-members")
    left = apart.filter("of <> main").select(
        "key", F.col("keys").alias("kx"), F.col("id").alias("x"), F.col("of").alias("ox"), F.col("n").alias("nx"), F.col("shared").alias("sx"),
        F.col("near").alias("cx"),
    )
    rest = apart.select(
        "key", F.col("keys").alias("ky"), F.col("id").alias("y"), F.col("of").alias("oy"), F.col("n").alias("ny"), F.col("shared").alias("sy"), "main",
        F.col("near").alias("cy"),
    )
    most = F.least("cx", "cy") + F.least(F.col("sx") - F.col("cx"), F.col("sy") - F.col("cy"))
    single = F.col("key") == F.array_min(F.array_intersect("kx", "ky"))  # a pair meets in its least common bucket only
    bound = F.coalesce(100 * most >= percent * (F.col("nx") + F.col("ny") - most), F.lit(True))
    # Members outside the main group meet all others; among themselves each pair once.
    once = (F.col("oy") == F.col("main")) | (F.col("y") < F.col("x"))
    fit = _comparable(("nx", "sx"), ("ny", "sy"), percent)
    pairs = left.join(rest, "key").filter((F.col("ox") != F.col("oy")) & once & fit & bound & single)
    groups = grown(groups, _tested(untested(pairs.select("x", "y")), slim, texts, width, percent))

    ids = found.select("id", "n").join(groups, F.col("id") == F.col("node"), "left")
    component = F.coalesce("component", "id")
    return ids.select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns."""
    gone = near_duplicates(docs, id_col, text_col, **options).filter("not kept").select(F.col("doc_id").alias("__id"))
    gone = materialize(gone.distinct(), "near-duplicates")
    return docs.join(gone, F.col(id_col) == F.col("__id"), "left_anti")
