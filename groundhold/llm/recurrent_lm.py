"""A gated recurrent language model: trained by truncated backpropagation, scored over whole documents."""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered

HIDDEN = 16
CLASSES, CLASS_WORDS = 32, 32  # classes of frequent words, words in each
RARE = 32  # classes of all other words
DICTIONARY = 200_000  # most frequent words that every task holds with their counts; the counts of others are joined
WINDOW = 16  # steps of backpropagation
LANES = 256  # texts that are trained on side by side
SCORE_LANES, SCORE_WINDOW, DOCS = 256, 32, 5_000
CHUNK = 4_096  # rows worked out at once, and weights that travel in one row
RATE = 0.01
FOLDS, HELD_OUT = 7, 2
UNIT = np.dtype("<u2")  # of CLASSES * CLASS_WORDS + RARE
END = b"\n"  # stands for the end; no word holds white space
FLUSH = 400_000

COUNT_SCHEMA = "word binary, n long"
CODED_SCHEMA = (
    "row long, id long, fold long, n_tokens long, known long, counts double, score double, units binary, "
    "words array<binary>, times array<long>"
)
SCORE_SCHEMA = "row long, id long, n_tokens long, known long, counts double, score double"


def _names(schema: str) -> list[str]:
    return [part.split(" ")[0] for part in schema.split(", ")]


def fold(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def tokens(text: str | None) -> list[bytes]:
    return ("" if text is None else text).encode().lower().split()


def word_counts(rows: DataFrame) -> DataFrame:
    """word, n over the texts of ``rows``; a task adds up words before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for text in batch["text"]:
                found.update(tokens(text.as_py()))
                found[END] += 1
                if len(found) > FLUSH:
                    yield out()
        yield out()

    return rows.select("text").mapInArrow(count, COUNT_SCHEMA).groupBy("word").agg(F.sum("n").alias("n"))


def rare_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % RARE


@dataclass
class Vocabulary:
    """The most frequent words with their counts, and how many tokens and words the classes of the others hold."""

    index: dict[bytes, int]
    counts: np.ndarray
    rare_tokens: np.ndarray
    rare_words: np.ndarray

    def __post_init__(self) -> None:
        self.heads = CLASSES * CLASS_WORDS
        self.head_words = min(self.heads, len(self.index))
        rare = [rare_class(w) for w in self.index]
        self.unit = np.array([i if i < self.heads else self.heads + r for i, r in enumerate(rare)], np.int32)
        self.log_counts = np.log10(self.counts + 1.0)
        self.log_rare = np.log10(self.rare_tokens + self.rare_words + 1.0)

    def units(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(unit of each word, place in the dictionary or -1, the words that are not in it)."""
        get = self.index.get
        place = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
        unit = self.unit[place] if len(self.unit) else np.zeros(len(words), np.int32)
        unknown = np.flatnonzero(place < 0).tolist()
        strange = [words[i] for i in unknown]
        if strange:
            unit[unknown] = [self.heads + rare_class(w) for w in strange]
        return unit, place, strange


def vocabulary(counts: DataFrame) -> Vocabulary:
    # The end comes first, however many words are more frequent.
    top = counts.orderBy(F.col("word") != F.lit(bytearray(END)), F.desc("n"), "word").limit(DICTIONARY).collect()
    heads = [bytes(r["word"]) for r in top[: CLASSES * CLASS_WORDS]]
    spark = counts.sparkSession
    head = spark.createDataFrame([(bytearray(w),) for w in heads] or [(bytearray(b""),)], "word binary")
    others = counts.join(F.broadcast(head), "word", "left_anti")  # at most CLASSES * CLASS_WORDS rows
    key = F.crc32(F.expr("substring(word, -2)")) % RARE
    rare = others.groupBy(key.alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    held, words_ = np.zeros(RARE), np.zeros(RARE)
    for r in rare:
        held[r["c"]], words_[r["c"]] = r["n"], r["v"]
    return Vocabulary({bytes(r["word"]): i for i, r in enumerate(top)}, np.array([r["n"] for r in top], float), held, words_)


class Model:
    """Weights in one flat vector: gates of each input unit, recurrent gates, class and in-class outputs."""

    def __init__(self, flat: np.ndarray | None = None, prior: Vocabulary | None = None, seed: int = 1):
        h, units, classes = HIDDEN, CLASSES * CLASS_WORDS + RARE, CLASSES + RARE
        shapes = {
            "gates": (units, 3 * h), "back": (h, 3 * h), "to_class": (h, classes), "class_bias": (classes,),
            "to_word": (CLASSES, h, CLASS_WORDS), "word_bias": (CLASSES, CLASS_WORDS),
        }
        sizes = [int(np.prod(s)) for s in shapes.values()]
        if flat is None:
            rng = np.random.default_rng(seed)
            flat = (rng.standard_normal(sum(sizes)) * 0.1).astype(np.float32)
        self.flat, self.names = flat, list(shapes)
        at = np.cumsum([0, *sizes])
        for (name, shape), low, high in zip(shapes.items(), at[:-1], at[1:], strict=True):
            setattr(self, name, flat[low:high].reshape(shape))
        if prior is not None:
            n = np.full(CLASSES * CLASS_WORDS, 0.5)
            n[: prior.head_words] += prior.counts[: prior.head_words]
            n = n.reshape(CLASSES, CLASS_WORDS)
            self.word_bias[:] = np.log(n / n.sum(1, keepdims=True))
            mass = np.concatenate((n.sum(1), prior.rare_tokens + 1))
            self.class_bias[:] = np.log(mass / mass.sum())

    def states(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Hidden states (steps, lanes, HIDDEN) for inputs (steps, lanes), from h; ``fresh`` marks where texts begin.

        ``keep`` takes what the way back needs, each (steps, lanes, ...).
        """
        n, pre = HIDDEN, self.gates[x]
        out = np.empty((*x.shape, n), pre.dtype)
        if keep is not None:
            keep.update(before=np.empty_like(out), gate=np.empty((*x.shape, 2 * n), pre.dtype), new=np.empty_like(out), back=np.empty_like(out))
        some = fresh.any(1)
        for t in range(len(x)):
            if some[t]:
                h = np.where(fresh[t][:, None], pre.dtype.type(0), h)
            back = h @ self.back
            gate = pre[t, :, : 2 * n] + back[:, : 2 * n]
            np.negative(gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            new = gate[:, n:] * back[:, 2 * n :]
            new += pre[t, :, 2 * n :]
            np.tanh(new, out=new)
            if keep is not None:
                keep["before"][t], keep["gate"][t], keep["new"][t], keep["back"][t] = h, gate, new, back[:, 2 * n :]
            h = np.subtract(h, new, out=out[t])
            h *= gate[:, :n]
            h += new
        return out

    def _by_class(self, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(order of units y by class, their classes and words in that order, where each class of frequent words begins)."""
        heads = CLASSES * CLASS_WORDS
        of = np.where(y < heads, y // CLASS_WORDS, y - heads + CLASSES)
        order = np.argsort(of, kind="stable")
        of = of[order]
        return order, of, y[order] % CLASS_WORDS, np.searchsorted(of, np.arange(CLASSES + 1))

    def _word_logits(self, rows: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        out = np.empty((cuts[-1], CLASS_WORDS), rows.dtype)
        for c in range(CLASSES):
            own = slice(cuts[c], cuts[c + 1])
            out[own] = rows[own] @ self.to_word[c] + self.word_bias[c]
        return out

    def log_probabilities(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural logarithms of the probabilities of units y (rare ones: of their class) after states h."""
        out = np.empty(len(y), h.dtype)
        for low in range(0, len(y), CHUNK):
            order, of, word, cuts = self._by_class(y[low : low + CHUNK])
            rows, n = h[low + order], cuts[-1]
            found = _picked(rows @ self.to_class + self.class_bias, of)
            found[:n] += _picked(self._word_logits(rows, cuts), word[:n])
            out[low + order] = found
        return out

    def gradient(self, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, live: np.ndarray, h: np.ndarray) -> tuple:
        """(gradient of the mean loss over a window, last states); nothing flows past the window's start."""
        kept: dict = {}
        states = self.states(x, fresh, h, kept)
        grad = Model(np.zeros_like(self.flat))
        order, of, word, cuts = self._by_class(y[live])
        at = np.flatnonzero(live)[order]
        rows, n = states.reshape(-1, HIDDEN)[at], cuts[-1]
        scale = states.dtype.type(1 / max(1, len(of)))
        wrong = _softmax(rows @ self.to_class + self.class_bias)
        wrong[np.arange(len(of)), of] -= 1
        wrong *= scale
        grad.to_class += rows.T @ wrong
        grad.class_bias += wrong.sum(0)
        down = wrong @ self.to_class.T
        wrong = _softmax(self._word_logits(rows, cuts))
        wrong[np.arange(n), word[:n]] -= 1
        wrong *= scale
        for c in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[c], cuts[c + 1])
            np.matmul(rows[own].T, wrong[own], out=grad.to_word[c])
            wrong[own].sum(0, out=grad.word_bias[c])
            down[own] += wrong[own] @ self.to_word[c].T
        flow = np.zeros_like(states)
        flow.reshape(-1, HIDDEN)[at] = down
        # What a step's loss is multiplied by on its way into each gate is worked out for the whole window at once.
        z, r, new = kept["gate"][..., :HIDDEN], kept["gate"][..., HIDDEN:], kept["new"]
        to_new = (1 - z) * (1 - new * new)
        to_z = (kept["before"] - new) * z * (1 - z)
        to_r = kept["back"] * r * (1 - r)
        following, into_back = np.zeros_like(h), np.empty((*x.shape, 3 * HIDDEN), states.dtype)
        into_new, some = np.empty_like(states), fresh.any(1)
        for t in reversed(range(len(x))):
            total = flow[t]
            total += following
            np.multiply(total, to_new[t], out=into_new[t])
            np.multiply(total, to_z[t], out=into_back[t, :, :HIDDEN])
            np.multiply(into_new[t], to_r[t], out=into_back[t, :, HIDDEN : 2 * HIDDEN])
            np.multiply(into_new[t], r[t], out=into_back[t, :, 2 * HIDDEN :])
            following = into_back[t] @ self.back.T
            following += total * z[t]
            if some[t]:
                following[fresh[t]] = 0
        grad.back += kept["before"].reshape(-1, HIDDEN).T @ into_back.reshape(-1, 3 * HIDDEN)
        gates = into_back
        gates[..., 2 * HIDDEN :] = into_new
        order = np.argsort(x.ravel().astype(np.int16), kind="stable")  # units are few
        units = x.ravel()[order]
        firsts = np.flatnonzero(np.diff(units, prepend=-1))
        grad.gates[units[firsts]] = np.add.reduceat(gates.reshape(-1, 3 * HIDDEN)[order], firsts)
        return grad.flat, states[-1]


def _exponentials(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(exponentials, their sums by row); rows are shifted in place by their maxima, but only where they would leave the range."""
    ones = np.ones(logits.shape[1], logits.dtype)
    if logits.size and logits.max() < 60:
        out = np.exp(logits)
        sums = out @ ones
        if sums.min() > 1e-30:
            return out, sums
    logits -= logits.max(1, keepdims=True)
    out = np.exp(logits)
    return out, out @ ones


def _softmax(logits: np.ndarray) -> np.ndarray:
    out, sums = _exponentials(logits)
    out /= sums[:, None]
    return out


def _picked(logits: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The logarithm of one softmax value per row."""
    _, sums = _exponentials(logits)
    return logits[np.arange(len(which)), which] - np.log(sums)


def lanes(texts: list[np.ndarray], count: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, fresh, text of each place), each (steps, lanes); -1 where a lane has ended.

    A text's inputs are the end and its units, its targets the units and the end. The longest texts are laid first, each
    in the shortest lane, and lanes run from the longest to the shortest.
    """
    count = max(1, min(count, len(texts)))
    heap, own = [(0, i) for i in range(count)], [[] for _ in range(count)]
    for k in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        length, lane = heapq.heappop(heap)
        own[lane].append(k)
        heapq.heappush(heap, (length + len(texts[k]) + 1, lane))
    own.sort(key=lambda ks: -sum(len(texts[k]) + 1 for k in ks))
    steps = max((sum(len(texts[k]) + 1 for k in ks) for ks in own), default=0)
    x, y, of = np.full((steps, count), end, np.int32), np.full((steps, count), end, np.int32), np.full((steps, count), -1, np.int32)
    fresh = np.zeros((steps, count), bool)
    for lane, ks in enumerate(own):
        at = 0
        for k in ks:
            n = len(texts[k])
            x[at + 1 : at + n + 1, lane] = texts[k]
            y[at : at + n, lane] = texts[k]
            of[at : at + n + 1, lane] = k
            fresh[at, lane] = True
            at += n + 1
    return x, y, fresh, of


def _code(rows: DataFrame, shared) -> DataFrame:
    """The units of each text, and what its score owes to the counts of the dictionary's words; ``words`` are the others.

    Texts are taken apart once here; training and scoring read two bytes a word and need no dictionary.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_ = shared.value
        for whole in batches:
            for start in range(0, len(whole), DOCS):
                batch = whole.slice(start, DOCS)
                n = len(batch)
                units, tails, length = [], [], np.zeros(n, np.int64)
                known, counts, extra = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
                for i, text in enumerate(batch["text"]):
                    unit, place, strange = words_.units(tokens(text.as_py()))
                    length[i] = len(unit) + 1
                    found = place[place >= 0] if strange else place
                    known[i] = len(found)
                    counts[i] = words_.log_counts[found].sum() if len(found) else 0
                    rare = found[found >= words_.heads]
                    extra[i] = words_.log_counts[rare].sum() if len(rare) else 0
                    extra[i] -= words_.log_rare[unit[unit >= words_.heads] - words_.heads].sum()
                    units.append(unit.astype(UNIT).tobytes())
                    tails.append(Counter(strange))
                if END in words_.index:
                    counts += words_.log_counts[words_.index[END]]
                    known += 1
                columns = [
                    batch["row"], batch["id"], batch["fold"], pa.array(length), pa.array(known), pa.array(counts), pa.array(extra),
                    pa.array(units, pa.binary()), pa.array([list(t) for t in tails], pa.list_(pa.binary())),
                    pa.array([list(t.values()) for t in tails], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, _names(CODED_SCHEMA))

    return rows.select(F.col("__row").alias("row"), "id", "fold", "text").mapInArrow(code, CODED_SCHEMA)


def _train(training: DataFrame, model: Model, end: int) -> Model:
    """One pass over the units of every text of ``training``: each task trains a copy on its own, and the copies are averaged
    by the tokens they saw."""
    start = training.sparkSession.sparkContext.broadcast(model.flat)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(start.value.copy())
        first, second, step, seen = np.zeros_like(own.flat), np.zeros_like(own.flat), 0, 0
        for batch in batches:
            x, y, fresh, of = lanes([np.frombuffer(u.as_buffer(), UNIT) for u in batch["units"]], LANES, end)
            h = np.zeros((x.shape[1], HIDDEN), np.float32)
            for low in range(0, len(x), WINDOW):
                part = slice(low, low + WINDOW)
                live = of[part] >= 0
                active = int(live.any(0).sum())
                grad, h_ = own.gradient(x[part, :active], y[part, :active], fresh[part, :active], live[:, :active], h[:active])
                h = h_
                grad *= min(1.0, 1.0 / max(1e-9, float(np.sqrt((grad * grad).sum()))))
                step += 1
                first += 0.1 * (grad - first)
                second += 0.01 * (grad * grad - second)
                # A window that few lanes reach, as in the longest texts, moves the weights by its share of a full one.
                rate = RATE * live.sum() / (LANES * WINDOW) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                own.flat -= (rate * first / (np.sqrt(second) + 1e-8)).astype(np.float32)
                seen += int(live.sum())
        if seen:
            values = own.flat.astype(np.float64) * seen
            parts = [values[low : low + CHUNK] for low in range(0, len(values), CHUNK)]
            columns = [pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.float64())), pa.array([seen] * len(parts))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "value", "seen"])

    copies = training.select("units").mapInArrow(train, "part int, value array<double>, seen long")
    # Sums by place are added up before and after the shuffle, so no task holds the copies of all tasks.
    places = copies.select("part", "seen", F.posexplode("value").alias("place", "value"))
    means = places.groupBy("part", "place").agg((F.sum("value") / F.sum("seen")).alias("value"))
    got = means.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("place", "value")))["value"].alias("value"))
    got = got.orderBy("part").collect()  # the weights of one model
    start.unpersist()
    if not got:
        return model
    return Model(np.concatenate([r["value"] for r in got]).astype(np.float32))


def _score(coded: DataFrame, weights, end: int) -> DataFrame:
    """``coded`` with the logarithms of the model's probabilities added to its score, without units and words."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(weights.value)
        for whole in batches:
            for start in range(0, len(whole), DOCS):
                batch = whole.slice(start, DOCS)
                n = len(batch)
                x, y, fresh, of = lanes([np.frombuffer(u.as_buffer(), UNIT) for u in batch["units"]], SCORE_LANES, end)
                total, h = np.zeros(n), np.zeros((x.shape[1], HIDDEN), np.float32)
                for low in range(0, len(x), SCORE_WINDOW):
                    part = slice(low, low + SCORE_WINDOW)
                    live = of[part] >= 0
                    active = int(live.any(0).sum())
                    live = live[:, :active]
                    states = model.states(x[part, :active], fresh[part, :active], h[:active])
                    h = states[-1]
                    found = model.log_probabilities(states[live], y[part, :active][live])
                    total += np.bincount(of[part, :active][live], found, n)
                names = _names(SCORE_SCHEMA)
                columns = [batch[name] for name in names[:-1]] + [pa.array(total / np.log(10) + batch["score"].to_numpy())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return coded.select(*_names(SCORE_SCHEMA), "units").mapInArrow(score, SCORE_SCHEMA)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows whose crc32(id as text) leaves 2 modulo 7 are held out; counts come from all others. A word's probability is that of
    its class, given the state that the whole text before it has left, times its own in the class: by the state for the
    ``CLASSES * CLASS_WORDS`` most frequent words, by (c + 1) / (tokens + words + 1) for all others, whose class follows from
    their last two bytes. An unseen word thus has the place of one more word of its class. The recurrent weights are
    trained on the whole texts of all training documents, in one pass, by tasks whose weights are averaged.

    The dictionary that tasks hold is bounded; counts of all other words are joined, so they are exact. A null or empty
    text is the end alone; a null id counts as the empty text and is not held out. Rows that repeat are scored each. Without
    training documents every word is unseen. An empty table gives no rows; other columns are ignored.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = numbered(slim, "id", "lm-documents").withColumn("fold", fold("id"))
    training = rows.filter(f"fold % {FOLDS} <> {HELD_OUT}")
    counts = materialize(word_counts(training), "word-counts")
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    words_ = vocabulary(counts)
    context = docs.sparkSession.sparkContext
    coded = materialize(_code(rows, context.broadcast(words_)), "lm-units")
    model, end = Model(prior=words_), 0
    if END in words_.index:
        end = int(words_.unit[words_.index[END]])
        model = _train(coded.filter(f"fold % {FOLDS} <> {HELD_OUT}"), model, end)
    found = _score(coded, context.broadcast(model.flat), end)

    pairs = F.explode(F.arrays_zip("words", "times")).alias("p")
    strange = coded.select("row", pairs).select("row", F.col("p.words").alias("word"), F.col("p.times").alias("times"))
    joined = strange.join(counts.hint("merge"), "word")
    rest = joined.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("seen")
    )
    slim = found.join(rest.withColumnRenamed("row", "of"), F.col("row") == F.col("of"), "left")
    more = F.coalesce("more", F.lit(0.0))
    size = float(np.log10(sums["n"] + sums["v"] + 1))
    return slim.select(
        F.col("id").alias("doc_id"), (fold("id") % FOLDS == HELD_OUT).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"), F.lit(sums["n"]).cast("long").alias("train_tokens"),
        (F.col("counts") + more - F.col("n_tokens") * size).alias("base_score"), (F.col("score") + more).alias("score"),
    )
