"""Repeated passages: every run of several sentences is hashed, runs meet globally, later copies are cut out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, numbered
from .hashing import PRIME, Polynomial, Words

RUN = 3  # sentences in a run, at least
MIN_WORDS = 20  # words in a run, at least
MAX_WORDS = 12  # words of a sentence; longer ones count as several, parted by the words' hashes
BATCH_DOCS = 2_000

RUN_SCHEMA = "h1 long, h2 int, row long, at int, rest array<struct<row: long, at: int>>"


class Sentences:
    """Cuts texts into sentences and hashes runs of them."""

    def __init__(self, run: int, min_words: int, max_words: int):
        self.run, self.min_words, self.max_words = run, min_words, max_words
        self.words = Words()
        self.polynomials = Polynomial(PRIME), Polynomial(0xD6E8FEB86659FD93)

    def cut(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first word of each sentence and the end, word starts, word ends, word hashes).

        A sentence ends after a word that ends in a full stop, question or exclamation mark, and at a line's end. One of more
        than ``max_words`` words is also cut before the last word with the smallest hash of each ``max_words`` in a row. So no
        piece is longer, and where two texts share words, cuts agree from the first such word on, whatever stands before.
        """
        raw, starts, ends, hashes = self.words(text)
        if not len(starts):
            return np.zeros(1, np.int64), starts, ends, hashes
        stops = np.isin(raw[ends - 1], np.frombuffer(b".!?", np.uint8))
        lines = np.cumsum(raw == 10)
        line = lines[starts]
        first = np.concatenate(([True], stops[:-1] | (line[1:] != line[:-1])))
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, len(starts)))
        long, of = np.repeat(sizes > self.max_words, sizes), np.repeat(heads, sizes)
        at = np.flatnonzero(long[: max(0, len(starts) - self.max_words + 1)])
        at = at[of[at] == of[at + self.max_words - 1]]
        if len(at):
            backwards = np.lib.stride_tricks.sliding_window_view(hashes, self.max_words)[at, ::-1]
            first[at + self.max_words - 1 - backwards.argmin(1)] = True
        return np.append(np.flatnonzero(first), len(starts)), starts, ends, hashes

    def runs(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first sentence, sentence after the last, two hashes) of the run that begins at each sentence, if it fits."""
        heads, _, _, hashes = self.cut(text)
        n = len(heads) - 1
        first = np.arange(n)
        after = np.maximum(np.searchsorted(heads, heads[:-1] + self.min_words), first + self.run)
        first, after = first[after <= n], after[after <= n]
        low, high = heads[first], heads[after]
        if not len(first):
            return first, after, np.empty(0, np.uint64), np.empty(0, np.uint64)
        length = (high - low).astype(np.uint64)
        one, two = (p(hashes, low, high) + length for p in self.polynomials)
        return first, after, one, two


def _first_runs(docs: DataFrame, text_col: str, settings: tuple) -> DataFrame:
    """One row per run and batch: the run's hashes, its first place in the batch, and the others in ``rest``.

    A run repeated thousands of times thus reaches the shuffle once per batch.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences = Sentences(*settings)
        place = pa.struct([("row", pa.int64()), ("at", pa.int32())])
        for whole in batches:
            for start in range(0, len(whole), BATCH_DOCS):
                batch = whole.slice(start, BATCH_DOCS)
                own = [sentences.runs(text.as_py()) for text in batch["text"]]
                counts = [len(r[0]) for r in own]
                if not sum(counts):
                    continue
                row = np.repeat(batch["row"].to_numpy(), counts)
                at, _, one, two = (np.concatenate([r[k] for r in own]) for k in range(4))
                two = (two >> np.uint64(32)).astype(np.uint32).view(np.int32)
                order = np.lexsort((at, row, two, one))
                row, at, one, two = row[order], at[order].astype(np.int32), one[order], two[order]
                heads = np.concatenate(([True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])))
                firsts = np.flatnonzero(heads)
                offsets = np.concatenate(([0], np.cumsum(np.diff(np.append(firsts, len(row))) - 1))).astype(np.int32)
                others = pa.StructArray.from_arrays([pa.array(row[~heads]), pa.array(at[~heads])], fields=list(place))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one[firsts].view(np.int64)), pa.array(two[firsts]), pa.array(row[firsts]),
                        pa.array(at[firsts]), pa.ListArray.from_arrays(pa.array(offsets), others),
                    ],
                    ["h1", "h2", "row", "at", "rest"],
                )

    return docs.select(F.col("__row").alias("row"), F.col(text_col).alias("text")).mapInArrow(runs, RUN_SCHEMA)


def repeated_runs(docs: DataFrame, text_col: str, settings: tuple) -> DataFrame:
    """(row, places): the sentences at which a run begins that is not the first of its kind; ``docs`` has __row.

    The others of a batch are later ones whatever other batches hold, so they never meet by hash. The first of each batch are
    compared with the smallest row of their kind, a minimum that tasks work out before the shuffle. A row is in one batch, so
    the first ones of a kind differ by row.
    """
    found = materialize(_first_runs(docs, text_col, settings), "sentence-runs")
    firsts = found.select("h1", "h2", "row", "at")
    smallest = firsts.groupBy("h1", "h2").agg(F.min("row").alias("least"), F.count("*").alias("batches")).filter("batches > 1")
    later = firsts.join(smallest, ["h1", "h2"]).filter("row > least").select("row", "at")
    others = found.filter("size(rest) > 0").select(F.explode("rest").alias("p")).select("p.row", "p.at")
    return later.union(others).groupBy("row").agg(F.collect_set("at").alias("places"))


CUT_SCHEMA = "id long, n_sentences long, n_removed long, removed_words long, text string"


def cut_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: id, n_sentences, n_removed, removed_words, text (what is left of it).

    A run is the least number of sentences, ``run`` or more, that has ``min_words`` words; a sentence of more than
    ``max_words`` words counts as several, parted where its words' hashes say so. Of runs with equal words (A-Z and white space aside), the one in the row with
    the smallest id, there the earliest, stays. Every sentence covered by any other goes, with the white space after it;
    copies inside one text go as well.

    Null, empty and blank texts have no sentences and give an empty or blank text; texts too short for a run stay. Ids
    that are null or repeat are told apart by the order of the table, which then decides which copy is first. An empty
    table gives no rows; other columns are ignored.
    """
    settings = (run, min_words, max_words)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = numbered(slim, "id", "passage-documents")
    places = materialize(repeated_runs(rows, "text", settings), "repeated-runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentences = Sentences(*settings)
        for batch in batches:
            out: list[tuple] = []
            for row_id, text, own in zip(batch["id"].to_pylist(), batch["text"], batch["places"], strict=True):
                text, own = text.as_py() or "", own.as_py()
                heads, starts, _, _ = sentences.cut(text)
                n = len(heads) - 1
                if not own:
                    out.append((row_id, n, 0, 0, text))
                    continue
                first, after, _, _ = sentences.runs(text)
                edges = np.zeros(n + 1, np.int64)
                mine = np.isin(first, own)
                np.add.at(edges, first[mine], 1)
                np.add.at(edges, after[mine], -1)
                gone = np.cumsum(edges)[:n] > 0
                raw = text.encode()
                begins = np.append(starts[heads[:-1]], len(raw))
                kept = raw[: begins[0]] + b"".join(raw[begins[i] : begins[i + 1]] for i in np.flatnonzero(~gone))
                out.append((row_id, n, int(gone.sum()), int(np.diff(heads)[gone].sum()), kept.decode()))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_sentences", "n_removed", "removed_words", "text"])

    joined = rows.join(places.withColumnRenamed("row", "__of"), F.col("__row") == F.col("__of"), "left")
    return joined.select(F.col("id").cast("long").alias("id"), "text", "places").mapInArrow(cut, CUT_SCHEMA)
