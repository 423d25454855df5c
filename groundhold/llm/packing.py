"""Sum-of-squares packing: a piece goes where the squared counts of open sequences per gap become smallest."""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize

LENGTH = 1024
END_ID = 2
# Pieces that one task packs; the sequences left open by a task grow far slower than its pieces.
PIECES_PER_TASK = 32_768
CACHED_WORDS = 600_000
ROW = 512
BLANK_AND_LINE_END = "\u0120\u010a"  # fixed values: how byte-level vocabularies write them
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"

# White space other than single blanks and line ends, and the special token, send a text to the tokenizer whole.
ODD = [
    "  ", " \n", "\n ", "\n\n", "<|endoftext|>",
    *"\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B)),
]


def _odd(text: str) -> bool:
    return text[:1] in " \n" or text[-1:] in " \n" or any(x in text for x in ODD)


def _rank_encoder(path: str):
    """The same vocabulary as ranks, which a second library encodes several times faster."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    own = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary


class WordIds:
    """Ids of texts, through a bounded cache of words.

    The tokenizer never joins a blank or line end with what stands before it, so a
    text whose words are parted by single blanks and line ends is the chain of its
    parted words. Any other text is encoded whole.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.encode = tokenizer.encode_batch_fast
        self.known: dict[bytes, bytes] = {}
        vocabulary = tokenizer.get_vocab()
        self.parts = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that begin with a blank or line end
        self.parts[[i for token, i in vocabulary.items() if token[0] in BLANK_AND_LINE_END]] = True
        self.fast = _rank_encoder(ranks) if ranks else None

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.encode(texts, add_special_tokens=False)]

    def _parted(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin with a blank or line end and have no other; they are encoded in rows of many."""
        rows = [words[i : i + ROW] for i in range(0, len(words), ROW)]
        out: list[bytes] = []
        joined = ["".join(row) for row in rows]
        encoded = [np.array(self.fast(r), dtype="<u4").tobytes() for r in joined] if self.fast else self._raw(joined)
        for row, ids in zip(rows, encoded, strict=True):
            at = [*(4 * np.flatnonzero(self.parts[np.frombuffer(ids, "<u4")])).tolist(), len(ids)]
            whole = len(at) == len(row) + 1
            out += [ids[a:b] for a, b in zip(at, at[1:], strict=False)] if whole else self._raw(row)
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        odd = [i for i, text in enumerate(texts) if _odd(text)]
        out: dict[int, bytes] = dict(zip(odd, self._raw([texts[i] for i in odd]), strict=True))
        # "\0" marks a text's first word; a line's first word keeps its line end, all others lose their blank.
        split = {
            i: (b"\0" + text.encode().replace(b"\n", b" \n")).split(b" ") for i, text in enumerate(texts) if i not in out
        }
        missing = list({w for part in split.values() for w in part if w not in self.known})
        heads = [w for w in missing if w[:1] == b"\0"]
        self.known.update(zip(heads, self._raw([w[1:].decode() for w in heads]), strict=True))
        others = [w for w in missing if w[:1] != b"\0"]
        parted = [w.decode() if w[:1] == b"\n" else " " + w.decode() for w in others]
        self.known.update(zip(others, self._parted(parted), strict=True))
        for i, part in split.items():
            out[i] = b"".join(map(self.known.__getitem__, part))
        return [out[i] for i in range(len(texts))]


_encoders: dict[tuple, WordIds] = {}


def _cut(doc_id: int | None, ids: bytes, length: int) -> Iterator[tuple]:
    n = len(ids) // 4
    head = n if n <= length else n % length or length
    bounds = [0, *range(head, n + 1, length)]
    for k, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        yield doc_id, k, low, high - low, zlib.crc32(ids[4 * low : 4 * high])


def token_pieces(
    docs: DataFrame, tokenizer: str, id_col: str, text_col: str, length: int = LENGTH, ranks: str | None = None
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the ids of each text and the end id, cut if longer than ``length``."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (tokenizer, ranks) not in _encoders:
            _encoders[tokenizer, ranks] = WordIds(tokenizer, ranks)
        encoder = _encoders[tokenizer, ranks]
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256).to_pydict()
                texts = ["" if t is None else t for t in part["text"]]
                rows = [
                    row
                    for doc_id, ids in zip(part["id"], encoder(texts), strict=True)
                    for row in _cut(doc_id, ids + end, length)
                ]
                columns = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(tokenize, PIECE_SCHEMA)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of every length in the given order, and the number of bins.

    ``counts[g]`` is the number of open bins with gap g. A piece of length s in a bin with gap g changes the sum of
    squares by 2 (counts[g - s] - counts[g]) + 2; filling the bin adds nothing to an open count. The smallest change wins,
    of equal ones the smallest gap. A new bin is opened only where no gap fits: with the longest pieces first this comes
    within about a thousandth of the least number of bins, while opening bins whenever that is cheaper took 1.5 % more.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, used = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i, s in enumerate(lengths.tolist()):
        if s >= capacity:
            bins[i], offsets[i], used = used, 0, used + 1
            continue
        change = 2 * (counts[: capacity - s] - counts[s:capacity]) + 2
        change[0] = 1 - 2 * counts[s]
        change[counts[s:capacity] == 0] = 1 << 60
        g = int(change.argmin())
        if change[g] < 1 << 60:
            gap = g + s
            home = stacks[gap].pop()
            counts[gap] -= 1
        else:
            gap, home, used = capacity, used, used + 1
        bins[i], offsets[i] = home, capacity - gap
        if gap > s:
            counts[gap - s] += 1
            stacks[gap - s].append(home)
    return bins, offsets, used


def pack_pieces(pieces: DataFrame, length: int = LENGTH, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """Adds sequence_id and offset. ``pieces`` must be materialized: it is counted first.

    Pieces are dealt by a hash to tasks of about ``per_task`` and packed there, the longest first; as the tasks grow in
    number with the data, no task grows. A sequence's id holds its task above and its number below.
    """
    tasks = max(1, round(pieces.count() / per_task))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets, _ = sum_of_squares(rows["length"].to_numpy(), length)
        return rows.drop(columns="task").assign(sequence_id=bins + (key[0] << 32), offset=offsets)

    task = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(tasks))
    return pieces.withColumn("task", task).groupBy("task").applyInPandas(pack, PACKED_SCHEMA)


def pack(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
    ranks: str | None = None,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. A text of more than ``length`` ids is cut into pieces of that length, the
    first one shorter where they don't divide. Rows that repeat an id, or have none, are packed as documents of their
    own. An empty table gives no rows; other columns are ignored. ``tokenizer`` is the path of a vocabulary file that
    every executor has, ``ranks`` that of the same vocabulary as ranks (faster).
    """
    pieces = materialize(token_pieces(docs, tokenizer, id_col, text_col, length, ranks), "pieces")
    return pack_pieces(pieces, length)
