"""Secret scan: fixed patterns, and random strings by how few characters a token of a public vocabulary covers in them."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The patterns and least lengths of the base kinds, in their order.
KEY_WORDS = ("password", "passwd", "secret", "token", "api")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # 18 characters: a run that is too short holds no longer one
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")
BASE_KINDS = KINDS[:3]

# The token-efficiency test. A random string of base64, base36 or hex has 1.2 to 1.9 characters per token, words have 2.4 and
# more; runs of letters that read as words are held to a lower ratio.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
MAX_RATIO = 2.0
WORDLIKE_RATIO = 1.7
WINDOW = 4096  # characters encoded at once, as the time of one merge grows faster than its length
# Known digests (md5, sha1, sha224 to sha512), and identifiers: UUIDs, numbers with separators.
KNOWN = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128}"
    r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}|[0-9+/_=-]+)"
)
WORDLIKE = re.compile(r"[+/_=-]*(?:(?:[A-Z]?[a-z]{2,}|[A-Z]{2,})[+/_=-]*)+")

Span = tuple[int, int, int]  # start, number of the kind, end


def encoder(ranks: str) -> Callable[[str], list[int]]:
    """Token ids of a text under a vocabulary file of ranks; nothing in the text counts as a special token."""
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    own = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
    return own.encode_ordinary


def base_spans(text: str) -> list[Span]:
    """The matches of the fixed patterns, as code point offsets."""
    low, spans = text.lower(), []
    if any(word in low for word in KEY_WORDS):
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_VALUE]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return spans


def is_random(run: str, encode: Callable[[str], list[int]]) -> bool:
    """Whether a run of characters takes too many tokens to be text; known digests and identifiers are not tested."""
    if KNOWN.fullmatch(run):
        return False
    limit = WORDLIKE_RATIO if WORDLIKE.fullmatch(run) else MAX_RATIO
    tokens = sum(len(encode(run[at : at + WINDOW])) for at in range(0, len(run), WINDOW))
    return len(run) <= limit * tokens


def text_spans(text: str, encode: Callable[[str], list[int]]) -> list[Span]:
    """All spans of a text by start, then kind. A run that a pattern matches as well has a span of each kind."""
    random = [(m.start(), 3, m.end()) for m in CANDIDATE.finditer(text) if is_random(m.group(), encode)]
    return sorted(base_spans(text) + random)


_encoders: dict[str, Callable[[str], list[int]]] = {}
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPAN_TYPE = "array<struct<kind: string, start: bigint, end: bigint>>"


def secret_spans(
    docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = False
) -> DataFrame:
    """One row per row of ``docs``: id, spans (kind, start, end in code points, end exclusive) and, if asked, text.

    Kinds are assign, access and hex, matched by pattern, and random: runs of 20 characters or more with at most 2.0
    characters per token of the vocabulary ``ranks`` (1.7 where the letters read as words) that are no known digest, UUID or
    number. They are added to the others: a key that a pattern matches may be there as random too. Spans are sorted by
    start, then by kind.

    Null and empty texts have no spans. Texts are searched whole, in time linear in their length. Equal texts and repeated
    rows are searched and returned each; ids may be null. An empty table gives no rows; other columns are ignored.
    ``ranks`` is the path of a file that every executor has.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if ranks not in _encoders:
            _encoders[ranks] = encoder(ranks)
        encode = _encoders[ranks]
        for whole in batches:
            for low in range(0, len(whole), 256):
                batch = whole.slice(low, 256)
                found = [text_spans(t, encode) if t else [] for t in batch["text"].to_pylist()]
                spans = pa.array(
                    [[{"kind": KINDS[k], "start": start, "end": end} for start, k, end in each] for each in found], pa.list_(SPAN)
                )
                columns = {"id": batch["id"], "spans": spans, **({"text": batch["text"]} if keep_text else {})}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return rows.mapInArrow(scan, f"id {kind}, spans {SPAN_TYPE}" + (", text string" if keep_text else ""))


def redacted(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """id, n_spans, text: each text with every stretch that spans cover replaced by ``mark``; a null text stays null."""
    found = secret_spans(docs, ranks, id_col, text_col, keep_text=True)
    kind = found.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, len(whole), 256):
                batch = whole.slice(low, 256)
                texts = []
                for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True):
                    parts, at = [], 0
                    for span in spans:
                        if span["start"] >= at:
                            parts += [text[at : span["start"]], mark]
                        at = max(at, span["end"])
                    texts.append(None if text is None else "".join(parts) + text[at:])
                counts = pa.array([len(s) for s in batch["spans"]], pa.int64())
                yield pa.RecordBatch.from_arrays([batch["id"], counts, pa.array(texts, pa.string())], ["id", "n_spans", "text"])

    return found.mapInArrow(cut, f"id {kind}, n_spans long, text string")
