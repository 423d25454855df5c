"""Airspace status snapshots: one XML document per poll, of any shape.

Files are split at the documents' closing tags by Spark's text reader, so a large file of many polls is read in parallel.
A document is one row, and everything about a poll (its records, their duplicates, the absence of any delay) is settled
inside that row without a shuffle, in batch and in streams alike.

Status elements are told by a pattern in their tag, in any case and at any depth; other elements are not status. A fixed
schema cannot say that, so the elements are walked by a small function over Arrow batches.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_AIRSPACE
from .positions import file_time

# The status feed's root, the pattern in the lower-cased tag of each kind (the first that fits counts), its
# label, and the child elements or attributes to try per column.
ROOT_TAG = "AIRPORT_STATUS_INFORMATION"
_COMMON = {"airport_code": ("arpt", "airport"), "delay_reason": ("reason",), "end_time": ("end",)}
STATUS_KINDS = [
    (
        re.compile("ground_delay|gdp"),
        "Ground Delay Program",
        {**_COMMON, "avg_delay": ("avg", "average"), "max_delay": ("max", "maximum"), "start_time": ("start", "adv")},
    ),
    (re.compile("ground_stop"), "Ground Stop", {**_COMMON, "start_time": ("start",)}),
    (
        re.compile("^(?!.*program).*delay"),
        "Arrival/Departure Delay",
        {**_COMMON, "avg_delay": ("avg", "min"), "max_delay": ("max",), "start_time": ("start",)},
    ),
]
NEEDS_REASON = "Arrival/Departure Delay"

# The row that stands for a poll without any delay.
NO_DELAYS = {
    "airport_code": "NAS",
    "delay_type": "No Active Delays",
    "delay_reason": "National Airspace System operating normally",
    "avg_delay": "",
    "max_delay": "",
    "start_time": "",
    "end_time": "",
    "has_delay": False,
}

_RECORD = [f.name for f in RAW_AIRSPACE if f.name != "polled_at"]
_KEYS = ["airport_code", "delay_type", "delay_reason"]
RECORDS = "array<struct<" + ", ".join(f"{n}: {RAW_AIRSPACE[n].dataType.simpleString()}" for n in _RECORD) + ">>"
_ARROW = pa.list_(pa.struct([(n, pa.bool_() if n == "has_delay" else pa.string()) for n in _RECORD]))


def _local(tag: str) -> str:
    """A tag or attribute name in lower case, without its namespace."""
    return tag.rpartition("}")[2].lower()


def _first_text(element: ET.Element, names: tuple[str, ...]) -> str:
    """First non-blank value, name by name: among the child elements of that name, else the attribute; else empty."""
    for name in names:
        for child in element:
            if isinstance(child.tag, str) and _local(child.tag) == name and (child.text or "").strip():
                return child.text.strip()
        for key, value in element.attrib.items():
            if _local(key) == name and value.strip():
                return value.strip()
    return ""


def status_records(document: str) -> list[dict] | None:
    """The status records of a document in document order; None for a text that is no well-formed document."""
    try:
        root = ET.fromstring(document)
    except ET.ParseError:
        return None
    records = []
    for element in root.iter():
        tag = _local(element.tag) if isinstance(element.tag, str) else ""
        kind = next((k for k in STATUS_KINDS if k[0].search(tag)), None)
        if kind is None:
            continue
        _, label, names = kind
        record = {name: _first_text(element, names.get(name, ())) for name in _RECORD}
        record |= {"delay_type": label, "has_delay": True}
        if record["airport_code"] and (record["delay_reason"] or label != NEEDS_REASON):
            records.append(record)
    return records


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for low in range(0, len(whole), 1000):
            batch = whole.slice(low, 1000)
            records = pa.array([status_records(d) for d in batch["document"].to_pylist()], _ARROW)
            yield pa.RecordBatch.from_arrays([batch["polled_at"], batch["document"], records], ["polled_at", "document", "records"])


def split_documents(chunks: DataFrame, root_tag: str = ROOT_TAG) -> DataFrame:
    """polled_at, document: one row per document from ``value``, text that was split behind every closing root tag.

    What stands before a root tag (a declaration, the tags around several documents) is dropped; a root that closes itself
    is a document without elements.
    """
    opening = rf"<{re.escape(root_tag)}(?=[\s/>])"
    parts = F.filter(F.split("value", f"(?={opening})"), lambda part: part.rlike(f"^{opening}"))
    each = chunks.select("polled_at", F.explode(parts).alias("part"))
    alone = F.regexp_extract("part", r"""^<(?:[^>"'/]|"[^"]*"|'[^']*'|/(?!>))*+/>""", 0)
    return each.select("polled_at", F.when(alone != "", alone).otherwise(F.concat("part", F.lit(f"</{root_tag}>"))).alias("document"))


def walked(documents: DataFrame) -> DataFrame:
    """polled_at, document, records from ``polled_at`` and ``document``; records are NULL where a document can't be read."""
    return documents.select("polled_at", "document").mapInArrow(_walk, f"polled_at string, document string, records {RECORDS}")


def flatten_airspace(documents: DataFrame, unique: bool = True) -> DataFrame:
    """Raw status rows from ``document`` texts that also carry ``polled_at``.

    With ``unique`` the first record per (airport, type, reason) of a poll is kept and a poll without records gives the
    "no active delays" row. A document that can't be read gives no rows, as nothing is known about its poll; see
    ``unread_airspace``.
    """
    rows = walked(documents).filter("records is not null").select("polled_at", "records")
    if unique:
        keys = F.transform("records", lambda r: F.struct(*[r[k] for k in _KEYS]))
        rows = rows.withColumn("keys", keys)
        first = F.filter("records", lambda r, i: F.array_position("keys", F.get("keys", i)) == i + 1)
        quiet = F.struct(*[F.lit(NO_DELAYS[name]).alias(name) for name in _RECORD])
        rows = rows.withColumn("records", F.when(F.size("records") == 0, F.array(quiet)).otherwise(first))
    return rows.select("polled_at", F.inline("records")).select(*RAW_AIRSPACE.names)


def airspace_documents(reader, path: str, root_tag: str = ROOT_TAG) -> DataFrame:
    """All documents below ``path`` with the time of their poll; ``reader`` is ``spark.read`` or ``spark.readStream``."""
    chunks = reader.option("lineSep", f"</{root_tag}>").text(path)
    return split_documents(chunks.withColumn("polled_at", file_time()), root_tag)


def read_airspace_status(
    spark: SparkSession, path: str, unique: bool = False, root_tag: str = ROOT_TAG
) -> DataFrame:
    """Status rows of all landed documents; see ``flatten_airspace`` for ``unique``."""
    return flatten_airspace(airspace_documents(spark.read, path, root_tag), unique)


def unread_airspace(spark: SparkSession, path: str, root_tag: str = ROOT_TAG) -> DataFrame:
    """polled_at, document: the landed documents that are not well-formed and give no status rows."""
    return walked(airspace_documents(spark.read, path, root_tag)).filter("records is null").drop("records")


def dedup_airspace_status(status: DataFrame, polls: DataFrame | None = None) -> DataFrame:
    """One row per (airport, type, reason) of a poll, for status rows that are already flat.

    Of several rows the smallest remaining values are kept, so reruns agree.
    With ``polls`` (a ``polled_at`` column) every poll without rows gets the
    "no active delays" row.
    """
    keys = ["polled_at", *_KEYS]
    rest = [name for name in RAW_AIRSPACE.names if name not in keys]
    unique = (
        status.groupBy(*keys)
        .agg(F.min(F.struct(*rest)).alias("kept"))
        .select(*[F.col(name if name in keys else f"kept.{name}") for name in RAW_AIRSPACE.names])
    )
    if polls is None:
        return unique
    quiet = polls.select("polled_at").distinct().join(unique.select("polled_at"), "polled_at", "left_anti")
    return unique.unionByName(quiet.withColumns({name: F.lit(value) for name, value in NO_DELAYS.items()}))
