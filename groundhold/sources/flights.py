"""Batch load of on-time performance files, each with its own header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_FLIGHTS
from ..session import scratch_path

ENCODING = "ISO-8859-1"
MARK = "\ufeff|ï»¿"  # a byte order mark, as UTF-8 and as read in the files' encoding
# The table of headers has a row per file; it is broadcast only when it was counted and has at most this many.
BROADCAST_FILES = 50_000
# Up to so many layouts, a row carries the number of its layout; beyond, the places of its file.
MOST_LAYOUTS = 16


def csv_headers(spark: SparkSession, csv_dir: str) -> DataFrame:
    """file, read_as, names (trimmed, lower case), places (of the kept columns, -1 for those the file lacks): a row per file with a line.

    ``read_as`` is the file as ``input_file_name`` writes it, which costs a row less than its metadata.

    Found by a scan of the lines that parses nothing and combines to one row per file before the shuffle. Materialized.
    """
    lines = spark.read.text(csv_dir).select(
        F.input_file_name().alias("read_as"), F.input_file_block_start().alias("start"), "value", F.monotonically_increasing_id().alias("at")
    ).filter("start = 0")
    first = lines.groupBy("read_as").agg(F.min_by("value", "at").alias("line"))
    names = F.split(F.regexp_replace("line", f"^(?:{MARK})", ""), ",")
    names = F.transform(names, lambda name: F.lower(F.trim(F.btrim(F.trim(name), F.lit('"')))))
    places = [(F.array_position("names", name) - 1).cast("int") for name in RAW_FLIGHTS.names]
    path = scratch_path(spark, "csv-headers")
    file = F.regexp_replace("read_as", "^([^:/]+):///", "$1:/")
    first.select(file.alias("file"), "read_as", names.alias("names")).withColumn("places", F.array(*places)).write.parquet(path)
    return spark.read.parquet(path)


def _read_text(spark: SparkSession, csv_dir: str) -> DataFrame:
    """file and the 37 columns as text, every value matched by its own file's header."""
    headers = csv_headers(spark, csv_dir)
    date_place = F.get("places", F.lit(RAW_FLIGHTS.names.index("flightdate")))
    undated = headers.filter(date_place < 0).select("file").limit(3).collect()
    if undated:
        raise ValueError(f"no flightdate column in {', '.join(r.file for r in undated)}")
    kinds = [F.collect_set(F.get("places", F.lit(i))).alias(name) for i, name in enumerate(RAW_FLIGHTS.names)]
    files, widest, *places = headers.agg(F.count(F.lit(1)), F.max(F.size("names")), *kinds).first()
    if not files:
        raise ValueError(f"no rows in {csv_dir}")
    # One scan reads every place that some file keeps; a row picks its own by the layout of its file, one number per row.
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(widest)])
    rows = spark.read.schema(schema).option("encoding", ENCODING).option("mode", "PERMISSIVE").csv(csv_dir)
    used = sorted({place for found in places for place in found if place >= 0})
    rows = rows.select(F.input_file_name().alias("of"), *[f"c{i}" for i in used])
    layouts = headers.select("places").distinct().limit(MOST_LAYOUTS + 1).collect()
    if len(layouts) <= MOST_LAYOUTS:
        numbers = [F.when(F.col("places") == F.lit(r.places), F.lit(i)) for i, r in enumerate(layouts)]
        known = headers.select("file", "read_as", F.coalesce(*numbers).alias("layout"))
    else:
        known = headers.select("file", "read_as", *[F.get("places", F.lit(i)).alias(f"at_{name}") for i, name in enumerate(RAW_FLIGHTS.names)])
    joined = rows.join(F.broadcast(known) if files <= BROADCAST_FILES else known, F.col("of") == F.col("read_as"))

    def value(i: int, name: str, found: list[int]) -> str:
        there = sorted(place for place in found if place >= 0)
        if len(found) == 1:  # all files agree
            return f"c{there[0]} as {name}" if there else f"cast(null as string) as {name}"
        by, at = f"at_{name}", [(place, place) for place in there]
        if len(layouts) <= MOST_LAYOUTS:
            by, at = "layout", [(k, r.places[i]) for k, r in enumerate(layouts) if r.places[i] >= 0]
        return f"case {by} {' '.join(f'when {k} then c{place}' for k, place in at)} end as {name}"

    text = joined.selectExpr("file", *[value(i, name, found) for i, (name, found) in enumerate(zip(RAW_FLIGHTS.names, places))])
    return text.filter(F.lower(F.trim(F.coalesce("flightdate", F.lit("")))) != "flightdate")


def _typed(field: T.StructField) -> Column:
    value = F.col(field.name)
    if field.dataType == T.StringType():
        return value
    value = F.trim(value)
    if field.dataType == T.IntegerType():
        value = value.try_cast("double")  # whole numbers may be written as 1.0
    return value.try_cast(field.dataType)


def read_flights_csv(spark: SparkSession, csv_dir: str) -> DataFrame:
    """All CSV files of a directory as raw flights.

    Headers are trimmed and lower-cased, columns outside the 37 kept ones are dropped and text is latin-1. Every file has
    its own header: order, case, padding and further columns may differ from file to file, and a column that a file lacks
    is NULL for its rows. Values are cast to the declared types; a value that does not fit becomes NULL, and
    ``unfit_values`` counts such values.

    Raises ``ValueError`` for a directory without rows or a file without a flight date.
    """
    text = _read_text(spark, csv_dir)
    if text.isEmpty():
        raise ValueError(f"no rows in {csv_dir}")
    return text.select(*[_typed(field).alias(field.name) for field in RAW_FLIGHTS])


def unfit_values(spark: SparkSession, csv_dir: str) -> DataFrame:
    """file, column_name, unfit (values that are there but don't fit the column's type), example (the smallest one).

    Only columns with such values have a row. One scan; a file's rows are combined before the shuffle.
    """
    text = _read_text(spark, csv_dir)
    checked = [field for field in RAW_FLIGHTS if field.dataType != T.StringType()]

    def wrong(field: T.StructField) -> Column:
        there = F.trim(F.col(field.name)) != ""
        return F.when(there & _typed(field).isNull(), F.trim(F.col(field.name)))

    found = text.select("file", *[wrong(field).alias(field.name) for field in checked])
    counts = [F.struct(F.count(f.name).alias("unfit"), F.min(f.name).alias("example")).alias(f.name) for f in checked]
    each = [F.struct(F.lit(f.name).alias("column_name"), F.col(f"{f.name}.unfit"), F.col(f"{f.name}.example")) for f in checked]
    return found.groupBy("file").agg(*counts).select("file", F.inline(F.array(*each))).filter("unfit > 0")
