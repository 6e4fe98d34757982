"""CSV ingest with an explicit, positional schema.

Spark binds a user schema to CSV columns **by position** and ignores the header
names, so a reordered export would silently load the wrong values. We therefore
check the header: its leading names must equal the schema's, extra trailing columns
(e.g. a ``source`` column) are allowed and dropped. The first file's header is checked
before the read; Spark then holds every file's header against it during the one read
(``enforceSchema=false``), so a folder needs no extra pass. PERMISSIVE
mode keeps rows whose typed values do not parse (they become null); rows whose
key is null are counted as rejects instead of disappearing silently.
"""

from __future__ import annotations

import csv as _csv
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.profile import column_counts, profile_schema, read_text_columns, with_types


class HeaderMismatch(ValueError):
    pass


def source_path(root: str, entity: str, extension: str = "csv") -> str:
    """``<root>/<entity>.csv`` for any Hadoop file system URI (file:, hdfs:, s3a:, abfss:)."""
    return f"{root.rstrip('/')}/{entity}.{extension}"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first line (one line, read through Spark's file system)."""
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return []
    return next(_csv.reader([first[0].value.lstrip("﻿")]))


def check_header(header: list[str], schema: T.StructType) -> None:
    expected = schema.fieldNames()
    leading = [h.strip() for h in header[: len(expected)]]
    if leading != expected:
        raise HeaderMismatch(
            f"CSV header {header!r} does not start with the schema columns {expected!r}")


def read_csv_positional(spark: SparkSession, path: str, schema: T.StructType, *,
                        header: bool = True, verify_header: bool = True,
                        null_value: str | None = None, multi_line: bool = False) -> DataFrame:
    """``spark.read.schema(s).option("header", ...).csv(path)``, PERMISSIVE. Records with line
    feeds inside quotes need ``multi_line``, which reads a file in one task.

    ``null_value`` (e.g. ``\\N``) turns that marker into null at parse time; by
    default markers are kept as text (raw layer) and cleaned later.
    """
    names = schema.fieldNames()
    options = {"header": header, "mode": "PERMISSIVE", "multiLine": multi_line}
    if header and verify_header:
        found = read_header(spark, path)
        check_header(found, schema)
        # the columns beyond the schema are read as text, only to compare headers
        extra = [T.StructField(h.strip(), T.StringType()) for h in found[len(names):]]
        schema = T.StructType([*schema.fields, *extra])
        options["enforceSchema"] = False
    if null_value is not None:
        options["nullValue"] = null_value
    return spark.read.schema(schema).options(**options).csv(path).select(*names)


@contextmanager
def header_errors():
    """Turns Spark's complaint about a file's header, raised by the job that reads it,
    into ``HeaderMismatch``."""
    try:
        yield
    except Exception as error:
        if "CSV header" in str(error):
            raise HeaderMismatch(str(error).splitlines()[0]) from error
        raise


def profile_csv(spark: SparkSession, path: str | list[str], sampling_ratio: float = 1.0, *,
                markers: tuple[str, ...] = ()) -> T.StructType:
    """Schema of a new export, from the counts of a full pass: every value of the file fits it.
    A ``sampling_ratio`` below 1 counts a part of the rows, for a first look; the schema it gives
    must not load data."""
    texts = read_text_columns(spark, path)
    counts = column_counts(texts.sample(sampling_ratio, seed=0) if sampling_ratio < 1 else texts, markers)
    return profile_schema(with_types(counts, markers_are_null=bool(markers)))


# ---- values that do not parse ------------------------------------------------------
RAW_LINE, UNPARSED = "_raw_line", "_unparsed"


def read_csv_lanes(spark: SparkSession, path: str, schema: T.StructType, *,
                   null_value: str | None = None) -> DataFrame:
    """The typed columns, ``_raw_line`` (the record as it stands in the file, where a value of
    it did not parse) and ``_unparsed`` (names of the columns that are null for that reason;
    a null of any other column stood in the file).

    Only damaged records are split a second time. Store the result before reading single
    columns of it: Spark parses no column that a query does not ask for."""
    names = schema.fieldNames()
    found = read_header(spark, path)
    check_header(found, schema)
    extra = [T.StructField(h.strip(), T.StringType()) for h in found[len(names):]]
    options = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_LINE}
    if null_value is not None:
        options["nullValue"] = null_value
    typed = T.StructType([*schema.fields, *extra, T.StructField(RAW_LINE, T.StringType())])
    rows = spark.read.schema(typed).options(**options).csv(path)
    texts = ", ".join(f"`{n}` string" for n in [*names, *(f.name for f in extra)])
    token = F.from_csv(F.col(RAW_LINE), texts, {"nullValue": null_value} if null_value is not None else {})
    tokens = "__tokens"
    rows = rows.withColumn(tokens, F.when(F.col(RAW_LINE).isNotNull(), token))
    failed = F.filter(F.array(*[F.when(F.col(f"`{n}`").isNull() & F.col(f"{tokens}.`{n}`").isNotNull(), F.lit(n))
                                for n in names]), lambda n: n.isNotNull())
    return rows.withColumn(UNPARSED, failed).select(*names, RAW_LINE, UNPARSED)


def null_causes(lanes: DataFrame) -> DataFrame:
    """One row per column of stored lanes: column, null_in_file, null_by_parse."""
    names = [c for c in lanes.columns if c not in (RAW_LINE, UNPARSED)]
    by_parse = lambda n: F.array_contains(UNPARSED, n)
    structs = [F.struct(F.lit(n).alias("column"),
                        F.count_if(F.col(f"`{n}`").isNull() & ~by_parse(n)).alias("null_in_file"),
                        F.count_if(by_parse(n)).alias("null_by_parse")) for n in names]
    return lanes.agg(F.array(*structs).alias("all")).select(F.inline("all"))


# ---- files whose columns moved -----------------------------------------------------
def _headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Header of every file below the paths: one line a file, read on the driver like a listing."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files = []
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(conf)
        listing = fs.listFiles(where, True)
        while listing.hasNext():
            status = listing.next()
            hidden = any(part[:1] in ("_", ".") for part in status.getPath().toString()[len(path):].split("/"))
            if status.getLen() and not hidden:
                files.append((fs, status.getPath()))

    def first_line(file) -> tuple[str, str | None]:
        fs, where = file
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(where), "UTF-8"))
        try:
            return where.toString(), reader.readLine()
        finally:
            reader.close()

    with ThreadPoolExecutor(16) as pool:
        return {name: [h.strip() for h in next(_csv.reader([line.lstrip("\ufeff")]))]
                for name, line in pool.map(first_line, files) if line}


def read_csv_by_header(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """Files with the schema's columns in any order and others between: files of one header are
    read together in their own order, then mapped by name. A missing or repeated column raises
    ``HeaderMismatch`` and names a file."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for name, header in sorted(_headers(spark, [paths] if isinstance(paths, str) else paths).items()):
        lacking = [n for n in schema.fieldNames() if header.count(n) != 1]
        if lacking:
            raise HeaderMismatch(f"{name}: columns {lacking} are missing or repeated in {header}")
        groups.setdefault(tuple(header), []).append(name)
    kinds = {f.name: f.dataType for f in schema.fields}
    out = spark.createDataFrame([], schema)
    for header, files in groups.items():
        # a column of no name, or of a name used twice, is read under its position
        own = T.StructType([T.StructField(h if h in kinds else f"_{i}", kinds.get(h, T.StringType()))
                            for i, h in enumerate(header)])
        out = out.unionByName(spark.read.schema(own).option("header", True).option("mode", "PERMISSIVE")
                              .csv(files).select(*schema.fieldNames()))
    return out


def reject_condition(keys: list[str]) -> Column:
    cond = F.lit(False)
    for key in keys:
        cond = cond | F.col(key).isNull()
    return cond


@dataclass(frozen=True)
class Ingest:
    rows: DataFrame          # every parsed row (bronze keeps them all)
    accepted: DataFrame      # rows whose keys are all there
    rejects: DataFrame       # rows with a null key (unparsable or missing)

    def reject_count(self) -> DataFrame:
        """One-row frame ``rejects``; cheap on columnar storage (key columns only)."""
        return self.rejects.agg(F.count(F.lit(1)).alias("rejects"))


def ingest(df: DataFrame, keys: list[str]) -> Ingest:
    rejected = reject_condition(keys)
    return Ingest(rows=df, accepted=df.filter(~rejected), rejects=df.filter(rejected))
