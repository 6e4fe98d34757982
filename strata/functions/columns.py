"""Column-level building blocks: projections, renames, audit, null markers, flags.

All of them are Catalyst expressions (no Python UDF), so they stay inside
whole-stage codegen and fold into the neighbouring scan / project.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: semantics of the modelled data --------------------------------
# Status text meaning "finished", and the pattern of "finished, N laps down".
FINISHED_STATUS = "Finished"
LAPPED_STATUS_PATTERN = r"^\+\d+ Lap"
# Finishing positions that count as a podium, and the winning position.
PODIUM_POSITIONS = (1, 2, 3)
WIN_POSITION = 1
# Text written by the source system for "no value".
NULL_MARKERS = ("\\N",)
AUDIT_COLUMN = "ingestion_date"


def project(df: DataFrame, spec: Sequence[tuple[str, str]] | Mapping[str, str]) -> DataFrame:
    """Column subset + rename in one projection (``select(col(a).alias(b))``)."""
    pairs = spec.items() if isinstance(spec, Mapping) else spec
    return df.select(*[F.col(src).alias(dst) for src, dst in pairs])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Chained rename; Catalyst collapses it into the surrounding projection."""
    return df.withColumnsRenamed(dict(mapping))


def with_audit_column(df: DataFrame, name: str = AUDIT_COLUMN) -> DataFrame:
    """Load timestamp: one constant per query (``current_timestamp`` is folded once)."""
    return df.withColumn(name, F.current_timestamp())


def null_if_marker(c: Column | str, markers: Iterable[str] = NULL_MARKERS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    markers = list(markers)
    return F.when(c.isin(markers), F.lit(None)).otherwise(c)


def clean_null_markers(df: DataFrame, columns: Mapping[str, str | None],
                       markers: Iterable[str] = NULL_MARKERS) -> DataFrame:
    """Marker text -> null, then an optional ``try_cast`` (unparsable -> null).

    ``columns`` maps column -> target type name (or ``None`` to keep string).
    Plain ``cast`` would raise under ANSI mode on text such as ``\\N``.
    """
    out = {}
    for name, typ in columns.items():
        cleaned = null_if_marker(name, markers)
        out[name] = cleaned.try_cast(typ) if typ else cleaned
    return df.withColumns(out)


def clean_text(df: DataFrame, markers: Iterable[str] = NULL_MARKERS) -> DataFrame:
    """Marker text -> null in every string column."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return clean_null_markers(df, {name: None for name in text}, markers)


def cast_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Strict casts that keep the column name (errors raise under ANSI)."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in mapping.items()})


def full_name(first: str | Column, last: str | Column) -> Column:
    """``first last``; a null part is skipped, never rendered as a blank."""
    return F.concat_ws(" ", first, last)


def finished_flag(status: str | Column, finished_value: str = FINISHED_STATUS,
                  lapped_pattern: str = LAPPED_STATUS_PATTERN) -> Column:
    """True for the finished text or a lapped finish; never null (unknown -> False)."""
    status = F.col(status) if isinstance(status, str) else status
    return (F.when(status == finished_value, F.lit(True))
            .when(status.rlike(lapped_pattern), F.lit(True))
            .otherwise(F.lit(False)))


def podium_flag(position: str | Column, podium: Sequence[int] = PODIUM_POSITIONS) -> Column:
    """Null when the position is null (so sums skip it)."""
    position = F.col(position) if isinstance(position, str) else position
    return position.isin(*podium)


def win_flag(position: str | Column, win: int = WIN_POSITION) -> Column:
    position = F.col(position) if isinstance(position, str) else position
    return position == win


def conditional_count(flag: str | Column) -> Column:
    """Number of true flags as int; null (not 0) when every flag of the group is null."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.sum(flag.cast("int")).cast("int")
