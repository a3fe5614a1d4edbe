"""A file's own columns against the ones that are expected of it.

Columns are taken by name. Numbers of any kind become the expected kind where
every value stays what it is; anything else that differs is named in one error,
before a row is read. Files that differ among themselves are read in groups of
equal schemas.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaDrift(ValueError):
    """A file lacks expected columns, or has them in types that cannot be taken."""


@dataclass(frozen=True)
class Drift:
    """How a schema differs from the expected one; names as the file has them."""

    missing: list[str] = field(default_factory=list)
    ambiguous: list[str] = field(default_factory=list)
    added: list[str] = field(default_factory=list)
    renamed: dict[str, str] = field(default_factory=dict)
    retyped: dict[str, tuple[str, str]] = field(default_factory=dict)
    refused: dict[str, tuple[str, str]] = field(default_factory=dict)


def _takes(found: T.DataType, expected: T.DataType) -> bool:
    """Whether values of one type can stand for the other without a change of meaning."""
    if isinstance(expected, T.StringType):
        return isinstance(found, (T.StringType, T.VarcharType, T.CharType, T.NullType))
    # Numbers, and text that spells them; a text that does not is an error when read.
    return isinstance(found, (T.NumericType, T.StringType, T.NullType))


def compare(
    found: T.StructType, expected: T.StructType, renames: Mapping[str, str] | None = None
) -> Drift:
    """``renames`` maps expected names to the file's; else case alone may differ."""
    renames = renames or {}
    by_case: dict[str, list[str]] = {}
    for name in found.names:
        by_case.setdefault(name.lower(), []).append(name)
    drift, used = Drift(), set()
    for column in expected:
        wanted = renames.get(column.name, column.name)
        names = [wanted] if wanted in found.names else by_case.get(wanted.lower(), [])
        if len(names) != 1:
            (drift.ambiguous if names else drift.missing).append(column.name)
            continue
        (name,) = names
        used.add(name)
        if name != column.name:
            drift.renamed[column.name] = name
        kind = found[name].dataType
        if kind != column.dataType:
            kinds = kind.simpleString(), column.dataType.simpleString()
            (drift.retyped if _takes(kind, column.dataType) else drift.refused)[column.name] = kinds
    drift.added.extend(n for n in found.names if n not in used)
    return drift


def _unchanged(value: Column, found: T.DataType, expected: T.DataType) -> Column:
    """The value in the expected type; one that would change is an error."""
    cast = value.cast(expected)
    if not isinstance(expected, T.DoubleType) or not isinstance(found, (T.LongType, T.DecimalType)):
        return cast
    back = cast.cast(found)
    refused = F.raise_error(F.concat(F.lit("INEXACT_NUMBER: "), value.cast("string")))
    return F.when(value.isNull() | (back == value), cast).otherwise(refused.cast(expected))


def conform(
    df: DataFrame,
    expected: T.StructType,
    renames: Mapping[str, str] | None = None,
    optional: Sequence[str] = (),
    source: str = "",
) -> DataFrame:
    """The expected columns, typed, in order; or ``SchemaDrift`` with all that is wrong.

    ``optional`` names columns that may be missing, and are NULL then. Added
    columns are left out.
    """
    drift = compare(df.schema, expected, renames)
    absent = [c for c in drift.missing if c not in set(optional)]
    wrong = [f"missing {c}" for c in absent]
    wrong += [f"ambiguous {c}" for c in drift.ambiguous]
    wrong += [f"{c} is {a}, not {b}" for c, (a, b) in drift.refused.items()]
    if wrong:
        raise SchemaDrift(f"{source or 'schema'}: {'; '.join(wrong)}")
    columns = []
    for column in expected:
        if column.name in drift.missing:
            value = F.lit(None).cast(column.dataType)
        else:
            name = drift.renamed.get(column.name, column.name)
            kind, value = df.schema[name].dataType, F.col(f"`{name}`")
            if kind != column.dataType:
                value = _unchanged(value, kind, column.dataType)
        columns.append(value.alias(column.name))
    return df.select(*columns)


def parquet_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The Parquet files under a path, in groups of equal schemas.

    Only footers are read, one of each file. A folder partitioned by column
    names stays one group, as its files lack those columns.
    """
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(hadoop)
    matched = files.globStatus(root)
    if not matched:
        return [[path]]
    groups: dict[str, list[str]] = {}
    waiting = list(matched)
    while waiting:
        status = waiting.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            if "=" in name:
                return [[path]]
            if status is matched[0] or not name.startswith(("_", ".")):
                waiting.extend(files.listStatus(status.getPath()))
        elif not name.startswith(("_", ".")):
            source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromStatus(status, hadoop)
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
            try:
                schema = reader.getFileMetaData().getSchema().toString()
            finally:
                reader.close()
            groups.setdefault(schema, []).append(status.getPath().toString())
    return [sorted(g) for _, g in sorted(groups.items())] or [[path]]


def read_conforming(
    spark: SparkSession,
    path: str,
    format: str,
    expected: T.StructType,
    options: Mapping[str, str] | None = None,
    renames: Mapping[str, str] | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """A path in any format, its columns as expected, whatever each file calls them."""
    reader = spark.read.format(format).options(**(options or {}))
    groups = parquet_groups(spark, path) if format == "parquet" else [[path]]
    frames = []
    for group in groups:
        frame = reader.load(path if len(groups) == 1 else group)
        frames.append(conform(frame, expected, renames, optional, group[0]))
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
