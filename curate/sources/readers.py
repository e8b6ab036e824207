"""Readers. A schema is declared, comes with the file, or is found from all records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header row; quotes inside a quoted text are doubled.

    Without a schema every column is text.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType | str
) -> DataFrame:
    """One JSON record per line. A field that a record lacks is null."""
    return spark.read.schema(schema).json(path)


def _column_type(kind: T.DataType) -> T.DataType:
    """A type that a column can have: text where records disagree or all are null."""
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_column_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _column_type(f.dataType)) for f in kind])
    return kind


def _written(kind: T.DataType) -> str:
    """A type as SQL writes it, with every name in back quotes."""
    if isinstance(kind, T.ArrayType):
        return f"array<{_written(kind.elementType)}>"
    if isinstance(kind, T.StructType):
        fields = (f"`{f.name.replace('`', '``')}`: {_written(f.dataType)}" for f in kind)
        return f"struct<{', '.join(fields)}>"
    return kind.simpleString()


def union_of_keys(lines: DataFrame, column: str = "value") -> T.StructType:
    """The schema that holds every key of every JSON record, nested ones too.

    Types come from all records, merged in one aggregate: a key that is a number here
    and a text there is text, as is a key that is always null. Text that is no JSON
    object takes no part. Two keys of a record set that differ in case alone cannot be
    columns of one table and raise.
    """
    record = F.try_parse_json(column).alias("record")
    objects = lines.select(record).filter(F.schema_of_variant("record").startswith("OBJECT"))
    # Otherwise keys that differ in case alone become one, and records lose theirs.
    conf = lines.sparkSession.conf
    before = conf.get("spark.sql.caseSensitive")
    conf.set("spark.sql.caseSensitive", True)
    try:
        found = objects.agg(F.schema_of_variant_agg("record")).first()[0]
    finally:
        conf.set("spark.sql.caseSensitive", before)
    if not found.startswith("OBJECT"):
        return T.StructType([])
    # Names that are not plain stand in back quotes, so the word can only be a type.
    parts = found.split("`")
    parts[::2] = [p.replace("OBJECT<", "STRUCT<") for p in parts[::2]]
    schema = _column_type(T.DataType.fromDDL("`".join(parts)))
    same = {f.name.lower() for f in schema}
    if len(same) < len(schema):
        raise ValueError(f"keys differ in case alone: {sorted(f.name for f in schema)}")
    return schema


def records_by_union(
    lines: DataFrame, column: str = "value", schema: T.StructType | None = None
) -> DataFrame:
    """JSON records as a table whose columns are the union of all keys, in the order of
    their names; a key that a record lacks is null.

    Reads the text twice, once for the keys; pass ``schema`` where they are known. Text
    that is no JSON object gives a row of nulls.
    """
    schema = union_of_keys(lines, column) if schema is None else schema
    if not schema.fields:
        return lines.select()
    record = F.try_variant_get(F.try_parse_json(column), "$", _written(schema))
    return lines.select(record.alias("record")).select("record.*")


def read_json_union(spark: SparkSession, path: str) -> DataFrame:
    """JSON records, one per line, without a declared schema; see ``records_by_union``."""
    return records_by_union(spark.read.text(path))
