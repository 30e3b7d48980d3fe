"""File and catalog readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from tallyworks.schemas import require_columns


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines, nested objects included; with a schema no inference pass runs."""
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet; a schema selects columns and reads zone-less times as UTC instants."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """The schema's columns of a CSV, found by the names in its header line, whatever else it holds.

    A column that is missing is an error, as are files of one path with different headers. Without a header
    the columns are those of the schema in its order.
    """
    if not header:
        return spark.read.schema(schema).csv(path)
    kinds = {f.name: f.dataType for f in schema.fields}
    found = spark.read.csv(path, header=True).columns
    present = StructType([StructField(c, kinds.get(c, StringType())) for c in found])
    return require_columns(spark.read.schema(present).csv(path, header=True, enforceSchema=False), schema, f"header of {path}")


def read_table(spark: SparkSession, name: str, schema: StructType | None = None) -> DataFrame:
    """A catalog table, checked against a column contract if one is given."""
    table = spark.table(name)
    return table if schema is None else require_columns(table, schema, name)
