"""Small frames and multiset comparison."""

from collections import Counter
from decimal import Decimal

from pyspark.sql import types as T

from gridtally.sources.warehouse import TABLES, Warehouse


def frame(spark, schema: T.StructType, rows: list[dict]):
    """Rows given as dicts; absent columns are null, volumes may be plain numbers."""

    def value(field, row):
        given = row.get(field.name)
        if given is not None and isinstance(field.dataType, T.DecimalType):
            return Decimal(str(given))
        return given

    return spark.createDataFrame([tuple(value(f, r) for f in schema.fields) for r in rows], schema)


def warehouse(spark, **tables: list[dict]) -> Warehouse:
    """A warehouse from rows per attribute; tables not given are empty."""
    return Warehouse(
        **{
            attribute: frame(spark, schema, tables.get(attribute, []))
            for attribute, (_, schema) in TABLES.items()
        }
    )


def multiset(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(
        tuple(str(v) if isinstance(v, Decimal) else v for v in (row[i] for i in order))
        for row in rows
    )


def spark_multiset(df) -> Counter:
    return multiset([tuple(row) for row in df.collect()], df.columns)


def duck_multiset(connection, sql) -> Counter:
    relation = connection.execute(sql)
    names = [column[0] for column in relation.description]
    return multiset(relation.fetchall(), names)
