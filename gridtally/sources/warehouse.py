"""Loads the six tables from Parquet folders or from a catalog."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtally.session import size_shuffles
from gridtally.sources import schemas

# Attribute of Warehouse -> (table name, declared schema).
TABLES: dict[str, tuple[str, T.StructType]] = {
    "contracts": ("dim_elec_contract", schemas.DIM_ELEC_CONTRACT),
    "costs": ("fact_elec_cost_current_monthly", schemas.FACT_COST_MONTHLY),
    "daily": ("fact_elec_consumption_current_daily", schemas.FACT_CONSUMPTION_DAILY),
    "settlement": (
        "fact_elec_volumes_settlement_consumption_monthly",
        schemas.FACT_SETTLEMENT_MONTHLY,
    ),
    "monthly": ("fact_elec_consumption_current_monthly", schemas.FACT_CONSUMPTION_MONTHLY),
    "customers": ("dim_customer", schemas.DIM_CUSTOMER),
}


def conform(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Project ``df`` onto ``schema``.

    A missing column is an error. A column of another type is cast (text months become integers,
    float volumes become exact decimals); under ANSI mode a value that does not fit raises. Columns
    that already have the declared type stay bare, so filters on them still reach the scan.
    """
    found = {field.name.lower(): field.dataType for field in df.schema.fields}
    missing = [field.name for field in schema.fields if field.name.lower() not in found]
    if missing:
        raise ValueError(f"{table} lacks columns {', '.join(missing)}")
    return df.select(
        *(
            F.col(field.name)
            if found[field.name.lower()] == field.dataType
            else F.col(field.name).cast(field.dataType).alias(field.name)
            for field in schema.fields
        )
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once. A customer listed twice doubles forecast sums."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


@dataclass(frozen=True)
class Warehouse:
    """The six inputs as DataFrames."""

    contracts: DataFrame
    costs: DataFrame
    daily: DataFrame
    settlement: DataFrame
    monthly: DataFrame
    customers: DataFrame

    @classmethod
    def from_parquet(
        cls,
        spark: SparkSession,
        root: str,
        paths: Mapping[str, str] | None = None,
        declared: bool = False,
        unique: bool = False,
    ) -> Warehouse:
        """Read ``root/<table name>`` for each table; ``paths`` overrides single tables by name.

        ``declared`` reads with the declared schemas, without a look at any footer, for files that have
        those types; else columns of other types are cast. ``unique`` runs ``check_unique``.
        """
        paths = paths or {}

        def read(name: str, schema: T.StructType) -> DataFrame:
            reader = spark.read.schema(schema) if declared else spark.read
            return reader.parquet(paths.get(name, f"{root}/{name}"))

        return cls._load(read, unique)

    @classmethod
    def from_catalog(
        cls,
        spark: SparkSession,
        database: str | None = None,
        names: Mapping[str, str] | None = None,
        unique: bool = False,
    ) -> Warehouse:
        """Read catalog tables or views; ``names`` gives the full name of single tables."""
        names = names or {}
        prefix = f"{database}." if database else ""
        return cls._load(lambda name, _: spark.table(names.get(name, prefix + name)), unique)

    def check_unique(self) -> None:
        """Raise if a customer or contract is listed more than once. Runs a job for each."""
        for attribute, key in (("customers", "customer_key"), ("contracts", "contract_key")):
            found = duplicate_keys(getattr(self, attribute), key).first()
            if found is not None:
                raise ValueError(f"{TABLES[attribute][0]} lists {key} {found[0]} {found[1]} times")

    @classmethod
    def _load(cls, read, unique: bool) -> Warehouse:
        warehouse = cls(
            **{
                attribute: conform(read(name, schema), schema, name)
                for attribute, (name, schema) in TABLES.items()
            }
        )
        size_shuffles(*(getattr(warehouse, attribute) for attribute in TABLES))
        if unique:
            warehouse.check_unique()
        return warehouse
