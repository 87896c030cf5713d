"""Facts stored by the keys they are joined on, so that plans need not exchange them.

The daily fact is dealt into buckets by contract and day, the settlement and monthly facts by meter. A
plan over such tables finds the rows of a key in one bucket already. The bucket of a key is read by one
task, which AQE cannot split, so this suits keys of which none holds a large share of the rows: contract-days
are that by nature, meters should be looked at with ``largest_share`` first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.session import TARGET_PARTITION_BYTES, read_bytes
from gridtally.sources.warehouse import TABLES, Warehouse

# Attribute of Warehouse -> the keys its rows are dealt by.
KEYS = {
    "daily": ("contract_key", "delivery_date_key"),
    "settlement": ("meter_key",),
    "monthly": ("meter_key",),
}


def write_laid_out(warehouse: Warehouse, database: str, buckets: int | None = None) -> None:
    """Store the six tables in ``database`` of the session's catalog, the facts bucketed by ``KEYS``.

    ``buckets`` is the same for all facts, as joined facts need the same; by default as many as give the
    largest fact buckets of about 256 MB. ``Warehouse.from_catalog(spark, database)`` reads the tables;
    ``configure(spark, laid_out=True)`` lets plans rely on the buckets. Existing tables raise.
    """
    if buckets is None:
        largest = max(read_bytes(getattr(warehouse, attribute)) for attribute in KEYS)
        buckets = max(1, -(-largest // TARGET_PARTITION_BYTES))
    for attribute, (name, _) in TABLES.items():
        rows = getattr(warehouse, attribute)
        keys = KEYS.get(attribute)
        if keys is None:
            writer = rows.write
        else:
            # The exchange deals rows as buckets do, so each task writes one file of one bucket.
            writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        writer.format("parquet").saveAsTable(f"{database}.{name}")


def largest_share(rows: DataFrame, attribute: str) -> float:
    """The share of ``rows`` that the most frequent key of ``KEYS[attribute]`` holds; 0 without rows."""
    counts = rows.groupBy(*KEYS[attribute]).agg(F.count("*").alias("n"))
    most, total = counts.agg(F.max("n"), F.sum("n")).first()
    return (most or 0) / (total or 1)
