"""Queries against their DuckDB twins on small random warehouses full of the rare cases: null keys,
null dates, repeated dimension rows, exact copies, ties, keys that hold a third of all rows."""

import random
from datetime import datetime, timedelta

import duckdb
import pytest
from helpers import duck_multiset, frame, spark_multiset

import __spark_entry__ as entry_module
from fixtures.oracles import INPUTS, oracles
from fixtures.warehouse import OVERRIDES
from gridtally.sources.warehouse import TABLES, Warehouse

MODELS = ["Fixed Renewable", "Non Renewable", "Fixed No Renewable", "renewable", "Standard", None]


class Draw:
    def __init__(self, seed: int) -> None:
        self.random = random.Random(seed)

    def maybe(self, value, p_null: float = 0.1):
        return None if self.random.random() < p_null else value

    def key(self, prefix: str, n: int, p_null: float = 0.05):
        """One of n keys; the first holds about a third of the rows."""
        i = 0 if self.random.random() < 0.33 else self.random.randrange(n)
        return self.maybe(f"{prefix}{i}", p_null)

    def kwh(self):
        return self.maybe(self.random.choice([0, 5, 1005, 1234.567, 99999.999, 16777217]), 0.15)

    def day(self):
        return datetime(1997, 6, 1) + timedelta(days=self.random.randrange(1000))

    def moment(self):
        return self.day() + timedelta(hours=self.random.choice([0, 0, 7, 23]))

    def pick(self, values):
        return self.random.choice(values)


def _quote(d: Draw):
    return d.maybe(d.pick([OVERRIDES[1], OVERRIDES[2], "Q1", "Q2", "Q11", "Q9"]), 0.1)


def _contracts(d: Draw):
    rows = []
    for i in range(14):
        for _ in range(d.pick([1, 1, 1, 2])):
            start = d.maybe(d.moment(), 0.08)
            rows.append(
                {
                    "contract_key": f"c{i}",
                    "contract_reference": _quote(d),
                    "agreement_number": d.maybe(d.random.randrange(3), 0.2),
                    "agreement_start_date": start,
                    "agreement_end_date": d.maybe(
                        (start or d.day()) + timedelta(days=d.pick([20, 200, 730])), 0.15
                    ),
                    "agreement_cancelled_flag": d.maybe(d.pick("YNN"), 0.1),
                    "agreement_cancellation_date": d.maybe(
                        (start or d.day()) + timedelta(hours=d.pick([5, 9, 2400])), 0.4
                    ),
                    "quote_model": d.pick(MODELS),
                }
            )
    return rows


def _customers(d: Draw):
    numbers = ["12345", "1234567890", "SC123", "7x", "", None]
    return [
        {"customer_key": f"u{i}", "companyno": d.pick(numbers)}
        for i in range(6)
        for _ in range(d.pick([1, 1, 2]))
    ]


def _costs(d: Draw):
    return [
        {
            "quote_mpan": d.pick([f"m{d.random.randrange(8)}", "0000000000021", None]),
            "costcomponent_key": d.pick(["59b1", "59b1", "other", None]),
            "year": d.maybe(d.pick([1998, 1999, 2000])),
            "contract_won_date_key": d.maybe(f"{d.day():%Y%m%d}"),
        }
        for _ in range(40)
    ]


def _daily(d: Draw):
    rows = []
    for _ in range(160):
        row = {
            "contract_key": d.key("c", 16),
            "contract_reference": _quote(d),
            "meter_key": d.key("t", 4),
            "customer_key": d.key("u", 4),
            "product_key": d.key("p", 3),
            "quote_mpan": d.key("m", 6),
            "delivery_date_key": d.maybe(f"1998{d.pick(['0401', '0402', '0501'])}", 0.08),
            "contract_won_date_key": d.maybe("19980115"),
            "fin_rep_period": d.maybe("P1"),
            "snapshot_date": d.maybe("2002-01-01"),
            "itron_forecast_key_lt": d.maybe("k", 0.25),
            **{name: d.kwh() for name in ("nbp_volume_kwh", "gsp_volume_kwh", "site_volume_kwh")},
            **{f"reforecasted_{p}_volume_lt": d.kwh() for p in ("nbp", "gsp", "msp")},
        }
        rows += [row] * d.pick([1, 1, 1, 4])
    return rows


def _month(d: Draw):
    return {"year": d.maybe(d.pick([1997, 1998, 1998, 1999, 1999]), 0.03), "month": d.random.randint(1, 12)}


def _monthly(d: Draw):
    volumes = [f.name for f in TABLES["monthly"][1].fields if "volume" in f.name]
    return [
        {
            "contract_key": d.key("c", 16),
            "contract_reference": _quote(d),
            "customer_key": d.key("u", 7),
            "product_key": d.key("p", 3),
            "meter_key": d.key("t", 4),
            "quote_mpan": d.key("m", 4),
            "mpan": d.key("m", 4, p_null=0.2),
            **_month(d),
            **{name: d.kwh() for name in volumes},
        }
        for _ in range(250)
    ]


def _settlement(d: Draw):
    rows = []
    for _ in range(120):
        row = {
            "meter_key": d.key("t", 5),
            "mpan": d.key("m", 4),
            "meter_type": d.maybe(d.pick(["HH", "NHH"]), 0.05),
            "measurement_quantity_id": d.pick(["AI", "RI", None, None]),
            "actual_estimate_indicator": d.pick(["A", "A", "E", None]),
            **_month(d),
            **{f"settlement_{p}_volume_kwh": d.kwh() for p in ("site", "gsp", "nbp")},
        }
        rows += [row] * d.pick([1, 1, 3])
    return rows


MAKERS = {
    "contracts": _contracts,
    "costs": _costs,
    "daily": _daily,
    "settlement": _settlement,
    "monthly": _monthly,
    "customers": _customers,
}


@pytest.mark.parametrize("seed", range(4))
def test_queries_equal_oracles(spark, tmp_path, seed):
    draw = Draw(seed)
    root = str(tmp_path)
    connection = duckdb.connect()
    tables = {}
    for attribute, maker in MAKERS.items():
        path = f"{root}/{attribute}"
        frame(spark, TABLES[attribute][1], maker(draw)).write.parquet(path)
        tables[attribute] = spark.read.parquet(path)
        connection.execute(
            f"CREATE TABLE {attribute} AS SELECT * FROM read_parquet('{path}/*.parquet')"
        )
    warehouse = Warehouse(**tables)
    twins = oracles(given=INPUTS)
    failures = []
    nonempty = set()
    for name, query in entry_module.QUERIES.items():
        actual = spark_multiset(query(warehouse))
        expected = duck_multiset(connection, twins[name])
        if expected:
            nonempty.add(name)
        if actual != expected:
            failures.append((name, len(actual), len(expected)))
    assert not failures
    assert len(nonempty) >= len(twins) - 2
