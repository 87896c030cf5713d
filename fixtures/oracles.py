"""DuckDB twins of the registered queries, written as plain SQL over the same test tables.

They state the meaning without the library's rewrites: plain joins before distinct, row numbers and
window functions, the OR filter as one predicate.
"""

from __future__ import annotations

from fixtures.warehouse import CONTRACT_PARAMS, OVERRIDES, WINDOW
from gridtally.plans.reports import ACTUAL_NAMES, COMMON_NAMES, FORECAST_NAMES

_LO = f"TIMESTAMP '{WINDOW.start}'"
_HI = f"TIMESTAMP '{WINDOW.end}'"
_IN_LIST = ", ".join(f"'{quote}'" for quote in OVERRIDES)
_EXCLUDED = ", ".join(f"'{mpan}'" for mpan in CONTRACT_PARAMS.excluded_mpans)
_FISCAL = "((year = 1998 AND month >= 4) OR (year = 1999 AND month <= 3))"
_RENEWABLE = "(quote_model LIKE '%Renewable%' AND quote_model NOT LIKE '%No Renewable%')"
_KWH = "DECIMAL(18,3)"
_MWH = "DECIMAL(28,6)"
_POINTS = ("nbp", "gsp", "msp")
_SIX = [f"{p}_volume_kwh" for p in _POINTS] + [f"reforecasted_{p}_volume_kwh" for p in _POINTS]
_DAY_KEYS = (
    "contract_key, quote, meter_key, customer_key, product_key, delivery_date, calendarmonthkey, "
    "contract_won_date, fin_rep_period, snapshot_date, quote_mpan"
)
_FORECAST = {
    "forecast_msp_mwh": "site_volume_kwh",
    "forecast_gsp_mwh": "gsp_volume_kwh",
    "forecast_nbp_mwh": "nbp_volume_kwh",
    "forecast_st_msp_mwh": "reforecasted_msp_volume_st",
    "forecast_st_gsp_mwh": "reforecasted_gsp_volume_st",
    "forecast_st_nbp_mwh": "reforecasted_nbp_volume_st",
    "forecast_lt_msp_mwh": "reforecasted_msp_volume_lt",
    "forecast_lt_gsp_mwh": "reforecasted_gsp_volume_lt",
    "forecast_lt_nbp_mwh": "reforecasted_nbp_volume_lt",
}
_ACTUAL = {
    "actual_msp_mwh": "settlement_site_volume_kwh",
    "actual_gsp_mwh": "settlement_gsp_volume_kwh",
    "actual_nbp_mwh": "settlement_nbp_volume_kwh",
}
_LAST_FRAME = (
    "(PARTITION BY quote_mpan ORDER BY delivery_date ASC NULLS LAST, contract_key ASC NULLS FIRST, "
    "meter_key ASC NULLS FIRST, customer_key ASC NULLS FIRST, product_key ASC NULLS FIRST, "
    "agreement_cancellation_date ASC NULLS FIRST "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
)


def _generation_key(rows: str) -> str:
    return (
        f"{rows}.quote_mpan || CAST({rows}.year AS VARCHAR) || "
        f"lpad(CAST({rows}.month AS VARCHAR), 2, '0') || '01' || CAST({rows}.contract_key AS VARCHAR)"
    )


def _bad(key: str) -> str:
    """``key`` with a month 13 for February and no day in July."""
    return (
        f"CASE {key}[5:6] WHEN '02' THEN {key}[1:4] || '13' || {key}[7:8] "
        f"WHEN '07' THEN {key}[1:6] ELSE {key} END"
    )


def _unread(key: str) -> str:
    return f"({key} IS NOT NULL AND try_strptime({key}, '%Y%m%d') IS NULL)"


def _reason(key: str) -> str:
    return f"CASE WHEN {_unread(key)} THEN '{key} is not yyyyMMdd: ' || {key} END"


INPUTS = ("contracts", "customers", "costs", "daily", "monthly", "settlement")

# Common table expressions: name -> (names it reads, body). INPUTS derive the six input tables.
_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "lines": (
        (),
        f"""
        SELECT l.*, o.o_custkey, o.o_orderdate,
               (o_custkey - o_custkey % 2) * 10 + l_partkey % 3 AS meter,
               lpad(CAST((o_custkey - o_custkey % 2) * 10 + l_partkey % 3 AS VARCHAR), 13, '0') AS point,
               'Q' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS quote,
               CAST(l_quantity AS {_KWH}) AS q,
               CAST(l_extendedprice AS {_KWH}) AS p,
               CAST(year(l_shipdate) AS INTEGER) AS ship_year,
               CAST(month(l_shipdate) AS INTEGER) AS ship_month,
               CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS VARCHAR)
                   AS won_key
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    ),
    "contracts": (
        (),
        """
        SELECT o_orderkey AS contract_key,
               'Q' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS contract_reference,
               CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 5 END AS INTEGER)
                   AS agreement_number,
               o_orderdate AS agreement_start_date,
               o_orderdate + INTERVAL 730 DAY AS agreement_end_date,
               CASE WHEN o_orderstatus = 'P' THEN 'Y' ELSE 'N' END AS agreement_cancelled_flag,
               CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 180 DAY END
                   AS agreement_cancellation_date,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Fixed Renewable'
                                    WHEN '2-HIGH' THEN 'Fixed No Renewable'
                                    WHEN '3-MEDIUM' THEN NULL
                                    ELSE 'Fixed Standard' END AS quote_model
        FROM orders WHERE o_orderkey % 13 <> 0""",
    ),
    "customers": (
        (),
        """
        SELECT c_custkey AS customer_key,
               CASE c_custkey % 4 WHEN 0 THEN 'SC' || CAST(c_custkey AS VARCHAR)
                                  WHEN 1 THEN CAST(c_custkey AS VARCHAR)
                                  WHEN 2 THEN CAST(100000000 + c_custkey AS VARCHAR) END AS companyno
        FROM customer""",
    ),
    "costs": (
        ("lines",),
        """
        SELECT point AS quote_mpan,
               CASE WHEN meter % 10 = 0 THEN 'other' ELSE '59b1' END AS costcomponent_key,
               ship_year AS year, won_key AS contract_won_date_key
        FROM lines""",
    ),
    "daily": (
        ("lines",),
        f"""
        SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_orderkey END AS contract_key,
               quote AS contract_reference, meter AS meter_key, o_custkey AS customer_key,
               l_suppkey AS product_key, point AS quote_mpan,
               CAST(ship_year * 10000 + ship_month * 100 + 1 AS VARCHAR) AS delivery_date_key,
               won_key AS contract_won_date_key,
               'P' || CAST(ship_month AS VARCHAR) AS fin_rep_period,
               '2002-01-01' AS snapshot_date,
               CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber END AS itron_forecast_key_lt,
               CASE WHEN l_linenumber = 3 THEN NULL ELSE q END AS nbp_volume_kwh,
               CAST(q * 2 AS {_KWH}) AS gsp_volume_kwh,
               p AS site_volume_kwh,
               CAST(q * 3 AS {_KWH}) AS reforecasted_nbp_volume_lt,
               CAST(q * 4 AS {_KWH}) AS reforecasted_gsp_volume_lt,
               CASE WHEN l_linenumber = 2 THEN NULL ELSE CAST(p * 2 AS {_KWH}) END
                   AS reforecasted_msp_volume_lt
        FROM (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE meter % 10 = 1)""",
    ),
    "monthly": (
        ("lines",),
        f"""
        SELECT l_orderkey AS contract_key, quote AS contract_reference, o_custkey AS customer_key,
               l_suppkey AS product_key, meter AS meter_key, point AS quote_mpan, point AS mpan,
               ship_year AS year, ship_month AS month,
               p AS site_volume_kwh, CAST(q * 2 AS {_KWH}) AS gsp_volume_kwh, q AS nbp_volume_kwh,
               CAST(p * 2 AS {_KWH}) AS reforecasted_msp_volume_st,
               CAST(q * 3 AS {_KWH}) AS reforecasted_gsp_volume_st,
               CAST(q * 5 AS {_KWH}) AS reforecasted_nbp_volume_st,
               CAST(p * 3 AS {_KWH}) AS reforecasted_msp_volume_lt,
               CAST(q * 7 AS {_KWH}) AS reforecasted_gsp_volume_lt,
               CAST(q * 9 AS {_KWH}) AS reforecasted_nbp_volume_lt
        FROM lines""",
    ),
    "settlement": (
        ("lines",),
        f"""
        SELECT meter AS meter_key, point AS mpan,
               CASE WHEN l_linestatus = 'O' THEN 'NHH' ELSE 'HH' END AS meter_type,
               CASE l_returnflag WHEN 'A' THEN 'AI' WHEN 'R' THEN 'RI' END AS measurement_quantity_id,
               CASE WHEN l_linenumber % 3 = 0 THEN 'E' ELSE 'A' END AS actual_estimate_indicator,
               ship_year AS year, ship_month AS month,
               p AS settlement_site_volume_kwh, CAST(q * 2 AS {_KWH}) AS settlement_gsp_volume_kwh,
               q AS settlement_nbp_volume_kwh
        FROM lines""",
    ),
    "effective": (
        ("contracts",),
        """
        SELECT DISTINCT contract_key, CAST(agreement_start_date AS DATE) AS agreement_start_date,
               CAST(CASE WHEN agreement_cancelled_flag = 'Y' THEN agreement_cancellation_date
                         ELSE agreement_end_date END AS DATE) AS agreement_end_date,
               agreement_cancelled_flag, agreement_cancellation_date
        FROM contracts""",
    ),
    "listed": (
        ("contracts",),
        """
        SELECT contract_reference AS quote FROM contracts
        WHERE agreement_cancelled_flag = 'Y' AND contract_reference IS NOT NULL""",
    ),
    "bad_costs": (
        ("costs",),
        f"""
        SELECT * REPLACE ({_bad("contract_won_date_key")} AS contract_won_date_key) FROM costs
        WHERE costcomponent_key = '59b1' AND quote_mpan IS NOT NULL""",
    ),
    "bad_daily": (
        ("daily", "mpans"),
        f"""
        SELECT contract_key, contract_reference AS quote, meter_key, customer_key, product_key,
               {_bad("delivery_date_key")} AS delivery_date_key,
               {_bad("contract_won_date_key")} AS contract_won_date_key,
               fin_rep_period, snapshot_date, quote_mpan,
               nbp_volume_kwh, gsp_volume_kwh, site_volume_kwh AS msp_volume_kwh,
               reforecasted_nbp_volume_lt, reforecasted_gsp_volume_lt, reforecasted_msp_volume_lt
        FROM daily
        WHERE contract_key IS NOT NULL AND meter_key IS NOT NULL
          AND customer_key IS NOT NULL AND product_key IS NOT NULL
          AND quote_mpan IN (SELECT quote_mpan FROM mpans)""",
    ),
    "mpans": (
        ("costs",),
        f"""
        SELECT DISTINCT quote_mpan FROM costs
        WHERE costcomponent_key = '59b1'
          AND (year >= 2000 OR CAST(strptime(contract_won_date_key, '%Y%m%d') AS DATE)
                               BETWEEN DATE '{CONTRACT_PARAMS.won_from}' AND DATE '{CONTRACT_PARAMS.won_to}')
          AND quote_mpan NOT IN ({_EXCLUDED})""",
    ),
    "ltf": (
        ("daily",),
        """
        SELECT contract_key, delivery_date_key,
               min(CASE WHEN itron_forecast_key_lt IS NULL THEN 'N' ELSE 'Y' END) AS has_ltf
        FROM daily WHERE contract_key IS NOT NULL GROUP BY contract_key, delivery_date_key""",
    ),
    "clean": (
        ("daily", "mpans"),
        """
        SELECT DISTINCT contract_key, contract_reference AS quote, meter_key, customer_key, product_key,
               CAST(strptime(delivery_date_key, '%Y%m%d') AS DATE) AS delivery_date,
               delivery_date_key[1:6] AS calendarmonthkey,
               CAST(strptime(contract_won_date_key, '%Y%m%d') AS DATE) AS contract_won_date,
               delivery_date_key, fin_rep_period, snapshot_date, quote_mpan,
               nbp_volume_kwh, gsp_volume_kwh, site_volume_kwh AS msp_volume_kwh,
               reforecasted_nbp_volume_lt, reforecasted_gsp_volume_lt, reforecasted_msp_volume_lt
        FROM daily
        WHERE contract_key IS NOT NULL AND meter_key IS NOT NULL
          AND customer_key IS NOT NULL AND product_key IS NOT NULL
          AND quote_mpan IN (SELECT quote_mpan FROM mpans)""",
    ),
    "chosen": (
        ("clean", "ltf"),
        f"""
        SELECT c.{_DAY_KEYS.replace(", ", ", c.")},
               {", ".join(f"CAST(coalesce({p}_volume_kwh, 0) AS {_KWH}) AS {p}_volume_kwh" for p in _POINTS)},
               {", ".join(
                   f"CAST(coalesce(CASE WHEN has_ltf = 'Y' THEN reforecasted_{p}_volume_lt "
                   f"ELSE {p}_volume_kwh END, 0) AS {_KWH}) AS reforecasted_{p}_volume_kwh"
                   for p in _POINTS)}
        FROM clean c LEFT JOIN ltf f
          ON c.contract_key = f.contract_key AND c.delivery_date_key = f.delivery_date_key""",
    ),
    "rolled": (
        ("chosen",),
        f"""
        SELECT {_DAY_KEYS}, {", ".join(f"CAST(sum({v}) AS DECIMAL(28,3)) AS {v}" for v in _SIX)}
        FROM chosen GROUP BY {_DAY_KEYS}""",
    ),
    "cut": (
        ("rolled", "effective"),
        f"""
        SELECT r.{_DAY_KEYS.replace(", ", ", r.")}, e.agreement_cancelled_flag,
               CAST(e.agreement_cancellation_date AS DATE) AS agreement_cancellation_date,
               {", ".join(f"r.{p}_volume_kwh" for p in _POINTS)},
               {", ".join(
                   f"CAST(CASE WHEN delivery_date NOT BETWEEN agreement_start_date AND agreement_end_date "
                   f"THEN 0 ELSE r.reforecasted_{p}_volume_kwh END AS DECIMAL(28,3)) "
                   f"AS reforecasted_{p}_volume_kwh" for p in _POINTS)}
        FROM rolled r LEFT JOIN effective e ON r.contract_key = e.contract_key""",
    ),
    "newest": (
        ("cut",),
        f"""
        SELECT *,
               {", ".join(
                   f"last_value({k}) OVER {_LAST_FRAME} AS last_{k}"
                   for k in ("contract_key", "meter_key", "customer_key", "product_key"))},
               max(agreement_cancelled_flag) OVER (PARTITION BY quote_mpan)
                   AS last_agreement_cancelled_flag,
               last_value(agreement_cancellation_date IGNORE NULLS) OVER {_LAST_FRAME}
                   AS last_agreement_cancellation_date
        FROM cut""",
    ),
    "readings": (
        ("settlement",),
        f"""
        SELECT * FROM settlement
        WHERE ((meter_type = 'HH' AND measurement_quantity_id = 'AI' AND actual_estimate_indicator = 'A')
               OR (meter_type = 'NHH' AND measurement_quantity_id IS NULL
                   AND actual_estimate_indicator = 'A'))
          AND {_FISCAL}""",
    ),
    "settled": (
        ("readings", "monthly", "customers"),
        f"""
        SELECT contract_key, customer_key, product_key, meter_key, generation_key, quote_id, mpan,
               meter_type, month, year, delivery_month,
               {", ".join(f"CAST({kwh} * 0.001 AS {_MWH}) AS {name}" for name, kwh in _ACTUAL.items())}
        FROM (SELECT DISTINCT m.contract_key, m.customer_key, m.product_key, s.meter_key,
                     m.contract_reference AS quote_id, c.companyno, m.quote_mpan, s.mpan, s.meter_type,
                     s.month, s.year, {", ".join(f"s.{kwh}" for kwh in _ACTUAL.values())},
                     s.measurement_quantity_id, s.actual_estimate_indicator,
                     m.quote_mpan || CAST(s.year AS VARCHAR) || lpad(CAST(s.month AS VARCHAR), 2, '0')
                         || '01' || CAST(m.contract_key AS VARCHAR) AS generation_key,
                     make_timestamp(s.year, s.month, 1, 0, 0, 0) AS delivery_month
              FROM readings s JOIN monthly m ON s.meter_key = m.meter_key
                              JOIN customers c ON m.customer_key = c.customer_key)""",
    ),
    "touching": (
        ("contracts",),
        f"""
        SELECT * FROM contracts
        WHERE (agreement_start_date >= {_LO} AND agreement_start_date <= {_HI})
           OR (agreement_end_date >= {_LO} AND agreement_end_date <= {_HI})
           OR (agreement_start_date <= {_LO} AND agreement_end_date >= {_HI})""",
    ),
    "ranked": (
        ("touching", "monthly"),
        """
        SELECT t.contract_key, t.agreement_number, t.agreement_start_date, t.agreement_end_date,
               t.contract_reference, t.quote_model, m.mpan,
               row_number() OVER (PARTITION BY t.contract_reference || m.mpan
                                  ORDER BY t.agreement_number DESC NULLS FIRST,
                                           t.contract_key DESC NULLS LAST,
                                           t.agreement_start_date DESC NULLS LAST,
                                           t.agreement_end_date DESC NULLS LAST,
                                           t.quote_model DESC NULLS LAST,
                                           m.mpan DESC NULLS LAST) AS rn
        FROM touching t JOIN monthly m ON t.contract_key = m.contract_key""",
    ),
    "forecast": (
        ("monthly", "customers"),
        f"""
        SELECT m.contract_key, m.customer_key, m.product_key, m.meter_key, m.mpan, m.month, m.year,
               m.contract_reference AS quote_id, {_generation_key("m")} AS generation_key,
               make_timestamp(m.year, m.month, 1, 0, 0, 0) AS delivery_month,
               {", ".join(f"CAST(sum(m.{kwh}) * 0.001 AS {_MWH}) AS {n}" for n, kwh in _FORECAST.items())}
        FROM monthly m JOIN customers c ON m.customer_key = c.customer_key
        WHERE {_FISCAL}
        GROUP BY m.contract_key, m.customer_key, m.product_key, m.meter_key, c.companyno, m.mpan,
                 m.month, m.year, m.contract_reference, m.quote_mpan""",
    ),
}

_ROW_NUMBER = """row_number() OVER (PARTITION BY contract_reference || mpan
    ORDER BY agreement_number DESC NULLS FIRST, contract_key DESC NULLS LAST,
             agreement_start_date DESC NULLS LAST, agreement_end_date DESC NULLS LAST,
             quote_model DESC NULLS LAST, mpan DESC NULLS LAST)"""
_ACTUAL_OUT = (
    "s.contract_key, s.customer_key, s.generation_key, s.quote_id, s.mpan, s.meter_type, "
    "s.delivery_month, " + ", ".join(f"s.{name}" for name in _ACTUAL)
)
_FORECAST_OUT = (
    "f.contract_key, f.customer_key, f.product_key, f.generation_key, f.quote_id, f.mpan, "
    "f.delivery_month, " + ", ".join(f"f.{name}" for name in _FORECAST)
)
_OVERRIDE = f"contract_reference IN ({_IN_LIST})"
_LISTED = "contract_reference IN (SELECT quote FROM listed)"
_BAD_DAY = f"({_unread('delivery_date_key')} OR {_unread('contract_won_date_key')})"
_BAD_POINT = f"(coalesce(year, 0) < 2000 AND {_unread('contract_won_date_key')})"
_ACTUALS = f"""
    SELECT DISTINCT {_ACTUAL_OUT} FROM settled s JOIN ranked a ON a.contract_key = s.contract_key
    WHERE a.rn = 1 AND s.delivery_month BETWEEN a.agreement_start_date AND a.agreement_end_date
      AND ({_RENEWABLE} OR {_OVERRIDE})"""
_FORECAST_STRICT = f"""
    SELECT DISTINCT {_FORECAST_OUT} FROM forecast f JOIN ranked a ON a.contract_key = f.contract_key
    WHERE a.rn = 1 AND f.delivery_month BETWEEN a.agreement_start_date AND a.agreement_end_date
      AND ({_RENEWABLE} OR {_OVERRIDE})"""
_FORECAST_LOOSE = f"""
    SELECT DISTINCT {_FORECAST_OUT} FROM forecast f JOIN ranked a ON a.contract_key = f.contract_key
    WHERE (a.rn = 1 AND f.delivery_month BETWEEN a.agreement_start_date AND a.agreement_end_date
           AND {_RENEWABLE})
       OR {_OVERRIDE}"""
_MONTH_KEYS = (
    _DAY_KEYS.replace("delivery_date, ", "")
    + ", agreement_cancelled_flag, agreement_cancellation_date, last_contract_key, last_meter_key, "
    "last_customer_key, last_product_key, last_agreement_cancelled_flag, "
    "last_agreement_cancellation_date"
)
_COMPANY = """CASE WHEN companyno ~ '^[0-9].*' AND length(companyno) < 8 THEN lpad(companyno, 8, '0')
                   ELSE coalesce(companyno, '') END"""


def _display(columns: str, names: dict[str, str]) -> str:
    """``columns`` (comma-separated, one-letter prefix) with display names."""
    return ", ".join(f'{c.split(".")[1]} AS "{names[c.split(".")[1]]}"' for c in columns.split(", "))


def _with_clause(names: tuple[str, ...], given: tuple[str, ...]) -> str:
    """WITH clause holding ``names`` and all they read, dependencies first, but for ``given``."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order or name in given:
            return
        for needed in _CTES[name][0]:
            add(needed)
        order.append(name)

    for name in names:
        add(name)
    if not order:
        return ""
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name][1]})" for name in order) + "\n"


def oracles(given: tuple[str, ...] = ()) -> dict[str, str]:
    """One statement per query. Names in ``given`` are tables that exist already."""

    def _with(*names: str) -> str:
        return _with_clause(names, given)

    def _all(name: str, columns: str = "*", where: str | None = None) -> str:
        tail = f" WHERE {where}" if where else ""
        return _with(name) + f"SELECT {columns} FROM {name}{tail}"

    names = {**COMMON_NAMES, **ACTUAL_NAMES, **FORECAST_NAMES}
    newest_only = "contract_key, mpan, agreement_number, agreement_start_date, agreement_end_date, " \
        "contract_reference, quote_model"
    validity = "contract_key, agreement_start_date AS valid_from, agreement_end_date AS valid_to"
    cut_columns = _DAY_KEYS + ", agreement_cancelled_flag, agreement_cancellation_date, " + ", ".join(_SIX)
    return {
        # Filters.
        "not_null_keys": _all(
            "daily",
            where="contract_key IS NOT NULL AND meter_key IS NOT NULL "
            "AND customer_key IS NOT NULL AND product_key IS NOT NULL",
        ),
        "select_mpans": _all("mpans"),
        "mpan_semi_join": _with("daily", "mpans")
        + "SELECT * FROM daily WHERE quote_mpan IN (SELECT quote_mpan FROM mpans)",
        "meter_class_filter": _all(
            "settlement",
            where="(meter_type = 'HH' AND measurement_quantity_id = 'AI' "
            "AND actual_estimate_indicator = 'A') OR (meter_type = 'NHH' "
            "AND measurement_quantity_id IS NULL AND actual_estimate_indicator = 'A')",
        ),
        "fiscal_year_filter": _all("monthly", where=_FISCAL),
        "agreement_overlap": _all("touching"),
        "renewable_filter": _all("contracts", where=_RENEWABLE),
        "quote_override": _all("contracts", where=_OVERRIDE),
        "renewable_or_override_strict": _with("forecast", "ranked")
        + "SELECT DISTINCT f.* FROM forecast f JOIN ranked a ON a.contract_key = f.contract_key "
        "WHERE a.rn = 1 AND f.delivery_month BETWEEN a.agreement_start_date AND a.agreement_end_date "
        f"AND ({_RENEWABLE} OR {_OVERRIDE})",
        "renewable_or_override_loose": _with("forecast", "ranked")
        + "SELECT DISTINCT f.* FROM forecast f JOIN ranked a ON a.contract_key = f.contract_key "
        "WHERE a.rn = 1 AND f.delivery_month BETWEEN a.agreement_start_date AND a.agreement_end_date "
        f"AND {_RENEWABLE} OR {_OVERRIDE}",
        "quote_override_list": _with("contracts", "listed") + f"SELECT * FROM contracts WHERE {_LISTED}",
        "renewable_or_override_strict_list": _with("forecast", "ranked", "listed")
        + "SELECT DISTINCT f.* FROM forecast f JOIN ranked a ON a.contract_key = f.contract_key "
        "WHERE a.rn = 1 AND f.delivery_month BETWEEN a.agreement_start_date AND a.agreement_end_date "
        f"AND ({_RENEWABLE} OR {_LISTED})",
        "renewable_or_override_loose_list": _with("forecast", "ranked", "listed")
        + "SELECT DISTINCT f.* FROM forecast f JOIN ranked a ON a.contract_key = f.contract_key "
        "WHERE a.rn = 1 AND f.delivery_month BETWEEN a.agreement_start_date AND a.agreement_end_date "
        f"AND {_RENEWABLE} OR {_LISTED}",
        "ranked_agreements_spread": _with("touching", "monthly")
        + f"SELECT {newest_only}, {_ROW_NUMBER} AS row_num FROM touching t "
        "JOIN (SELECT DISTINCT contract_key, mpan FROM monthly) m USING (contract_key)",
        "ranked_agreements": _with("touching", "monthly")
        + f"SELECT {newest_only}, {_ROW_NUMBER} AS row_num FROM touching t "
        "JOIN (SELECT DISTINCT contract_key, mpan FROM monthly) m USING (contract_key)",
        "admitted_contracts_strict": _with("ranked")
        + f"SELECT DISTINCT {validity} FROM ranked WHERE rn = 1 AND ({_RENEWABLE} OR {_OVERRIDE})",
        "admitted_contracts_loose": _with("ranked")
        + f"SELECT DISTINCT {validity} FROM ranked WHERE rn = 1 AND {_RENEWABLE} "
        f"UNION SELECT contract_key, {_LO}, {_HI} FROM touching WHERE {_OVERRIDE}",
        # Islands: whatever is covered when the next interval begins; plain window and grouping.
        "merged_validity": _with("contracts")
        + """, spans AS (
          SELECT contract_reference AS contract_key, agreement_start_date AS f, agreement_end_date AS t
          FROM contracts WHERE agreement_start_date <= agreement_end_date
        ), begun AS (
          SELECT *, CASE WHEN f <= max(t) OVER (PARTITION BY contract_key ORDER BY f, t
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM spans
        ), islands AS (
          SELECT *, sum(fresh) OVER (PARTITION BY contract_key ORDER BY f, t
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM begun
        ) SELECT contract_key, min(f) AS valid_from, max(t) AS valid_to
        FROM islands GROUP BY contract_key, island""".replace(
            ", spans", ", spans" if "contracts" not in given else "WITH spans", 1
        ),
        # Daily volumes.
        "contract_effective_dates": _all("effective"),
        "ltf_flag": _all("ltf"),
        "dedup_volumes": _all("clean"),
        "dedup_volumes_by_hash": _all("clean"),
        "ltf_flag_of_needed_days": _with("ltf", "clean")
        + "SELECT * FROM ltf f WHERE EXISTS (SELECT 1 FROM clean c WHERE "
        "c.contract_key = f.contract_key AND c.delivery_date_key = f.delivery_date_key)",
        "select_mpans_lenient": _with("bad_costs")
        + f"""SELECT DISTINCT quote_mpan FROM bad_costs
        WHERE (year >= 2000 OR CAST(try_strptime(contract_won_date_key, '%Y%m%d') AS DATE)
               BETWEEN DATE '{CONTRACT_PARAMS.won_from}' AND DATE '{CONTRACT_PARAMS.won_to}')
          AND quote_mpan NOT IN ({_EXCLUDED})""",
        "select_mpans_rejects": _with("bad_costs")
        + f"SELECT *, {_reason('contract_won_date_key')} AS reason FROM bad_costs WHERE {_BAD_POINT}",
        "dedup_volumes_lenient": _with("bad_daily")
        + f"""SELECT DISTINCT * EXCLUDE (contract_won_date_key),
               CAST(try_strptime(delivery_date_key, '%Y%m%d') AS DATE) AS delivery_date,
               delivery_date_key[1:6] AS calendarmonthkey,
               CAST(try_strptime(contract_won_date_key, '%Y%m%d') AS DATE) AS contract_won_date
        FROM bad_daily WHERE NOT {_BAD_DAY}""",
        "dedup_volumes_rejects": _with("bad_daily")
        + f"""SELECT *, concat_ws('; ', {_reason('delivery_date_key')},
               {_reason('contract_won_date_key')}) AS reason
        FROM bad_daily WHERE {_BAD_DAY}""",
        "reforecast_fallback": _all("chosen"),
        "daily_rollup": _all("rolled"),
        "zero_outside_agreement": _all("cut", cut_columns),
        **dict.fromkeys(("latest_keys", "latest_keys_by_day"), _all("newest")),
        "latest_cancellation": _all("newest", cut_columns + ", last_agreement_cancellation_date"),
        "any_cancelled": _all("newest", cut_columns + ", last_agreement_cancelled_flag"),
        **dict.fromkeys(tuple(f"contract_month_volumes{way}" for way in ("", "_filtered", "_by_day")), _with("newest")
        + f"SELECT {_MONTH_KEYS}, "
        + ", ".join(
            f"CAST(sum({v}) * 0.001 AS DECIMAL(10,2)) AS {out}"
            for v, out in zip(
                _SIX,
                [f"quoted_{p}_volume_mwh" for p in _POINTS]
                + [f"reforecasted_{p}_volume_mwh" for p in _POINTS],
            )
        )
        + f" FROM newest GROUP BY {_MONTH_KEYS}"),
        # Monthly volumes.
        "with_generation_key": _with("monthly")
        + f"SELECT monthly.*, {_generation_key('monthly')} AS generation_key FROM monthly",
        "with_company_uid": _with("monthly", "customers")
        + f"SELECT m.*, m.quote_mpan || {_COMPANY} AS meter_uid "
        "FROM monthly m JOIN customers c ON m.customer_key = c.customer_key",
        "volumes_to_mwh": _with("settlement")
        + "SELECT * EXCLUDE (" + ", ".join(_ACTUAL.values()) + "), "
        + ", ".join(f"CAST({kwh} * 0.001 AS {_MWH}) AS {name}" for name, kwh in _ACTUAL.items())
        + " FROM settlement",
        "settled_months": _all("settled"),
        "latest_agreement": _all("ranked", newest_only, "rn = 1"),
        "forecast_months": _all("forecast"),
        "validity_join": _with("forecast", "ranked")
        + "SELECT f.*, a.agreement_start_date, a.agreement_end_date, "
        "a.contract_reference AS agreement_quote_id, a.quote_model "
        "FROM forecast f JOIN (SELECT DISTINCT contract_key, agreement_start_date, agreement_end_date, "
        "contract_reference, quote_model FROM ranked WHERE rn = 1) a ON a.contract_key = f.contract_key "
        "AND f.delivery_month BETWEEN a.agreement_start_date AND a.agreement_end_date",
        "actual_volumes_renewable": _with("settled", "ranked") + _ACTUALS,
        "actual_report": _with("settled", "ranked")
        + f"SELECT {_display(_ACTUAL_OUT, names)} FROM ({_ACTUALS}) "
        "ORDER BY contract_key NULLS LAST, generation_key NULLS LAST, delivery_month NULLS LAST",
        "forecast_volumes_renewable": _with("forecast", "ranked") + _FORECAST_LOOSE,
        "forecast_volumes_renewable_strict": _with("forecast", "ranked") + _FORECAST_STRICT,
        "actual_volumes_renewable_list": _with("settled", "ranked", "listed")
        + _ACTUALS.replace(_OVERRIDE, _LISTED),
        "forecast_volumes_renewable_list": _with("forecast", "ranked", "listed")
        + _FORECAST_LOOSE.replace(_OVERRIDE, _LISTED),
        "forecast_report": _with("forecast", "ranked")
        + f"SELECT {_display(_FORECAST_OUT, names)} FROM ({_FORECAST_LOOSE}) "
        "ORDER BY contract_key NULLS LAST, generation_key NULLS LAST, delivery_month NULLS LAST",
    }
