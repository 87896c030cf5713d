"""Business identifiers assembled as text. ``concat`` is meant: a null part makes the whole null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPANY_DIGITS = 8


def generation_key(quote_mpan: Column, year: Column, month: Column, contract_key: Column) -> Column:
    """Supply point, first day of the month as ``yyyyMMdd``, then the contract."""
    return F.concat(
        quote_mpan.cast("string"),
        year.cast("string"),
        F.lpad(month.cast("string"), 2, "0"),
        F.lit("01"),
        contract_key.cast("string"),
    )


def company_code(companyno: Column) -> Column:
    """Numeric company numbers padded to eight places; others as they are; none as empty text."""
    too_short = companyno.rlike("^[0-9]") & (F.length(companyno) < COMPANY_DIGITS)
    return F.when(too_short, F.lpad(companyno, COMPANY_DIGITS, "0")).otherwise(
        F.coalesce(companyno, F.lit(""))
    )


def meter_uid(quote_mpan: Column, companyno: Column) -> Column:
    return F.concat(quote_mpan.cast("string"), company_code(companyno))


def agreement_group(contract_reference: Column, mpan: Column) -> Column:
    """Quote and supply point joined without a delimiter; rows missing either share the null group."""
    return F.concat(contract_reference.cast("string"), mpan.cast("string"))
