"""Special-day tables: one shape, five operations."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from portalake.schema import Table, parse_fields

# Vendor tokens, column names and kinds.
_DAYS = parse_fields("""
locdate    date        date_ymd  key
dateName   name        text      key
isHoliday  is_holiday  text
dateKind   kind_code   text
seq        sequence    int
""")

_OPERATIONS = {
    "holidays": "getRestDeInfo",
    "national_holidays": "getHoliDeInfo",
    "anniversaries": "getAnniversaryInfo",
    "solar_terms": "get24DivisionsInfo",
    "sundry_days": "getSundryDayInfo",
}


def _year(params: Column) -> tuple[Column, Column]:
    """A year, or one month of it."""
    month = params["solMonth"]
    return F.concat(params["solYear"], F.coalesce(month, F.lit("01"))), F.concat(params["solYear"], F.coalesce(month, F.lit("12")))


TABLES = tuple(Table("holidays", name, op, _DAYS, span=_year) for name, op in _OPERATIONS.items())
