"""Short-range forecast tables."""

from portalake.schema import Table, between, parse_fields

# Vendor tokens, column names and kinds.
_FORECAST = parse_fields("""
baseDate   base_date       date_ymd
baseTime   base_time       text
category   category        text      key
fcstDate   forecast_date   date_ymd  key
fcstTime   forecast_time   text      key
fcstValue  forecast_value  text
nx         nx              int       key
ny         ny              int       key
""")

_NOWCAST = parse_fields("""
baseDate   base_date       date_ymd
baseTime   base_time       text
category   category        text      key
obsrValue  observed_value  text
nx         nx              int       key
ny         ny              int       key
""")

# Request parameters.
_ASKED = {"asks": {"base_time": "base_time", "nx": "nx", "ny": "ny"}, "span": between("base_date")}

TABLES = tuple(Table("weather", name, operation, fields, wide=True, slices=("base_time", "nx", "ny"), **_ASKED)
               for name, operation, fields in (("forecast", "getVilageFcst", _FORECAST),
                                               ("ultra_forecast", "getUltraSrtFcst", _FORECAST),
                                               ("nowcast", "getUltraSrtNcst", _NOWCAST)))
