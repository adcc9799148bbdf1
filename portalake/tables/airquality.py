"""Air quality measurement tables."""

from portalake.schema import Field, Table, parse_fields

# Vendor tokens, column names and kinds.
_INDEX = parse_fields("""
dataTime   measured_at  text  key
khaiValue  khai         int
khaiGrade  khai_grade   int
""")
_POLLUTANTS = {"pm10": "int", "pm25": "int", "so2": "decimal", "co": "decimal",
               "o3": "decimal", "no2": "decimal"}
_BY_SIDO = parse_fields("""
sidoName     sido     text
stationName  station  text  key
""")
_BY_STATION = parse_fields("""
mangName     network  text
stationName  station  text  key
""")

# Each pollutant has a value, a grade and a flag that explains a missing value.
_MEASURES = _INDEX + tuple(
    field for name, kind in _POLLUTANTS.items()
    for field in (Field(f"{name}Value", name, kind),
                  Field(f"{name}Grade", f"{name}_grade", "int"),
                  Field(f"{name}Flag", f"{name}_flag", "text")))

TABLES = (
    Table("airquality", "by_sido", "getCtprvnRltmMesureDnsty", _BY_SIDO + _MEASURES, wide=True,
          period_column="measured_at", slices=("sido", "station")),
    Table("airquality", "by_station", "getMsrstnAcctoRltmMesureDnsty", _BY_STATION + _MEASURES,
          wide=True, period_column="measured_at", slices=("station",), asks={"station": "stationName"}),
)
