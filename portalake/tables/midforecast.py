"""Mid-range forecast tables: one column per day ahead, or half day for the nearer days."""

from portalake.schema import Field, Table, between

# Days ahead, tokens, column names and kinds.
_HALF_DAYS = range(4, 8)
_WHOLE_DAYS = range(8, 11)
_REGION = Field("regId", "region_code", "text", True)
_RAIN, _SKY = ("rnSt", "precip_prob", "int"), ("wf", "sky", "text")
_LOW, _HIGH = ("taMin", "temp_min", "int"), ("taMax", "temp_max", "int")


def _by_half_day(token: str, column: str, kind: str) -> tuple[Field, ...]:
    halves = [(f"{d}{half}", f"{d}{half.lower()}") for d in _HALF_DAYS for half in ("Am", "Pm")]
    days = [(str(d), str(d)) for d in _WHOLE_DAYS]
    return tuple(Field(token + t, f"{column}_{c}", kind) for t, c in halves + days)


_LAND = (_REGION, *_by_half_day(*_RAIN), *_by_half_day(*_SKY))
_TEMPERATURE = (_REGION, *(Field(f"{token}{d}", f"{column}_{d}", kind)
                           for d in (*_HALF_DAYS, *_WHOLE_DAYS)
                           for token, column, kind in (_LOW, _HIGH)))

TABLES = tuple(Table("midforecast", name, operation, fields, wide=True, period_param="tmFc", slices=("region_code",),
                     asks={"region_code": "regId"}, span=between("tmFc"))
               for name, operation, fields in (("land", "getMidLandFcst", _LAND), ("temperature", "getMidTa", _TEMPERATURE)))
