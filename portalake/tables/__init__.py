"""The declared tables of all services."""

from portalake.schema import Table
from portalake.tables import (airquality, customs, holidays, kofia, midforecast, procurement,
                              realestate, weather)

TABLES: dict[str, Table] = {
    table.full_name: table
    for module in (weather, airquality, holidays, realestate, midforecast, procurement, customs,
                   kofia)
    for table in module.TABLES
}


def table(name: str | Table) -> Table:
    """A table by ``service.name``; one that is given, such as an ``exact`` one, as it is."""
    if isinstance(name, Table):
        return name
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}; one of {list(TABLES)}")
    return TABLES[name]
