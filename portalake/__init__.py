"""Landed public-data API responses as typed Spark tables."""

from types import ModuleType

from portalake.functions.announcements import latest_announcement
from portalake.functions.grid import grid_cell
from portalake.operators.audit import complete_only, in_order, page_audit, refused
from portalake.operators.clean import clean, project, rejects
from portalake.operators.merge import latest_by_key, replace_periods, upsert_by_key, with_row_id
from portalake.operators.places import (districts_from_legal_codes, land_zones, resolve_land_zone,
                                        resolve_named, resolve_region, resolve_temp_city)
from portalake.plans.datasets import (empty_fetches, fetch, generic_rows, refresh_table,
                                      refused_fetches, rejected_rows, select_rows, typed_rows, vendor_rows)
from portalake.schema import Field, Table
from portalake.session import discard, settle, tune
from portalake.sinks.tables import (replace_table, rows_to_json, upsert_table, write_json,
                                    write_table)
from portalake.sources.captures import (CAPTURE_SCHEMA, read_bodies, read_captures, with_records,
                                        write_captures)
from portalake.sources.envelope import parse_pages, raw_rows, stage_pages
from portalake.sources.pages import layer_pages, update_pages
from portalake.tables import TABLES, table

__all__ = [name for name, value in list(globals().items())
           if not name.startswith("_") and not isinstance(value, ModuleType)]
