"""Monthly trade by commodity code."""

from portalake.schema import Table, between, parse_fields

# Vendor tokens, column names and kinds.
_ITEM_TRADE = parse_fields("""
year         period            date_ym  key
hsCode       hs_code           text     key
statKor      item_name         text
expDlr       export_usd        int
expWgt       export_weight_kg  int
impDlr       import_usd        int
impWgt       import_weight_kg  int
balPayments  trade_balance_usd int
""")

TABLES = (Table("customs", "item_trade", "getItemtradeList", _ITEM_TRADE, span=between("strtYymm", "endYymm")),)
