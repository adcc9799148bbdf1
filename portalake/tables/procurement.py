"""Public bid notices: one shape, four kinds of contract."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from portalake.schema import Table, parse_fields

# Vendor tokens, column names and kinds.
_BID = parse_fields("""
bidNtceNo          notice_no            text  key
bidNtceOrd         notice_ord           text  key
bidNtceNm          notice_name          text
ntceKindNm         notice_kind          text
ntceInsttNm        notice_agency        text
dminsttNm          demand_agency        text
bidMethdNm         bid_method           text
cntrctCnclsMthdNm  contract_method      text
bidNtceDt          notice_at            text
bidClseDt          bid_close_at         text
opengDt            opening_at           text
presmptPrce        estimated_price_krw  int
asignBdgtAmt       budget_amount_krw    int
ntceInsttOfclNm    officer_name         text
bidNtceDtlUrl      notice_url           text
rgstDt             registered_at        text
""")

_OPERATIONS = {
    "goods": "getBidPblancListInfoThngPPSSrch",
    "services": "getBidPblancListInfoServcPPSSrch",
    "construction": "getBidPblancListInfoCnstwkPPSSrch",
    "foreign": "getBidPblancListInfoFrgcptPPSSrch",
}



def _noticed(params: Column) -> tuple[Column, Column]:
    """The window asked for, if it is one of notices and not of openings."""
    by_notice = params["inqryDiv"] == "1"
    return F.when(by_notice, params["inqryBgnDt"]), F.when(by_notice, params["inqryEndDt"])


TABLES = tuple(Table("procurement", name, op, _BID, wide=True, period_column="notice_at",
                     slices=("notice_no", "notice_ord"), span=_noticed) for name, op in _OPERATIONS.items())
