"""Apartment contract tables. The contract date comes in three tokens and is put together
here, under a token of our own."""

from portalake.functions.parsers import deal_date
from portalake.schema import Table, between, parse_fields

# Vendor tokens, column names and kinds.
_PLACE = """
dealDate    deal_date           date_ymd  key
sggCd       region_code         text      key
umdNm       dong                text      key
jibun       jibun               text      key
aptNm       apt_name            text      key
excluUseAr  exclusive_area      decimal   key
floor       floor               int       key
buildYear   build_year          int
"""
_SALE = _PLACE + """
dealAmount        deal_amount_manwon  int
dealingGbn        dealing_type        text
buyerGbn          buyer_type          text
slerGbn           seller_type         text
cdealType         cancel_type         text
cdealDay          cancel_date         text
estateAgentSggNm  agent_region        text
"""
_TRADE = _SALE + """
aptDong           apt_dong            text
landLeaseholdGbn  land_leasehold      text
rgstDate          register_date       text
"""
_TRADE_DETAIL = _SALE + """
aptDong           apt_dong            text
aptSeq            apt_seq             text
bonbun            main_no             text
bubun             sub_no              text
landCd            land_code           text
landLeaseholdGbn  land_leasehold      text
umdCd             dong_code           text
rgstDate          register_date       text
roadNm            road_name           text
roadNmCd          road_code           text
roadNmBonbun      road_main_no        text
roadNmBubun       road_sub_no         text
roadNmSeq         road_seq            text
roadNmSggCd       road_region_code    text
roadNmbCd         road_basement_yn    text
"""
_PRESALE = _SALE + """
ownershipGbn      ownership_type      text
sggNm             region_name         text
"""
_RENT = _PLACE + """
deposit           deposit_manwon            int
monthlyRent       monthly_rent_manwon       int
contractType      contract_type             text
contractTerm      contract_term             text
preDeposit        prev_deposit_manwon       int
preMonthlyRent    prev_monthly_rent_manwon  int
useRRRight        renewal_right_used        text
aptSeq            apt_seq                   text
roadnm            road_name                 text
roadnmcd          road_code                 text
roadnmbonbun      road_main_no              text
roadnmbubun       road_sub_no               text
roadnmseq         road_seq                  text
roadnmsggcd       road_region_code          text
roadnmbcd         road_basement_yn          text
"""


def _table(name: str, operation: str, fields: str) -> Table:
    lines = "\n".join(line for line in fields.splitlines() if line.strip())
    return Table("realestate", name, f"{operation}/get{operation}", parse_fields(lines), wide=True,
                 monthly=True, slices=("region_code",),
                 asks={"region_code": "LAWD_CD"}, span=between("DEAL_YMD"),
                 derived={"dealDate": deal_date},
                 derived_from=("dealYear", "dealMonth", "dealDay"))


TABLES = (
    _table("apt_trade", "RTMSDataSvcAptTrade", _TRADE),
    _table("apt_trade_detail", "RTMSDataSvcAptTradeDev", _TRADE_DETAIL),
    _table("apt_rent", "RTMSDataSvcAptRent", _RENT),
    _table("apt_presale", "RTMSDataSvcSilvTrade", _PRESALE),
)
