"""Financial market statistics, daily and monthly."""

from portalake.schema import Table, between, parse_fields

# Vendor tokens, column names and kinds.
_MARKET_FUNDS = """
basDt                     base_date                       date_ymd  key
invrDpsgAmt               investor_deposit                int
onbdDrvPrdTrRcAdvAmt      derivatives_deposit             int
toCstRpchCndBndSlgBal     customer_rp_sale_balance        int
brkTrdUcolMny             brokerage_receivable            int
brkTrdUcolMnyVsOppsTrdAmt forced_sell_amount              int
ucolMnyVsOppsTrdRlImpt    forced_sell_to_receivable_ratio ratio
"""
_CREDIT_BALANCE = """
basDt            base_date            date_ymd  key
crdTrFingWhl     margin_loan_total    int
crdTrFingScrs    margin_loan_kospi    int
crdTrFingKosdaq  margin_loan_kosdaq   int
crdTrLndrWhl     stock_loan_total     int
crdTrLndrScrs    stock_loan_kospi     int
crdTrLndrKosdaq  stock_loan_kosdaq    int
sbscCapLn        subscription_loan    int
dpsgScrtMogFing  collateral_loan      int
"""
_FUND_NET_ASSET = """
basDt       base_date        date_ymd  key
ctg         fund_type        text      key
tstMthdCtg  offering_type    text      key
nPptTotAmt  net_asset_total  int
"""
_CMA_STATUS = """
basDt        base_date              date_ymd  key
mngInvTgt    management_target      text      key
invrCtg      investor_type          text      key
scrtCmpyCnt  securities_firm_count  int
actCnt       account_count          int
actBal       account_balance        int
"""
_DLS_DLB = """
basDt         base_ym        date_ym  key
ctgDlbDls     product_type   text     key
ctgPrplcPsub  offering_type  text     key
presCtg       status_type    text     key
amt           amount_krw     int
ccnt          deal_count     int
"""
_ELS_ELB = """
basDt         base_ym        date_ym  key
ctgElbEls     product_type   text     key
ctgPrplcPsub  offering_type  text     key
presCtg       status_type    text     key
amt           amount_krw     int
ccnt          deal_count     int
"""
_TRUST_SCALE = """
basYm   base_ym        date_ym  key
bzds    sector         text     key
tstCtg  trust_type     text     key
kind    trust_kind     text     key
iqBs    measure_basis  text     key
val     measure_value  int
"""
_OVERSEAS_DERIVATIVES = """
basDt            base_ym                 date_ym  key
byPrdGrp         product_group           text     key
actCtg           account_type            text     key
ctgBsonCntrForm  contract_form           text     key
prdNm            product_name            text     key
brkPn            customer_type           text     key
xchNm            exchange                text     key
csfBsonCntrForm  contract_class          text     key
byNtnl           country                 text     key
prdGrp           underlying_asset_group  text     key
trqu             trade_volume            int
trPrcUsd         trade_value_usd         int
"""


def _table(name: str, operation: str, fields: str, wide: bool = False) -> Table:
    columns = parse_fields(fields)
    # The date's own token names the bounds.
    token = next(f.token for f in columns if f.is_date)
    token = token[0].upper() + token[1:]
    return Table("kofia", name, operation, columns, wide=wide, fmt="json", span=between(f"begin{token}", f"end{token}"))


TABLES = (
    _table("market_funds", "getSecuritiesMarketTotalCapitalInfo", _MARKET_FUNDS),
    _table("credit_balance", "getGrantingOfCreditBalanceInfo", _CREDIT_BALANCE),
    _table("fund_net_asset", "getFundTotalNetEssetInfo", _FUND_NET_ASSET),
    _table("cma_status", "getCMAStatus", _CMA_STATUS),
    _table("dls_dlb", "getDLSAndDLBInfo", _DLS_DLB),
    _table("els_elb", "getELSAndELBInfo", _ELS_ELB),
    _table("trust_scale", "getTrustScaleInfo", _TRUST_SCALE),
    _table("overseas_derivatives", "getDerivationProductTradingInfo", _OVERSEAS_DERIVATIVES,
           wide=True),
)
