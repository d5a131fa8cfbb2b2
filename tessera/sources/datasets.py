"""The lake's datasets with their types, and a named reader for each."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .lake import Dataset, Lake


def _schema(text: str) -> T.StructType:
    kinds = {"s": T.StringType(), "d": T.DoubleType(), "l": T.LongType(), "i": T.IntegerType(), "b": T.BooleanType(), "date": T.DateType(), "ts": T.TimestampType()}
    fields = (f.split(":") for f in text.split())
    return T.StructType([T.StructField(n, kinds[k]) for names, k in fields for n in names.split(",")])


#: Event streams by date (holdings also by fund), and tables that each pull replaces.
STREAMS = {
    "day_aggs": "ticker:s date:date open,high,low,close,volume:d transactions:l window_start_utc:ts",
    "tickers": "ticker,name,type,primary_exchange,currency_name,cik,composite_figi,share_class_figi:s active:b date:date",
    "ticker_details": "ticker,name,type,cik,composite_figi,share_class_figi,sic_code,sic_description,list_date,primary_exchange,currency_name:s active:b market_cap,share_class_shares_outstanding,weighted_shares_outstanding,total_employees,round_lot:d date:date",
    "short_volume": "ticker:s total_volume,short_volume,exempt_volume,short_volume_ratio:d date:date",
    "short_interest": "ticker:s date:date settlement_date:date short_interest,avg_daily_volume:l days_to_cover:d",
    "borrow": "date:date snapshot_at:ts symbol,ticker,currency,name,isin,composite_figi:s conid:l rebate_rate,fee_rate:d available:l available_capped:b",
    "etf_funds": "date:date issuer,fund,name,asset_class,sub_asset_class,market_type,region,country,benchmark:s inception_date:date expense_ratio,nav:d nav_date:date total_net_assets:d assets_date:date close_price,premium_discount:d cusip,isin,portfolio_id,product_url:s",
    "etf_holdings": "date:date fund,issuer:s position:i ticker,name,sector,asset_class:s market_value,weight,notional_value,quantity,price:d location,exchange,currency,market_currency:s fx_rate:d cusip,isin,sedol:s coupon:d maturity:date duration,ytm,fund_shares_outstanding:d",
}
TABLES = {
    "splits": "id,ticker:s execution_date:date split_from,split_to:d adjustment_type:s historical_adjustment_factor:d vendor_pull_date:date",
    "dividends": "id,ticker:s ex_dividend_date:date cash_amount,historical_adjustment_factor:d currency,distribution_type:s frequency:l vendor_pull_date:date",
    "fred_series": "series_id:s date:date value:d vendor_pull_date:date",
    "french_factors": "date:date mkt_rf,smb,hml,rmw,cma,mom,st_rev,lt_rev,rf:d crsp_month:s vendor_pull_date:date",
    "french_international": "file,series,column_name:s month:date value:d vendor_pull_date:date",
    "q_factors": "date:date r_f,r_mkt,r_me,r_ia,r_roe,r_eg:d vintage:s vendor_pull_date:date",
    "worldbank_commodities": "sheet,series,unit:s month:date value:d vendor_pull_date:date",
    "etf_nav_history": "fund:s date:date nav,shares_outstanding,total_net_assets:d vendor_pull_date:date",
    "sec_nport": "fund,series_id,accession:s filed,report_date:date cusip,isin,name,title:s balance:d units:s val_usd,pct_val:d asset_cat,issuer_cat,inv_country,payoff:s",
    "openfigi_cusips": "cusip,isin,share_class_figi,composite_figi,ticker,name,security_type:s mapped_on:date",
}

DATASETS = [Dataset(n, "date", _schema(s), merge=True, member="fund" if n == "etf_holdings" else None) for n, s in STREAMS.items()]
DATASETS += [Dataset(n, None, _schema(s)) for n, s in TABLES.items()]


def open_lake(spark, root: str) -> Lake:
    """A lake with all datasets registered."""
    return Lake(spark, root).register(*DATASETS)


def read(lake: Lake, name: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Any dataset by name: a range of an event stream, or a current table (which takes no range)."""
    if lake.datasets[name].key:
        return lake.series(name, start, end)
    if start or end:
        raise TypeError(f"{name} is a current table")
    return lake.current(name)


def tickers_on(lake: Lake, date: dt.date) -> DataFrame:
    return lake.on_date("tickers", date)
