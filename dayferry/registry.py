"""Which tables are synced, how their columns are renamed, and how far back each one goes."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dayferry.frames import small_frame

MIN_DAYS, MAX_DAYS = 1, 365

DAY = "day"  # the partition column of a target


@dataclass(frozen=True)
class ColumnSpec:
    source: str
    target: str
    type: str | None = None  # None keeps the type of the source


@dataclass(frozen=True)
class TableSpec:
    source_table: str
    target_table: str
    columns: tuple[ColumnSpec, ...]
    time_column: str  # by its source name
    default_days: int = 60
    zone: str | None = None  # whose days count, for times in UTC; None takes days as the times are stored

    def __post_init__(self):
        for side in ("source", "target"):
            names = [getattr(c, side).lower() for c in self.columns]
            if len(set(names)) != len(names):
                raise ValueError(f"{self.target_table}: duplicate {side} column names")
        if DAY in (c.target.lower() for c in self.columns):
            raise ValueError(f"{self.target_table}: target column name {DAY!r} is kept for the partition")
        if self.time_column not in self.source_columns:
            raise ValueError(f"{self.target_table}: time column {self.time_column!r} is not mapped")
        check_days(self.default_days)

    @property
    def source_columns(self) -> list[str]:
        return [c.source for c in self.columns]

    @property
    def target_columns(self) -> list[str]:
        return [c.target for c in self.columns]

    @property
    def target_time_column(self) -> str:
        return next(c.target for c in self.columns if c.source == self.time_column)

    def untyped(self) -> TableSpec:
        """The same table with every value copied as the source has it."""
        return replace(self, columns=tuple(replace(c, type=None) for c in self.columns))

    @property
    def lane(self) -> str:
        return f"{self.source_table}_{self.target_table}"

    def missing_columns(self, available: Iterable[str]) -> list[str]:
        """Mapped source columns that the input does not have."""
        have = {name.lower() for name in available}
        return [c for c in self.source_columns if c.lower() not in have]


def check_days(days: int) -> int:
    if isinstance(days, bool) or not isinstance(days, int) or not MIN_DAYS <= days <= MAX_DAYS:
        raise ValueError(f"days must be an integer in {MIN_DAYS}..{MAX_DAYS}, got {days!r}")
    return days


def window_days(spec: TableSpec, override: int | None = None) -> int:
    return spec.default_days if override is None else check_days(override)


def mapping(sources: Sequence[str], targets: Sequence[str], types: Sequence[str | None] | None = None):
    """Pair names by position; all lists must be of one length."""
    types = [None] * len(sources) if types is None else types
    return tuple(ColumnSpec(s, t, k) for s, t, k in zip(sources, targets, types, strict=True))


def _columns(*entries: tuple[str, str, str]) -> tuple[ColumnSpec, ...]:
    return tuple(ColumnSpec(*e) for e in entries)


# --- the shipped report tables ---------------------------------------------------------------

# Tables, default days, and (source, target) column names in projection order. The sources declare
# no types; the third entry proposes one, see ``TableSpec.untyped``.
REPORT_TABLES: tuple[TableSpec, ...] = (
    TableSpec("ods_Query", "ods_query", columns=_columns(
        ("Time", "time", "date"),
        ("Query", "query", "string"),
        ("Keyword Text", "keyword_text", "string"),
        ("Profile Name", "profile_name", "string"),
        ("Current Bid", "current_bid", "decimal(18,4)"),
        ("Campaign Name", "campaign_name", "string"),
        ("Adgroup", "adgroup", "string"),
        ("Impression", "impression", "bigint"),
        ("Impression.rank", "impression_rank", "double"),
        ("Impression.share", "impression_share", "double"),
        ("Click", "click", "bigint"),
        ("Spend", "spend", "decimal(18,4)"),
        ("CTR", "ctr", "double"),
        ("CPC", "cpc", "decimal(18,4)"),
        ("CVR 14d", "cvr14d", "double"),
        ("ACOS 14d", "acos14d", "double"),
        ("ROAS 14d", "roas14d", "double"),
        ("Order 14d", "order14d", "bigint"),
        ("Sale Units 14d", "sale_units14d", "bigint"),
        ("Sales 14d", "sales14d", "decimal(18,4)"),
        ("DPV 14天", "dpv14d", "bigint"),
        ("广告活动标签", "campaign_tag", "string"),
        ("活动类型", "activity_type", "string"),
    ), time_column="Time", default_days=24),
    TableSpec("ods_campain", "ods_campain", columns=_columns(
        ("Time", "time", "date"),
        ("Campaign Name", "campaign_name", "string"),
        ("Profile Name", "profile_name", "string"),
        ("Portfolio Name", "portfolio_name", "string"),
        ("Status", "status", "string"),
        ("Impression", "impression", "bigint"),
        ("Click", "click", "bigint"),
        ("Spend", "spend", "decimal(18,4)"),
        ("CTR", "ctr", "double"),
        ("CPC", "cpc", "decimal(18,4)"),
        ("CVR 14d", "cvr14d", "double"),
        ("ACOS 14d", "acos14d", "double"),
        ("ROAS 14d", "roas14d", "double"),
        ("Order 14d", "order14d", "bigint"),
        ("Sale Units 14d", "sale_units14d", "bigint"),
        ("Sales 14d", "sales14d", "decimal(18,4)"),
        ("Campaign Type", "campaign_type", "string"),
        ("Campaign Tag", "campaign_tag", "string"),
        ("DPV 14天", "dpv14d", "bigint"),
        ("活动Id", "campaign_id", "string"),
    ), time_column="Time", default_days=60),
    TableSpec("ods_campaign_dsp", "ods_campaign_dsp", columns=_columns(
        ("TimeColumn", "time_column", "date"),
        ("IntervalStart", "interval_start", "timestamp_ntz"),
        ("IntervalEnd", "interval_end", "timestamp_ntz"),
        ("EntityName", "entity_name", "string"),
        ("EntityId", "entity_id", "string"),
        ("AdvertiserName", "advertiser_name", "string"),
        ("AdvertiserId", "advertiser_id", "string"),
        ("CountryCode", "country_code", "string"),
        ("OrderName", "order_name", "string"),
        ("OrderId", "order_id", "string"),
        ("LineItemName", "line_item_name", "string"),
        ("LineItemId", "line_item_id", "string"),
        ("LineItemType", "line_item_type", "string"),
        ("CreativeName", "creative_name", "string"),
        ("CreativeId", "creative_id", "string"),
        ("CreativeSize", "creative_size", "string"),
        ("Creative Tag", "creative_tag", "string"),
        ("Lineitem Tag", "line_item_tag", "string"),
        ("Order Tag", "order_tag", "string"),
        ("TotalCost", "total_cost", "decimal(18,4)"),
        ("Impressions", "impressions", "bigint"),
        ("ClickThroughs", "click_throughs", "bigint"),
        ("CTR", "ctr", "double"),
        ("ATC", "atc", "bigint"),
        ("Purchases", "purchases", "bigint"),
        ("PercentOfPurchasesNewToBrand", "percent_of_purchases_new_to_brand", "double"),
        ("ConversionRate", "conversion_rate", "double"),
        ("eCPM", "ecpm", "decimal(18,4)"),
        ("eCPC", "ecpc", "decimal(18,4)"),
        ("DPV", "dpv", "bigint"),
        ("DPVR", "dpvr", "double"),
        ("eCPDPV", "ecpdpv", "decimal(18,4)"),
        ("ATCR", "atcr", "double"),
        ("PurchaseRate", "purchase_rate", "double"),
        ("eCPP", "ecpp", "decimal(18,4)"),
        ("NewToBrandPurchases", "new_to_brand_purchases", "bigint"),
        ("NewToBrandeCPP", "new_to_brande_cpp", "decimal(18,4)"),
        ("eCPATC", "ecpatc", "decimal(18,4)"),
        ("UnitsSold", "units_sold", "bigint"),
        ("TotalSales", "total_sales", "decimal(18,4)"),
        ("SalesUSD", "sales_usd", "decimal(18,4)"),
        ("ProductSales", "product_sales", "decimal(18,4)"),
        ("ROAS", "roas", "double"),
        ("TotalROAS", "total_roas", "double"),
        ("TotalATC", "total_atc", "bigint"),
        ("TotalUnitsSold", "total_units_sold", "bigint"),
        ("TotalDPV", "total_dpv", "bigint"),
        ("TotalDPVR", "total_dpvr", "double"),
        ("TotalPurchases", "total_purchases", "bigint"),
        ("TotalPurchaseRate", "total_purchase_rate", "double"),
        ("TotaleCPP", "total_ecpp", "decimal(18,4)"),
        ("TotalNewToBrandPurchases", "total_new_to_brand_purchases", "bigint"),
        ("TotalPercentOfPurchasesNewToBrand", "total_percent_of_purchases_new_to_brand", "double"),
        ("TotalProductSales", "total_product_sales", "decimal(18,4)"),
        ("TotalNewToBrandUnitsSold", "total_new_to_brand_units_sold", "bigint"),
        ("TotalNewToBrandProductSales", "total_new_to_brand_product_sales", "decimal(18,4)"),
        ("TotalNewToBrandROAS", "total_new_to_brand_roas", "double"),
        ("TotalSnSS", "total_sn_ss", "bigint"),
        ("TotalSnSSRate", "total_sn_ss_rate", "double"),
        ("TotalNewToBrandeCPP", "total_new_to_brande_cpp", "decimal(18,4)"),
        ("TotalNewToBrandPurchaseRate", "total_new_to_brand_purchase_rate", "double"),
        ("NTB Sales", "ntb_sales", "decimal(18,4)"),
        ("T-Pixel", "tpixel", "bigint"),
        ("T-Pixel CPA", "tpixel_cpa", "decimal(18,4)"),
        ("T-Pixel CVR", "tpixel_cvr", "double"),
        ("SnSSR", "sn_ssr", "double"),
        ("NTBROAS", "ntbroas", "double"),
        ("ExchangeCode", "exchange_code", "string"),
        ("Video Start", "video_start", "bigint"),
        ("Video Complete", "video_complete", "bigint"),
        ("PurchaseButton", "purchase_button", "bigint"),
        ("PurchaseButtonCPA", "purchase_button_cpa", "decimal(18,4)"),
        ("PurchaseButtonCVR", "purchase_button_cvr", "double"),
        ("OffAmazonPurchases", "off_amazon_purchases", "bigint"),
        ("OffAmazonConversions", "off_amazon_conversions", "bigint"),
        ("OffAmazonCVR", "Off_Amazon_CVR", "double"),
        ("OffAmazonCPA", "off_amazon_cpa", "decimal(18,4)"),
        ("OffAmazonProductSales", "off_amazon_product_sales", "decimal(18,4)"),
        ("OffAmazonUnitsSold", "off_amazon_units_sold", "bigint"),
        ("OffAmazonROAS", "off_amazon_roas", "double"),
        ("OffAmazoneRPM", "off_amazon_erpm", "decimal(18,4)"),
        ("OffAmazonPurchasesRate", "off_amazon_purchases_rate", "double"),
        ("OffAmazoneCPP", "off_amazone_cpp", "decimal(18,4)"),
        ("CombinedPurchasesRate", "combined_purchases_rate", "double"),
        ("CombinedeCPP", "combinede_cpp", "decimal(18,4)"),
        ("CombinedROAS", "combined_roas", "double"),
        ("CombinedeRPM", "combined_erpm", "decimal(18,4)"),
        ("CombinedPurchases", "combined_purchases", "bigint"),
        ("CombinedUnitsSold", "combined_units_sold", "bigint"),
        ("CombinedProductSales", "combined_product_sales", "decimal(18,4)"),
        ("BrandSearch", "brand_search", "bigint"),
        ("BrandSearchsRate", "brand_searchs_rate", "double"),
        ("eCP Branded Search", "ecp_branded_search", "decimal(18,4)"),
        ("Original Currency", "original_currency", "string"),
        ("Exchange Rate", "exchange_rate", "double"),
        ("ATSC", "atsc", "bigint"),
        ("ATSC CVR", "atsc_cvr", "double"),
        ("ATSC CPA", "atsc_cpa", "decimal(18,4)"),
        ("ATSC value sum", "atsc_value_sum", "decimal(18,4)"),
        ("ATSC value average", "atsc_value_average", "decimal(18,4)"),
        ("Checkout", "checkout", "bigint"),
        ("Checkout CVR", "checkout_cvr", "double"),
        ("Checkout CPA", "checkout_cpa", "decimal(18,4)"),
        ("Checkout value sum", "checkout_value_sum", "decimal(18,4)"),
        ("Checkout value average", "checkout_value_average", "decimal(18,4)"),
        ("PageView", "pageview", "bigint"),
        ("PageView CVR", "pageview_cvr", "double"),
        ("PageView CPA", "pageview_cpa", "decimal(18,4)"),
        ("PageView value sum", "pageview_value_sum", "decimal(18,4)"),
        ("PageView value average", "pageview_value_average", "decimal(18,4)"),
        ("SignUp", "sign_up", "bigint"),
        ("SignUp CVR", "sign_up_cvr", "double"),
        ("SignUp CPA", "sign_up_cpa", "decimal(18,4)"),
        ("SignUp value sum", "sign_up_value_sum", "decimal(18,4)"),
        ("SignUp value average", "sign_up_value_average", "decimal(18,4)"),
        ("Application", "application", "bigint"),
        ("Application CVR", "application_cvr", "double"),
        ("Application CPA", "application_cpa", "decimal(18,4)"),
        ("Application value sum", "application_value_sum", "decimal(18,4)"),
        ("Application value average", "application_value_average", "decimal(18,4)"),
        ("Contact", "contact", "bigint"),
        ("Contact CVR", "contact_cvr", "double"),
        ("Contact CPA", "contact_cpa", "decimal(18,4)"),
        ("Contact value sum", "contact_value_sum", "decimal(18,4)"),
        ("Contact value average", "contact_value_average", "decimal(18,4)"),
        ("Lead", "lead", "bigint"),
        ("Lead CVR", "lead_cvr", "double"),
        ("Lead CPA", "lead_cpa", "decimal(18,4)"),
        ("Lead value sum", "lead_value_sum", "decimal(18,4)"),
        ("Lead value average", "lead_value_average", "decimal(18,4)"),
        ("Search CVR", "search_cvr", "double"),
        ("Search CPA", "search_cpa", "decimal(18,4)"),
        ("Search value sum", "search_value_sum", "decimal(18,4)"),
        ("Search", "search", "bigint"),
        ("Search value average", "search_value_average", "decimal(18,4)"),
        ("TotaleCPDPV", "totale_cpdpv", "decimal(18,4)"),
        ("TotaleCPATC", "totale_cpatc", "decimal(18,4)"),
    ), time_column="TimeColumn", default_days=60),
    TableSpec("ods_aws_asin_philips", "ods_aws_asin_philips", columns=_columns(
        ("Time", "time", "date"),
        ("ASIN", "ASIN", "string"),
        ("Profile_Name", "profile_name", "string"),
        ("SKU", "sku", "string"),
        ("Title", "title", "string"),
        ("Brand", "brand", "string"),
        ("Image_Url", "image_url", "string"),
        ("Impression", "impression", "bigint"),
        ("Click", "click", "bigint"),
        ("Spend", "spend", "decimal(18,4)"),
        ("CTR", "ctr", "double"),
        ("CPC", "cpc", "decimal(18,4)"),
        ("CVR_14d", "cvr14d", "double"),
        ("ACOS_14d", "acos14d", "double"),
        ("ROAS_14d", "roas14d", "double"),
        ("Order_14d", "order14d", "bigint"),
        ("Sale_Units_14d", "sale_units14d", "bigint"),
        ("Sales_14d", "sales14d", "decimal(18,4)"),
        ("ASIN_Tag", "asin_tag", "string"),
        ("Status", "status", "string"),
        ("Profile_Id", "profile_id", "string"),
        ("Philips_ALL", "philips_all", "string"),
        ("CVR_1d", "cvr1d", "double"),
        ("CVR_7d", "cvr7d", "double"),
        ("CVR_30d", "cvr30d", "double"),
        ("ACOS_1d", "acos1d", "double"),
        ("ACOS_7d", "acos7d", "double"),
        ("ACOS_30d", "acos30d", "double"),
        ("ROAS_1d", "roas1d", "double"),
        ("ROAS_7d", "roas7d", "double"),
        ("ROAS_30d", "roas30d", "double"),
        ("CPA_1d", "cpa1d", "decimal(18,4)"),
        ("CPA_7d", "cpa7d", "decimal(18,4)"),
        ("CPA_14d", "cpa14d", "decimal(18,4)"),
        ("CPA_30d", "cpa30d", "decimal(18,4)"),
        ("Order_1d", "order1d", "bigint"),
        ("Order_7d", "order7d", "bigint"),
        ("Order_30d", "order30d", "bigint"),
        ("Sale_Units_1d", "sale_units1d", "bigint"),
        ("Sale_Units_7d", "sale_units7d", "bigint"),
        ("Sale_Units_30d", "sale_units30d", "bigint"),
        ("Sales_1d", "sales1d", "decimal(18,4)"),
        ("Sales_7d", "sales7d", "decimal(18,4)"),
        ("Sales_30d", "sales30d", "decimal(18,4)"),
        ("Orders_NTB_14d", "orders_ntb14d", "bigint"),
        ("Orders_NTB_Percentage_14d", "orders_ntb_percentage14d", "double"),
        ("Order_Rate_NTB_14d", "order_rate_ntb14d", "double"),
        ("Sales_NTB_14d", "sales_ntb14d", "decimal(18,4)"),
        ("Sales_NTB_Percentage_14d", "sales_ntb_percentage14d", "double"),
        ("Units_Ordered_NTB_14d", "units_ordered_ntb14d", "bigint"),
        ("SameSKU_Sales_1d", "same_sku_sales1d", "decimal(18,4)"),
        ("SameSKU_Sales_7d", "same_sku_sales7d", "decimal(18,4)"),
        ("SameSKU_Sales_14d", "same_sku_sales14d", "decimal(18,4)"),
        ("SameSKU_Sales_30d", "same_sku_sales30d", "decimal(18,4)"),
        ("SameSKU_Orders_1d", "same_sku_orders1d", "bigint"),
        ("SameSKU_Orders_7d", "same_sku_orders7d", "bigint"),
        ("SameSKU_Orders_14d", "same_sku_orders14d", "bigint"),
        ("SameSKU_Orders_30d", "same_sku_orders30d", "bigint"),
        ("SameSKU_Sale_Units_1d", "same_sku_sale_units1d", "bigint"),
        ("SameSKU_Sale_Units_7d", "same_sku_sale_units7d", "bigint"),
        ("SameSKU_Sale_Units_14d", "same_sku_sale_units14d", "bigint"),
        ("SameSKU_Sale_Units_30d", "same_sku_sale_units30d", "bigint"),
        ("Other_Sales_1d", "other_sales1d", "decimal(18,4)"),
        ("Other_Sales_7d", "other_sales7d", "decimal(18,4)"),
        ("Other_Sales_14d", "other_sales14d", "decimal(18,4)"),
        ("Other_Sales_30d", "other_sales30d", "decimal(18,4)"),
        ("Kindle_Pages_Read_14d", "kindle_pages_read14d", "bigint"),
        ("Kindle_Pages_Royalties_14d", "kindle_pages_royalties14d", "decimal(18,4)"),
    ), time_column="Time", default_days=60),
)


# --- the registry as frames ----------------------------------------------------------------

REGISTRY_SCHEMA = T.StructType([
    T.StructField("source_table", T.StringType()),
    T.StructField("target_table", T.StringType()),
    T.StructField("table_index", T.LongType()),
    T.StructField("default_days", T.LongType()),
    T.StructField("lane", T.StringType()),
])

MAPPING_SCHEMA = T.StructType([
    T.StructField("target_table", T.StringType()),
    T.StructField("position", T.LongType()),
    T.StructField("source_column", T.StringType()),
    T.StructField("target_column", T.StringType()),
    T.StructField("proposed_type", T.StringType()),
])


def select_tables(registry: Sequence[TableSpec], tables: Sequence[str] | None = None) -> list[TableSpec]:
    """The named target tables in registry order; nothing named means all."""
    if not tables:
        return list(registry)
    unknown = set(tables) - {s.target_table for s in registry}
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    return [s for s in registry if s.target_table in set(tables)]


def registry_frame(spark: SparkSession, registry: Sequence[TableSpec]) -> DataFrame:
    rows = [
        {
            "source_table": s.source_table,
            "target_table": s.target_table,
            "table_index": i,
            "default_days": s.default_days,
            "lane": s.lane,
        }
        for i, s in enumerate(registry)
    ]
    return small_frame(spark, rows, REGISTRY_SCHEMA)


def mapping_frame(spark: SparkSession, registry: Sequence[TableSpec]) -> DataFrame:
    rows = [
        {
            "target_table": s.target_table,
            "position": i,
            "source_column": c.source,
            "target_column": c.target,
            "proposed_type": c.type,
        }
        for s in registry
        for i, c in enumerate(s.columns)
    ]
    return small_frame(spark, rows, MAPPING_SCHEMA)
