"""The shipped mappings as they have to be, for the oracle alone: written out, not taken from the registry."""

# Target table, source column, target column, proposed type, in order.
EXPECTED = """
ods_query|Time|time|date
ods_query|Query|query|string
ods_query|Keyword Text|keyword_text|string
ods_query|Profile Name|profile_name|string
ods_query|Current Bid|current_bid|decimal(18,4)
ods_query|Campaign Name|campaign_name|string
ods_query|Adgroup|adgroup|string
ods_query|Impression|impression|bigint
ods_query|Impression.rank|impression_rank|double
ods_query|Impression.share|impression_share|double
ods_query|Click|click|bigint
ods_query|Spend|spend|decimal(18,4)
ods_query|CTR|ctr|double
ods_query|CPC|cpc|decimal(18,4)
ods_query|CVR 14d|cvr14d|double
ods_query|ACOS 14d|acos14d|double
ods_query|ROAS 14d|roas14d|double
ods_query|Order 14d|order14d|bigint
ods_query|Sale Units 14d|sale_units14d|bigint
ods_query|Sales 14d|sales14d|decimal(18,4)
ods_query|DPV 14天|dpv14d|bigint
ods_query|广告活动标签|campaign_tag|string
ods_query|活动类型|activity_type|string
ods_campain|Time|time|date
ods_campain|Campaign Name|campaign_name|string
ods_campain|Profile Name|profile_name|string
ods_campain|Portfolio Name|portfolio_name|string
ods_campain|Status|status|string
ods_campain|Impression|impression|bigint
ods_campain|Click|click|bigint
ods_campain|Spend|spend|decimal(18,4)
ods_campain|CTR|ctr|double
ods_campain|CPC|cpc|decimal(18,4)
ods_campain|CVR 14d|cvr14d|double
ods_campain|ACOS 14d|acos14d|double
ods_campain|ROAS 14d|roas14d|double
ods_campain|Order 14d|order14d|bigint
ods_campain|Sale Units 14d|sale_units14d|bigint
ods_campain|Sales 14d|sales14d|decimal(18,4)
ods_campain|Campaign Type|campaign_type|string
ods_campain|Campaign Tag|campaign_tag|string
ods_campain|DPV 14天|dpv14d|bigint
ods_campain|活动Id|campaign_id|string
ods_campaign_dsp|TimeColumn|time_column|date
ods_campaign_dsp|IntervalStart|interval_start|timestamp_ntz
ods_campaign_dsp|IntervalEnd|interval_end|timestamp_ntz
ods_campaign_dsp|EntityName|entity_name|string
ods_campaign_dsp|EntityId|entity_id|string
ods_campaign_dsp|AdvertiserName|advertiser_name|string
ods_campaign_dsp|AdvertiserId|advertiser_id|string
ods_campaign_dsp|CountryCode|country_code|string
ods_campaign_dsp|OrderName|order_name|string
ods_campaign_dsp|OrderId|order_id|string
ods_campaign_dsp|LineItemName|line_item_name|string
ods_campaign_dsp|LineItemId|line_item_id|string
ods_campaign_dsp|LineItemType|line_item_type|string
ods_campaign_dsp|CreativeName|creative_name|string
ods_campaign_dsp|CreativeId|creative_id|string
ods_campaign_dsp|CreativeSize|creative_size|string
ods_campaign_dsp|Creative Tag|creative_tag|string
ods_campaign_dsp|Lineitem Tag|line_item_tag|string
ods_campaign_dsp|Order Tag|order_tag|string
ods_campaign_dsp|TotalCost|total_cost|decimal(18,4)
ods_campaign_dsp|Impressions|impressions|bigint
ods_campaign_dsp|ClickThroughs|click_throughs|bigint
ods_campaign_dsp|CTR|ctr|double
ods_campaign_dsp|ATC|atc|bigint
ods_campaign_dsp|Purchases|purchases|bigint
ods_campaign_dsp|PercentOfPurchasesNewToBrand|percent_of_purchases_new_to_brand|double
ods_campaign_dsp|ConversionRate|conversion_rate|double
ods_campaign_dsp|eCPM|ecpm|decimal(18,4)
ods_campaign_dsp|eCPC|ecpc|decimal(18,4)
ods_campaign_dsp|DPV|dpv|bigint
ods_campaign_dsp|DPVR|dpvr|double
ods_campaign_dsp|eCPDPV|ecpdpv|decimal(18,4)
ods_campaign_dsp|ATCR|atcr|double
ods_campaign_dsp|PurchaseRate|purchase_rate|double
ods_campaign_dsp|eCPP|ecpp|decimal(18,4)
ods_campaign_dsp|NewToBrandPurchases|new_to_brand_purchases|bigint
ods_campaign_dsp|NewToBrandeCPP|new_to_brande_cpp|decimal(18,4)
ods_campaign_dsp|eCPATC|ecpatc|decimal(18,4)
ods_campaign_dsp|UnitsSold|units_sold|bigint
ods_campaign_dsp|TotalSales|total_sales|decimal(18,4)
ods_campaign_dsp|SalesUSD|sales_usd|decimal(18,4)
ods_campaign_dsp|ProductSales|product_sales|decimal(18,4)
ods_campaign_dsp|ROAS|roas|double
ods_campaign_dsp|TotalROAS|total_roas|double
ods_campaign_dsp|TotalATC|total_atc|bigint
ods_campaign_dsp|TotalUnitsSold|total_units_sold|bigint
ods_campaign_dsp|TotalDPV|total_dpv|bigint
ods_campaign_dsp|TotalDPVR|total_dpvr|double
ods_campaign_dsp|TotalPurchases|total_purchases|bigint
ods_campaign_dsp|TotalPurchaseRate|total_purchase_rate|double
ods_campaign_dsp|TotaleCPP|total_ecpp|decimal(18,4)
ods_campaign_dsp|TotalNewToBrandPurchases|total_new_to_brand_purchases|bigint
ods_campaign_dsp|TotalPercentOfPurchasesNewToBrand|total_percent_of_purchases_new_to_brand|double
ods_campaign_dsp|TotalProductSales|total_product_sales|decimal(18,4)
ods_campaign_dsp|TotalNewToBrandUnitsSold|total_new_to_brand_units_sold|bigint
ods_campaign_dsp|TotalNewToBrandProductSales|total_new_to_brand_product_sales|decimal(18,4)
ods_campaign_dsp|TotalNewToBrandROAS|total_new_to_brand_roas|double
ods_campaign_dsp|TotalSnSS|total_sn_ss|bigint
ods_campaign_dsp|TotalSnSSRate|total_sn_ss_rate|double
ods_campaign_dsp|TotalNewToBrandeCPP|total_new_to_brande_cpp|decimal(18,4)
ods_campaign_dsp|TotalNewToBrandPurchaseRate|total_new_to_brand_purchase_rate|double
ods_campaign_dsp|NTB Sales|ntb_sales|decimal(18,4)
ods_campaign_dsp|T-Pixel|tpixel|bigint
ods_campaign_dsp|T-Pixel CPA|tpixel_cpa|decimal(18,4)
ods_campaign_dsp|T-Pixel CVR|tpixel_cvr|double
ods_campaign_dsp|SnSSR|sn_ssr|double
ods_campaign_dsp|NTBROAS|ntbroas|double
ods_campaign_dsp|ExchangeCode|exchange_code|string
ods_campaign_dsp|Video Start|video_start|bigint
ods_campaign_dsp|Video Complete|video_complete|bigint
ods_campaign_dsp|PurchaseButton|purchase_button|bigint
ods_campaign_dsp|PurchaseButtonCPA|purchase_button_cpa|decimal(18,4)
ods_campaign_dsp|PurchaseButtonCVR|purchase_button_cvr|double
ods_campaign_dsp|OffAmazonPurchases|off_amazon_purchases|bigint
ods_campaign_dsp|OffAmazonConversions|off_amazon_conversions|bigint
ods_campaign_dsp|OffAmazonCVR|Off_Amazon_CVR|double
ods_campaign_dsp|OffAmazonCPA|off_amazon_cpa|decimal(18,4)
ods_campaign_dsp|OffAmazonProductSales|off_amazon_product_sales|decimal(18,4)
ods_campaign_dsp|OffAmazonUnitsSold|off_amazon_units_sold|bigint
ods_campaign_dsp|OffAmazonROAS|off_amazon_roas|double
ods_campaign_dsp|OffAmazoneRPM|off_amazon_erpm|decimal(18,4)
ods_campaign_dsp|OffAmazonPurchasesRate|off_amazon_purchases_rate|double
ods_campaign_dsp|OffAmazoneCPP|off_amazone_cpp|decimal(18,4)
ods_campaign_dsp|CombinedPurchasesRate|combined_purchases_rate|double
ods_campaign_dsp|CombinedeCPP|combinede_cpp|decimal(18,4)
ods_campaign_dsp|CombinedROAS|combined_roas|double
ods_campaign_dsp|CombinedeRPM|combined_erpm|decimal(18,4)
ods_campaign_dsp|CombinedPurchases|combined_purchases|bigint
ods_campaign_dsp|CombinedUnitsSold|combined_units_sold|bigint
ods_campaign_dsp|CombinedProductSales|combined_product_sales|decimal(18,4)
ods_campaign_dsp|BrandSearch|brand_search|bigint
ods_campaign_dsp|BrandSearchsRate|brand_searchs_rate|double
ods_campaign_dsp|eCP Branded Search|ecp_branded_search|decimal(18,4)
ods_campaign_dsp|Original Currency|original_currency|string
ods_campaign_dsp|Exchange Rate|exchange_rate|double
ods_campaign_dsp|ATSC|atsc|bigint
ods_campaign_dsp|ATSC CVR|atsc_cvr|double
ods_campaign_dsp|ATSC CPA|atsc_cpa|decimal(18,4)
ods_campaign_dsp|ATSC value sum|atsc_value_sum|decimal(18,4)
ods_campaign_dsp|ATSC value average|atsc_value_average|decimal(18,4)
ods_campaign_dsp|Checkout|checkout|bigint
ods_campaign_dsp|Checkout CVR|checkout_cvr|double
ods_campaign_dsp|Checkout CPA|checkout_cpa|decimal(18,4)
ods_campaign_dsp|Checkout value sum|checkout_value_sum|decimal(18,4)
ods_campaign_dsp|Checkout value average|checkout_value_average|decimal(18,4)
ods_campaign_dsp|PageView|pageview|bigint
ods_campaign_dsp|PageView CVR|pageview_cvr|double
ods_campaign_dsp|PageView CPA|pageview_cpa|decimal(18,4)
ods_campaign_dsp|PageView value sum|pageview_value_sum|decimal(18,4)
ods_campaign_dsp|PageView value average|pageview_value_average|decimal(18,4)
ods_campaign_dsp|SignUp|sign_up|bigint
ods_campaign_dsp|SignUp CVR|sign_up_cvr|double
ods_campaign_dsp|SignUp CPA|sign_up_cpa|decimal(18,4)
ods_campaign_dsp|SignUp value sum|sign_up_value_sum|decimal(18,4)
ods_campaign_dsp|SignUp value average|sign_up_value_average|decimal(18,4)
ods_campaign_dsp|Application|application|bigint
ods_campaign_dsp|Application CVR|application_cvr|double
ods_campaign_dsp|Application CPA|application_cpa|decimal(18,4)
ods_campaign_dsp|Application value sum|application_value_sum|decimal(18,4)
ods_campaign_dsp|Application value average|application_value_average|decimal(18,4)
ods_campaign_dsp|Contact|contact|bigint
ods_campaign_dsp|Contact CVR|contact_cvr|double
ods_campaign_dsp|Contact CPA|contact_cpa|decimal(18,4)
ods_campaign_dsp|Contact value sum|contact_value_sum|decimal(18,4)
ods_campaign_dsp|Contact value average|contact_value_average|decimal(18,4)
ods_campaign_dsp|Lead|lead|bigint
ods_campaign_dsp|Lead CVR|lead_cvr|double
ods_campaign_dsp|Lead CPA|lead_cpa|decimal(18,4)
ods_campaign_dsp|Lead value sum|lead_value_sum|decimal(18,4)
ods_campaign_dsp|Lead value average|lead_value_average|decimal(18,4)
ods_campaign_dsp|Search CVR|search_cvr|double
ods_campaign_dsp|Search CPA|search_cpa|decimal(18,4)
ods_campaign_dsp|Search value sum|search_value_sum|decimal(18,4)
ods_campaign_dsp|Search|search|bigint
ods_campaign_dsp|Search value average|search_value_average|decimal(18,4)
ods_campaign_dsp|TotaleCPDPV|totale_cpdpv|decimal(18,4)
ods_campaign_dsp|TotaleCPATC|totale_cpatc|decimal(18,4)
ods_aws_asin_philips|Time|time|date
ods_aws_asin_philips|ASIN|ASIN|string
ods_aws_asin_philips|Profile_Name|profile_name|string
ods_aws_asin_philips|SKU|sku|string
ods_aws_asin_philips|Title|title|string
ods_aws_asin_philips|Brand|brand|string
ods_aws_asin_philips|Image_Url|image_url|string
ods_aws_asin_philips|Impression|impression|bigint
ods_aws_asin_philips|Click|click|bigint
ods_aws_asin_philips|Spend|spend|decimal(18,4)
ods_aws_asin_philips|CTR|ctr|double
ods_aws_asin_philips|CPC|cpc|decimal(18,4)
ods_aws_asin_philips|CVR_14d|cvr14d|double
ods_aws_asin_philips|ACOS_14d|acos14d|double
ods_aws_asin_philips|ROAS_14d|roas14d|double
ods_aws_asin_philips|Order_14d|order14d|bigint
ods_aws_asin_philips|Sale_Units_14d|sale_units14d|bigint
ods_aws_asin_philips|Sales_14d|sales14d|decimal(18,4)
ods_aws_asin_philips|ASIN_Tag|asin_tag|string
ods_aws_asin_philips|Status|status|string
ods_aws_asin_philips|Profile_Id|profile_id|string
ods_aws_asin_philips|Philips_ALL|philips_all|string
ods_aws_asin_philips|CVR_1d|cvr1d|double
ods_aws_asin_philips|CVR_7d|cvr7d|double
ods_aws_asin_philips|CVR_30d|cvr30d|double
ods_aws_asin_philips|ACOS_1d|acos1d|double
ods_aws_asin_philips|ACOS_7d|acos7d|double
ods_aws_asin_philips|ACOS_30d|acos30d|double
ods_aws_asin_philips|ROAS_1d|roas1d|double
ods_aws_asin_philips|ROAS_7d|roas7d|double
ods_aws_asin_philips|ROAS_30d|roas30d|double
ods_aws_asin_philips|CPA_1d|cpa1d|decimal(18,4)
ods_aws_asin_philips|CPA_7d|cpa7d|decimal(18,4)
ods_aws_asin_philips|CPA_14d|cpa14d|decimal(18,4)
ods_aws_asin_philips|CPA_30d|cpa30d|decimal(18,4)
ods_aws_asin_philips|Order_1d|order1d|bigint
ods_aws_asin_philips|Order_7d|order7d|bigint
ods_aws_asin_philips|Order_30d|order30d|bigint
ods_aws_asin_philips|Sale_Units_1d|sale_units1d|bigint
ods_aws_asin_philips|Sale_Units_7d|sale_units7d|bigint
ods_aws_asin_philips|Sale_Units_30d|sale_units30d|bigint
ods_aws_asin_philips|Sales_1d|sales1d|decimal(18,4)
ods_aws_asin_philips|Sales_7d|sales7d|decimal(18,4)
ods_aws_asin_philips|Sales_30d|sales30d|decimal(18,4)
ods_aws_asin_philips|Orders_NTB_14d|orders_ntb14d|bigint
ods_aws_asin_philips|Orders_NTB_Percentage_14d|orders_ntb_percentage14d|double
ods_aws_asin_philips|Order_Rate_NTB_14d|order_rate_ntb14d|double
ods_aws_asin_philips|Sales_NTB_14d|sales_ntb14d|decimal(18,4)
ods_aws_asin_philips|Sales_NTB_Percentage_14d|sales_ntb_percentage14d|double
ods_aws_asin_philips|Units_Ordered_NTB_14d|units_ordered_ntb14d|bigint
ods_aws_asin_philips|SameSKU_Sales_1d|same_sku_sales1d|decimal(18,4)
ods_aws_asin_philips|SameSKU_Sales_7d|same_sku_sales7d|decimal(18,4)
ods_aws_asin_philips|SameSKU_Sales_14d|same_sku_sales14d|decimal(18,4)
ods_aws_asin_philips|SameSKU_Sales_30d|same_sku_sales30d|decimal(18,4)
ods_aws_asin_philips|SameSKU_Orders_1d|same_sku_orders1d|bigint
ods_aws_asin_philips|SameSKU_Orders_7d|same_sku_orders7d|bigint
ods_aws_asin_philips|SameSKU_Orders_14d|same_sku_orders14d|bigint
ods_aws_asin_philips|SameSKU_Orders_30d|same_sku_orders30d|bigint
ods_aws_asin_philips|SameSKU_Sale_Units_1d|same_sku_sale_units1d|bigint
ods_aws_asin_philips|SameSKU_Sale_Units_7d|same_sku_sale_units7d|bigint
ods_aws_asin_philips|SameSKU_Sale_Units_14d|same_sku_sale_units14d|bigint
ods_aws_asin_philips|SameSKU_Sale_Units_30d|same_sku_sale_units30d|bigint
ods_aws_asin_philips|Other_Sales_1d|other_sales1d|decimal(18,4)
ods_aws_asin_philips|Other_Sales_7d|other_sales7d|decimal(18,4)
ods_aws_asin_philips|Other_Sales_14d|other_sales14d|decimal(18,4)
ods_aws_asin_philips|Other_Sales_30d|other_sales30d|decimal(18,4)
ods_aws_asin_philips|Kindle_Pages_Read_14d|kindle_pages_read14d|bigint
ods_aws_asin_philips|Kindle_Pages_Royalties_14d|kindle_pages_royalties14d|decimal(18,4)
"""
