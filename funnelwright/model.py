"""Event schemas on the wire, flat table contracts and aggregate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PUBLISHER = "publisher: struct<id: int, name: string>"

# The four event streams, nested as producers send them. Timestamps are ISO text.
EVENT_SCHEMAS = {
    "bid_requests": f"""
        id string,
        imp array<struct<id: string, banner: struct<w: int, h: int, pos: int>,
            bidfloor: double, bidfloorcur: string, secure: int>>,
        site struct<id: string, domain: string, cat: array<string>, page: string,
            {_PUBLISHER}>,
        app struct<id: string, bundle: string, storeurl: string, cat: array<string>,
            {_PUBLISHER}>,
        device struct<ua: string, ip: string,
            geo: struct<lat: double, lon: double, country: string, region: string>,
            devicetype: int, os: string, osv: string>,
        user struct<id: string, buyeruid: string>,
        at int, tmax int, cur array<string>,
        source struct<fd: int, tid: string>,
        regs struct<coppa: int, ext: struct<gdpr: int>>,
        event_timestamp string, received_at string""",
    "bid_responses": """
        id string,
        seatbid array<struct<seat: int, bid: array<struct<id: string, impid: string, price: double,
            adid: string, crid: int, adomain: array<string>, w: int, h: int, dealid: int,
            campaign_id: int, line_item_id: int, strategy_id: int, advertiser_id: int, agency_id: int>>>>,
        bidid string, cur string, ext struct<request_id: string>, event_timestamp string""",
    "impressions": """
        impression_id string, request_id string, response_id string, imp_id string, bidder_id int,
        win_price double, win_currency string, creative_id int, ad_domain string, event_timestamp string""",
    "clicks": """
        click_id string, request_id string, impression_id string, imp_id string, bidder_id int,
        creative_id int, click_url string, event_timestamp string""",
}

_SCD = "valid_from timestamp, valid_to timestamp, is_current boolean"

# Flat tables: facts, aggregates, dimensions and job state.
TABLES = {
    "bid_requests": """request_id string, imp_id string, imp_banner_w int, imp_banner_h int,
        imp_bidfloor double, site_id string, site_domain string, site_cat array<string>,
        publisher_id int, device_type int, device_os string, device_geo_country string,
        device_geo_region string, user_id string, auction_type int, tmax int, currency string,
        is_coppa boolean, is_gdpr boolean, event_timestamp timestamp, received_at timestamp""",
    "bid_requests_enriched": """request_id string, imp_id string, imp_banner_w int, imp_banner_h int,
        imp_bidfloor double, imp_bidfloor_usd double, imp_bidfloorcur string, site_id string,
        site_domain string, app_id string, app_bundle string, publisher_id int, device_type int,
        device_os string, device_ip string, device_geo_country string, device_geo_region string,
        device_category string, user_id string, auction_type int, currency string, is_coppa boolean,
        is_gdpr boolean, is_test_traffic boolean, is_private_ip boolean,
        event_timestamp timestamp, received_at timestamp""",
    "bid_responses": """response_id string, request_id string, seat int, bid_id string, imp_id string,
        bid_price double, creative_id int, deal_id int, ad_domain string, campaign_id int,
        line_item_id int, strategy_id int, advertiser_id int, agency_id int, currency string,
        event_timestamp timestamp""",
    "impressions": """impression_id string, request_id string, response_id string, imp_id string,
        bidder_id int, win_price double, win_currency string, creative_id int, ad_domain string,
        event_timestamp timestamp""",
    "clicks": """click_id string, request_id string, impression_id string, imp_id string, bidder_id int,
        creative_id int, click_url string, event_timestamp timestamp""",
    "dq_rejected_events": """request_id string, imp_id string, publisher_id int, device_ip string,
        reject_reason string, event_timestamp timestamp""",
    "hourly_impressions_by_geo": """window_start timestamp, device_geo_country string,
        impression_count long, total_revenue double, avg_win_price double""",
    "rolling_metrics_by_bidder": """window_start timestamp, window_end timestamp, bidder_id int,
        win_count long, revenue double, avg_cpm double""",
    "dq_event_quality_hourly": """window_start timestamp,
        total_bid_requests long, unique_bid_requests long, duplicate_bid_requests long,
        duplicate_bid_request_rate double,
        total_bid_responses long, unique_bid_responses long, duplicate_bid_responses long,
        duplicate_bid_response_rate double,
        total_wins long, unique_wins long, duplicate_wins long, duplicate_win_rate double,
        total_clicks long, unique_clicks long, duplicate_clicks long, duplicate_click_rate double,
        invalid_bid_requests long, invalid_bid_request_rate double,
        total_events_all long, duplicate_events_all long, duplicate_rate_all double""",
    "bid_landscape_hourly": """window_start timestamp, publisher_id int, request_count long,
        total_bids long, bids_per_request double, avg_bid_price double, max_bid_price double""",
    "realtime_serving_metrics_1m": """window_start timestamp, bidder_id int, impressions long,
        clicks long, revenue double, ctr double""",
    "hourly_funnel_by_publisher": """window_start timestamp, publisher_id int, bid_requests long,
        bid_responses long, impressions long, clicks long, fill_rate double, win_rate double, ctr double""",
    "funnel_leakage_hourly": """window_start timestamp, publisher_id int, requests_no_response long,
        responses_no_impression long, impressions_no_click long, response_leakage_rate double,
        impression_leakage_rate double, click_leakage_rate double""",
    "dim_agency": f"agency_id int, agency_name string, holding_company string, headquarters string, {_SCD}",
    "dim_advertiser": f"advertiser_id int, agency_id int, advertiser_name string, industry string, domain string, {_SCD}",
    "dim_campaign": f"campaign_id int, advertiser_id int, campaign_name string, objective string, start_date string, end_date string, {_SCD}",
    "dim_line_item": f"line_item_id int, campaign_id int, line_item_name string, budget double, bid_strategy string, {_SCD}",
    "dim_strategy": f"strategy_id int, line_item_id int, strategy_name string, targeting_type string, channel string, {_SCD}",
    "dim_creative": f"creative_id int, strategy_id int, creative_name string, format string, width int, height int, landing_page_url string, {_SCD}",
    "dim_bidder": f"bidder_id int, bidder_name string, domain string, exchange_seat int, region string, {_SCD}",
    "dim_publisher": f"publisher_id int, publisher_name string, domain string, vertical string, tier string, {_SCD}",
    "dim_deal": f"deal_id int, deal_name string, deal_type string, floor_price double, buyer_seat int, seller_id int, {_SCD}",
    "dim_geo": f"geo_key int, country_code string, country_name string, region_code string, region_name string, timezone string, {_SCD}",
    "dim_device_type": f"device_type_code int, device_type_name string, form_factor string, is_mobile boolean, {_SCD}",
    "dim_device_os": f"os_name string, os_vendor string, os_family string, {_SCD}",
    "dim_browser": f"browser_id int, browser_name string, vendor string, engine string, {_SCD}",
    "materialization_watermarks": "table_name string, last_materialized_at timestamp",
}

# Keys that identify one row of an upserted aggregate.
AGGREGATE_KEYS = {
    "hourly_impressions_by_geo": ["window_start", "device_geo_country"],
    "rolling_metrics_by_bidder": ["window_start", "bidder_id"],
    "dq_event_quality_hourly": ["window_start"],
    "bid_landscape_hourly": ["window_start", "publisher_id"],
    "realtime_serving_metrics_1m": ["window_start", "bidder_id"],
    "hourly_funnel_by_publisher": ["window_start", "publisher_id"],
    "funnel_leakage_hourly": ["window_start", "publisher_id"],
}

# Business key of each dimension; with valid_from it identifies a version.
DIMENSION_KEYS = {
    "dim_agency": "agency_id",
    "dim_advertiser": "advertiser_id",
    "dim_campaign": "campaign_id",
    "dim_line_item": "line_item_id",
    "dim_strategy": "strategy_id",
    "dim_creative": "creative_id",
    "dim_bidder": "bidder_id",
    "dim_publisher": "publisher_id",
    "dim_deal": "deal_id",
    "dim_geo": "geo_key",
    "dim_device_type": "device_type_code",
    "dim_device_os": "os_name",
    "dim_browser": "browser_id",
}

# Event-time column of each fact table's partitioning, and its second partition column.
FACT_PARTITIONS = {
    "bid_requests": "device_geo_country",
    "bid_requests_enriched": "device_category",
    "bid_responses": None,
    "impressions": None,
    "clicks": None,
    "dq_rejected_events": None,
}


def event_schema(topic: str) -> T.StructType:
    return T.StructType.fromDDL(EVENT_SCHEMAS[topic])


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Bind columns to a contract by name, with its order and types.

    A missing column is an error; a value that does not fit its type fails
    the write under ANSI mode rather than being stored as NULL.
    """
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(table)])
