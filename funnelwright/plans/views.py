"""Facts and aggregates with current dimension attributes.

Every view is a function of a mapping of tables. The result is one plan, so
Catalyst prunes columns and filters through the view into the scans.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import hour_of, ratio
from funnelwright.operators.funnel import leakage, linked_funnel
from funnelwright.operators.joins import dim_join, frequent_summary, hot_keys, left_join, may_be_hot, sized_broadcast
from funnelwright.operators.landscape import linked_landscape

Tables = Mapping[str, DataFrame]

# Join keys and output columns of each dimension, by the prefix used in views.
_PUBLISHER = ("dim_publisher", [("publisher_id", "publisher_id")])
_DEVICE_TYPE = ("dim_device_type", [("device_type", "device_type_code")])
_DEVICE_OS = ("dim_device_os", [("device_os", "os_name")])
_GEO = ("dim_geo", [("device_geo_country", "country_code"), ("device_geo_region", "region_code")])
_BIDDER = ("dim_bidder", [("bidder_id", "bidder_id")])
_SEAT = ("dim_bidder", [("seat", "bidder_id")])
_CREATIVE = ("dim_creative", [("creative_id", "creative_id")])

_PATH_DIMS = [
    ("dim_strategy", [("strategy_id", "strategy_id")]),
    ("dim_line_item", [("line_item_id", "line_item_id")]),
    ("dim_campaign", [("campaign_id", "campaign_id")]),
    ("dim_advertiser", [("advertiser_id", "advertiser_id")]),
    ("dim_agency", [("agency_id", "agency_id")]),
    ("dim_deal", [("deal_id", "deal_id")]),
]


def _attach(rows: DataFrame, tables: Tables, dim: tuple[str, list], **columns: str) -> DataFrame:
    table, on = dim
    return dim_join(rows, tables[table], on, columns)


def _request_dims(rows: DataFrame, tables: Tables) -> DataFrame:
    rows = _attach(
        rows, tables, _PUBLISHER, publisher_name="publisher_name", publisher_vertical="vertical", publisher_tier="tier"
    )
    rows = _attach(
        rows,
        tables,
        _DEVICE_TYPE,
        device_type_name="device_type_name",
        form_factor="form_factor",
        is_mobile="is_mobile",
    )
    rows = _attach(rows, tables, _DEVICE_OS, os_vendor="os_vendor")
    return _attach(
        rows, tables, _GEO, country_name="country_name", region_name="region_name", timezone="timezone"
    )


def _bid_dims(rows: DataFrame, tables: Tables) -> DataFrame:
    rows = _attach(rows, tables, _SEAT, bidder_name="bidder_name")
    rows = _attach(
        rows,
        tables,
        _CREATIVE,
        creative_name="creative_name",
        creative_format="format",
        creative_width="width",
        creative_height="height",
    )
    outputs = [
        {"strategy_name": "strategy_name", "targeting_type": "targeting_type", "channel": "channel"},
        {"line_item_name": "line_item_name", "budget": "budget", "bid_strategy": "bid_strategy"},
        {"campaign_name": "campaign_name", "campaign_objective": "objective"},
        {"advertiser_name": "advertiser_name", "industry": "industry"},
        {"agency_name": "agency_name", "holding_company": "holding_company"},
        {"deal_name": "deal_name", "deal_type": "deal_type", "deal_floor_price": "floor_price"},
    ]
    for dim, columns in zip(_PATH_DIMS, outputs):
        rows = _attach(rows, tables, dim, **columns)
    return rows


def enriched_bid_requests(tables: Tables) -> DataFrame:
    return _request_dims(tables["bid_requests"], tables).select(
        "request_id",
        "imp_id",
        "imp_banner_w",
        "imp_banner_h",
        "imp_bidfloor",
        "site_id",
        "site_domain",
        "publisher_id",
        "publisher_name",
        "publisher_vertical",
        "publisher_tier",
        "device_type",
        "device_type_name",
        "form_factor",
        "is_mobile",
        "device_os",
        "os_vendor",
        "device_geo_country",
        "device_geo_region",
        "country_name",
        "region_name",
        "timezone",
        "user_id",
        "auction_type",
        "tmax",
        "currency",
        "is_coppa",
        "is_gdpr",
        "event_timestamp",
        "received_at",
    )


def enriched_bid_responses(tables: Tables) -> DataFrame:
    return _bid_dims(tables["bid_responses"], tables).select(
        "response_id",
        "request_id",
        "seat",
        "bidder_name",
        "bid_id",
        "imp_id",
        "bid_price",
        "creative_id",
        "creative_name",
        "creative_format",
        "creative_width",
        "creative_height",
        "strategy_id",
        "strategy_name",
        "targeting_type",
        "channel",
        "line_item_id",
        "line_item_name",
        "budget",
        "bid_strategy",
        "campaign_id",
        "campaign_name",
        "campaign_objective",
        "advertiser_id",
        "advertiser_name",
        "industry",
        "agency_id",
        "agency_name",
        "holding_company",
        "deal_id",
        "deal_name",
        "deal_type",
        "deal_floor_price",
        "ad_domain",
        "currency",
        "event_timestamp",
    )


def enriched_impressions(tables: Tables) -> DataFrame:
    rows = _attach(tables["impressions"], tables, _BIDDER, bidder_name="bidder_name")
    rows = _attach(rows, tables, _CREATIVE, creative_name="creative_name", creative_format="format")
    return rows.select(
        "impression_id",
        "request_id",
        "response_id",
        "imp_id",
        "bidder_id",
        "bidder_name",
        "win_price",
        "win_currency",
        "creative_id",
        "creative_name",
        "creative_format",
        "ad_domain",
        "event_timestamp",
    )


def enriched_clicks(tables: Tables) -> DataFrame:
    rows = _attach(tables["clicks"], tables, _BIDDER, bidder_name="bidder_name")
    rows = _attach(rows, tables, _CREATIVE, creative_name="creative_name", creative_format="format")
    return rows.select(
        "click_id",
        "request_id",
        "impression_id",
        "imp_id",
        "bidder_id",
        "bidder_name",
        "creative_id",
        "creative_name",
        "creative_format",
        "click_url",
        "event_timestamp",
    )


# The key by which each fact follows the one before it.
LINKS = {"bid_responses": "request_id", "impressions": "response_id", "clicks": "impression_id"}


def _hot(tables: Tables, fact: str) -> DataFrame | None:
    """Hot links of a fact: none if it is too small to have any.

    Read from the summary ``frequent_<fact>`` where the tables have one, as a job that
    writes facts can store it, else from one made of the fact's key column.
    """
    rows, key = tables[fact], LINKS[fact]
    if not may_be_hot(rows):
        return None
    name = f"frequent_{fact}"
    summary = tables[name] if name in tables else frequent_summary(rows, key)
    return hot_keys(rows, key, summary=summary)


def full_funnel(tables: Tables) -> DataFrame:
    """Row-level chain of all four stages with all attributes.

    Here the fan-out is the result, one row per path. The hops nest from the
    right: every hop is an equality with the stage before it, which a NULL never
    passes, so the rows are those of the chain from the left, but the wide
    request row is shuffled once and no unmatched row leaves a NULL key that
    the next hop would gather in one task. Names are looked up after the joins,
    so that only keys travel through the shuffles.
    """
    requests = tables["bid_requests"].select(
        "request_id",
        "imp_id",
        "imp_banner_w",
        "imp_banner_h",
        "imp_bidfloor",
        "site_id",
        "site_domain",
        "publisher_id",
        "device_type",
        "device_os",
        "device_geo_country",
        "device_geo_region",
        "user_id",
        "auction_type",
        "currency",
        "is_coppa",
        "is_gdpr",
        F.col("event_timestamp").alias("request_timestamp"),
    )
    responses = tables["bid_responses"].select(
        "request_id",
        "response_id",
        "seat",
        "bid_price",
        "creative_id",
        "strategy_id",
        "line_item_id",
        "campaign_id",
        "advertiser_id",
        "agency_id",
        "deal_id",
        "ad_domain",
        F.col("event_timestamp").alias("response_timestamp"),
    )
    impressions = tables["impressions"].select(
        "response_id",
        "impression_id",
        "win_price",
        "win_currency",
        F.col("event_timestamp").alias("impression_timestamp"),
    )
    clicks = tables["clicks"].select(
        "impression_id", "click_id", "click_url", F.col("event_timestamp").alias("click_timestamp")
    )
    shown = left_join(impressions, clicks, "impression_id", _hot(tables, "clicks"))
    bids = left_join(responses, shown, "response_id", _hot(tables, "impressions"))
    chain = left_join(requests, bids, "request_id", _hot(tables, "bid_responses"))
    rows = _bid_dims(_request_dims(chain, tables), tables)
    return rows.select(
        "request_id",
        "imp_id",
        "imp_banner_w",
        "imp_banner_h",
        "imp_bidfloor",
        "site_id",
        "site_domain",
        "publisher_id",
        "publisher_name",
        "publisher_vertical",
        "publisher_tier",
        "device_type",
        "device_type_name",
        "is_mobile",
        "device_os",
        "os_vendor",
        "device_geo_country",
        "device_geo_region",
        "country_name",
        "region_name",
        "user_id",
        "auction_type",
        "currency",
        "is_coppa",
        "is_gdpr",
        "request_timestamp",
        "response_id",
        "seat",
        "bidder_name",
        "bid_price",
        "creative_id",
        "creative_name",
        "creative_format",
        "strategy_id",
        "strategy_name",
        "targeting_type",
        "line_item_id",
        "line_item_name",
        "campaign_id",
        "campaign_name",
        "campaign_objective",
        "advertiser_id",
        "advertiser_name",
        "industry",
        "agency_id",
        "agency_name",
        "holding_company",
        "deal_id",
        "deal_name",
        "deal_type",
        "ad_domain",
        "response_timestamp",
        "impression_id",
        "win_price",
        "win_currency",
        "impression_timestamp",
        "click_id",
        "click_url",
        "click_timestamp",
        F.col("response_id").isNotNull().alias("has_response"),
        F.col("impression_id").isNotNull().alias("has_impression"),
        F.col("click_id").isNotNull().alias("has_click"),
    )


def metrics_by_bidder(tables: Tables) -> DataFrame:
    rows = (
        tables["impressions"]
        .groupBy(hour_of(F.col("event_timestamp")).alias("hour_start"), "bidder_id")
        .agg(
            F.count("*").alias("win_count"),
            F.sum("win_price").alias("revenue"),
            F.avg("win_price").alias("avg_cpm"),
        )
    )
    rows = _attach(rows, tables, _BIDDER, bidder_name="bidder_name", bidder_domain="domain")
    return rows.select(
        "hour_start", "bidder_id", "bidder_name", "bidder_domain", "win_count", "revenue", "avg_cpm"
    )


def bid_landscape(tables: Tables) -> DataFrame:
    rows = linked_landscape(tables["bid_responses"], tables["bid_requests"])
    rows = _attach(rows, tables, _PUBLISHER, publisher_name="publisher_name", publisher_vertical="vertical")
    return rows.select(
        "hour_start",
        "publisher_id",
        "publisher_name",
        "publisher_vertical",
        "request_count",
        "total_bids",
        "bids_per_request",
        "avg_bid_price",
        "max_bid_price",
    )


def serving_metrics(tables: Tables) -> DataFrame:
    """Each impression counts once, with all clicks on it whenever they came."""
    clicked = tables["clicks"].groupBy("impression_id").agg(F.count("*").alias("click_count"))
    shown = (
        tables["impressions"]
        .groupBy("impression_id", hour_of(F.col("event_timestamp")).alias("hour_start"), "bidder_id")
        .agg(F.count("*").alias("n"), F.sum("win_price").alias("price"))
    )
    rows = (
        shown.join(clicked, "impression_id", "left")
        .groupBy("hour_start", "bidder_id")
        .agg(
            F.sum("n").alias("impressions"),
            F.coalesce(F.sum(F.col("click_count") * F.col("n")), F.lit(0)).alias("clicks"),
            F.sum("price").alias("revenue"),
        )
        .withColumn("ctr", ratio(F.col("clicks"), F.col("impressions")))
    )
    rows = _attach(rows, tables, _BIDDER, bidder_name="bidder_name")
    return rows.select("hour_start", "bidder_id", "bidder_name", "impressions", "clicks", "revenue", "ctr")


def funnel_by_publisher(tables: Tables) -> DataFrame:
    counts = linked_funnel(
        tables["bid_requests"], tables["bid_responses"], tables["impressions"], tables["clicks"]
    )
    return publisher_funnel(counts, tables)


def publisher_funnel(counts: DataFrame, tables: Tables) -> DataFrame:
    """Counts of the funnel with the attributes of their publishers."""
    rows = _attach(
        counts, tables, _PUBLISHER, publisher_name="publisher_name", publisher_vertical="vertical", publisher_tier="tier"
    )
    return rows.select(
        "hour_start",
        "publisher_id",
        "publisher_name",
        "publisher_vertical",
        "publisher_tier",
        "bid_requests",
        "bid_responses",
        "impressions",
        "clicks",
        "fill_rate",
        "win_rate",
        "ctr",
    )


def funnel_leakage(tables: Tables) -> DataFrame:
    counts = linked_funnel(
        tables["bid_requests"], tables["bid_responses"], tables["impressions"], tables["clicks"]
    )
    return publisher_leakage(counts, tables)


def publisher_leakage(counts: DataFrame, tables: Tables) -> DataFrame:
    """What each stage of the funnel loses, with the attributes of the publishers."""
    rows = leakage(counts, "hour_start")
    rows = _attach(rows, tables, _PUBLISHER, publisher_name="publisher_name", publisher_vertical="vertical")
    return rows.select(
        "hour_start",
        "publisher_id",
        "publisher_name",
        "publisher_vertical",
        "requests_no_response",
        "responses_no_impression",
        "impressions_no_click",
        "response_leakage_rate",
        "impression_leakage_rate",
        "click_leakage_rate",
    )


def impressions_by_geo(tables: Tables) -> DataFrame:
    """A request row per slot repeats its impressions; counted by weight, not by pairs."""
    asked = tables["bid_requests"].groupBy("request_id", "device_geo_country").agg(F.count("*").alias("copies"))
    shown = (
        tables["impressions"]
        .groupBy("request_id", hour_of(F.col("event_timestamp")).alias("hour_start"))
        .agg(
            F.count("*").alias("n"), F.count("win_price").alias("priced"), F.sum("win_price").alias("price")
        )
    )
    copies = F.coalesce(F.col("copies"), F.lit(1))
    rows = (
        shown.join(asked, "request_id", "left")
        .groupBy("hour_start", "device_geo_country")
        .agg(
            F.sum(F.col("n") * copies).alias("impression_count"),
            F.sum(F.col("price") * copies).alias("total_revenue"),
            F.sum(F.col("priced") * copies).alias("priced"),
        )
        .withColumn("avg_win_price", F.col("total_revenue") / F.nullif(F.col("priced"), F.lit(0)))
    )
    countries = (
        tables["dim_geo"]
        .filter("is_current")
        .groupBy(F.col("country_code").alias("device_geo_country"))
        .agg(F.max("country_name").alias("country_name"))
    )
    return rows.join(sized_broadcast(countries), "device_geo_country", "left").select(
        "hour_start", "device_geo_country", "country_name", "impression_count", "total_revenue", "avg_win_price"
    )


def realtime_funnel(tables: Tables) -> DataFrame:
    rows = _attach(
        tables["hourly_funnel_by_publisher"],
        tables,
        _PUBLISHER,
        publisher_name="publisher_name",
        publisher_vertical="vertical",
        publisher_tier="tier",
    )
    return rows.select(
        "window_start",
        "publisher_id",
        "publisher_name",
        "publisher_vertical",
        "publisher_tier",
        "bid_requests",
        "bid_responses",
        "impressions",
        "clicks",
        "fill_rate",
        "win_rate",
        "ctr",
    )


def realtime_rolling(tables: Tables) -> DataFrame:
    rows = _attach(
        tables["rolling_metrics_by_bidder"], tables, _BIDDER, bidder_name="bidder_name", bidder_domain="domain"
    )
    return rows.select(
        "window_start",
        "window_end",
        "bidder_id",
        "bidder_name",
        "bidder_domain",
        "win_count",
        "revenue",
        "avg_cpm",
    )


def realtime_landscape(tables: Tables) -> DataFrame:
    rows = _attach(
        tables["bid_landscape_hourly"],
        tables,
        _PUBLISHER,
        publisher_name="publisher_name",
        publisher_vertical="vertical",
    )
    return rows.select(
        "window_start",
        "publisher_id",
        "publisher_name",
        "publisher_vertical",
        "request_count",
        "total_bids",
        "bids_per_request",
        "avg_bid_price",
        "max_bid_price",
    )


def realtime_serving(tables: Tables) -> DataFrame:
    rows = _attach(tables["realtime_serving_metrics_1m"], tables, _BIDDER, bidder_name="bidder_name")
    return rows.select("window_start", "bidder_id", "bidder_name", "impressions", "clicks", "revenue", "ctr")


VIEWS = {
    "v_event_enriched_bid_requests": enriched_bid_requests,
    "v_event_enriched_bid_responses": enriched_bid_responses,
    "v_event_enriched_impressions": enriched_impressions,
    "v_event_enriched_clicks": enriched_clicks,
    "v_event_enriched_full_funnel": full_funnel,
    "v_agg_metrics_by_bidder": metrics_by_bidder,
    "v_agg_bid_landscape": bid_landscape,
    "v_agg_serving_metrics": serving_metrics,
    "v_agg_funnel_by_publisher": funnel_by_publisher,
    "v_agg_funnel_leakage": funnel_leakage,
    "v_agg_impressions_by_geo": impressions_by_geo,
    "v_realtime_agg_hourly_funnel_by_publisher": realtime_funnel,
    "v_realtime_agg_rolling_metrics_by_bidder": realtime_rolling,
    "v_realtime_agg_bid_landscape_hourly": realtime_landscape,
    "v_realtime_agg_serving_metrics_1m": realtime_serving,
}
