"""Nested events to flat fact tables: clean, enriched, rejected, and 1:1 tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import device_category, event_time, is_private_ip, usd_floor
from funnelwright.model import conform


def publisher_id() -> Column:
    """The publisher of a nested request, whether on a site or in an app."""
    return F.coalesce("site.publisher.id", "app.publisher.id")


def device_ip() -> Column:
    return F.col("device.ip")


def _slots(requests: DataFrame, *more: str) -> DataFrame:
    """One row per impression slot; a request without slots has none.

    The slot is zipped from the leaves that are used. Each is an array by
    itself, so the scan reads no other, whatever filter stands above.
    """
    leaves = {"id": "imp.id", "w": "imp.banner.w", "h": "imp.banner.h", "bidfloor": "imp.bidfloor"}
    leaves |= {name: f"imp.{name}" for name in more}
    zipped = F.arrays_zip(*[F.col(path).alias(name) for name, path in leaves.items()])
    return requests.withColumn("slot", F.explode(zipped))


def _flag(value: Column) -> Column:
    """TRUE where the value is 1, FALSE otherwise, also for NULL."""
    return F.coalesce(value == 1, F.lit(False))


def _common_columns() -> dict[str, Column]:
    return {
        "request_id": F.col("id"),
        "imp_id": F.col("slot.id"),
        "imp_banner_w": F.col("slot.w"),
        "imp_banner_h": F.col("slot.h"),
        "imp_bidfloor": F.col("slot.bidfloor"),
        "publisher_id": publisher_id(),
        "device_type": F.col("device.devicetype"),
        "device_os": F.col("device.os"),
        "device_ip": device_ip(),
        "device_geo_country": F.col("device.geo.country"),
        "device_geo_region": F.col("device.geo.region"),
        "user_id": F.col("user.id"),
        "auction_type": F.col("at"),
        "currency": F.get("cur", F.lit(0)),
        "is_coppa": _flag(F.col("regs.coppa")),
        "is_gdpr": _flag(F.col("regs.ext.gdpr")),
        "event_timestamp": event_time(F.col("event_timestamp")),
        "received_at": event_time(F.col("received_at")),
    }


def clean_requests(requests: DataFrame) -> DataFrame:
    """Slots of real publishers from public addresses with a positive floor.

    A NULL publisher or address fails the test, and publisher 0 is not > 0.
    Request-level tests come before the explode, so dropped requests never fan out.
    """
    kept = requests.filter((publisher_id() > 0) & ~is_private_ip(device_ip()))
    rows = _slots(kept).filter(F.col("slot.bidfloor") > 0)
    columns = _common_columns() | {
        "site_id": F.coalesce("site.id", "app.id"),
        "site_domain": F.coalesce("site.domain", "app.bundle"),
        "site_cat": F.coalesce("site.cat", "app.cat"),
        "tmax": F.col("tmax"),
    }
    return conform(rows.select(*[c.alias(name) for name, c in columns.items()]), "bid_requests")


def enriched_requests(requests: DataFrame) -> DataFrame:
    """All slots, with USD floor, device category and traffic flags."""
    columns = _common_columns() | {
        "imp_bidfloor_usd": usd_floor(F.col("slot.bidfloor"), F.col("slot.bidfloorcur")),
        "imp_bidfloorcur": F.col("slot.bidfloorcur"),
        "site_id": F.col("site.id"),
        "site_domain": F.col("site.domain"),
        "app_id": F.col("app.id"),
        "app_bundle": F.col("app.bundle"),
        "device_category": device_category(F.col("device.devicetype"), F.col("app.id"), F.col("site.id")),
        "is_test_traffic": F.coalesce(publisher_id() < 0, F.lit(False)),
        "is_private_ip": F.coalesce(is_private_ip(device_ip()), F.lit(False)),
    }
    rows = _slots(requests, "bidfloorcur").select(*[c.alias(name) for name, c in columns.items()])
    return conform(rows, "bid_requests_enriched")


def rejected_requests(requests: DataFrame) -> DataFrame:
    """Slots that fail a quality rule, with the first rule they fail."""
    reason = (
        F.when(publisher_id() < 0, "TEST_PUBLISHER")
        .when(is_private_ip(device_ip()), "PRIVATE_IP")
        .when(F.col("slot.bidfloor") <= 0, "NON_POSITIVE_BIDFLOOR")
    )
    columns = _common_columns() | {"reject_reason": reason}
    rows = _slots(requests).filter(reason.isNotNull()).select(*[c.alias(name) for name, c in columns.items()])
    return conform(rows, "dq_rejected_events")


def flat_bids(responses: DataFrame) -> DataFrame:
    """One row per bid of every seat; the first advertiser domain only."""
    rows = responses.withColumn("seatbid", F.explode("seatbid")).withColumn("bid", F.explode("seatbid.bid"))
    columns = {
        "response_id": F.col("id"),
        "request_id": F.col("ext.request_id"),
        "seat": F.col("seatbid.seat"),
        "bid_id": F.col("bid.id"),
        "imp_id": F.col("bid.impid"),
        "bid_price": F.col("bid.price"),
        "creative_id": F.col("bid.crid"),
        "deal_id": F.col("bid.dealid"),
        "ad_domain": F.get("bid.adomain", F.lit(0)),
        "campaign_id": F.col("bid.campaign_id"),
        "line_item_id": F.col("bid.line_item_id"),
        "strategy_id": F.col("bid.strategy_id"),
        "advertiser_id": F.col("bid.advertiser_id"),
        "agency_id": F.col("bid.agency_id"),
        "currency": F.col("cur"),
        "event_timestamp": event_time(F.col("event_timestamp")),
    }
    return conform(rows.select(*[c.alias(name) for name, c in columns.items()]), "bid_responses")


def flat_impressions(impressions: DataFrame) -> DataFrame:
    return conform(
        impressions.withColumn("event_timestamp", event_time(F.col("event_timestamp"))), "impressions"
    )


def flat_clicks(clicks: DataFrame) -> DataFrame:
    return conform(clicks.withColumn("event_timestamp", event_time(F.col("event_timestamp"))), "clicks")


# Every fact table with the stream it is fed from.
FACT_BUILDERS = {
    "bid_requests": ("bid_requests", clean_requests),
    "bid_requests_enriched": ("bid_requests", enriched_requests),
    "dq_rejected_events": ("bid_requests", rejected_requests),
    "bid_responses": ("bid_responses", flat_bids),
    "impressions": ("impressions", flat_impressions),
    "clicks": ("clicks", flat_clicks),
}
