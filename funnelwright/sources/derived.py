"""Ad-auction tables and event streams derived from general sales tables.

An order becomes a bid request, its line items the bids of one response, some
line items the impressions won and the clicks on them. Apart from the country
look-up every fact is a projection, so nothing is shuffled to derive it and
volume grows with the input. Line items repeat (order, line number), which
gives natural copies of events; more copies are added by a fixed rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.model import conform, event_schema
from funnelwright.operators.joins import sized_broadcast

# Microseconds since 1970 of 2024-01-01; events spread over three days from here.
_BASE = 1704067200000000
_REQUEST_US = f"{_BASE} + ((k * 7919) % 259200) * 1000000 + (k % 4) * 250000"
_RESPONSE_US = f"{_REQUEST_US} + (k % 8) * 1000000"
_IMPRESSION_US = f"{_RESPONSE_US} + ((k * 5 + ln) % 13) * 1000000"
_CLICK_US = f"{_IMPRESSION_US} + ((k * 11 + ln * 7 + j * 30) % 70) * 1000000"


def _iso(micros: str) -> str:
    """ISO text with offset; without a fraction where it is zero."""
    ts = f"timestamp_micros({micros})"
    return (
        f"CASE WHEN ({micros}) % 1000000 = 0 THEN date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss'+00:00'\")"
        f" ELSE date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\") END"
    )


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _copies(df: DataFrame, rule: str) -> DataFrame:
    """Repeat rows that meet the rule once more."""
    return df.withColumn("copy", F.expr(f"explode(CASE WHEN {rule} THEN array(0, 1) ELSE array(0) END)")).drop("copy")


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per bid-request event, with the fields every shape of it needs."""
    nation = read(spark, sf_dir, "nation").selectExpr("n_nationkey AS nk", "n_name AS country")
    rows = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS k", "o_custkey AS ck", "o_custkey % 25 AS nk")
    rows = rows.join(sized_broadcast(nation), "nk").drop("nk")
    # Copies are made after the fields, since a projection above them would be
    # merged into this one and every use of a field would compute it again.
    fields = rows.selectExpr(
        "k",
        "country",
        "CAST(k AS string) AS request_id",
        "CASE WHEN k % 97 = 11 THEN 'none' WHEN k % 10 < 3 THEN 'app' ELSE 'site' END AS traffic",
        """CAST(CASE WHEN k % 97 = 11 THEN NULL WHEN k % 20 = 0 THEN -(k % 999) - 1 WHEN k % 401 = 0 THEN 0
            ELSE ck % 27 + 1 END AS int) AS publisher_id""",
        """CASE WHEN k % 701 = 3 THEN NULL WHEN k % 50 = 7 THEN '10.1.2.3' WHEN k % 50 = 8 THEN '192.168.1.9'
            WHEN k % 50 = 9 THEN concat('172.', CAST(k % 20 + 14 AS string), '.0.1')
            WHEN k % 50 = 19 THEN concat('172.2', CASE WHEN k % 100 = 19 THEN '' ELSE '00' END, '.0.1')
            ELSE '203.0.113.7' END AS ip""",
        "CAST(CASE k % 9 WHEN 0 THEN 7 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 4 WHEN 4 THEN 3 ELSE 2 END AS int) AS device_type",
        "CASE k % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' ELSE 'Linux' END AS device_os",
        "concat('R', CAST(k % 5 AS string)) AS region",
        "concat('u', CAST(ck AS string)) AS user_id",
        "CAST(k % 3 + 1 AS int) AS auction_type",
        "CAST(100 + k % 3 * 50 AS int) AS tmax",
        "CASE WHEN k % 53 = 0 THEN NULL WHEN k % 7 = 1 THEN 'EUR' ELSE 'USD' END AS currency",
        "k % 13 = 0 AS is_coppa",
        "k % 4 = 1 AS is_gdpr",
        "concat(CASE WHEN k % 10 < 3 THEN 'app-' ELSE 'site-' END, CAST(k % 40 AS string)) AS place_id",
        "concat(CASE WHEN k % 10 < 3 THEN 'com.bundle' ELSE 'www.site' END, CAST(k % 40 AS string)) AS place",
        "CAST(CASE WHEN k % 89 = 0 THEN 0 ELSE 1 + k % 3 END AS int) AS n_slots",
        f"{_REQUEST_US} AS event_us",
        f"{_REQUEST_US} + (k % 3) * 50000 AS received_us",
    )
    return _copies(fields, "k % 20 = 3")


# Fields of slot {j} (from 1) of request k. Sizes are fixed values.
_SLOT = {
    "w": "CAST(CASE (k + {j}) % 5 WHEN 0 THEN 300 WHEN 1 THEN 728 WHEN 2 THEN 160 WHEN 3 THEN 320 ELSE 970 END AS int)",
    "h": "CAST(CASE (k + {j}) % 5 WHEN 0 THEN 250 WHEN 1 THEN 90 WHEN 2 THEN 600 WHEN 3 THEN 50 ELSE 250 END AS int)",
    "floor": "((k * 7 + {j} * 31) % 499) / 100.0e0",
    "currency": "CASE (k + {j}) % 11 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' WHEN 2 THEN 'JPY' WHEN 3 THEN NULL ELSE 'USD' END",
}


def bid_request_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested bid-request events as on the wire."""

    def slot(j: int) -> str:
        fields = {name: rule.format(j=j) for name, rule in _SLOT.items()}
        return f"""named_struct('id', '{j}', 'banner', named_struct('w', {fields['w']}, 'h', {fields['h']}, 'pos', {j}),
            'bidfloor', {fields['floor']}, 'bidfloorcur', {fields['currency']}, 'secure', 1)"""

    publisher = "named_struct('id', publisher_id, 'name', CAST(publisher_id AS string))"
    return _requests(spark, sf_dir).selectExpr(
        "request_id AS id",
        f"slice(array({slot(1)}, {slot(2)}, {slot(3)}), 1, n_slots) AS imp",
        f"""CASE WHEN traffic = 'site' THEN named_struct('id', place_id, 'domain', place,
            'cat', array('IAB1', concat('IAB', CAST(k % 20 AS string))), 'page', concat('https://', place),
            'publisher', {publisher}) END AS site""",
        f"""CASE WHEN traffic = 'app' THEN named_struct('id', place_id, 'bundle', place,
            'storeurl', concat('https://store.example/', place),
            'cat', array('IAB1', concat('IAB', CAST(k % 20 AS string))), 'publisher', {publisher}) END AS app""",
        """named_struct('ua', 'ua', 'ip', ip, 'geo', named_struct('lat', 0.0e0, 'lon', 0.0e0, 'country', country,
            'region', region), 'devicetype', device_type, 'os', device_os, 'osv', '1') AS device""",
        "named_struct('id', user_id, 'buyeruid', user_id) AS user",
        "auction_type AS at",
        "tmax",
        "CASE WHEN currency IS NULL THEN CAST(array() AS array<string>) ELSE array(currency) END AS cur",
        "named_struct('fd', 1, 'tid', request_id) AS source",
        "named_struct('coppa', int(is_coppa), 'ext', named_struct('gdpr', int(is_gdpr))) AS regs",
        f"{_iso('event_us')} AS event_timestamp",
        f"{_iso('received_us')} AS received_at",
    )


def request_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean flat table that ingestion makes of the nested requests.

    Built directly, so that reports do not pay for making and taking apart
    nested events; the ingest query shows that both ways agree.
    """
    rows = (
        _requests(spark, sf_dir)
        .filter("traffic <> 'none' AND publisher_id > 0 AND ip IS NOT NULL")
        .filter(
            r"NOT (ip LIKE '10.%' OR ip LIKE '192.168.%' OR ip RLIKE '^172[.](1[6-9]|2[0-9]|3[01])[.]')"
        )
        .filter("n_slots > 0")
        .withColumn("j", F.expr("explode(sequence(1, n_slots))"))
        .selectExpr(
            "*",
            f"{_SLOT['w'].format(j='j')} AS imp_banner_w",
            f"{_SLOT['h'].format(j='j')} AS imp_banner_h",
            f"{_SLOT['floor'].format(j='j')} AS imp_bidfloor",
        )
        .filter("imp_bidfloor > 0")
        .selectExpr(
            "*",
            "CAST(j AS string) AS imp_id",
            "place_id AS site_id",
            "place AS site_domain",
            "array('IAB1', concat('IAB', CAST(k % 20 AS string))) AS site_cat",
            "country AS device_geo_country",
            "region AS device_geo_region",
            "timestamp_micros(event_us) AS event_timestamp",
            "timestamp_micros(received_us) AS received_at",
        )
    )
    return conform(rows, "bid_requests")


# Buy-side path of a creative, each level from the one below.
_PATH = {
    "strategy_id": "CAST((creative_id * 7) % 180 + 1 AS int)",
    "line_item_id": "CAST((strategy_id - 1) % 120 + 1 AS int)",
    "campaign_id": "CAST((line_item_id - 1) % 60 + 1 AS int)",
    "advertiser_id": "CAST((campaign_id - 1) % 20 + 1 AS int)",
    "agency_id": "CAST((advertiser_id - 1) % 5 + 1 AS int)",
}


def _bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        read(spark, sf_dir, "lineitem")
        .filter("l_orderkey % 5 < 3")
        .selectExpr(
            "l_orderkey AS k",
            "l_linenumber AS ln",
            "concat('r', CAST(l_orderkey AS string)) AS response_id",
            "CAST(l_orderkey AS string) AS request_id",
            "CAST(l_suppkey % 5 + 1 AS int) AS seat",
            "concat(CAST(l_orderkey AS string), '-', CAST(l_linenumber AS string)) AS bid_id",
            "'1' AS imp_id",
            "floor(l_extendedprice / 100) / 100.0e0 AS bid_price",
            "CAST(l_partkey % 50 + 1 AS int) AS creative_id",
            "CAST(CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey % 19 + 1 END AS int) AS deal_id",
        )
    )
    for name, rule in _PATH.items():
        rows = rows.withColumn(name, F.expr(rule))
    return rows.selectExpr(
        "*",
        "CASE WHEN ln = 7 THEN NULL ELSE concat('adv', CAST(advertiser_id AS string), '.example') END AS ad_domain",
        "'USD' AS currency",
        f"{_RESPONSE_US} AS event_us",
    )


def bid_response_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested bid-response events: one response per order, a seat per supplier group."""
    bid = """struct(bid_id AS id, imp_id AS impid, bid_price AS price, bid_id AS adid, creative_id AS crid,
        CASE WHEN ad_domain IS NULL THEN CAST(array() AS array<string>) ELSE array(ad_domain, 'other.example') END AS adomain,
        300 AS w, 250 AS h, deal_id AS dealid, campaign_id, line_item_id, strategy_id, advertiser_id, agency_id)"""
    seats = _bids(spark, sf_dir).groupBy("k", "response_id", "request_id", "seat", "event_us").agg(
        F.expr(f"collect_list({bid})").alias("bid")
    )
    events = seats.groupBy("k", "response_id", "request_id", "event_us").agg(
        F.collect_list(F.struct("seat", "bid")).alias("seatbid")
    )
    return _copies(events, "k % 25 = 4").selectExpr(
        "response_id AS id",
        "seatbid",
        "response_id AS bidid",
        "'USD' AS cur",
        "named_struct('request_id', request_id) AS ext",
        f"{_iso('event_us')} AS event_timestamp",
    )


def bid_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _copies(_bids(spark, sf_dir), "k % 25 = 4")
    return conform(rows.withColumn("event_timestamp", F.expr("timestamp_micros(event_us)")), "bid_responses")


def _impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "lineitem")
        .filter("l_orderkey % 5 < 3 AND l_orderkey % 4 < 2 AND l_linenumber % 3 = 1")
        .selectExpr("l_orderkey AS k", "l_linenumber AS ln")
        .selectExpr(
            "k",
            "ln",
            "concat('i', CAST(k AS string), '-', CAST(ln AS string)) AS impression_id",
            "CAST(k AS string) AS request_id",
            "concat('r', CAST(k AS string)) AS response_id",
            "'1' AS imp_id",
            "CAST((k + ln) % 6 + 1 AS int) AS bidder_id",
            "((k * 37 + ln * 101) % 900 + 10) / 100.0e0 AS win_price",
            "'USD' AS win_currency",
            "CAST((k * 3 + ln) % 50 + 1 AS int) AS creative_id",
            "concat('adv', CAST((k * 3 + ln) % 20 AS string), '.example') AS ad_domain",
            f"{_IMPRESSION_US} AS event_us",
        )
    )


def impression_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _copies(_impressions(spark, sf_dir), "k % 15 = 6")
    rows = rows.withColumn("event_timestamp", F.expr(_iso("event_us")))
    return rows.select(*event_schema("impressions").fieldNames())


def impression_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _copies(_impressions(spark, sf_dir), "k % 15 = 6")
    return conform(rows.withColumn("event_timestamp", F.expr("timestamp_micros(event_us)")), "impressions")


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        _impressions(spark, sf_dir)
        .filter("(k + ln) % 3 = 0")
        .withColumn("j", F.expr("explode(CASE WHEN (k + ln) % 9 = 0 THEN array(0, 1) ELSE array(0) END)"))
        .selectExpr(
            "k",
            "concat('c', substr(impression_id, 2), '-', CAST(j AS string)) AS click_id",
            "request_id",
            "impression_id",
            "imp_id",
            "bidder_id",
            "creative_id",
            "concat('https://land.example/', CAST(creative_id AS string)) AS click_url",
            f"{_CLICK_US} AS event_us",
        )
    )
    return _copies(rows, "k % 10 = 0")


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _clicks(spark, sf_dir)
    rows = rows.withColumn("event_timestamp", F.expr(_iso("event_us")))
    return rows.select(*event_schema("clicks").fieldNames())


def click_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _clicks(spark, sf_dir)
    return conform(rows.withColumn("event_timestamp", F.expr("timestamp_micros(event_us)")), "clicks")


def request_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The narrow request rows that the aggregates read, without the nested detour."""
    return _requests(spark, sf_dir).selectExpr(
        "request_id", "timestamp_micros(event_us) AS event_ts", "publisher_id", "country"
    )


def response_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "lineitem").filter("l_orderkey % 5 < 3").selectExpr("l_orderkey AS k").distinct()
    return _copies(orders, "k % 25 = 4").selectExpr(
        "concat('r', CAST(k AS string)) AS response_id",
        "CAST(k AS string) AS request_id",
        f"timestamp_micros({_RESPONSE_US}) AS event_ts",
    )


def bid_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bid_facts(spark, sf_dir).selectExpr("bid_id", "request_id", "bid_price", "event_timestamp AS event_ts")


def impression_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impression_facts(spark, sf_dir).selectExpr(
        "impression_id", "request_id", "response_id", "bidder_id", "win_price", "event_timestamp AS event_ts"
    )


def click_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_facts(spark, sf_dir).selectExpr("click_id", "impression_id", "event_timestamp AS event_ts")


_ALWAYS = ["timestamp'2020-01-01' AS valid_from", "CAST(NULL AS timestamp) AS valid_to", "true AS is_current"]


def _numbered(source: str, key: str, count: int, name: str) -> Callable[[SparkSession, str], DataFrame]:
    """``count`` entities named after the first of the source rows that share a number."""

    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        number = F.expr(f"CAST({key} % {count} + 1 AS int)").alias("id")
        return read(spark, sf_dir, source).groupBy(number).agg(F.min(name).alias("name"))

    return build


def _publishers(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = read(spark, sf_dir, "nation").selectExpr("n_nationkey AS n", "n_name")
    first = base.selectExpr(
        "n",
        "concat(n_name, ' Media') AS publisher_name",
        "CASE n % 3 WHEN 0 THEN 'premium' WHEN 1 THEN 'mid-tier' ELSE 'long-tail' END AS tier",
        "timestamp'2020-01-01' AS valid_from",
        "CASE WHEN n % 3 = 0 THEN timestamp'2024-01-02' END AS valid_to",
        "n % 3 <> 0 AND n <> 23 AS is_current",
    )
    second = base.filter("n % 3 = 0").selectExpr(
        "n",
        "concat(n_name, ' Media v2') AS publisher_name",
        "'premium' AS tier",
        "timestamp'2024-01-02' AS valid_from",
        "CAST(NULL AS timestamp) AS valid_to",
        "true AS is_current",
    )
    return first.unionByName(second).selectExpr(
        "n + 1 AS publisher_id",
        "publisher_name",
        "concat('pub', CAST(n AS string), '.example') AS domain",
        "CASE n % 4 WHEN 0 THEN 'News' WHEN 1 THEN 'Sports' WHEN 2 THEN 'Tech' ELSE 'Travel' END AS vertical",
        "tier",
        "valid_from",
        "valid_to",
        "is_current",
    )


def _geos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four regions per country; events also name a fifth that has no row."""
    rows = read(spark, sf_dir, "nation").withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return rows.selectExpr(
        "n_nationkey * 4 + r + 1 AS geo_key",
        "n_name AS country_code",
        "concat('Country ', n_name) AS country_name",
        "concat('R', CAST(r AS string)) AS region_code",
        "concat(n_name, ' region ', CAST(r AS string)) AS region_name",
        "'UTC' AS timezone",
        *_ALWAYS,
    )


# Dimension: source of its numbered entities, and its columns from (id, name).
_NUMBERED_DIMS = {
    "dim_agency": (
        _numbered("supplier", "s_suppkey", 5, "s_name"),
        [
            "id AS agency_id",
            "name AS agency_name",
            "concat('Group ', name) AS holding_company",
            "'Paris' AS headquarters",
        ],
    ),
    "dim_advertiser": (
        _numbered("supplier", "s_suppkey", 20, "s_name"),
        [
            "id AS advertiser_id",
            "(id - 1) % 5 + 1 AS agency_id",
            "name AS advertiser_name",
            "concat('Industry ', CAST(id % 6 AS string)) AS industry",
            "concat('adv', CAST(id AS string), '.example') AS domain",
        ],
    ),
    "dim_campaign": (
        _numbered("part", "p_partkey", 60, "p_name"),
        [
            "id AS campaign_id",
            "(id - 1) % 20 + 1 AS advertiser_id",
            "name AS campaign_name",
            "CASE id % 2 WHEN 0 THEN 'awareness' ELSE 'conversion' END AS objective",
            "'2024-01-01' AS start_date",
            "'2024-12-31' AS end_date",
        ],
    ),
    "dim_line_item": (
        _numbered("part", "p_partkey", 120, "p_name"),
        [
            "id AS line_item_id",
            "(id - 1) % 60 + 1 AS campaign_id",
            "name AS line_item_name",
            "id * 100.0e0 AS budget",
            "CASE id % 2 WHEN 0 THEN 'max_clicks' ELSE 'target_cpa' END AS bid_strategy",
        ],
    ),
    "dim_strategy": (
        _numbered("part", "p_partkey", 180, "p_name"),
        [
            "id AS strategy_id",
            "(id - 1) % 120 + 1 AS line_item_id",
            "name AS strategy_name",
            "CASE id % 2 WHEN 0 THEN 'contextual' ELSE 'behavioral' END AS targeting_type",
            "CASE id % 3 WHEN 0 THEN 'display' WHEN 1 THEN 'video' ELSE 'mobile' END AS channel",
        ],
    ),
    "dim_creative": (
        _numbered("part", "p_partkey", 50, "p_name"),
        [
            "id AS creative_id",
            "id * 7 % 180 + 1 AS strategy_id",
            "name AS creative_name",
            "CASE id % 2 WHEN 0 THEN 'banner' ELSE 'native' END AS format",
            "300 AS width",
            "250 AS height",
            "concat('https://land.example/', CAST(id AS string)) AS landing_page_url",
        ],
    ),
    "dim_bidder": (
        _numbered("supplier", "s_suppkey", 5, "s_name"),
        [
            "id AS bidder_id",
            "name AS bidder_name",
            "concat('bidder', CAST(id AS string), '.example') AS domain",
            "id AS exchange_seat",
            "'EU' AS region",
        ],
    ),
    "dim_deal": (
        _numbered("part", "p_partkey", 18, "p_name"),
        [
            "id AS deal_id",
            "name AS deal_name",
            "CASE id % 2 WHEN 0 THEN 'preferred' ELSE 'private_auction' END AS deal_type",
            "id / 10.0e0 AS floor_price",
            "id % 5 + 1 AS buyer_seat",
            "id AS seller_id",
        ],
    ),
}

# Device types, operating systems and browsers.
_LISTED_DIMS = {
    "dim_device_type": (
        "device_type_code, device_type_name, form_factor, is_mobile",
        "(1, 'Mobile/Tablet', 'tablet', true), (2, 'Personal Computer', 'desktop', false), "
        "(4, 'Phone', 'phone', true), (7, 'Set Top Box', 'stb', false)",
    ),
    "dim_device_os": (
        "os_name, os_vendor, os_family",
        "('iOS', 'Apple', 'Darwin'), ('Android', 'Google', 'Linux'), ('Windows', 'Microsoft', 'NT')",
    ),
    "dim_browser": (
        "browser_id, browser_name, vendor, engine",
        "(1, 'Chrome', 'Google', 'Blink'), (2, 'Firefox', 'Mozilla', 'Gecko'), (3, 'Safari', 'Apple', 'WebKit')",
    ),
}


def dimension(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the thirteen dimensions."""
    if table == "dim_publisher":
        rows = _publishers(spark, sf_dir)
    elif table == "dim_geo":
        rows = _geos(spark, sf_dir)
    elif table in _LISTED_DIMS:
        columns, values = _LISTED_DIMS[table]
        rows = spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})").selectExpr("*", *_ALWAYS)
    else:
        build, columns = _NUMBERED_DIMS[table]
        rows = build(spark, sf_dir).selectExpr(*columns, *_ALWAYS)
    return conform(rows, table)


FACTS = {
    "bid_requests": request_facts,
    "bid_responses": bid_facts,
    "impressions": impression_facts,
    "clicks": click_facts,
}

EVENTS = {
    "bid_requests": bid_request_events,
    "bid_responses": bid_response_events,
    "impressions": impression_events,
    "clicks": click_events,
}

STAGES = {
    "requests": request_stage,
    "responses": response_stage,
    "bids": bid_stage,
    "impressions": impression_stage,
    "clicks": click_stage,
}
