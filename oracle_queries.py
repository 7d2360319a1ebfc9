"""ANSI SQL for every registered query, to be run by DuckDB on the same tables.

Each text states the plain definition of an operator: full left-join chains,
COUNT(DISTINCT ...), unnested windows. The Spark side computes the same results in
other ways, so agreement checks those ways.
"""

from __future__ import annotations

REQUEST_US = "1704067200000000 + ((k * 7919) % 259200) * 1000000 + (k % 4) * 250000"
RESPONSE_US = f"{REQUEST_US} + (k % 8) * 1000000"
IMPRESSION_US = f"{RESPONSE_US} + ((k * 5 + ln) % 13) * 1000000"
CLICK_US = f"{IMPRESSION_US} + ((k * 11 + ln * 7 + j * 30) % 70) * 1000000"


def _private(ip: str) -> str:
    patterns = ["10.%", "192.168.%", "172.16.%", "172.17.%", "172.18.%", "172.19.%", "172.2_.%", "172.30.%", "172.31.%"]
    return "(" + " OR ".join(f"{ip} LIKE '{p}'" for p in patterns) + ")"


def _rate(part: str, whole: str) -> str:
    return f"CASE WHEN {whole} > 0 THEN CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) ELSE 0.0 END"


def _avg(value: str, digits: int = 6) -> str:
    return f"round(avg({value}) + 1e-9, {digits})"


_SCD = "TIMESTAMP '2020-01-01' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current"

# Common table expressions, each with the ones it reads.
CTES: dict[str, tuple[str, list[str]]] = {
    "ev_request": (
        f"""SELECT k, n_name AS country, CAST(k AS VARCHAR) AS request_id,
            CASE WHEN k % 97 = 11 THEN 'none' WHEN k % 10 < 3 THEN 'app' ELSE 'site' END AS traffic,
            CAST(CASE WHEN k % 97 = 11 THEN NULL WHEN k % 20 = 0 THEN -(k % 999) - 1 WHEN k % 401 = 0 THEN 0
                ELSE ck % 27 + 1 END AS INTEGER) AS publisher_id,
            CASE WHEN k % 701 = 3 THEN NULL WHEN k % 50 = 7 THEN '10.1.2.3' WHEN k % 50 = 8 THEN '192.168.1.9'
                WHEN k % 50 = 9 THEN concat('172.', CAST(k % 20 + 14 AS VARCHAR), '.0.1')
                WHEN k % 50 = 19 THEN CASE WHEN k % 100 = 19 THEN '172.2.0.1' ELSE '172.200.0.1' END
                ELSE '203.0.113.7' END AS ip,
            CAST(CASE k % 9 WHEN 0 THEN 7 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 4 WHEN 4 THEN 3 ELSE 2 END AS INTEGER) AS device_type,
            CASE k % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Windows' ELSE 'Linux' END AS device_os,
            concat('R', CAST(k % 5 AS VARCHAR)) AS region, concat('u', CAST(ck AS VARCHAR)) AS user_id,
            CAST(k % 3 + 1 AS INTEGER) AS auction_type, CAST(100 + k % 3 * 50 AS INTEGER) AS tmax,
            CASE WHEN k % 53 = 0 THEN NULL WHEN k % 7 = 1 THEN 'EUR' ELSE 'USD' END AS currency,
            k % 13 = 0 AS is_coppa, k % 4 = 1 AS is_gdpr,
            concat(CASE WHEN k % 10 < 3 THEN 'app-' ELSE 'site-' END, CAST(k % 40 AS VARCHAR)) AS place_id,
            concat(CASE WHEN k % 10 < 3 THEN 'com.bundle' ELSE 'www.site' END, CAST(k % 40 AS VARCHAR)) AS place,
            CASE WHEN k % 89 = 0 THEN 0 ELSE 1 + k % 3 END AS n_slots,
            make_timestamp({REQUEST_US}) AS event_ts,
            make_timestamp({REQUEST_US} + (k % 3) * 50000) AS received_at
        FROM (SELECT o_orderkey AS k, o_custkey AS ck FROM orders) o
        JOIN nation ON n_nationkey = ck % 25
        JOIN (SELECT 0 AS c UNION ALL SELECT 1) t ON c = 0 OR k % 20 = 3""",
        [],
    ),
    "slot": (
        """SELECT r.*, CAST(j AS VARCHAR) AS imp_id,
            CAST(CASE (k + j) % 5 WHEN 0 THEN 300 WHEN 1 THEN 728 WHEN 2 THEN 160 WHEN 3 THEN 320 ELSE 970 END AS INTEGER) AS imp_banner_w,
            CAST(CASE (k + j) % 5 WHEN 0 THEN 250 WHEN 1 THEN 90 WHEN 2 THEN 600 WHEN 3 THEN 50 ELSE 250 END AS INTEGER) AS imp_banner_h,
            ((k * 7 + j * 31) % 499) / 100.0e0 AS imp_bidfloor,
            CASE (k + j) % 11 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' WHEN 2 THEN 'JPY' WHEN 3 THEN NULL ELSE 'USD' END AS imp_bidfloorcur
        FROM ev_request r JOIN (SELECT 1 AS j UNION ALL SELECT 2 UNION ALL SELECT 3) n ON j <= n_slots""",
        ["ev_request"],
    ),
    "bid_requests": (
        f"""SELECT request_id, imp_id, imp_banner_w, imp_banner_h, imp_bidfloor,
            CASE WHEN traffic <> 'none' THEN place_id END AS site_id, CASE WHEN traffic <> 'none' THEN place END AS site_domain,
            CASE WHEN traffic <> 'none' THEN ['IAB1', concat('IAB', CAST(k % 20 AS VARCHAR))] END AS site_cat,
            publisher_id, device_type, device_os, country AS device_geo_country, region AS device_geo_region, user_id,
            auction_type, tmax, currency, is_coppa, is_gdpr, event_ts AS event_timestamp, received_at
        FROM slot WHERE publisher_id > 0 AND NOT {_private('ip')} AND imp_bidfloor > 0""",
        ["slot"],
    ),
    "bid_requests_enriched": (
        f"""SELECT request_id, imp_id, imp_banner_w, imp_banner_h, imp_bidfloor,
            CASE imp_bidfloorcur WHEN 'EUR' THEN imp_bidfloor * 1.08e0 WHEN 'GBP' THEN imp_bidfloor * 1.25e0
                WHEN 'JPY' THEN imp_bidfloor * 0.0067e0 ELSE imp_bidfloor END AS imp_bidfloor_usd,
            imp_bidfloorcur,
            CASE WHEN traffic = 'site' THEN place_id END AS site_id, CASE WHEN traffic = 'site' THEN place END AS site_domain,
            CASE WHEN traffic = 'app' THEN place_id END AS app_id, CASE WHEN traffic = 'app' THEN place END AS app_bundle,
            publisher_id, device_type, device_os, ip AS device_ip, country AS device_geo_country, region AS device_geo_region,
            CASE WHEN device_type = 7 THEN 'CTV' WHEN device_type IN (1, 4) AND traffic = 'app' THEN 'Mobile App'
                WHEN device_type IN (1, 4) AND traffic = 'site' THEN 'Mobile Web'
                WHEN device_type = 2 THEN 'Desktop' ELSE 'Unknown' END AS device_category,
            user_id, auction_type, currency, is_coppa, is_gdpr,
            CASE WHEN publisher_id < 0 THEN true ELSE false END AS is_test_traffic,
            CASE WHEN {_private('ip')} THEN true ELSE false END AS is_private_ip,
            event_ts AS event_timestamp, received_at
        FROM slot""",
        ["slot"],
    ),
    "dq_rejected_events": (
        f"""SELECT request_id, imp_id, publisher_id, ip AS device_ip,
            CASE WHEN publisher_id < 0 THEN 'TEST_PUBLISHER' WHEN {_private('ip')} THEN 'PRIVATE_IP'
                WHEN imp_bidfloor <= 0 THEN 'NON_POSITIVE_BIDFLOOR' ELSE 'UNKNOWN' END AS reject_reason,
            event_ts AS event_timestamp
        FROM slot WHERE publisher_id < 0 OR {_private('ip')} OR imp_bidfloor <= 0""",
        ["slot"],
    ),
    "bid_responses": (
        f"""SELECT response_id, request_id, seat, bid_id, '1' AS imp_id, bid_price, creative_id, deal_id,
            CASE WHEN ln <> 7 THEN concat('adv', CAST(advertiser_id AS VARCHAR), '.example') END AS ad_domain,
            campaign_id, line_item_id, strategy_id, advertiser_id,
            CAST((advertiser_id - 1) % 5 + 1 AS INTEGER) AS agency_id, 'USD' AS currency,
            make_timestamp({RESPONSE_US}) AS event_timestamp
        FROM (SELECT *, CAST((campaign_id - 1) % 20 + 1 AS INTEGER) AS advertiser_id
            FROM (SELECT *, CAST((line_item_id - 1) % 60 + 1 AS INTEGER) AS campaign_id
            FROM (SELECT *, CAST((strategy_id - 1) % 120 + 1 AS INTEGER) AS line_item_id
            FROM (SELECT *, CAST((creative_id * 7) % 180 + 1 AS INTEGER) AS strategy_id
            FROM (SELECT l_orderkey AS k, l_linenumber AS ln, concat('r', CAST(l_orderkey AS VARCHAR)) AS response_id,
                CAST(l_orderkey AS VARCHAR) AS request_id, CAST(l_suppkey % 5 + 1 AS INTEGER) AS seat,
                concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS bid_id,
                floor(l_extendedprice / 100) / 100.0e0 AS bid_price, CAST(l_partkey % 50 + 1 AS INTEGER) AS creative_id,
                CAST(CASE WHEN l_orderkey % 3 = 0 THEN l_orderkey % 19 + 1 END AS INTEGER) AS deal_id
            FROM lineitem WHERE l_orderkey % 5 < 3) a) b) c) d) e
        JOIN (SELECT 0 AS c UNION ALL SELECT 1) t ON c = 0 OR k % 25 = 4""",
        [],
    ),
    "ev_response": (
        f"""SELECT concat('r', CAST(k AS VARCHAR)) AS response_id, CAST(k AS VARCHAR) AS request_id,
            make_timestamp({RESPONSE_US}) AS event_ts
        FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey % 5 < 3) o
        JOIN (SELECT 0 AS c UNION ALL SELECT 1) t ON c = 0 OR k % 25 = 4""",
        [],
    ),
    "won": (
        f"""SELECT k, ln, concat('i', CAST(k AS VARCHAR), '-', CAST(ln AS VARCHAR)) AS impression_id,
            CAST(k AS VARCHAR) AS request_id, concat('r', CAST(k AS VARCHAR)) AS response_id, '1' AS imp_id,
            CAST((k + ln) % 6 + 1 AS INTEGER) AS bidder_id, ((k * 37 + ln * 101) % 900 + 10) / 100.0e0 AS win_price,
            'USD' AS win_currency, CAST((k * 3 + ln) % 50 + 1 AS INTEGER) AS creative_id,
            concat('adv', CAST((k * 3 + ln) % 20 AS VARCHAR), '.example') AS ad_domain,
            make_timestamp({IMPRESSION_US}) AS event_timestamp
        FROM (SELECT l_orderkey AS k, l_linenumber AS ln FROM lineitem
            WHERE l_orderkey % 5 < 3 AND l_orderkey % 4 < 2 AND l_linenumber % 3 = 1) l""",
        [],
    ),
    "impressions": (
        """SELECT impression_id, request_id, response_id, imp_id, bidder_id, win_price, win_currency, creative_id,
            ad_domain, event_timestamp
        FROM won JOIN (SELECT 0 AS c UNION ALL SELECT 1) t ON c = 0 OR k % 15 = 6""",
        ["won"],
    ),
    "clicks": (
        f"""SELECT concat('c', substr(impression_id, 2), '-', CAST(j AS VARCHAR)) AS click_id, request_id, impression_id,
            imp_id, bidder_id, creative_id, concat('https://land.example/', CAST(creative_id AS VARCHAR)) AS click_url,
            make_timestamp({CLICK_US}) AS event_timestamp
        FROM won
        JOIN (SELECT 0 AS j UNION ALL SELECT 1) u ON j = 0 OR (k + ln) % 9 = 0
        JOIN (SELECT 0 AS c UNION ALL SELECT 1) t ON c = 0 OR k % 10 = 0
        WHERE (k + ln) % 3 = 0""",
        ["won"],
    ),
    "dim_publisher": (
        """SELECT n + 1 AS publisher_id, publisher_name, concat('pub', CAST(n AS VARCHAR), '.example') AS domain,
            CASE n % 4 WHEN 0 THEN 'News' WHEN 1 THEN 'Sports' WHEN 2 THEN 'Tech' ELSE 'Travel' END AS vertical,
            tier, valid_from, valid_to, is_current
        FROM (SELECT n_nationkey AS n, concat(n_name, ' Media') AS publisher_name,
                CASE n_nationkey % 3 WHEN 0 THEN 'premium' WHEN 1 THEN 'mid-tier' ELSE 'long-tail' END AS tier,
                TIMESTAMP '2020-01-01' AS valid_from,
                CASE WHEN n_nationkey % 3 = 0 THEN TIMESTAMP '2024-01-02' END AS valid_to,
                n_nationkey % 3 <> 0 AND n_nationkey <> 23 AS is_current FROM nation
            UNION ALL SELECT n_nationkey, concat(n_name, ' Media v2'), 'premium', TIMESTAMP '2024-01-02', NULL, true
            FROM nation WHERE n_nationkey % 3 = 0) p""",
        [],
    ),
    "dim_geo": (
        f"""SELECT CAST(n_nationkey * 4 + r + 1 AS INTEGER) AS geo_key, n_name AS country_code, concat('Country ', n_name) AS country_name,
            concat('R', CAST(r AS VARCHAR)) AS region_code, concat(n_name, ' region ', CAST(r AS VARCHAR)) AS region_name,
            'UTC' AS timezone, {_SCD}
        FROM nation JOIN (SELECT 0 AS r UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3) t ON true""",
        [],
    ),
    "dim_agency": (
        f"""SELECT CAST(s_suppkey % 5 + 1 AS INTEGER) AS agency_id, min(s_name) AS agency_name,
            concat('Group ', min(s_name)) AS holding_company, 'Paris' AS headquarters, {_SCD} FROM supplier GROUP BY 1""",
        [],
    ),
    "dim_advertiser": (
        f"""SELECT id AS advertiser_id, (id - 1) % 5 + 1 AS agency_id, name AS advertiser_name,
            concat('Industry ', CAST(id % 6 AS VARCHAR)) AS industry,
            concat('adv', CAST(id AS VARCHAR), '.example') AS domain, {_SCD}
        FROM (SELECT CAST(s_suppkey % 20 + 1 AS INTEGER) AS id, min(s_name) AS name FROM supplier GROUP BY 1) t""",
        [],
    ),
    "dim_campaign": (
        f"""SELECT id AS campaign_id, (id - 1) % 20 + 1 AS advertiser_id, name AS campaign_name,
            CASE id % 2 WHEN 0 THEN 'awareness' ELSE 'conversion' END AS objective,
            '2024-01-01' AS start_date, '2024-12-31' AS end_date, {_SCD}
        FROM (SELECT CAST(p_partkey % 60 + 1 AS INTEGER) AS id, min(p_name) AS name FROM part GROUP BY 1) t""",
        [],
    ),
    "dim_line_item": (
        f"""SELECT id AS line_item_id, (id - 1) % 60 + 1 AS campaign_id, name AS line_item_name, id * 100.0e0 AS budget,
            CASE id % 2 WHEN 0 THEN 'max_clicks' ELSE 'target_cpa' END AS bid_strategy, {_SCD}
        FROM (SELECT CAST(p_partkey % 120 + 1 AS INTEGER) AS id, min(p_name) AS name FROM part GROUP BY 1) t""",
        [],
    ),
    "dim_strategy": (
        f"""SELECT id AS strategy_id, (id - 1) % 120 + 1 AS line_item_id, name AS strategy_name,
            CASE id % 2 WHEN 0 THEN 'contextual' ELSE 'behavioral' END AS targeting_type,
            CASE id % 3 WHEN 0 THEN 'display' WHEN 1 THEN 'video' ELSE 'mobile' END AS channel, {_SCD}
        FROM (SELECT CAST(p_partkey % 180 + 1 AS INTEGER) AS id, min(p_name) AS name FROM part GROUP BY 1) t""",
        [],
    ),
    "dim_creative": (
        f"""SELECT id AS creative_id, id * 7 % 180 + 1 AS strategy_id, name AS creative_name,
            CASE id % 2 WHEN 0 THEN 'banner' ELSE 'native' END AS format, 300 AS width, 250 AS height,
            concat('https://land.example/', CAST(id AS VARCHAR)) AS landing_page_url, {_SCD}
        FROM (SELECT CAST(p_partkey % 50 + 1 AS INTEGER) AS id, min(p_name) AS name FROM part GROUP BY 1) t""",
        [],
    ),
    "dim_bidder": (
        f"""SELECT id AS bidder_id, name AS bidder_name, concat('bidder', CAST(id AS VARCHAR), '.example') AS domain,
            id AS exchange_seat, 'EU' AS region, {_SCD}
        FROM (SELECT CAST(s_suppkey % 5 + 1 AS INTEGER) AS id, min(s_name) AS name FROM supplier GROUP BY 1) t""",
        [],
    ),
    "dim_deal": (
        f"""SELECT id AS deal_id, name AS deal_name,
            CASE id % 2 WHEN 0 THEN 'preferred' ELSE 'private_auction' END AS deal_type, id / 10.0e0 AS floor_price,
            id % 5 + 1 AS buyer_seat, id AS seller_id, {_SCD}
        FROM (SELECT CAST(p_partkey % 18 + 1 AS INTEGER) AS id, min(p_name) AS name FROM part GROUP BY 1) t""",
        [],
    ),
    "dim_device_type": (
        f"""SELECT *, {_SCD} FROM (VALUES (1, 'Mobile/Tablet', 'tablet', true), (2, 'Personal Computer', 'desktop', false),
            (4, 'Phone', 'phone', true), (7, 'Set Top Box', 'stb', false))
            t(device_type_code, device_type_name, form_factor, is_mobile)""",
        [],
    ),
    "dim_device_os": (
        f"""SELECT *, {_SCD} FROM (VALUES ('iOS', 'Apple', 'Darwin'), ('Android', 'Google', 'Linux'),
            ('Windows', 'Microsoft', 'NT')) t(os_name, os_vendor, os_family)""",
        [],
    ),
    "hourly_impressions_by_geo": (
        """SELECT date_trunc('hour', i.event_ts) AS window_start, device_geo_country, count(*) AS impression_count,
            sum(win_price) AS total_revenue, avg(win_price) AS avg_win_price
        FROM (SELECT impression_id, request_id, max(win_price) AS win_price, max(event_timestamp) AS event_ts
            FROM impressions GROUP BY 1, 2) i
        JOIN (SELECT request_id, min(country) AS device_geo_country, max(event_ts) AS event_ts FROM ev_request GROUP BY 1) r
            ON i.request_id = r.request_id
            AND r.event_ts BETWEEN i.event_ts - INTERVAL 10 SECOND AND i.event_ts
        GROUP BY 1, 2""",
        ["impressions", "ev_request"],
    ),
    "rolling_metrics_by_bidder": (
        """SELECT date_trunc('minute', event_ts) - h * INTERVAL 1 MINUTE AS window_start,
            date_trunc('minute', event_ts) + (5 - h) * INTERVAL 1 MINUTE AS window_end, bidder_id,
            count(*) AS win_count, sum(win_price) AS revenue, avg(win_price) AS avg_cpm
        FROM (SELECT impression_id, bidder_id, max(win_price) AS win_price, max(event_timestamp) AS event_ts
            FROM impressions GROUP BY 1, 2) i
        JOIN (SELECT 0 AS h UNION ALL SELECT 1 UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) t ON true
        GROUP BY 1, 2, 3""",
        ["impressions"],
    ),
    "dq_counts": (
        f"""SELECT w.window_start, coalesce(tr, 0) AS tr, coalesce(ur, 0) AS ur, coalesce(tp, 0) AS tp, coalesce(up, 0) AS up,
            coalesce(tw, 0) AS tw, coalesce(uw, 0) AS uw, coalesce(tc, 0) AS tc, coalesce(uc, 0) AS uc,
            coalesce(inv, 0) AS inv
        FROM (SELECT date_trunc('hour', event_ts) AS window_start FROM ev_request
            UNION SELECT date_trunc('hour', event_ts) FROM ev_response
            UNION SELECT date_trunc('hour', event_timestamp) FROM impressions
            UNION SELECT date_trunc('hour', event_timestamp) FROM clicks) w
        LEFT JOIN (SELECT date_trunc('hour', event_ts) AS h, count(*) AS tr, count(DISTINCT request_id) AS ur FROM ev_request GROUP BY 1) a ON a.h = w.window_start
        LEFT JOIN (SELECT date_trunc('hour', event_ts) AS h, count(*) AS tp, count(DISTINCT response_id) AS up FROM ev_response GROUP BY 1) b ON b.h = w.window_start
        LEFT JOIN (SELECT date_trunc('hour', event_timestamp) AS h, count(*) AS tw, count(DISTINCT impression_id) AS uw FROM impressions GROUP BY 1) c ON c.h = w.window_start
        LEFT JOIN (SELECT date_trunc('hour', event_timestamp) AS h, count(*) AS tc, count(DISTINCT click_id) AS uc FROM clicks GROUP BY 1) d ON d.h = w.window_start
        LEFT JOIN (SELECT date_trunc('hour', event_ts) AS h,
                count(DISTINCT CASE WHEN publisher_id < 0 OR {_private('ip')} OR imp_bidfloor <= 0 THEN request_id END) AS inv
            FROM slot GROUP BY 1) e ON e.h = w.window_start""",
        ["ev_request", "ev_response", "impressions", "clicks", "slot"],
    ),
    "dq_event_quality_hourly": (
        f"""SELECT window_start, tr AS total_bid_requests, ur AS unique_bid_requests, tr - ur AS duplicate_bid_requests,
            {_rate('(tr - ur)', 'tr')} AS duplicate_bid_request_rate,
            tp AS total_bid_responses, up AS unique_bid_responses, tp - up AS duplicate_bid_responses,
            {_rate('(tp - up)', 'tp')} AS duplicate_bid_response_rate,
            tw AS total_wins, uw AS unique_wins, tw - uw AS duplicate_wins, {_rate('(tw - uw)', 'tw')} AS duplicate_win_rate,
            tc AS total_clicks, uc AS unique_clicks, tc - uc AS duplicate_clicks, {_rate('(tc - uc)', 'tc')} AS duplicate_click_rate,
            inv AS invalid_bid_requests, {_rate('inv', 'tr')} AS invalid_bid_request_rate,
            tr + tp + tw + tc AS total_events_all, tr - ur + tp - up + tw - uw + tc - uc AS duplicate_events_all,
            {_rate('(tr - ur + tp - up + tw - uw + tc - uc)', '(tr + tp + tw + tc)')} AS duplicate_rate_all
        FROM dq_counts""",
        ["dq_counts"],
    ),
    "bid_landscape_hourly": (
        f"""SELECT date_trunc('hour', b.event_ts) AS window_start, coalesce(publisher_id, 0) AS publisher_id,
            count(DISTINCT b.request_id) AS request_count, count(*) AS total_bids,
            {_rate('count(*)', 'count(DISTINCT b.request_id)')} AS bids_per_request,
            avg(bid_price) AS avg_bid_price, max(bid_price) AS max_bid_price
        FROM (SELECT bid_id, request_id, max(bid_price) AS bid_price, max(event_timestamp) AS event_ts
            FROM bid_responses GROUP BY 1, 2) b
        LEFT JOIN ev_request r ON r.request_id = b.request_id
            AND r.event_ts BETWEEN b.event_ts - INTERVAL 10 SECOND AND b.event_ts + INTERVAL 5 SECOND
        GROUP BY 1, 2""",
        ["bid_responses", "ev_request"],
    ),
    "realtime_serving_metrics_1m": (
        f"""SELECT date_trunc('minute', i.event_ts) AS window_start, bidder_id, count(*) AS impressions,
            count(DISTINCT click_id) AS clicks, sum(win_price) AS revenue, {_rate('count(DISTINCT click_id)', 'count(*)')} AS ctr
        FROM (SELECT impression_id, bidder_id, max(win_price) AS win_price, max(event_timestamp) AS event_ts
            FROM impressions GROUP BY 1, 2) i
        LEFT JOIN (SELECT click_id, impression_id, max(event_timestamp) AS event_ts FROM clicks GROUP BY 1, 2) c
            ON c.impression_id = i.impression_id
            AND c.event_ts BETWEEN i.event_ts AND i.event_ts + INTERVAL 60 SECOND
        GROUP BY 1, 2""",
        ["impressions", "clicks"],
    ),
    "timed_chain": (
        """SELECT q.request_id, q.publisher_id, q.event_ts, p.response_id, i.impression_id, c.click_id
        FROM ev_request q
        LEFT JOIN ev_response p ON p.request_id = q.request_id
            AND p.event_ts BETWEEN q.event_ts AND q.event_ts + INTERVAL 5 SECOND
        LEFT JOIN impressions i ON i.response_id = p.response_id
            AND i.event_timestamp BETWEEN p.event_ts AND p.event_ts + INTERVAL 10 SECOND
        LEFT JOIN clicks c ON c.impression_id = i.impression_id
            AND c.event_timestamp BETWEEN i.event_timestamp AND i.event_timestamp + INTERVAL 60 SECOND""",
        ["ev_request", "ev_response", "impressions", "clicks"],
    ),
    "hourly_funnel_by_publisher": (
        f"""SELECT date_trunc('hour', event_ts) AS window_start, publisher_id, count(DISTINCT request_id) AS bid_requests,
            count(DISTINCT response_id) AS bid_responses, count(DISTINCT impression_id) AS impressions,
            count(DISTINCT click_id) AS clicks,
            {_rate('count(DISTINCT response_id)', 'count(DISTINCT request_id)')} AS fill_rate,
            {_rate('count(DISTINCT impression_id)', 'count(DISTINCT response_id)')} AS win_rate,
            {_rate('count(DISTINCT click_id)', 'count(DISTINCT impression_id)')} AS ctr
        FROM timed_chain GROUP BY 1, 2""",
        ["timed_chain"],
    ),
    "funnel_leakage_hourly": (
        f"""SELECT window_start, publisher_id, bid_requests - bid_responses AS requests_no_response,
            bid_responses - impressions AS responses_no_impression, impressions - clicks AS impressions_no_click,
            {_rate('(bid_requests - bid_responses)', 'bid_requests')} AS response_leakage_rate,
            {_rate('(bid_responses - impressions)', 'bid_responses')} AS impression_leakage_rate,
            {_rate('(impressions - clicks)', 'impressions')} AS click_leakage_rate
        FROM hourly_funnel_by_publisher""",
        ["hourly_funnel_by_publisher"],
    ),
    "id_chain": (
        """SELECT br.request_id, br.publisher_id, br.event_timestamp, resp.response_id, imp.impression_id, cl.click_id,
            dp.publisher_name, dp.vertical, dp.tier
        FROM bid_requests br
        LEFT JOIN bid_responses resp ON br.request_id = resp.request_id
        LEFT JOIN impressions imp ON resp.response_id = imp.response_id
        LEFT JOIN clicks cl ON imp.impression_id = cl.impression_id
        LEFT JOIN dim_publisher dp ON br.publisher_id = dp.publisher_id AND dp.is_current""",
        ["bid_requests", "bid_responses", "impressions", "clicks", "dim_publisher"],
    ),
}


def with_ctes(body: str, *needs: str) -> str:
    """Prefix a query with the expressions it needs, in dependency order."""
    order: list[str] = []

    def add(name: str) -> None:
        for other in CTES[name][1]:
            add(other)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + body


# The columns of each aggregate as compared: money sums to the cent, means to six digits.
COMPARED = {
    "hourly_impressions_by_geo": "window_start, device_geo_country, impression_count, round(total_revenue, 2) AS total_revenue, round(avg_win_price + 1e-9, 6) AS avg_win_price",
    "rolling_metrics_by_bidder": "window_start, window_end, bidder_id, win_count, round(revenue, 2) AS revenue, round(avg_cpm + 1e-9, 6) AS avg_cpm",
    "bid_landscape_hourly": "window_start, publisher_id, request_count, total_bids, bids_per_request, round(avg_bid_price + 1e-9, 6) AS avg_bid_price, max_bid_price",
    "realtime_serving_metrics_1m": "window_start, bidder_id, impressions, clicks, round(revenue, 2) AS revenue, ctr",
}

_BID_DIM_JOINS = """
        LEFT JOIN dim_bidder dbid ON resp.seat = dbid.bidder_id AND dbid.is_current
        LEFT JOIN dim_creative dc ON resp.creative_id = dc.creative_id AND dc.is_current
        LEFT JOIN dim_strategy ds ON resp.strategy_id = ds.strategy_id AND ds.is_current
        LEFT JOIN dim_line_item dl ON resp.line_item_id = dl.line_item_id AND dl.is_current
        LEFT JOIN dim_campaign dcmp ON resp.campaign_id = dcmp.campaign_id AND dcmp.is_current
        LEFT JOIN dim_advertiser da ON resp.advertiser_id = da.advertiser_id AND da.is_current
        LEFT JOIN dim_agency dag ON resp.agency_id = dag.agency_id AND dag.is_current
        LEFT JOIN dim_deal dd ON resp.deal_id = dd.deal_id AND dd.is_current"""
_BID_DIMS = [
    "dim_bidder",
    "dim_creative",
    "dim_strategy",
    "dim_line_item",
    "dim_campaign",
    "dim_advertiser",
    "dim_agency",
    "dim_deal",
]
_REQUEST_DIM_JOINS = """
        LEFT JOIN dim_publisher dp ON br.publisher_id = dp.publisher_id AND dp.is_current
        LEFT JOIN dim_device_type ddt ON br.device_type = ddt.device_type_code AND ddt.is_current
        LEFT JOIN dim_device_os dos ON br.device_os = dos.os_name AND dos.is_current
        LEFT JOIN dim_geo dg ON br.device_geo_country = dg.country_code AND br.device_geo_region = dg.region_code AND dg.is_current"""
_REQUEST_DIMS = ["dim_publisher", "dim_device_type", "dim_device_os", "dim_geo"]


def _views() -> dict[str, str]:
    out = {}
    out["v_event_enriched_bid_requests"] = with_ctes(
        f"""SELECT br.request_id, imp_id, imp_banner_w, imp_banner_h, imp_bidfloor, site_id, site_domain, br.publisher_id,
            publisher_name, vertical AS publisher_vertical, tier AS publisher_tier, device_type, device_type_name,
            form_factor, is_mobile, device_os, os_vendor, device_geo_country, device_geo_region, country_name,
            region_name, timezone, user_id, auction_type, tmax, currency, is_coppa, is_gdpr, event_timestamp, received_at
        FROM bid_requests br {_REQUEST_DIM_JOINS}""",
        "bid_requests",
        *_REQUEST_DIMS,
    )
    out["v_event_enriched_bid_responses"] = with_ctes(
        f"""SELECT response_id, request_id, seat, bidder_name, bid_id, imp_id, bid_price, resp.creative_id, creative_name,
            dc.format AS creative_format, dc.width AS creative_width, dc.height AS creative_height, resp.strategy_id,
            strategy_name, targeting_type, channel, resp.line_item_id, line_item_name, budget, bid_strategy,
            resp.campaign_id, campaign_name, objective AS campaign_objective, resp.advertiser_id, advertiser_name,
            industry, resp.agency_id, agency_name, holding_company, resp.deal_id, deal_name, deal_type,
            floor_price AS deal_floor_price, ad_domain, currency, event_timestamp
        FROM bid_responses resp {_BID_DIM_JOINS}""",
        "bid_responses",
        *_BID_DIMS,
    )
    for table, own in (
        ("impressions", "impression_id, request_id, response_id, imp_id, win_price, win_currency, ad_domain"),
        ("clicks", "click_id, request_id, impression_id, imp_id, click_url"),
    ):
        out[f"v_event_enriched_{table}"] = with_ctes(
            f"""SELECT {own}, f.bidder_id, bidder_name, f.creative_id, creative_name, dc.format AS creative_format,
                event_timestamp
            FROM {table} f LEFT JOIN dim_bidder d ON f.bidder_id = d.bidder_id AND d.is_current
            LEFT JOIN dim_creative dc ON f.creative_id = dc.creative_id AND dc.is_current""",
            table,
            "dim_bidder",
            "dim_creative",
        )
    out["v_event_enriched_full_funnel"] = with_ctes(
        f"""SELECT br.request_id, br.imp_id, br.imp_banner_w, br.imp_banner_h, br.imp_bidfloor, br.site_id, br.site_domain,
            br.publisher_id, publisher_name, vertical AS publisher_vertical, tier AS publisher_tier, br.device_type,
            device_type_name, is_mobile, br.device_os, os_vendor, br.device_geo_country, br.device_geo_region,
            country_name, region_name, br.user_id, br.auction_type, br.currency, br.is_coppa, br.is_gdpr,
            br.event_timestamp AS request_timestamp, resp.response_id, resp.seat, bidder_name, resp.bid_price,
            resp.creative_id, creative_name, dc.format AS creative_format, resp.strategy_id, strategy_name,
            targeting_type, resp.line_item_id, line_item_name, resp.campaign_id, campaign_name,
            objective AS campaign_objective, resp.advertiser_id, advertiser_name, industry, resp.agency_id, agency_name,
            holding_company, resp.deal_id, deal_name, deal_type, resp.ad_domain,
            resp.event_timestamp AS response_timestamp, imp.impression_id, imp.win_price, imp.win_currency,
            imp.event_timestamp AS impression_timestamp, cl.click_id, cl.click_url,
            cl.event_timestamp AS click_timestamp, resp.response_id IS NOT NULL AS has_response,
            imp.impression_id IS NOT NULL AS has_impression, cl.click_id IS NOT NULL AS has_click
        FROM bid_requests br
        LEFT JOIN bid_responses resp ON br.request_id = resp.request_id
        LEFT JOIN impressions imp ON resp.response_id = imp.response_id
        LEFT JOIN clicks cl ON imp.impression_id = cl.impression_id {_REQUEST_DIM_JOINS} {_BID_DIM_JOINS}""",
        "bid_requests",
        "bid_responses",
        "impressions",
        "clicks",
        *_REQUEST_DIMS,
        *_BID_DIMS,
    )
    out["v_agg_metrics_by_bidder"] = with_ctes(
        f"""SELECT date_trunc('hour', event_timestamp) AS hour_start, i.bidder_id, bidder_name, domain AS bidder_domain,
            count(*) AS win_count, round(sum(win_price), 2) AS revenue, {_avg('win_price')} AS avg_cpm
        FROM impressions i LEFT JOIN dim_bidder d ON i.bidder_id = d.bidder_id AND d.is_current GROUP BY 1, 2, 3, 4""",
        "impressions",
        "dim_bidder",
    )
    out["v_agg_bid_landscape"] = with_ctes(
        f"""SELECT date_trunc('hour', resp.event_timestamp) AS hour_start, br.publisher_id, publisher_name,
            vertical AS publisher_vertical, count(DISTINCT resp.request_id) AS request_count, count(*) AS total_bids,
            {_rate('count(*)', 'count(DISTINCT resp.request_id)')} AS bids_per_request,
            {_avg('bid_price')} AS avg_bid_price, max(bid_price) AS max_bid_price
        FROM bid_responses resp LEFT JOIN bid_requests br ON resp.request_id = br.request_id
        LEFT JOIN dim_publisher dp ON br.publisher_id = dp.publisher_id AND dp.is_current GROUP BY 1, 2, 3, 4""",
        "bid_responses",
        "bid_requests",
        "dim_publisher",
    )
    out["v_agg_serving_metrics"] = with_ctes(
        f"""SELECT date_trunc('hour', i.event_timestamp) AS hour_start, i.bidder_id, bidder_name, count(*) AS impressions,
            CAST(coalesce(sum(click_count), 0) AS BIGINT) AS clicks, round(sum(win_price), 2) AS revenue,
            {_rate('coalesce(sum(click_count), 0)', 'count(*)')} AS ctr
        FROM impressions i
        LEFT JOIN (SELECT impression_id, count(*) AS click_count FROM clicks GROUP BY 1) c ON i.impression_id = c.impression_id
        LEFT JOIN dim_bidder d ON i.bidder_id = d.bidder_id AND d.is_current GROUP BY 1, 2, 3""",
        "impressions",
        "clicks",
        "dim_bidder",
    )
    n_req, n_resp = "count(DISTINCT request_id)", "count(DISTINCT response_id)"
    n_imp, n_clk = "count(DISTINCT impression_id)", "count(DISTINCT click_id)"
    out["v_agg_funnel_by_publisher"] = with_ctes(
        f"""SELECT date_trunc('hour', event_timestamp) AS hour_start, publisher_id, publisher_name,
            vertical AS publisher_vertical, tier AS publisher_tier, {n_req} AS bid_requests, {n_resp} AS bid_responses,
            {n_imp} AS impressions, {n_clk} AS clicks, {_rate(n_resp, n_req)} AS fill_rate,
            {_rate(n_imp, n_resp)} AS win_rate, {_rate(n_clk, n_imp)} AS ctr
        FROM id_chain GROUP BY 1, 2, 3, 4, 5""",
        "id_chain",
    )
    out["v_agg_funnel_leakage"] = with_ctes(
        f"""SELECT date_trunc('hour', event_timestamp) AS hour_start, publisher_id, publisher_name,
            vertical AS publisher_vertical, {n_req} - {n_resp} AS requests_no_response,
            {n_resp} - {n_imp} AS responses_no_impression, {n_imp} - {n_clk} AS impressions_no_click,
            {_rate(f'({n_req} - {n_resp})', n_req)} AS response_leakage_rate,
            {_rate(f'({n_resp} - {n_imp})', n_resp)} AS impression_leakage_rate,
            {_rate(f'({n_imp} - {n_clk})', n_imp)} AS click_leakage_rate
        FROM id_chain GROUP BY 1, 2, 3, 4""",
        "id_chain",
    )
    out["v_agg_impressions_by_geo"] = with_ctes(
        f"""SELECT date_trunc('hour', imp.event_timestamp) AS hour_start, br.device_geo_country, dg.country_name,
            count(*) AS impression_count, round(sum(imp.win_price), 2) AS total_revenue,
            {_avg('imp.win_price')} AS avg_win_price
        FROM impressions imp LEFT JOIN bid_requests br ON imp.request_id = br.request_id
        LEFT JOIN (SELECT country_code, max(country_name) AS country_name FROM dim_geo WHERE is_current GROUP BY 1) dg
            ON br.device_geo_country = dg.country_code
        GROUP BY 1, 2, 3""",
        "impressions",
        "bid_requests",
        "dim_geo",
    )
    publisher = "LEFT JOIN dim_publisher d ON a.publisher_id = d.publisher_id AND d.is_current"
    bidder = "LEFT JOIN dim_bidder d ON a.bidder_id = d.bidder_id AND d.is_current"
    for name, table, columns, join in (
        (
            "hourly_funnel_by_publisher",
            "hourly_funnel_by_publisher",
            "publisher_name, vertical AS publisher_vertical, tier AS publisher_tier",
            publisher,
        ),
        (
            "rolling_metrics_by_bidder",
            "rolling_metrics_by_bidder",
            "bidder_name, domain AS bidder_domain",
            bidder,
        ),
        (
            "bid_landscape_hourly",
            "bid_landscape_hourly",
            "publisher_name, vertical AS publisher_vertical",
            publisher,
        ),
        ("serving_metrics_1m", "realtime_serving_metrics_1m", "bidder_name", bidder),
    ):
        own = COMPARED.get(table, "*")
        out[f"v_realtime_agg_{name}"] = with_ctes(
            f"SELECT a.*, {columns} FROM (SELECT {own} FROM {table}) a {join}",
            table,
            "dim_publisher" if join is publisher else "dim_bidder",
        )
    return out


def _reports() -> dict[str, str]:
    pct = "round(CAST({0} AS DOUBLE) / {1} * 100, 2)"
    return {
        "q01": with_ctes(
            "SELECT device_geo_country, count(*) AS request_count FROM bid_requests GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
            "bid_requests",
        ),
        "q02": with_ctes(
            f"""SELECT device_geo_country, device_geo_region, {_avg('imp_bidfloor', 4)} AS avg_bidfloor, count(*) AS request_count
            FROM bid_requests GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
            "bid_requests",
        ),
        "q03": with_ctes(
            f"""SELECT imp_banner_w, imp_banner_h, round(min(imp_bidfloor) + 1e-9, 4) AS min_floor,
                {_avg('imp_bidfloor', 4)} AS avg_floor, round(max(imp_bidfloor) + 1e-9, 4) AS max_floor,
                count(*) AS request_count
            FROM bid_requests GROUP BY 1, 2 ORDER BY 6 DESC, 1, 2 LIMIT 10""",
            "bid_requests",
        ),
        "q04": with_ctes(
            "SELECT device_os, device_type, count(*) AS request_count FROM bid_requests GROUP BY 1, 2", "bid_requests"
        ),
        "q05": with_ctes(
            """SELECT date_trunc('hour', event_timestamp) AS hour, count(*) AS request_count FROM bid_requests
            GROUP BY 1 ORDER BY 1 DESC LIMIT 24""",
            "bid_requests",
        ),
        "q06": with_ctes(
            """SELECT auction_type, CASE auction_type WHEN 1 THEN 'First Price' WHEN 2 THEN 'Second Price'
                ELSE 'Other' END AS auction_name, count(*) AS request_count
            FROM bid_requests GROUP BY 1""",
            "bid_requests",
        ),
        "q07": with_ctes(
            "SELECT is_gdpr, is_coppa, count(*) AS request_count FROM bid_requests GROUP BY 1, 2", "bid_requests"
        ),
        "q09": with_ctes(
            f"""SELECT br.device_geo_country, count(br.request_id) AS requests, count(resp.request_id) AS responses,
                {pct.format('count(resp.request_id)', 'count(br.request_id)')} AS fill_rate_pct
            FROM bid_requests br LEFT JOIN bid_responses resp ON br.request_id = resp.request_id
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
            "bid_requests",
            "bid_responses",
        ),
        "q10": with_ctes(
            f"""SELECT resp.seat AS bidder, count(resp.response_id) AS bids, count(imp.impression_id) AS wins,
                {pct.format('count(imp.impression_id)', 'count(resp.response_id)')} AS win_rate_pct
            FROM bid_responses resp LEFT JOIN impressions imp ON resp.response_id = imp.response_id GROUP BY 1""",
            "bid_responses",
            "impressions",
        ),
        "q11": with_ctes(
            f"""SELECT imp.creative_id, count(imp.impression_id) AS impressions, count(clk.click_id) AS clicks,
                {pct.format('count(clk.click_id)', 'count(imp.impression_id)')} AS ctr_pct
            FROM impressions imp LEFT JOIN clicks clk ON imp.impression_id = clk.impression_id
            GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
            "impressions",
            "clicks",
        ),
        "q12": with_ctes(
            f"""SELECT br.publisher_id, count(imp.impression_id) AS wins, round(sum(imp.win_price) + 1e-9, 2) AS total_revenue,
                {_avg('imp.win_price', 4)} AS avg_win_price
            FROM bid_requests br JOIN impressions imp ON br.request_id = imp.request_id
            GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
            "bid_requests",
            "impressions",
        ),
        "q13": with_ctes(
            f"""SELECT *, {pct.format('responses', 'nullif(requests, 0)')} AS fill_rate_pct,
                {pct.format('impressions', 'nullif(responses, 0)')} AS win_rate_pct,
                {pct.format('clicks', 'nullif(impressions, 0)')} AS ctr_pct
            FROM (SELECT count(DISTINCT br.request_id) AS requests, count(DISTINCT resp.request_id) AS responses,
                count(DISTINCT imp.impression_id) AS impressions, count(DISTINCT clk.click_id) AS clicks
            FROM bid_requests br LEFT JOIN bid_responses resp ON br.request_id = resp.request_id
            LEFT JOIN impressions imp ON br.request_id = imp.request_id
            LEFT JOIN clicks clk ON imp.impression_id = clk.impression_id) t""",
            "bid_requests",
            "bid_responses",
            "impressions",
            "clicks",
        ),
        "q14": with_ctes(
            f"""SELECT resp.seat AS bidder, {_avg('resp.bid_price', 4)} AS avg_bid_price,
                {_avg('imp.win_price', 4)} AS avg_win_price, {_avg('resp.bid_price - imp.win_price', 4)} AS avg_spread
            FROM bid_responses resp JOIN impressions imp ON resp.response_id = imp.response_id GROUP BY 1""",
            "bid_responses",
            "impressions",
        ),
        "q15": with_ctes(
            "SELECT reject_reason, count(*) AS rejected_count FROM dq_rejected_events GROUP BY 1", "dq_rejected_events"
        ),
        "q16": with_ctes(
            """SELECT window_start, total_bid_requests, duplicate_bid_requests, duplicate_bid_request_rate,
                total_bid_responses, duplicate_bid_responses, duplicate_bid_response_rate, total_wins, duplicate_wins,
                duplicate_win_rate, total_clicks, duplicate_clicks, duplicate_click_rate, invalid_bid_requests,
                invalid_bid_request_rate, total_events_all, duplicate_events_all, duplicate_rate_all
            FROM dq_event_quality_hourly ORDER BY 1 DESC LIMIT 24""",
            "dq_event_quality_hourly",
        ),
        "q17": with_ctes(
            f"""SELECT {COMPARED['bid_landscape_hourly']} FROM bid_landscape_hourly
            ORDER BY window_start DESC, total_bids DESC, publisher_id LIMIT 20""",
            "bid_landscape_hourly",
        ),
        "q18": with_ctes(
            f"""SELECT {COMPARED['realtime_serving_metrics_1m']} FROM realtime_serving_metrics_1m
            ORDER BY window_start DESC, round(realtime_serving_metrics_1m.revenue, 2) DESC, bidder_id LIMIT 30""",
            "realtime_serving_metrics_1m",
        ),
        "q19": with_ctes(
            """SELECT * FROM funnel_leakage_hourly
            ORDER BY window_start DESC, requests_no_response DESC, publisher_id NULLS FIRST LIMIT 20""",
            "funnel_leakage_hourly",
        ),
    }


def _charts() -> dict[str, str]:
    out = {}
    for name, table, key, counted, limit in (
        ("requests_by_country", "bid_requests", "device_geo_country", "request_id", 100),
        ("responses_by_seat", "bid_responses", "seat", "response_id", 100),
        ("impressions_by_bidder", "impressions", "bidder_id", "impression_id", 100),
        ("clicks_by_creative", "clicks", "creative_id", "click_id", 50),
        ("device_category", "bid_requests_enriched", "device_category", "request_id", 10),
        ("test_traffic", "bid_requests_enriched", "is_test_traffic", "request_id", 10),
    ):
        out[f"chart_{name}"] = with_ctes(
            f"SELECT {key}, count({counted}) AS event_count FROM {table} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {limit}", table
        )
    out["chart_revenue_by_country"] = with_ctes(
        """SELECT device_geo_country, round(sum(total_revenue), 2) AS total_revenue FROM hourly_impressions_by_geo
        GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
        "hourly_impressions_by_geo",
    )
    out["chart_rolling_by_bidder"] = with_ctes(
        """SELECT bidder_id, CAST(sum(win_count) AS BIGINT) AS win_count, round(sum(revenue), 2) AS revenue
        FROM rolling_metrics_by_bidder GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "rolling_metrics_by_bidder",
    )
    out["chart_funnel_by_publisher"] = with_ctes(
        """SELECT publisher_id, CAST(sum(clicks) AS BIGINT) AS clicks, CAST(sum(impressions) AS BIGINT) AS impressions,
            CAST(sum(bid_responses) AS BIGINT) AS bid_responses, CAST(sum(bid_requests) AS BIGINT) AS bid_requests
        FROM hourly_funnel_by_publisher GROUP BY 1 ORDER BY 4 DESC, 1 NULLS LAST LIMIT 20""",
        "hourly_funnel_by_publisher",
    )
    return out


def _aggregates() -> dict[str, str]:
    names = {
        "geo_hourly": "hourly_impressions_by_geo",
        "rolling_bidder": "rolling_metrics_by_bidder",
        "dq_hourly": "dq_event_quality_hourly",
        "landscape_hourly": "bid_landscape_hourly",
        "serving_1m": "realtime_serving_metrics_1m",
        "funnel_hourly": "hourly_funnel_by_publisher",
        "leakage_hourly": "funnel_leakage_hourly",
    }
    return {q: with_ctes(f"SELECT {COMPARED.get(t, '*')} FROM {t}", t) for q, t in names.items()}


def _dims() -> dict[str, str]:
    return {
        "scd2_current": with_ctes("SELECT * FROM dim_publisher WHERE is_current", "dim_publisher"),
        "scd2_asof": with_ctes(
            """SELECT i.impression_id, i.event_timestamp, r.publisher_id, publisher_name, tier
            FROM impressions i
            JOIN (SELECT DISTINCT request_id, publisher_id FROM ev_request) r ON i.request_id = r.request_id
            LEFT JOIN dim_publisher d ON r.publisher_id = d.publisher_id AND d.valid_from <= i.event_timestamp
                AND (d.valid_to IS NULL OR i.event_timestamp < d.valid_to)""",
            "impressions",
            "ev_request",
            "dim_publisher",
        ),
        "creative_path": with_ctes(
            """SELECT creative_id, s.strategy_id, l.line_item_id, c.campaign_id, a.advertiser_id, a.agency_id
            FROM dim_creative k JOIN dim_strategy s ON k.strategy_id = s.strategy_id
            JOIN dim_line_item l ON s.line_item_id = l.line_item_id JOIN dim_campaign c ON l.campaign_id = c.campaign_id
            JOIN dim_advertiser a ON c.advertiser_id = a.advertiser_id""",
            "dim_creative",
            "dim_strategy",
            "dim_line_item",
            "dim_campaign",
            "dim_advertiser",
        ),
    }


#: Impressions in three parts by event time, some a part late, and the watermark each part meets.
_LATE_ROWS = """WITH timed AS (SELECT *, epoch_us(event_timestamp) AS us FROM ({impressions})),
    span AS (SELECT min(us) AS lo, max(us) AS hi FROM timed),
    dealt AS (SELECT timed.*, least(CASE WHEN us >= lo + 2 * (hi - lo) // 3 THEN 2 WHEN us >= lo + (hi - lo) // 3 THEN 1
            ELSE 0 END + CASE WHEN impression_id LIKE '%7-%' THEN 1 ELSE 0 END, 2) AS part FROM timed, span),
    newest AS (SELECT p.part, max(d.us) AS us FROM (SELECT DISTINCT part FROM dealt) p JOIN dealt d ON d.part < p.part
        GROUP BY 1),
    judged AS (SELECT dealt.*, coalesce(dealt.us <= (newest.us // 1000 - 30000) * 1000, false) AS is_late
        FROM dealt LEFT JOIN newest ON dealt.part = newest.part)
    SELECT 'late' AS kind, date_trunc('minute', event_timestamp) AS window_start, bidder_id, count(*) AS n
    FROM judged WHERE is_late GROUP BY ALL
    UNION ALL
    SELECT 'window', date_trunc('minute', event_timestamp) - h * INTERVAL 1 MINUTE, bidder_id, count(*)
    FROM (SELECT DISTINCT impression_id, bidder_id, event_timestamp FROM judged WHERE NOT is_late)
        JOIN (SELECT unnest(range(5)) AS h) ON true GROUP BY ALL
    UNION ALL
    SELECT 'minute', window_start, bidder_id, impressions FROM ({serving})"""


def oracles() -> dict[str, str]:
    out = {}
    for table in (
        "bid_requests",
        "bid_requests_enriched",
        "dq_rejected_events",
        "bid_responses",
        "impressions",
        "clicks",
    ):
        columns = "*" if table != "bid_requests" else "* EXCLUDE (site_cat), array_to_string(site_cat, ',') AS site_cat"
        out[f"ingest_{table}"] = with_ctes(f"SELECT {columns} FROM {table}", table)
    out |= _aggregates() | _views() | _reports() | _charts() | _dims()
    # Streams and incremental tables must equal the batch result over all data.
    out |= {
        "stream_ingest": out["ingest_dq_rejected_events"],
        **{
            f"stream_ingest_{t}": out[f"ingest_{t}"]
            for t in ("bid_requests", "bid_requests_enriched", "bid_responses", "impressions", "clicks")
        },
        "stream_geo": out["geo_hourly"],
        "stream_quality": out["dq_hourly"],
        "stream_leakage": out["leakage_hourly"],
        "mat_bid_responses": out["v_event_enriched_bid_responses"],
        "mat_clicks": out["v_event_enriched_clicks"],
        "mat_agg_metrics_by_bidder": out["v_agg_metrics_by_bidder"],
        "mat_agg_funnel_by_publisher": out["v_agg_funnel_by_publisher"],
        "mat_agg_funnel_leakage": out["v_agg_funnel_leakage"],
        "mat_agg_impressions_by_geo": out["v_agg_impressions_by_geo"],
        "scd2_load": out["scd2_current"],
        "compaction": out["ingest_impressions"],
        "stored_funnel": out["v_agg_funnel_by_publisher"],
        "stored_leakage": out["v_agg_funnel_leakage"],
        "stream_rolling": out["rolling_bidder"],
        "stream_restart": out["rolling_bidder"],
        "stream_late_rows": _LATE_ROWS.format(impressions=out["ingest_impressions"], serving=out["serving_1m"]),
        "stream_funnel": out["funnel_hourly"],
        "stream_funnel_delta": out["funnel_hourly"],
        "stream_serving": out["serving_1m"],
        "stream_landscape": out["landscape_hourly"],
        "mat_append": out["v_event_enriched_bid_requests"],
        "mat_late_repair": out["v_agg_serving_metrics"],
        "mat_lookback_repair": out["v_event_enriched_impressions"],
        "mat_dim_repair": out["v_agg_bid_landscape"],
        "mat_funnel_repair": out["v_event_enriched_full_funnel"],
        "mat_indexed_repair": out["v_event_enriched_full_funnel"],
        "mat_indexed_serving": out["v_agg_serving_metrics"],
        "stream_click_join": with_ctes(
            """SELECT i.impression_id, bidder_id, win_price, i.event_timestamp AS event_ts, click_id,
                c.event_timestamp AS click_ts
            FROM impressions i LEFT JOIN (SELECT click_id, impression_id, event_timestamp FROM clicks) c
                ON c.impression_id = i.impression_id
                AND c.event_timestamp BETWEEN i.event_timestamp AND i.event_timestamp + INTERVAL 60 SECOND""",
            "impressions",
            "clicks",
        ),
        "stream_funnel_chain": with_ctes("SELECT DISTINCT * FROM timed_chain", "timed_chain"),
    }
    return out
