from funnelwright.model import TABLES, event_schema, table_schema
from funnelwright.operators import ingest, stages


def request(id, publisher, ip, floors, place="site", cur=("USD",)):
    pub = {"id": publisher, "name": "p"} if publisher is not None else None
    return {
        "id": id,
        "imp": [
            {"id": str(i + 1), "banner": {"w": 300, "h": 250, "pos": 1}, "bidfloor": f, "bidfloorcur": "EUR", "secure": 1}
            for i, f in enumerate(floors)
        ],
        "site": {"id": "s", "domain": "d", "cat": ["IAB1"], "page": "", "publisher": pub} if place == "site" else None,
        "app": {"id": "a", "bundle": "b", "storeurl": "", "cat": None, "publisher": pub} if place == "app" else None,
        "device": {
            "ua": "",
            "ip": ip,
            "geo": {"lat": 0.0, "lon": 0.0, "country": "USA", "region": "WA"},
            "devicetype": 1,
            "os": "iOS",
            "osv": "1",
        },
        "user": {"id": "u", "buyeruid": "b"},
        "at": 1,
        "tmax": 100,
        "cur": list(cur),
        "source": {"fd": 0, "tid": "t"},
        "regs": {"coppa": 1, "ext": {"gdpr": None}},
        "event_timestamp": "2024-01-01T00:00:00.500000+00:00",
        "received_at": "2024-01-01T00:00:01+00:00",
    }


REQUESTS = [
    request("good", 5, "8.8.8.8", [1.0, 0.0, 2.0]),
    request("app", 6, "8.8.8.8", [1.0], place="app", cur=()),
    request("neither", None, "8.8.8.8", [1.0], place=None),
    request("test", -5, "10.0.0.1", [0.0]),
    request("private", 5, "172.25.0.1", [0.0]),
    request("zero", 0, "8.8.8.8", [1.0]),
    request("noip", 5, None, [1.0]),
    request("empty", -5, "8.8.8.8", []),
]


def test_requests(spark):
    events = spark.createDataFrame(REQUESTS, event_schema("bid_requests"))
    clean = {(r.request_id, r.imp_id): r for r in ingest.clean_requests(events).collect()}
    assert set(clean) == {("good", "1"), ("good", "3"), ("app", "1")}
    app = clean["app", "1"]
    assert (app.site_id, app.site_domain, app.currency, app.is_coppa, app.is_gdpr) == ("a", "b", None, True, False)

    enriched = {(r.request_id, r.imp_id): r for r in ingest.enriched_requests(events).collect()}
    assert len(enriched) == 9
    assert enriched["app", "1"].device_category == "Mobile App"
    assert enriched["good", "1"].imp_bidfloor_usd == 1.08
    assert enriched["neither", "1"].is_test_traffic is False

    rejected = {(r.request_id, r.imp_id): r.reject_reason for r in ingest.rejected_requests(events).collect()}
    assert rejected == {
        ("good", "2"): "NON_POSITIVE_BIDFLOOR",
        ("test", "1"): "TEST_PUBLISHER",
        ("private", "1"): "PRIVATE_IP",
    }
    # Publisher 0, no publisher and no address are in neither table.
    assert set(enriched) - set(clean) - set(rejected) == {("neither", "1"), ("zero", "1"), ("noip", "1")}

    invalid = {r.request_id for r in stages.request_stage(events).filter("is_invalid").collect()}
    assert invalid == {"good", "test", "private"}


def test_bids(spark):
    def bid(id, domains):
        return {"id": id, "impid": "1", "price": 1.0, "crid": 1, "adomain": domains}

    events = spark.createDataFrame(
        [
            {
                "id": "r1",
                "seatbid": [
                    {"seat": 1, "bid": [bid("a", ["x", "y"]), bid("b", [])]},
                    {"seat": 2, "bid": [bid("c", None), bid("d", ["z"])]},
                ],
                "cur": "USD",
                "ext": {"request_id": "q1"},
                "event_timestamp": "2024-01-01T00:00:00+00:00",
            },
            {"id": "r2", "seatbid": [], "ext": {"request_id": "q2"}},
        ],
        event_schema("bid_responses"),
    )
    got = sorted((r.seat, r.bid_id, r.ad_domain, r.request_id) for r in ingest.flat_bids(events).collect())
    assert got == [(1, "a", "x", "q1"), (1, "b", None, "q1"), (2, "c", None, "q1"), (2, "d", "z", "q1")]
    assert stages.bid_stage(events).count() == 4


def test_contracts_parse():
    assert all(table_schema(t).fields for t in TABLES)
