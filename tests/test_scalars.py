from pyspark.sql import functions as F

from funnelwright.functions import device_category, event_time, is_private_ip, ratio, settle, usd_floor


def test_private_addresses(spark):
    private = ["10.0.0.1", "192.168.1.1", "172.16.0.1", "172.19.9.9", "172.25.0.1", "172.30.0.1", "172.31.0.1"]
    public = ["172.15.0.1", "172.2.0.1", "172.200.0.1", "172.32.0.1", "11.0.0.1", "192.169.0.1", "172.160.0.1"]
    df = spark.createDataFrame([(ip, True) for ip in private] + [(ip, False) for ip in public], "ip string, want boolean")
    assert df.filter(is_private_ip(F.col("ip")) != F.col("want")).count() == 0
    assert spark.sql("SELECT CAST(NULL AS string) AS ip").select(is_private_ip(F.col("ip"))).first()[0] is None


def test_event_time(spark):
    texts = [
        ("2024-01-01T02:03:04.123456+00:00", "2024-01-01 02:03:04.123456"),
        ("2024-01-01T02:03:04+00:00", "2024-01-01 02:03:04"),
        ("2024-01-01T02:03:04.123+00:00", "2024-01-01 02:03:04.123"),
        ("2024-01-01T02:03:04+02:00", "2024-01-01 02:03:04"),
        ("2024-01-01T02:03:04.123+02:00", "2024-01-01 02:03:04.123"),
        ("2024-01-01T02:03:04.123456+02:00", "2024-01-01 02:03:04.123456"),
        ("2024-01-01T02:03:04Z", "2024-01-01 02:03:04"),
        ("12:30:00", None),
        ("2024", None),
        ("2024-01-01 02:03:04", None),
        ("2024-13-01T02:03:04", None),
        ("nonsense", None),
        (None, None),
    ]
    df = spark.createDataFrame(texts, "text string, want string")
    got = df.select(event_time(F.col("text")).cast("string")).collect()
    assert [r[0] for r in got] == [want for _, want in texts]


def test_small_helpers(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (0, 3)], "a int, b int")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.25, 0.0, 0.0]
    money = spark.createDataFrame([(2.0, "EUR"), (2.0, "USD"), (2.0, None)], "v double, c string")
    assert [r[0] for r in money.select(usd_floor(F.col("v"), F.col("c"))).collect()] == [2.16, 2.0, 2.0]
    kinds = spark.createDataFrame(
        [(7, None, None), (1, "a", None), (4, None, "s"), (2, None, "s"), (1, None, None), (3, "a", None), (None, "a", None)],
        "t int, app string, site string",
    )
    got = [r[0] for r in kinds.select(device_category(F.col("t"), F.col("app"), F.col("site"))).collect()]
    assert got == ["CTV", "Mobile App", "Mobile Web", "Desktop", "Unknown", "Unknown", "Unknown"]
    assert spark.range(1).select(settle(F.lit(10.41955), 4)).first()[0] == 10.4196
