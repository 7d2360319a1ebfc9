"""Column helpers. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Units of USD per unit of the named currency; others count as USD.
USD_RATES = {"EUR": 1.08, "GBP": 1.25, "JPY": 0.0067}

# Names of the auction types.
AUCTION_NAMES = {1: "First Price", 2: "Second Price"}

# First octets of the private address ranges.
PRIVATE_PREFIXES = (
    "10.",
    "192.168.",
    "172.16.",
    "172.17.",
    "172.18.",
    "172.19.",
    "172.30.",
    "172.31.",
)


def event_time(text: Column) -> Column:
    """ISO date and time to a timestamp, NULL for text of another shape.

    The text must hold a date, a T and a time to the second, with up to six
    digits of a fraction if any. What follows is cut off, an offset too, so
    every writer's clock is read as UTC however many digits it writes. A time
    or a year alone is no event time. Reading by cast costs no exception per
    odd row, unlike reading by pattern.
    """
    shaped = (F.length(text) >= 19) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 11, 1) == "T")
    fraction = F.regexp_extract(F.substring(text, 20, 7), r"^\.[0-9]{1,6}", 0)
    return F.when(shaped, F.try_to_timestamp(F.concat(F.substring(text, 1, 19), fraction)))


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def is_private_ip(ip: Column) -> Column:
    """True for private addresses, NULL for a NULL address.

    172.2x needs exactly one character before the next dot, so 172.2.0.1 and
    172.200.0.1 are public.
    """
    test = ip.startswith("172.2") & (F.substring(ip, 7, 1) == ".")
    for prefix in PRIVATE_PREFIXES:
        test = test | ip.startswith(prefix)
    return test


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0.0 where whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def usd_floor(floor: Column, currency: Column) -> Column:
    rate = F.lit(1.0)
    for code, value in USD_RATES.items():
        rate = F.when(currency == code, F.lit(value)).otherwise(rate)
    return floor * rate


def auction_name(kind: Column) -> Column:
    name = F.lit("Other")
    for code, label in AUCTION_NAMES.items():
        name = F.when(kind == code, F.lit(label)).otherwise(name)
    return name


def device_category(device_type: Column, app_id: Column, site_id: Column) -> Column:
    handheld = device_type.isin(1, 4)
    return (
        F.when(device_type == 7, "CTV")
        .when(handheld & app_id.isNotNull(), "Mobile App")
        .when(handheld & site_id.isNotNull(), "Mobile Web")
        .when(device_type == 2, "Desktop")
        .otherwise("Unknown")
    )


def settle(value: Column, digits: int) -> Column:
    """Round for reports, with exact halves always going up.

    A mean of whole cents can sit exactly on a rounding boundary, where the
    last bit of a double, and so the order of summation, would decide.
    """
    return F.round(value + F.lit(1e-9), digits)
