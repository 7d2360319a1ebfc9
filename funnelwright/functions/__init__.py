from funnelwright.functions.scalars import (
    auction_name,
    device_category,
    event_time,
    hour_of,
    is_private_ip,
    minute_of,
    ratio,
    settle,
    usd_floor,
)

__all__ = [
    "auction_name",
    "device_category",
    "event_time",
    "hour_of",
    "is_private_ip",
    "minute_of",
    "ratio",
    "settle",
    "usd_floor",
]
