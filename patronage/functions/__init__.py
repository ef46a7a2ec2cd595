from patronage.functions.scalar import (
    channel_value,
    guarded_ratio,
    net_amount,
    null_default,
    presence_flag,
    return_percentage,
    total_of,
)

__all__ = [
    "channel_value",
    "guarded_ratio",
    "net_amount",
    "null_default",
    "presence_flag",
    "return_percentage",
    "total_of",
]
