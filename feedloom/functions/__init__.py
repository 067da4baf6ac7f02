from feedloom.functions.columns import (
    LOCAL_PREFIX,
    day_epoch,
    day_text,
    flag,
    null_text,
    ratio,
    rounded_ctr,
    starts_local,
    stripped,
    within,
)

__all__ = [
    "LOCAL_PREFIX",
    "day_epoch",
    "day_text",
    "flag",
    "null_text",
    "ratio",
    "rounded_ctr",
    "starts_local",
    "stripped",
    "within",
]
