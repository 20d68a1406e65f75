"""Channel grouping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Channel keys with a group of their own, in matching order.
CORE_CHANNELS = [
    "liftoff_int_app",
    "google_paid search",
    "facebook_app",
    "tiktok_app",
    "facebook_paid social",
    "apple_app",
    "moloco_app",
    "tiktok_paid social",
    "snapchat_paid social",
    "applovin_int_app",
    "snapchat_app",
    "bingsearch_paid search",
    "smadex_int_app",
]
# The two further keys of the older projections.
WIDE_CHANNELS = CORE_CHANNELS + ["ironsource_int_app", "unityads_int_app"]

# Peer classes used to fill missing growth.
PEER_CLASSES = {
    "network": ["applovin_int_app", "liftoff_int_app", "smadex_int_app", "moloco_app"],
    "paid_search": ["google_paid_search", "bingsearch_paid_search"],
    "paid_social": ["tiktok_paid_social", "snapchat_paid_social"],
    "social_app": ["tiktok_app", "snapchat_app", "facebook_app"],
}


def group_name(key: str) -> str:
    return key.replace(" ", "_")


def channel_group(col: Column, keys: list[str] = CORE_CHANNELS) -> Column:
    """Exact key, then affiliate and invite wording, then the first key found inside the text."""
    inside = [F.when(col.contains(k), F.lit(group_name(k))) for k in keys]
    return (
        F.when(col.isin(keys), F.translate(col, " ", "_"))
        .when(col.rlike("(?i)affiliate|social traffic|content creator"), F.lit("affiliates"))
        .when(col.rlike("(?i)invite friend"), F.lit("invite_friend"))
        .otherwise(F.coalesce(*inside, F.lit("other")))
    )


def peer_class(group: Column) -> Column:
    return F.coalesce(
        *[F.when(group.isin(members), F.lit(name)) for name, members in PEER_CLASSES.items()]
    )
