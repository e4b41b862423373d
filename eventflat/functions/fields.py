"""Names fixed by the event-export format, and the default columns built from them."""

from __future__ import annotations

# Columns an older export may lack, filled with 0.
BATCH_COLUMNS = ("batch_event_index", "batch_page_id", "batch_ordering_id")

# Fields of the traffic-source struct collected with an event.
COLLECTED_TRAFFIC_SOURCE = (
    "manual_campaign_id",
    "manual_campaign_name",
    "manual_source",
    "manual_medium",
    "manual_term",
    "manual_content",
    "manual_source_platform",
    "manual_creative_format",
    "manual_marketing_tactic",
    "gclid",
    "dclid",
    "srsltid",
)

# The six campaign structs of a session's last click.
SESSION_TRAFFIC_SOURCE_LAST_CLICK = {
    "manual_campaign": (
        "campaign_id", "campaign_name", "source", "medium", "term", "content",
        "source_platform", "creative_format", "marketing_tactic",
    ),
    "google_ads_campaign": (
        "customer_id", "account_name", "campaign_id", "campaign_name", "ad_group_id",
        "ad_group_name",
    ),
    "cross_channel_campaign": (
        "customer_id", "campaign_name", "source", "medium", "source_platform",
        "default_channel_group", "primary_channel_group",
    ),
    "sa360_campaign": (
        "customer_id", "campaign_name", "source", "medium", "ad_group_id", "ad_group_name",
        "creative_format", "engine_account_name", "engine_account_type",
        "manager_account_name",
    ),
    "cm360_campaign": (
        "customer_id", "campaign_name", "source", "medium", "account_id", "account_name",
        "advertiser_id", "advertiser_name", "creative_id", "creative_format",
        "creative_name", "creative_type", "creative_type_id", "creative_version",
        "placement_id", "placement_cost_structure", "placement_name", "rendering_id",
        "site_id", "site_name",
    ),
    "dv360_campaign": (
        "customer_id", "campaign_name", "source", "medium", "account_id", "account_name",
        "advertiser_id", "advertiser_name", "creative_id", "creative_format",
        "creative_name", "exchange_id", "exchange_name", "insertion_order_id",
        "insertion_order_name", "line_item_id", "line_item_name", "partner_id",
        "partner_name",
    ),
}


def blank_struct(names: tuple[str, ...]) -> str:
    """A struct whose fields are all the empty text, as SQL."""
    return "named_struct(" + ", ".join(f"'{name}', ''" for name in names) + ")"


def default_traffic_columns() -> dict[str, str]:
    """The SQL value of each optional traffic-source column when an export lacks it."""
    campaigns = ", ".join(
        f"'{campaign}', {blank_struct(names)}"
        for campaign, names in SESSION_TRAFFIC_SOURCE_LAST_CLICK.items()
    )
    return {
        "session_traffic_source_last_click": f"named_struct({campaigns})",
        "collected_traffic_source": blank_struct(COLLECTED_TRAFFIC_SOURCE),
    }
