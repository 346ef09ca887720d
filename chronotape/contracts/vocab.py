"""Closed vocabularies and constants. All values in this file are fixed values: results depend on them."""

from __future__ import annotations

# Dispatch rank of a source among rows that share an instant.
SESSION, STATUS, LULD, REFERENCE, QUOTE, TRADE, BAR, SYNTHETIC = range(8)
SOURCE_RANKS = {
    "session": SESSION,
    "status": STATUS,
    "luld": LULD,
    "reference": REFERENCE,
    "quote": QUOTE,
    "trade": TRADE,
    "bar": BAR,
    "synthetic": SYNTHETIC,
}

# Absent sequence number, and the columns of the total order.
MISSING_SEQUENCE = -1
ORDER_KEY = ("event_time", "source_rank", "vendor_sequence", "venue_sequence", "ingest_index")

# Sentinels that bound every real ordering key.
BEFORE_EVERYTHING = (-(2**63), SESSION, -1, -1, -(2**62))
AFTER_EVERYTHING = (2**63 - 1, SYNTHETIC, 2**62, 2**62, 2**62)

# Sale conditions that keep a print out of regular-session bars, and their version.
INELIGIBLE_CONDITIONS = ("T", "U", "Z")
CONDITION_POLICY = "bar_eligibility_v1"

# Units of time in nanoseconds, default window, declared publication lag.
NS_PER_SECOND = 1_000_000_000
NS_PER_MINUTE = 60 * NS_PER_SECOND
NS_PER_HOUR = 60 * NS_PER_MINUTE
NS_PER_DAY = 24 * NS_PER_HOUR
DEFAULT_WINDOW_NS = NS_PER_MINUTE
DEFAULT_PUBLICATION_LAG_NS = 250_000

# Plausible instants are 2000-01-01 .. 2100-01-01, both ends included.
PLAUSIBLE_MIN_NS = 946_684_800 * NS_PER_SECOND
PLAUSIBLE_MAX_NS = 4_102_444_800 * NS_PER_SECOND

# Nano-dollars per dollar, and the storable range of a money column.
NANO = 1_000_000_000
STORABLE_LIMIT = 2**62

# How knowledge_time was derived.
LIVE_CAPTURE = "live_capture"
BACKFILL = "backfill"
ANNOUNCEMENT = "announcement"
KNOWLEDGE_POLICIES = (LIVE_CAPTURE, BACKFILL, ANNOUNCEMENT)

# Order life cycle.
ORDER_STATES = (
    "created",
    "risk_approved",
    "submitting",
    "acknowledged",
    "partially_filled",
    "filled",
    "rejected",
    "canceling",
    "canceled",
    "unknown",
)
TERMINAL_ORDER_STATES = ("filled", "rejected", "canceled")
SIDES = ("buy", "sell")

# Reason codes of a pre-trade decision.
RISK_REASONS = (
    "approved",
    "duplicate_client_order_id",
    "symbol_halted",
    "outside_luld_band",
    "stale_market_data",
    "outside_session",
    "price_collar",
    "position_limit",
    "gross_exposure_limit",
    "net_exposure_limit",
    "sector_exposure_limit",
    "daily_loss_limit",
    "participation_limit",
    "insufficient_buying_power",
    "short_not_supported",
    "fractional_not_supported",
    "unsigned_strategy",
    "operating_state_forbids",
)

# Operating states, those that put capital at risk, and permitted moves.
# Staying put and moving to "safe" are always permitted; capital states are never entered.
OPERATING_STATES = ("off", "research", "shadow", "paper", "canary", "live", "safe")
CAPITAL_STATES = ("canary", "live")
STATE_MOVES = {
    "off": ("research",),
    "research": ("shadow", "off"),
    "shadow": ("paper", "research"),
    "paper": ("canary", "shadow"),
    "canary": ("live", "paper"),
    "live": ("canary",),
    "safe": ("off", "research"),
}

# Experiment status.
EXPERIMENT_STATUSES = ("created", "queued", "running", "succeeded", "failed", "cancelled")

# Default exposure limits in basis points of net asset value.
POSITION_LIMIT_BPS = 200
GROSS_LIMIT_BPS = 5_000
NET_LIMIT_BPS = 2_000
