"""Values the results depend on, and the thresholds of the alert rules."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# --- fixed values: they have to stay exactly as they are for results to match ---
ACCOUNT_TYPES = ("SAVINGS", "CURRENT", "SALARY", "NRI")
REGIONS = ("North", "South", "East", "West", "Central")
TRANSACTION_TYPES = ("DEBIT", "CREDIT")
CHANNELS = ("UPI", "ATM", "CARD", "NETBANKING")

DEBIT = "DEBIT"
CREDIT = "CREDIT"
ACTIVE = "ACTIVE"

HIGH_VALUE = "HIGH_VALUE_TRANSACTION"
BURST = "RAPID_BURST_TRANSACTIONS"
DAILY_SPEND = "HIGH_DAILY_SPEND"
DORMANT = "DORMANT_ACCOUNT_ACTIVE"

NULL_CRITICAL = "Null in critical field"
NULL_TRANSACTION_ID = "Null transaction_id"
NULL_ACCOUNT_NUMBER = "Null account_number"
NULL_AMOUNT = "Null amount"
NEGATIVE_AMOUNT = "Negative amount"
INVALID_TIMESTAMP = "Invalid timestamp"

STAMP_FORMAT = "%Y-%m-%d %H:%M:%S"
RUPEE = "₹"
CRORE = 10_000_000
# --- end of fixed values ---

# Reasons used only by strict runs; else zero amounts are left out and odd numbers are clean.
ZERO_AMOUNT = "Zero amount"
NOT_FINITE = "Amount is not finite"

# Column of the raw layer that holds lines with too many or too few fields, and their reason.
MALFORMED = "malformed_row"
MALFORMED_ROW = "Malformed row"

# Labels of the two rules that look across window edges and between visits.
SLIDING_BURST = "SLIDING_BURST_TRANSACTIONS"
REACTIVATED = "REACTIVATED_AFTER_GAP"


@dataclass(frozen=True)
class RuleParams:
    """Thresholds of the alert rules; every comparison is strict unless it says otherwise."""

    high_value_over: float = 100_000
    burst_width: str = "10 minutes"
    burst_over: int = 3
    daily_spend_over: float = 1_000_000
    dormant_max_txns: int = 10  # inclusive
    dormant_active_since: date = date(2025, 10, 1)  # inclusive
    dormant_gap_over: int = 180


DEFAULT_RULES = RuleParams()
