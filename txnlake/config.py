"""Typed settings of the payments lake."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Domains, groups, thresholds and defect rates that results
# depend on.
# ---------------------------------------------------------------------------

STATUSES = ("INITIATED", "SUCCESS", "FAILED", "PENDING", "REVERSED")

CURRENCIES = ("GBP", "USD", "EUR", "AUD", "CAD", "JPY", "CHF", "HKD", "SGD", "INR")

PAYMENT_METHODS = (
    "credit_card", "debit_card", "bank_transfer", "digital_wallet",
    "buy_now_pay_later", "direct_debit", "standing_order", "faster_payments",
)

METHOD_GROUPS = {
    "credit_card": "card",
    "debit_card": "card",
    "bank_transfer": "account",
    "direct_debit": "account",
    "standing_order": "account",
    "faster_payments": "account",
    "digital_wallet": "digital",
    "buy_now_pay_later": "digital",
}

CHANNELS = ("online", "mobile", "branch", "atm", "pos")

DEVICE_TYPES = ("desktop", "mobile", "tablet", "unknown")

CUSTOMER_SEGMENTS = ("retail", "premium", "business", "student", "private_banking")

MERCHANT_CATEGORIES = (
    "retail", "food_and_beverage", "travel", "healthcare", "utilities",
    "entertainment", "financial_services", "ecommerce", "education", "real_estate",
)

DEFECT_RATES = {
    "null_customer_id": 0.005,
    "null_amount": 0.003,
    "duplicate_transaction_id": 0.008,
    "invalid_currency": 0.004,
    "invalid_status": 0.003,
    "orphan_customer_id": 0.005,
    "orphan_merchant_id": 0.004,
    "malformed_timestamp": 0.003,
    "future_timestamp": 0.002,
    "negative_amount": 0.003,
}


@dataclass(frozen=True)
class Config:
    """Thresholds and domains used by every stage."""

    schema_version: str = "1.0"
    max_amount: int | float = 1_000_000
    freshness_sla_hours: int = 24
    volume_threshold: float = 0.30
    warn_rate: float = 0.01
    fail_rate: float = 0.05
    expected_transactions: int = 75_000
    statuses: tuple[str, ...] = STATUSES
    currencies: tuple[str, ...] = CURRENCIES
    payment_methods: tuple[str, ...] = PAYMENT_METHODS
    method_groups: dict[str, str] = field(default_factory=lambda: dict(METHOD_GROUPS))
    defect_rates: dict[str, float] = field(default_factory=lambda: dict(DEFECT_RATES))

    def __post_init__(self) -> None:
        # Money is summed as DECIMAL(18,6), which ends at 10^12.
        if not 0 < self.max_amount < 10**12:
            raise ValueError("max_amount must lie between 0 and 10^12")

    @property
    def clean_share(self) -> float:
        """Share of raw rows expected to reach Silver."""
        return 1 - sum(self.defect_rates.values())
