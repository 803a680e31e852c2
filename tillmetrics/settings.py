"""Values the semantics depend on. Every operator takes them as a parameter."""

from __future__ import annotations

from dataclasses import dataclass

UNKNOWN = "Unknown"


@dataclass(frozen=True)
class Settings:
    categories: tuple[str, ...]
    channels: tuple[str, ...]
    guest_email: str = "guest@checkout.invalid"
    # A return is decided once, when an order line is this many days old.
    return_lag_days: int = 25
    # Windows and thresholds of the finding queries.
    trend_window_days: int = 70
    cost_months: int = 5
    min_cost_months: int = 4
    return_peak_pct: int = 10
    holiday_from: tuple[int, int] = (11, 20)
    holiday_to: tuple[int, int] = (12, 31)


# The retail vocabularies.
RETAIL = Settings(
    categories=(
        "Electronics",
        "Home & Kitchen",
        "Apparel",
        "Beauty",
        "Sports & Outdoors",
        "Books",
    ),
    channels=(
        "Organic / Direct",
        "Paid Search",
        "Paid Social",
        "Email",
        "Affiliate",
    ),
)
