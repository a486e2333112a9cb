from .bands import CREDIT_BANDS, CREDIT_TIERS, PRICING_TIERS, band
from .lists import names_where
from .loans import emi, is_business_hours, in_emi_window, npa_percentage, rate_card
from .temporal import days_since, decode_temporal, in_temporal_range

__all__ = [
    "CREDIT_BANDS", "CREDIT_TIERS", "PRICING_TIERS", "band", "emi", "is_business_hours", "in_emi_window",
    "names_where", "npa_percentage", "rate_card", "days_since", "decode_temporal", "in_temporal_range",
]
