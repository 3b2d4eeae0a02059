"""Scalar column helpers (slug URL, guarded ratio, boundary seconds, flags)."""

from .columns import (EMPTY_TARGET_DATE, LOOKBACK_DAYS, NONE_LABEL, count_if, flag,
                      product_page_url, safe_ratio, seconds_between, to_date)

__all__ = ["EMPTY_TARGET_DATE", "LOOKBACK_DAYS", "NONE_LABEL", "count_if", "flag",
           "product_page_url", "safe_ratio", "seconds_between", "to_date"]
