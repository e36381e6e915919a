from tillmart.functions.arithmetic import money_ratio, count_ratio
from tillmart.functions.cleaning import clean_product_sku, completed, normalise_status, to_amount
from tillmart.functions.dates import calendar_days, elapsed_days, utc_now

__all__ = [
    "calendar_days",
    "clean_product_sku",
    "completed",
    "count_ratio",
    "elapsed_days",
    "money_ratio",
    "normalise_status",
    "to_amount",
    "utc_now",
]
