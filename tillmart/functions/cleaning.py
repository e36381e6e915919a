"""Column-to-column cleaning rules; built-ins only, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status words of the payment source and what reports call them.
STATUS_WORDS = {"accepted": "completed", "refused": "failed"}
COMPLETED = "completed"


def clean_product_sku(sku: Column) -> Column:
    """Strip leading lowercase ``v``s, then one trailing ``.0``."""
    bare = F.ltrim(sku, F.lit("v"))
    without_suffix = bare.substr(F.lit(1), F.length(bare) - 2)
    return F.when(bare.endswith(".0"), without_suffix).otherwise(bare)


def normalise_status(status: Column) -> Column:
    """Translate the two source words; any other status, NULL included, passes through."""
    renamed = status
    for source_word, report_word in STATUS_WORDS.items():
        renamed = F.when(status == source_word, report_word).otherwise(renamed)
    return renamed


def to_amount(amount: Column) -> Column:
    """Euros with two decimals, half-up. Unreadable text becomes NULL, for the not-null check."""
    return amount.try_cast("decimal(18,2)")


def completed(status: str = "transaction_status") -> Column:
    return F.col(status) == COMPLETED
