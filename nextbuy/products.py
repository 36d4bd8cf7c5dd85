"""Product and class constants of the panel data model.

The driver's tables hold no bank panel; the adapter in
``nextbuy.sources.adapter`` derives one in which a product is a part brand.
Product code = brand number, flag column = ``prod_NN``, product name = flag
column name (the panel's convention: a class is named after its flag).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

N_PRODUCTS = 25
PRODUCT_CODES = list(range(1, N_PRODUCTS + 1))
PRODUCTS = [f"prod_{code:02d}" for code in PRODUCT_CODES]

NO_PURCHASE_CLASS = 0
OTHER_CLASS = 99
NO_PURCHASE_NAME = "no_purchase"
OTHER_NAME = "other"

# Tenure sentinel of the source panel: "missing".
TENURE_MISSING = -999999


def product_name_expr(code: Column) -> Column:
    """Code -> flag name; codes outside 1..N give NULL."""
    return F.when((code >= 1) & (code <= N_PRODUCTS),
                  F.concat(F.lit("prod_"), F.lpad(code.cast("string"), 2, "0")))
