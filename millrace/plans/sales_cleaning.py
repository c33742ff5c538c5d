"""The sales cleaning job from raw text to imputed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import parse_timestamp
from millrace.functions.text import normalize_text, parse_number
from millrace.operators import cleaning
from millrace.operators.lineage import materialize
from millrace.sources.schema import rename_select

COLUMNS = {
    "Transaction ID": "id",
    "Item": "item",
    "Quantity": "quantity",
    "Price Per Unit": "unit_price",
    "Total Spent": "total",
    "Payment Method": "payment",
    "Location": "branch",
    "Transaction Date": "bought_at",
}

# Labels for missing product, payment method and branch.
MISSING_LABELS = {"item": "desconocido", "payment": "no_definido", "branch": "sin_sucursal"}


def type_sales(raw: DataFrame) -> DataFrame:
    """Rename, drop error rows, normalise text, parse numbers and dates, remove copies."""
    named = cleaning.drop_error_rows(rename_select(raw, COLUMNS), "total")
    # texts first, so the date layouts below share one cleaned text
    texts = cleaning.apply_columns(named, ["id", "item", "payment", "branch", "bought_at"], normalize_text)
    typed = texts.withColumns(
        {
            "quantity": F.col("quantity").try_cast("double"),
            "unit_price": parse_number("unit_price"),
            "total": parse_number("total"),
            "bought_at": parse_timestamp("bought_at"),
        }
    )
    return cleaning.deduplicate(typed)


def clean_sales(raw: DataFrame) -> DataFrame:
    """Typed sales with medians and labels filled in and rows without id or date dropped."""
    typed = materialize(type_sales(raw))  # read again by the sketch, the ranks and the fill
    filled = cleaning.impute_median(typed, {"quantity": 0, "unit_price": None, "total": None})
    keyed = cleaning.drop_nulls(filled, ["bought_at", "id"])
    return cleaning.impute_constant(keyed, MISSING_LABELS)
