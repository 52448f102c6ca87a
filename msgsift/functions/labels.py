"""Label normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from msgsift.functions.text import strip_ws

# Accepted raw label spellings (after strip + lower) and their class.
LABEL_MAP = {
    "ham": "ham",
    "spam": "spam",
    "0": "ham",
    "1": "spam",
    "false": "ham",
    "true": "spam",
}

DEFAULT_LABELS = ("ham", "spam")

# Accepted column names (normalised) in priority order.
LABEL_COLUMN_CANDIDATES = ("label", "class", "target", "category", "v1")
TEXT_COLUMN_CANDIDATES = ("text", "message", "sms", "body", "v2")


def normalize_label(c: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """strip + lower the raw value and map it to a class; unknown -> null."""
    mapping = mapping or LABEL_MAP
    col = F.col(c) if isinstance(c, str) else c
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    key = F.lower(strip_ws(col.cast("string")))
    return F.when(key.isNull(), F.lit(None).cast("string")).otherwise(F.try_element_at(lookup, key))
