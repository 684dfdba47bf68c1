from tellerflow.functions.bands import (
    AGE_BANDS,
    BALANCE_BANDS,
    band_id,
    band_label,
    bandable,
    first_band_id,
    inside_band,
)
from tellerflow.functions.rules import (
    gender,
    parse_date,
    parse_money,
    round_half_up,
    strip_chars,
    yes_no,
)

__all__ = [
    "AGE_BANDS",
    "BALANCE_BANDS",
    "band_id",
    "band_label",
    "bandable",
    "first_band_id",
    "gender",
    "inside_band",
    "parse_date",
    "parse_money",
    "round_half_up",
    "strip_chars",
    "yes_no",
]
