from starloom.functions.scalars import (
    as_names,
    epoch_days,
    epoch_millis,
    fiscal_month,
    fiscal_year,
    literal_like,
    not_null,
    pairs,
    row_bytes,
    wkt_point,
)

__all__ = [
    "as_names",
    "epoch_days",
    "epoch_millis",
    "fiscal_month",
    "fiscal_year",
    "literal_like",
    "not_null",
    "pairs",
    "row_bytes",
    "wkt_point",
]
