from starfit.functions.columns import (
    box_fences,
    lambda_grid,
    or_zero,
    rmse,
    row_hash,
    support_band,
    to_double,
    to_integer,
)

__all__ = [
    "box_fences",
    "lambda_grid",
    "or_zero",
    "rmse",
    "row_hash",
    "support_band",
    "to_double",
    "to_integer",
]
