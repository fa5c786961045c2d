from sedimenta.functions.exprs import (
    NULL_TOKENS,
    as_date,
    null_tokens_to_null,
    or_default,
    percentage,
    round2,
)

__all__ = [
    "NULL_TOKENS",
    "as_date",
    "null_tokens_to_null",
    "or_default",
    "percentage",
    "round2",
]
