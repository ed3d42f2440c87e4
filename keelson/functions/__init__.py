from keelson.functions.columns import (
    affine,
    field,
    other_side,
    row_struct,
    safe_ratio,
    single_blanks,
    sort_keys,
    to_ascii,
    tokens_of,
    words,
)

__all__ = [
    "affine",
    "field",
    "other_side",
    "row_struct",
    "safe_ratio",
    "single_blanks",
    "sort_keys",
    "to_ascii",
    "tokens_of",
    "words",
]
