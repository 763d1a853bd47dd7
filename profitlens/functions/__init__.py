from profitlens.functions.expr import (  # noqa: F401
    MONEY, NA_CODE, SHARE, UNALLOCATED, WHITESPACE, conform_code,
    conform_numeric_code, dec, matches_any, money, nan_to_null, not_matching,
    pattern_match, ratio, round_half_even,
)
