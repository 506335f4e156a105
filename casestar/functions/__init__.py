"""Column-level functions: each returns a ``Column`` built from built-ins."""

from casestar.functions.columns import (  # noqa: F401
    AGE_MIDPOINTS,
    DISTRICT_CODE_RECODE,
    DISTRICT_NAME_RECODE,
    PERIOD_BOUNDS,
    PERIOD_LAST_LABEL,
    UNKNOWN_LABEL,
    UNKNOWN_TEXT,
    active_of,
    filter_coords,
    midpoint,
    pad_code,
    parse_date,
    period_bucket,
    recode,
    rekey_properties,
    strip_token,
    zero_as_null,
)
