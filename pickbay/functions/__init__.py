from pickbay.functions.scalars import (  # noqa: F401
    capped_share,
    clamp_positive,
    day_of,
    flag,
    latest_order_time,
    minute_text,
    ratio_or_default,
    text_to_int,
    valid_after,
)
