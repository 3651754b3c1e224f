from .dates import (
    ageing_bucket,
    ageing_days,
    as_date,
    digits_between,
    digits_to_time,
    in_month,
    month_bounds,
    month_key,
    parse_yyyymmdd,
)
from .numbers import (
    as_factor,
    charge_share,
    div0,
    exact,
    flag,
    money,
    net_of,
    outside_tolerance,
    override_by_prefix,
    product,
    quantity,
    signed,
    within_tolerance,
)
from .text import (
    access_key,
    choose,
    comma_decimal,
    format_ptbr,
    format_ptbr_compat,
    mask_tax_id,
    pad_key,
    remap,
    strip_prefix,
    text_key,
)

__all__ = [name for name in dir() if not name.startswith("_")]
