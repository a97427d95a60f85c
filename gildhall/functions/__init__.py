from gildhall.functions.calendar import (
    billing_label, date_sk, days_between, fiscal_month, fiscal_quarter, fiscal_year,
    from_date_sk, is_fiscal_year_end, is_fixed_holiday, is_month_end, is_weekend,
    iso_weekday, period_label,
)
from gildhall.functions.rules import (
    all_zero, any_not_null, flag, gap, is_distinct, like_any, money, ratio, rules, within, yn_flag,
)
from gildhall.functions.text import (
    blank_to_null, compose_code, first_non_blank, full_name, month_number,
    phone_with_ext, suffix_after,
)

__all__ = [
    "billing_label", "date_sk", "days_between", "fiscal_month", "fiscal_quarter",
    "fiscal_year", "from_date_sk", "is_fiscal_year_end", "is_fixed_holiday",
    "is_month_end", "is_weekend", "iso_weekday", "period_label",
    "all_zero", "any_not_null", "flag", "gap", "is_distinct", "like_any", "money", "ratio",
    "rules", "within", "yn_flag",
    "blank_to_null", "compose_code", "first_non_blank", "full_name", "month_number",
    "phone_with_ext", "suffix_after",
]
