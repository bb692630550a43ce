from .activity import activity_maps, activity_of, merge_activity, store_activity, stored_activity
from .daily import (
    city_pay,
    city_pay_top,
    daily_count,
    day_pay_all,
    day_pay_top,
    day_pay_view_all,
    day_pay_view_last,
    day_view_all,
    day_view_top,
)
from .shops import (
    shop_activity,
    shop_activity_top,
    shop_base_top,
    top_shops_by_daily_amount,
    welcome_documented,
    welcome_top,
    welcome_top_per_city,
)

__all__ = [
    "activity_maps",
    "activity_of",
    "city_pay",
    "city_pay_top",
    "daily_count",
    "day_pay_all",
    "day_pay_top",
    "day_pay_view_all",
    "day_pay_view_last",
    "day_view_all",
    "day_view_top",
    "merge_activity",
    "shop_activity",
    "shop_activity_top",
    "shop_base_top",
    "store_activity",
    "stored_activity",
    "top_shops_by_daily_amount",
    "welcome_documented",
    "welcome_top",
    "welcome_top_per_city",
]
