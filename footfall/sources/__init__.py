from .files import parse_shop_info, parse_user_pay, read_lines, read_shop_info, read_user_pay
from .lookup import distinct_cities, distinct_shops, first_appearance, shop_city_lookup
from .warehouse import bucketed_parts, province_totals, register_tables, save_bucketed, warehouse_table

__all__ = [
    "bucketed_parts",
    "distinct_cities",
    "distinct_shops",
    "first_appearance",
    "parse_shop_info",
    "parse_user_pay",
    "province_totals",
    "read_lines",
    "read_shop_info",
    "read_user_pay",
    "register_tables",
    "save_bucketed",
    "shop_city_lookup",
    "warehouse_table",
]
