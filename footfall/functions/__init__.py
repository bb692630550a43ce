from .text import day_of, first_field, line_fields, non_empty, second_field, tolerant_int

__all__ = ["day_of", "first_field", "line_fields", "non_empty", "second_field", "tolerant_int"]
