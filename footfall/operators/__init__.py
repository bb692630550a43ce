from .counting import counted, show_counted
from .joins import copies_of, hot_keys, hot_of, key_summary, lookup_join, relabel
from .ranking import appearance_index, rank_labels, top_k, top_k_per_group
from .series import series, series_lists

__all__ = [
    "appearance_index",
    "copies_of",
    "counted",
    "hot_keys",
    "hot_of",
    "key_summary",
    "lookup_join",
    "rank_labels",
    "relabel",
    "series",
    "series_lists",
    "show_counted",
    "top_k",
    "top_k_per_group",
]
