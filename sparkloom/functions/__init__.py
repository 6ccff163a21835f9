"""Column expressions shared by the operators."""

from .buckets import by_bounds, equal_width
from .colors import smallest_free_color
from .labels import cut_label, impact_label, sign_label
from .members import is_multi, member_list

__all__ = [
    "by_bounds",
    "cut_label",
    "equal_width",
    "impact_label",
    "is_multi",
    "member_list",
    "sign_label",
    "smallest_free_color",
]
