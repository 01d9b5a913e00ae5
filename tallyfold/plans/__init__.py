"""Physical-plan helpers: size-checked broadcast, skew-safe sequence
positions, and plan inspection used by tests and the bench."""

from tallyfold.plans.explain import count_nodes, plan_text
from tallyfold.plans.joins import BROADCAST_BYTES, fits_broadcast, join_small
from tallyfold.plans.sequence import DEFAULT_KEY_ROWS, fits_window, largest_group, positions, sequence_positions

__all__ = [
    "BROADCAST_BYTES",
    "DEFAULT_KEY_ROWS",
    "count_nodes",
    "fits_broadcast",
    "fits_window",
    "join_small",
    "largest_group",
    "plan_text",
    "positions",
    "sequence_positions",
]
