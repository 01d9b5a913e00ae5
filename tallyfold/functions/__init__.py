"""Column-level helpers (native Spark expressions only)."""

from tallyfold.functions.arrays import append_if, concat_arrays, empty_array, pad_and_append, safe_get
from tallyfold.functions.bits import bit_flag, bits_text, datelist_bits
from tallyfold.functions.classify import QUALITY_BANDS, SCORING_BANDS, band
from tallyfold.functions.keys import require_keys

__all__ = [
    "QUALITY_BANDS",
    "SCORING_BANDS",
    "append_if",
    "band",
    "bit_flag",
    "bits_text",
    "concat_arrays",
    "datelist_bits",
    "empty_array",
    "pad_and_append",
    "require_keys",
    "safe_get",
]
