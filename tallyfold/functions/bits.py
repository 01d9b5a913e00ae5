"""Date lists as bitmasks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def datelist_bits(dates: Column, end_date: Column, n_days: int = 10) -> Column:
    """Bitmask of a date list: the day ``k`` days before ``end_date`` sets bit
    ``n_days - 1 - k`` (so ``end_date`` is the highest bit).  Days outside
    the window and NULL dates are ignored.  Built with OR, never SUM, so a
    repeated date cannot carry into another bit.
    """
    if not 1 <= n_days <= 63:
        raise ValueError("n_days must be in 1..63 to fit a bigint")

    def in_window(d):
        k = F.datediff(end_date, d)
        return d.isNotNull() & (k >= 0) & (k < n_days)

    kept = F.filter(dates, in_window)
    return F.aggregate(
        kept,
        F.lit(0).cast("bigint"),
        lambda acc, d: acc.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(n_days - 1) - F.datediff(end_date, d))
        ),
    )


def bits_text(bits: Column, n_days: int = 10) -> Column:
    """Fixed-width binary text, like a BIT(n) column printed."""
    return F.lpad(F.bin(bits), n_days, "0")


def bit_flag(bits: Column, mask: int) -> Column:
    """``bit_count(bits & mask) > 0``."""
    return F.bit_count(bits.bitwiseAND(F.lit(mask).cast("bigint"))) > 0


# ------------------------------------------------- windows of any length
#
# More than 63 days: an array of 64-bit words, newest first.  The end date is
# the highest bit of word 0, the day before it the next lower one, and so on.


def n_words(n_days: int) -> int:
    return -(-n_days // 64)


def wide_bits(dates: Column, end_date: Column, n_days: int) -> Column:
    """Words of a date list.  Days outside the window and NULL dates are
    ignored; a repeated date sets one bit."""
    if n_days < 1:
        raise ValueError("n_days must be at least 1")

    def word(w: int) -> Column:
        first, last = 64 * w, min(64 * w + 63, n_days - 1)
        back = lambda d: F.datediff(end_date, d)
        kept = F.filter(dates, lambda d: d.isNotNull() & back(d).between(first, last))
        one = F.lit(1).cast("bigint")
        return F.aggregate(
            kept, F.lit(0).cast("bigint"), lambda acc, d: acc.bitwiseOR(F.call_function("shiftleft", one, F.lit(63 + first) - back(d)))
        )

    return F.array(*[word(w) for w in range(n_words(n_days))])


def advance_bits(words: Column, active: Column, n_days: int) -> Column:
    """The words one day later: every day moves one bit down, the lowest bit of
    a word into the highest of the next, days that leave the window go, and
    the highest bit says whether the new day was ``active``."""
    count, spare = n_words(n_days), 64 * n_words(n_days) - n_days
    one = F.lit(1).cast("bigint")
    top = F.call_function("shiftleft", one, F.lit(63))
    out = []
    for w in range(count):
        moved = F.call_function("shiftrightunsigned", F.get(words, F.lit(w)), F.lit(1))
        into = F.coalesce(active, F.lit(False)) if w == 0 else F.get(words, F.lit(w - 1)).bitwiseAND(one) == 1
        word = moved.bitwiseOR(F.when(into, top).otherwise(F.lit(0).cast("bigint")))
        if w == count - 1 and spare:
            word = F.call_function("shiftleft", F.call_function("shiftrightunsigned", word, F.lit(spare)), F.lit(spare))
        out.append(word)
    return F.array(*out)


def wide_bits_text(words: Column, n_days: int) -> Column:
    """The window as text of ``n_days`` characters, newest day first."""
    return F.substring(F.array_join(F.transform(words, lambda w: F.lpad(F.bin(w), 64, "0")), ""), 1, n_days)


def wide_bits_count(words: Column, last_days: int | None = None) -> Column:
    """Days set among the newest ``last_days`` (all by default)."""
    if last_days is None:
        return F.aggregate(words, F.lit(0), lambda n, w: n + F.bit_count(w))
    total = F.lit(0)
    for w in range(n_words(last_days)):
        spare = max(0, 64 * (w + 1) - last_days)
        total = total + F.bit_count(F.call_function("shiftrightunsigned", F.get(words, F.lit(w)), F.lit(spare)))
    return total
