"""Quality rules: a learned decision list over text statistics.

Statistics of every whole text are computed in Arrow and numpy inside the
tasks.  A decision list is learned from labelled rows by sequential covering
(IREP): on a growing part of the rows a rule is grown by adding the threshold
condition of highest FOIL gain, then cut back on a pruning part; accepted
rules leave the list's rows and the next one is grown, until no rule reaches
the asked precision.  The list is emitted as one ordered Spark conditional
(``CASE WHEN rule1 THEN false WHEN rule2 ... ELSE true END``).

The fit uses at most ``max_rows`` labelled rows (a documented bound, taken in
the order of a hash of the id); statistics and verdicts cover every row.

Edge cases: a null text has no words, so every count is 0; ids with
conflicting or null labels do not take part in the fit; with fewer than
``min_support`` labelled rows of a class the list is empty and keeps all;
repeated rows repeat; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm.text import hash_words, mix, slices, split_words, texts, windows, word_ids

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_upper_words", "n_digit_words", "n_marks",
)


def _dup_lines(text: str) -> tuple[int, int]:
    """Lines that hold a word, and those of them equal to an earlier one."""
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def repeat_words(ids_hash: np.ndarray, offsets: np.ndarray, k: int) -> np.ndarray:
    """Per text: words inside a ``k``-word window found twice or more in it."""
    n = np.diff(offsets)
    doc = np.repeat(np.arange(len(n)), n)
    fps = windows(ids_hash, k)
    if len(fps) == 0:
        return np.zeros(len(n), np.int64)
    inside = doc[: len(fps)] == doc[k - 1 :]
    starts = np.flatnonzero(inside)
    keys = fps[starts] ^ mix(doc[starts].astype(np.uint64) + np.uint64(1))
    order = np.sort(keys)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    if len(twice) == 0:
        return np.zeros(len(n), np.int64)
    hit = starts[pc.is_in(pa.array(keys), value_set=pa.array(twice)).to_numpy(zero_copy_only=False)]
    edge = np.zeros(len(ids_hash) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + k, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.diff(np.concatenate([[0], np.cumsum(covered)])[offsets])


def statistics(column: pa.Array, k: int = WINDOW) -> dict[str, np.ndarray]:
    """The counts of every text of a column (null: the empty text)."""
    col = texts(column)
    parts: list[list[np.ndarray]] = []
    for a, b in slices(col):
        rows = col.slice(a, b - a)
        offsets, flat = split_words(rows)
        ids, vocab = word_ids(flat)
        sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[ids])])[offsets])
        size = pc.utf8_length(vocab).to_numpy(zero_copy_only=False).astype(np.int64)
        upper = (pc.utf8_is_upper(vocab).to_numpy(zero_copy_only=False) & (size > 1)).astype(np.int64)
        digit = pc.match_substring_regex(vocab, "[0-9]").to_numpy(zero_copy_only=False).astype(np.int64)
        lines = np.array([_dup_lines(t) for t in rows.to_pylist()], np.int64).reshape(-1, 2)
        count = lambda regex: pc.count_substring_regex(rows, regex).to_numpy(zero_copy_only=False).astype(np.int64)
        parts.append([
            np.diff(offsets), sums(size), count("[#*$%&|<>]"), lines[:, 0], lines[:, 1],
            repeat_words(hash_words(vocab)[ids], offsets, k), sums(upper), sums(digit), count("[!?]"),
        ])
    return {
        name: np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i, name in enumerate(_COUNTS)
    }


def text_statistics(text: Column) -> Column:
    """struct of the counts, all long."""

    @F.arrow_udf("struct<" + ",".join(f"{c}:long" for c in _COUNTS) + ">")
    def counted(column: pa.Array) -> pa.Array:
        got = statistics(column)
        return pa.StructArray.from_arrays([pa.array(got[c], pa.int64()) for c in _COUNTS], list(_COUNTS))

    return counted(text)


def base_failed(stats: Column) -> Column:
    """Too short, or too much of it repeated."""
    return (stats["n_words"] < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * stats["n_words"])


#: The ratios rules may test; each is 0 for a text without words.
FEATURES = (
    "n_words", "mean_chars", "symbols_per_word", "dup_line_share", "repeat_share",
    "upper_share", "digit_share", "marks_per_word", "words_per_line",
)


def features(stats: Column) -> dict[str, Column]:
    per = lambda a, b: F.when(stats[b] > 0, stats[a] / stats[b]).otherwise(F.lit(0.0))
    return {
        "n_words": stats["n_words"].cast("double"),
        "mean_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "dup_line_share": per("n_dup_lines", "n_lines"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "upper_share": per("n_upper_words", "n_words"),
        "digit_share": per("n_digit_words", "n_words"),
        "marks_per_word": per("n_marks", "n_words"),
        "words_per_line": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for c in rule:
        v = x[:, FEATURES.index(c.feature)]
        out &= v > c.threshold if c.above else v <= c.threshold
    return out


def _best_condition(x: np.ndarray, bad: np.ndarray) -> Condition | None:
    """The condition of highest FOIL gain over the rows given."""
    p0, n0 = bad.sum(), (~bad).sum()
    best, gain = None, 1e-9
    before = np.log2(p0 / (p0 + n0))
    for i, name in enumerate(FEATURES):
        order = np.argsort(x[:, i], kind="stable")
        v, b = x[order, i], bad[order]
        cut = np.flatnonzero(v[1:] > v[:-1])  # rows up to and with `cut` lie at or below
        if len(cut) == 0:
            continue
        p_low, n_low = np.cumsum(b)[cut], np.cumsum(~b)[cut]
        for above, p, n in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
            with np.errstate(divide="ignore", invalid="ignore"):
                g = np.where(p > 0, p * (np.log2(p / (p + n)) - before), -1.0)
            j = int(np.argmax(g))
            if g[j] > gain:
                gain, best = g[j], Condition(name, above, float((v[cut[j]] + v[cut[j] + 1]) / 2))
    return best


def learn_rules(
    x: np.ndarray,
    bad: np.ndarray,
    max_rules: int = 24,
    max_conditions: int = 4,
    min_precision: float = 0.95,
    min_support: int = 8,
    seed: int = 7,
) -> list[Rule]:
    """Ordered rules for the bad rows."""
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    x, bad = np.asarray(x, float), np.asarray(bad, bool)
    while len(rules) < max_rules and min(bad.sum(), (~bad).sum()) >= min_support:
        growing = rng.random(len(x)) < 2 / 3
        gx, gb, px, pb = x[growing], bad[growing], x[~growing], bad[~growing]
        rule: Rule = ()
        while len(rule) < max_conditions:
            on = _holds(rule, gx)
            if not gb[on].any() or not (~gb[on]).any() or (c := _best_condition(gx[on], gb[on])) is None:
                break
            rule += (c,)
        worth = lambda r: (2 * pb[m].mean() - 1) if (m := _holds(r, px)).any() else -1.0
        shorter = [rule[:i] for i in range(1, len(rule) + 1)]
        if not shorter:
            break
        rule = max(shorter, key=lambda r: (worth(r), -len(r)))
        on = _holds(rule, x)
        held = _holds(rule, px)
        if bad[on].sum() < min_support or bad[on].mean() < min_precision or not held.any() or pb[held].mean() < min_precision:
            break
        rules.append(rule)
        x, bad = x[~on], bad[~on]
    return rules


def verdict(rules: list[Rule], stats: Column) -> Column:
    """The decision list as one ordered conditional: false where a rule
    rejects, true where none does."""
    cols, out = features(stats), None
    for rule in rules:
        cond = F.lit(True)
        for c in rule:
            cond &= cols[c.feature] > F.lit(c.threshold) if c.above else cols[c.feature] <= F.lit(c.threshold)
        out = F.when(cond, F.lit(False)) if out is None else out.when(cond, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit_rules(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    text_col: str = "text",
    id_col: str = "doc_id",
    max_rows: int = 20_000,
    **how,
) -> list[Rule]:
    """Learn rules for rows labelled 0 from at most ``max_rows`` of them."""
    agreed = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("_i"))
        .agg(F.min(label_col).alias("_y"), F.max(label_col).alias("_z"))
        .where("_y = _z")
        .select("_i", "_y")
        .orderBy(F.xxhash64("_i"), "_i")
        .limit(max_rows)
    )
    rows = (
        docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
        .join(F.broadcast(agreed), "_i")  # at most max_rows (id, label) pairs
        .select("_y", text_statistics(F.col("_t")).alias("_s"))
    )
    stats = F.col("_s")
    got = rows.select("_y", *[c.alias(n) for n, c in features(stats).items()]).limit(4 * max_rows).toPandas()
    return learn_rules(got[list(FEATURES)].to_numpy(float), got["_y"].to_numpy(int) == 0, **how)


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``docs`` with ``_stats`` (struct), ``base_failed`` and ``kept`` of every
    row appended under the names ``_tf_stats``, ``_tf_failed``, ``_tf_kept``."""
    with_stats = docs.withColumn("_tf_stats", text_statistics(F.col(text_col)))
    stats = F.col("_tf_stats")
    failed = base_failed(stats)
    return with_stats.withColumns({"_tf_failed": failed, "_tf_kept": ~failed & verdict(rules, stats)})
