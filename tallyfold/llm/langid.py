"""Language identification: sparse multinomial logistic regression on TF-IDF
character n-grams, trained with follow-the-regularised-leader (FTRL-proximal,
elastic-net penalty), then calibrated with a temperature.

N-grams of one to three characters of the lower-cased text are hashed into
``DIM`` features; a feature's value is ``(1 + log tf) * idf``, rows scaled to
unit length.  The fit runs on a bounded sample of labelled rows (at most
``max_rows`` whole texts of at most ``max_chars`` characters, in the order of
a hash of the id): document frequencies and weights from four fifths of it,
the temperature from the rest.  Every whole text is then scored in the tasks
with the weights, a broadcast of ``DIM`` x languages floats.

Edge cases: a null text, or one without a letter, is ``und`` with score 0;
equal scores go to the language first in code-point order; with no labelled
row at all every text is ``und``; repeated rows repeat.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM_BITS = 15
DIM = 1 << DIM_BITS
UNKNOWN = "und"

_A, _B = np.uint32(2654435761), np.uint32(2246822519)


def _ngrams(text: str) -> np.ndarray:
    """Feature numbers of all 1- to 3-grams; ASCII characters that are not
    letters count as one space."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    c[(c < 128) & ~((c >= 97) & (c <= 122))] = 32
    down = np.uint32(32 - DIM_BITS)
    one = (c + np.uint32(1)) * _A
    two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * _B + one[1:]
    three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * _B + one[2:]
    stir = lambda h: ((h ^ (h >> np.uint32(16))) * _A) >> down
    return np.concatenate([stir(one), stir(two), stir(three)])


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    dense = np.bincount(_ngrams(text), minlength=DIM)
    at = np.flatnonzero(dense)
    return at, 1.0 + np.log(dense[at])


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # DIM x languages
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, tf = _counts(text)
        v = tf * self.idf[at]
        norm = np.sqrt(v @ v)
        return at, v / norm if norm > 0 else v

    def logits(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        return v @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        p = _softmax(self.logits(*self.vector(text)) / self.temperature)
        i = int(np.argmax(p))
        return self.languages[i], float(p[i])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(
    samples: list[tuple[str, str]],
    epochs: int = 3,
    alpha: float = 2.0,
    beta: float = 1.0,
    l1: float = 2e-3,
    l2: float = 1e-2,
    seed: int = 11,
) -> Model:
    """Train on (text, language) pairs."""
    languages = sorted({lang for _, lang in samples})
    if not languages:
        return Model([], np.zeros(DIM), np.zeros((DIM, 0)), np.zeros(0))
    order = np.random.default_rng(seed).permutation(len(samples))
    cut = len(order) - len(order) // 5
    train, held = order[:cut], order[cut:]
    rows = {i: _counts(samples[i][0]) for i in order.tolist()}
    df = np.zeros(DIM)
    for i in train:
        df[rows[i][0]] += 1
    idf = np.log((1 + len(train)) / (1 + df)) + 1.0
    k = len(languages)
    # The bias is one more coordinate with value 1.
    z, n, w = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k))
    model = Model(languages, idf, w[:DIM], w[DIM])
    vectors = {}
    for i, (at, tf) in rows.items():
        v = tf * idf[at]
        norm = np.sqrt(v @ v)
        vectors[i] = np.append(at, DIM), np.append(v / norm if norm > 0 else v, 1.0)
    truth = {lang: i for i, lang in enumerate(languages)}
    for _ in range(epochs):
        for i in np.random.default_rng(seed).permutation(train):
            at, v = vectors[i]
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            p = _softmax(v @ wi)
            p[truth[samples[i][1]]] -= 1.0
            g = v[:, None] * p
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - sigma * wi
            n[at] = ni + g * g
    w[:] = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    model = Model(languages, idf, w[:DIM].copy(), w[DIM].copy())
    if len(held):
        logits = np.array([model.logits(vectors[i][0][:-1], vectors[i][1][:-1]) for i in held])
        y = np.array([truth[samples[i][1]] for i in held])
        model.temperature = calibrate(logits, y)
    return model


def calibrate(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log-likelihood (golden section over
    its logarithm)."""

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))
        return -float(np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean())

    lo, hi, g = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit_languages(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    max_rows: int = 4000,
    max_chars: int = 20_000,
    **how,
) -> Model:
    """Fit on a bounded sample of ``docs`` (rows with null text or language
    do not count)."""
    usable = docs.select(
        F.xxhash64(F.col(id_col).cast("string")).alias("h"), F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("l")
    ).where(F.col("t").isNotNull() & F.col("l").isNotNull() & (F.length("t") <= max_chars))
    first = usable.select("h").orderBy("h").limit(max_rows).agg(F.max("h")).first()[0]
    rows = [] if first is None else usable.where(F.col("h") <= first).limit(2 * max_rows).collect()
    rows.sort(key=lambda r: (r.h, r.l, r.t))
    return fit([(r.t, r.l) for r in rows], **how)


def identify(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predicted(column: pa.Array) -> pa.Array:
        m = shared.value
        got = [m.predict(x.as_py()) for x in column]
        return pa.StructArray.from_arrays(
            [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], ["lang_pred", "score"]
        )

    return (
        docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t"))
        .select("_i", predicted("_t").alias("_p"))
        .select(F.col("_i").alias(id_col), "_p.*")
    )
