"""Language identification (operator 5).

A sparse multinomial logistic regression over TF-IDF weighted character
n-grams (orders 1 to 3, hashed), trained with follow-the-regularised-leader
under an elastic-net penalty, followed by temperature calibration.

* Document frequencies are counted over all training documents, one vector of
  ``BUCKETS`` counters per task, added up in a shuffle.
* The regression is fitted on a bounded sample: about ``fit_rows`` documents
  of each language, drawn by a hash; a fifth of it is set aside for the
  temperature.  Features are extracted on the executors; the driver sees the
  sample's sparse vectors only.
* Prediction is a map over whole texts with the model broadcast (``BUCKETS``
  weights per language).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from telemetra.llm.common import forget_others, forgetting, slices

BUCKETS = 1 << 15
#: Rows drawn per row of the bound, before the bound is applied.
MORE = 1.5
UNKNOWN = "und"
_SPACE = 32
_MULTIPLIERS = (0x9E3779B1, 0x85EBCA77C2B2AE63, 0xC2B2AE3D27D4EB4F)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed n-grams of the lower-cased text and their counts; None without a letter.

    Characters that are no letters count as blanks.
    """
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter()[codes]
    if not letter.any():
        return None
    c = np.where(letter, codes, _SPACE).astype(np.uint64)
    with np.errstate(over="ignore"):
        grams = [c * np.uint64(_MULTIPLIERS[0])]
        for m in _MULTIPLIERS[1:]:
            if len(grams[-1]) < 2:
                break
            grams.append((grams[-1][:-1] ^ (grams[-1][:-1] >> np.uint64(29))) * np.uint64(m) + c[len(grams):])
        mixed = np.concatenate(grams) * np.uint64(_MULTIPLIERS[1])
    counts = np.bincount((mixed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    found = np.nonzero(counts)[0]
    return found, counts[found]


def weigh(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Sublinear TF times IDF, scaled to unit length."""
    x = (1.0 + np.log(counts)) * idf[found]
    norm = np.sqrt((x * x).sum())
    return x / norm if norm > 0 else x


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # BUCKETS x languages
    bias: np.ndarray
    temperature: float

    def logits(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weigh(found, counts, self.idf) @ self.weights[found] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 without a letter or a learned language."""
        grams = ngram_counts(text)
        if grams is None or not self.languages:
            return UNKNOWN, 0.0
        z = self.logits(*grams) / self.temperature
        p = np.exp(z - z.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def train_ftrl(samples: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, epochs: int = 3,
               alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.05, seed: int = 5
               ) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal on ``(buckets, values, class)``; returns weights and bias.

    Per coordinate: z gathers gradients less the drift of the weight, n their
    squares; the weight is the closed-form minimiser under l1 and l2.
    """
    z = np.zeros((BUCKETS + 1, n_classes))
    n = np.zeros((BUCKETS + 1, n_classes))

    def weights(zs, ns):
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(ns)) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(samples)):
            at, x, label = samples[k]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)  # the last coordinate is the bias
            zs, ns = z[at], n[at]
            w = weights(zs, ns)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[label] -= 1.0
            g = x[:, None] * p
            g2 = g * g
            z[at] = zs + g - (np.sqrt(ns + g2) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g2
    w = weights(z, n)
    return w[:BUCKETS], w[BUCKETS]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss (golden-section search over its logarithm).

    Labels count as certain up to 1 / (n + 2) only (Platt's smoothing), so the
    optimum is finite where all n documents are classified rightly.
    """
    if len(labels) == 0 or logits.shape[1] < 2:
        return 1.0
    doubt = 1.0 / (len(labels) + 2)
    want = np.full(logits.shape, doubt / (logits.shape[1] - 1))
    want[np.arange(len(labels)), labels] = 1.0 - doubt

    def loss(log_t: float) -> float:
        z = logits / np.exp(log_t)
        z = z - z.max(axis=1, keepdims=True)
        return float((np.log(np.exp(z).sum(axis=1)) - (want * z).sum(axis=1)).mean())

    low, high, ratio = -4.0, 4.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def held_out(id_col: str):
    """crc32 of the id as text, modulo 4, is 2 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        fit_rows: int = 1500, seed: int = 5) -> Model:
    """Learn from documents that are not held out and have a text and a language.

    ``fit_rows`` bounds the documents of each language that the regression
    sees: those of the least draws, one draw per row; document frequencies
    cover all training documents.
    Without training documents the model knows no language.
    """
    import pyarrow as pa

    train = docs.filter(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    per_lang = {r[0]: r[1] for r in train.groupBy(lang_col).count().collect()}
    languages = sorted(per_lang)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)

    def count(batches):
        forget_others()
        df = np.zeros(BUCKETS + 1, np.int64)  # the last counts documents
        for batch in batches:
            for text in batch.column(0):
                grams = ngram_counts(text.as_py())
                if grams is not None:
                    df[grams[0]] += 1
                    df[BUCKETS] += 1
        found = np.nonzero(df)[0]
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(df[found])], ["bucket", "df"])

    df = np.zeros(BUCKETS + 1)
    for r in train.select(text_col).mapInArrow(count, "bucket long, df long") \
            .groupBy("bucket").agg(F.sum("df").alias("df")).collect():
        df[r["bucket"]] = r["df"]
    idf = np.log((1.0 + df[BUCKETS]) / (1.0 + df[:BUCKETS])) + 1.0

    def vectors(batches):
        for batch in batches:
            langs, sides, at, values = [], [], [], []
            for text, lang, side in zip(batch.column(0), batch.column(1), batch.column(2)):
                grams = ngram_counts(text.as_py())
                if grams is not None:
                    langs.append(lang.as_py())
                    sides.append(side.as_py())
                    at.append(grams[0].astype(np.int32).tobytes())
                    values.append(weigh(*grams, idf).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sides, pa.int32()), pa.array(at, pa.binary()),
                 pa.array(values, pa.binary())], ["lang", "side", "at", "x"])

    def uniform(k: int):
        """A draw from 0 to 1 by a row's identity; copies of a text under other ids draw for themselves."""
        return F.pmod(F.xxhash64(F.lit(k), F.col(id_col), F.col(text_col)), F.lit(1 << 30)) / float(1 << 30)

    share = F.lit(0.0)
    for lang, rows in per_lang.items():
        share = F.when(F.col(lang_col) == lang, min(1.0, MORE * fit_rows / rows)).otherwise(share)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "text"))
    got = train.filter(uniform(seed) < share).select(
        F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), uniform(seed).alias("draw"),
        F.floor(5 * uniform(seed + 1)).cast("int").alias("side")) \
        .withColumn("place", place).filter(F.col("place") <= fit_rows).select("text", "lang", "side") \
        .mapInArrow(vectors, "lang string, side int, at binary, x binary").toPandas() \
        .sort_values(["lang", "at", "x"]).itertuples()
    index = {str(lang): i for i, lang in enumerate(languages)}
    sets: tuple[list, list] = ([], [])
    for r in got:
        sets[r.side == 0].append((np.frombuffer(r.at, np.int32), np.frombuffer(r.x, np.float32).astype(float),
                                  index[r.lang]))
    weights, bias = train_ftrl(sets[0], len(languages), seed=seed)
    logits = np.array([x @ weights[at] + bias for at, x, _ in sets[1]]).reshape(-1, len(languages))
    return Model([str(lang) for lang in languages], idf, weights.astype(np.float32), bias,
                 best_temperature(logits, np.array([y for _, _, y in sets[1]], np.int64)))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, held_out, lang_pred, score`` for every row; see :func:`predict_rows`."""
    return predict_rows(docs, model, text_col).select(
        f"row.{id_col}", held_out(f"row.{id_col}").alias("held_out"), "lang_pred", "score")


def predict_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``), ``lang_pred, score``, from the text alone.

    A null text, or one without a letter, is ``und`` with score 0, as is every
    text when nothing could be learned.  Every row gives a row, repeated ones
    too; an empty table gives an empty result; other columns are carried along.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)
    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))

    def run(batches):
        forget_others()
        own = shared.value
        for batch in slices(batches):
            texts = batch.column(0).field(text_col)
            got = [own.predict(text.as_py()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], ["row", "lang_pred", "score"])

    return given.mapInArrow(forgetting(run), StructType([
        *given.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
