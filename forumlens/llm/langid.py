"""Language identification with string kernels.

The kernel of two texts is the number of letter n-grams (of one to three code points, each
counted once) that both have, over the geometric mean of the numbers they have. A Nyström
map sends a text to its kernel values with a few landmark texts per language, whitened by
the landmarks' own kernel matrix; one ridge regression per language, against the rest, runs
on these features. n-grams are hashed to a fixed number of slots, so that a block of texts
is one 0/1 matrix and its scores are two matrix products.

Fitting uses a bounded sample of labelled rows: at most ``SAMPLE_ROWS`` different texts,
shared evenly by the languages, and ``LANDMARKS`` of them as landmarks. Prediction reads
every whole text and nothing but the text.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0. Repeated
texts get equal results. With no labelled rows everything is ``und``. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import joined_by_group, rows_of, small_batches, stored, text_blocks

SAMPLE_ROWS, LANDMARKS, SLOTS, ORDERS, RIDGE = 2000, 128, 1 << 15, 3, 1e-2
UNKNOWN = "und"
_TEXTS = 128
_LETTERS: dict[str, np.ndarray] = {}


@dataclass
class LanguageModel:
    """Languages, landmark n-gram sets (bits), and the weights from kernel values to one score per language."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    intercept: np.ndarray


def _letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    if "bmp" not in _LETTERS:
        _LETTERS["bmp"] = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)
    out = _LETTERS["bmp"][np.minimum(codes, 0xFFFF)]
    wide = np.flatnonzero(codes > 0xFFFF)
    if len(wide):
        out[wide] = [chr(c).isalpha() for c in codes[wide]]
    return out


def presence(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The 0/1 matrix of hashed n-grams of each text, and whether each text has a letter."""
    parts = [np.frombuffer((t or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    codes = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    letter = _letters(codes)
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, bool)
    keep = letter | first | np.concatenate([[False], letter[:-1]])[:len(letter)]
    codes, owner, letter = np.where(letter, codes, 32).astype(np.uint32)[keep], owner[keep], letter[keep]
    out = np.zeros((len(texts), SLOTS), np.float32)
    flat, gram = out.reshape(-1), np.zeros(len(codes), np.uint32)
    shift = np.uint32(32 - SLOTS.bit_length() + 1)
    for n in range(1, ORDERS + 1):
        m = len(codes) - n + 1
        if m <= 0:
            break
        gram = gram[:m] * np.uint32(0x01000193) + codes[n - 1:] + np.uint32(n)
        slot = ((gram ^ (gram >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> shift
        inside = owner[:m] == owner[n - 1:]
        flat[(owner[:m] * SLOTS + slot)[inside]] = 1
    return out, np.bincount(owner[letter], minlength=len(texts)) > 0


def _kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))[None, :]
    return (a @ b.T) / size


def _unpacked(bits: np.ndarray) -> np.ndarray:
    return np.unpackbits(bits, axis=1).astype(np.float32)


def fit(rows: list[np.ndarray], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """Fit on presence rows (packed bits) and their languages."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((0, SLOTS // 8), np.uint8), np.zeros((0, 0), np.float32), np.zeros(0, np.float32))
    packed = np.stack(rows)
    y = np.array([languages.index(v) for v in labels])
    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(y == c)[:each] for c in range(len(languages))])
    marks = _unpacked(packed[chosen])
    values, vectors = np.linalg.eigh(_kernel(marks, marks).astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    # a block of rows at a time: whole, the sample's matrix would take hundreds of megabytes of the driver
    z = np.concatenate([_kernel(_unpacked(packed[a:a + _TEXTS]), marks) for a in range(0, len(packed), _TEXTS)]) @ whiten
    target = np.where(y[:, None] == np.arange(len(languages)), 1.0, -1.0)
    # every language weighs the same, however many texts it has
    weight = (len(y) / (len(languages) * np.bincount(y)))[y][:, None]
    centre, mean = (weight * z).sum(0) / weight.sum(), (weight * target).sum(0) / weight.sum()
    zc = z - centre
    beta = np.linalg.solve(zc.T @ (weight * zc) + ridge * len(y) / 100 * np.eye(z.shape[1]), zc.T @ (weight * (target - mean)))
    return LanguageModel(languages, packed[chosen], (whiten @ beta).astype(np.float32),
                         (mean - centre @ beta).astype(np.float32))


def score(model: LanguageModel, landmarks: np.ndarray, texts: list) -> tuple[list[str], np.ndarray]:
    """Best language of each text and its score, from 0 to 1."""
    x, known = presence(texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    f = _kernel(x, landmarks) @ model.weights + model.intercept
    best = f.argmax(1)
    value = np.where(known, np.clip((f[np.arange(len(f)), best] + 1) / 2, 0, 1), 0)
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], value.astype(np.float64)


def _presence_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, _TEXTS):
            part = batch.slice(a, _TEXTS)
            bits, known = presence(part.column("text").to_pylist())
            packed = np.packbits(bits.astype(bool), axis=1)
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("key"), pa.array([r.tobytes() for r in packed], pa.binary()),
                                              pa.array(known)], names=["lang", "key", "bits", "known"])


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Fit on at most ``sample_rows`` different labelled texts, as many of each language (fewer where it has fewer).

    The sample is the texts of smallest hash within a language, so copies count once and the
    choice does not depend on how rows are stored. Ids are not looked at.
    """
    small_batches(docs.sparkSession)
    labelled = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("key"))
    # keys are uniform: below this part of their range lie about four times the sample, so no task ranks a whole language
    keys = stored(labelled.select("lang", "key").distinct(), "langid-keys")
    sized = joined_by_group(keys, ["lang"], keys.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "n")
    low = sized.filter(F.col("key") / 2.0 ** 64 + 0.5 <= F.lit(4.0 * max(sample_rows, 250)) / F.col("n"))
    ranked = stored(low.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("key")))
                    .filter(F.col("rank") <= sample_rows).select("lang", "key", "rank"), "langid-sample")
    languages = max(1, ranked.select("lang").distinct().count())
    chosen = ranked.filter(F.col("rank") <= max(1, sample_rows // languages)).orderBy("rank", "lang").limit(sample_rows)
    chosen = stored(chosen.select("lang", "key"), "langid-chosen")
    rows = (rows_of(labelled, "key", chosen).join(chosen, ["lang", "key"]).groupBy("lang", "key").agg(F.min("text").alias("text"))
            .mapInArrow(_presence_rows, "lang string, key bigint, bits binary, known boolean").filter("known"))
    found = sorted({(r.key, r.lang, bytes(r.bits)) for r in rows.collect()})  # at most sample_rows rows of 4 KB
    return fit([np.frombuffer(b, np.uint8) for _, _, b in found], [lang for _, lang, _ in found])


def _predict(model: LanguageModel, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        landmarks = _unpacked(model.landmarks)
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for a, b in text_blocks(texts, 1 << 20):
                for c in range(a, b, _TEXTS):
                    d = min(b, c + _TEXTS)
                    lang, value = score(model, landmarks, texts[c:d])
                    yield pa.RecordBatch.from_arrays([*(x.slice(c, d - c) for x in batch.columns), pa.array(lang, pa.string()),
                                                      pa.array(value)], names=names)

    return run


def classified(docs: DataFrame, model: LanguageModel, text_col: str = "text", lang_as: str = "lang_pred",
               score_as: str = "score") -> DataFrame:
    """``docs`` with the predicted language of every whole text and its score; columns of these names are replaced."""
    small_batches(docs.sparkSession)
    docs = docs.drop(lang_as, score_as)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_as, T.StringType()), T.StructField(score_as, T.DoubleType())])
    return docs.mapInArrow(_predict(model, docs.columns.index(text_col), schema.names), schema)
