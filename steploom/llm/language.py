"""Language identification with string kernels, landmarks and kernel ridge regression."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from steploom.session import materialize

from .common import crc_of

UNKNOWN = "und"
_GROUP_DOCS = 64
#: Characters of a text that are turned into grams at once.
_PIECE = 1 << 20


@dataclass(frozen=True)
class LangConfig:
    """``landmarks`` texts span the feature space and ``sample`` texts are learned from, both split evenly over the languages.

    Grams of 1 to 3 signs: all letters of all scripts, and one gap for everything between words.
    They are hashed into ``2 ** slot_bits`` slots.
    """

    landmarks: int = 128
    sample: int = 1600
    slot_bits: int = 17
    ridge: float = 1e-2
    sharpness: float = 4.0
    held_out: tuple[int, int] = (4, 2)


def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


#: Multipliers of the signs of a gram, and what tells grams of different lengths apart.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], dtype=np.uint64)
_LENGTHS = np.array([0, 0x2545F4914F6CDD1D, 0xA0761D6478BD642F], dtype=np.uint64)


class Grams:
    """Presence of the grams of one, two and three signs in texts."""

    def __init__(self, slot_bits: int):
        self.table = np.where(_letters(), np.arange(0x110000), 0).astype(np.uint64)
        self.size = 1 << slot_bits
        self.shift = np.uint64(64 - slot_bits)

    def presence(self, texts: list[str], piece: int = _PIECE) -> np.ndarray:
        """A row for each text.  Long texts go through in pieces; the last two signs of a piece go before the next one."""
        found = np.zeros((len(texts), self.size), dtype=bool)
        for row, text in zip(found, texts, strict=True):
            lowered, carried = text.lower(), np.zeros(1, dtype=np.uint64)
            for lo in range(0, max(1, len(lowered)), piece):
                signs = self.table[np.frombuffer(lowered[lo : lo + piece].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
                end = np.zeros(int(lo + piece >= len(lowered)), dtype=np.uint64)
                s = np.concatenate([carried, signs, end])
                s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]
                first, second, third = (s * f for f in _FACTORS)
                row[first[s != 0] >> self.shift] = True
                row[(first[:-1] + second[1:] + _LENGTHS[1]) >> self.shift] = True
                row[(first[:-2] + second[1:-1] + third[2:] + _LENGTHS[2]) >> self.shift] = True
                carried = s[-2:]
        return found


@dataclass
class LangModel:
    """Landmarks as columns of a presence matrix over the grams that some landmark has."""

    config: LangConfig
    languages: list[str]
    vocabulary: np.ndarray
    landmarks: np.ndarray
    sizes: np.ndarray
    weights: np.ndarray

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_grams"}

    def kernel(self, texts: list[str]) -> np.ndarray:
        """Normalised number of grams that each text shares with each landmark."""
        grams = self.__dict__.get("_grams") or self.__dict__.setdefault("_grams", Grams(self.config.slot_bits))
        return self.kernel_of(grams.presence(texts))

    def kernel_of(self, found: np.ndarray) -> np.ndarray:
        """The kernel of texts whose grams are known."""
        shared = found[:, self.vocabulary].astype(np.float32) @ self.landmarks
        sizes = np.maximum(found.sum(1), 1)
        return shared / np.sqrt(sizes[:, None] * self.sizes[None, :])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return names, scores
        known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        for lo in range(0, len(known), _GROUP_DOCS):
            rows = known[lo : lo + _GROUP_DOCS]
            value = self.kernel([texts[i] for i in rows]) @ self.weights
            power = np.exp(self.config.sharpness * (value - value.max(1, keepdims=True)))
            best = value.argmax(1)
            share = power[np.arange(len(rows)), best] / power.sum(1)
            for i, b, s in zip(rows, best.tolist(), share.tolist(), strict=True):
                names[i], scores[i] = self.languages[b], s
        return names, scores


def landmark_model(found: np.ndarray, config: LangConfig) -> LangModel:
    """A model that knows its landmarks, by the presence of their grams, and no language yet."""
    vocabulary = np.flatnonzero(found.any(0))
    columns = found[:, vocabulary].T.astype(np.float32)
    return LangModel(config, [], vocabulary, columns, np.maximum(found.sum(1), 1), np.zeros((0, 0)))


def fit_languages(model: LangModel, among: np.ndarray, rows: np.ndarray, languages: list[str]) -> LangModel:
    """Nyström features from the kernel of the landmarks ``among`` themselves, and ridge regression of one
    language against the rest on the kernel ``rows`` of the sample."""
    names = sorted(set(languages))
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    root = vectors @ np.diag(np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)) @ vectors.T
    features = rows @ root
    wanted = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    # Languages count equally, whatever their share of the sample.
    weight = np.array([1 / languages.count(x) for x in languages])
    weight *= len(languages) / weight.sum()
    system = features.T @ (features * weight[:, None]) + model.config.ridge * len(languages) / len(names) * np.eye(len(root))
    model.languages = names
    model.weights = root @ np.linalg.solve(system, features.T @ (wanted * weight[:, None]))
    return model


def held_out(key, config: LangConfig):
    """Whether a document is kept out of learning; false for a NULL id."""
    modulus, rest = config.held_out
    return F.coalesce(crc_of(key) % modulus == rest, F.lit(False))


def train_languages(docs: DataFrame, config: LangConfig | None = None) -> LangModel:
    """Learn from a bounded sample of ``docs`` (``doc_id``, ``text``, ``lang``) that are not held out.

    No text reaches the driver: landmarks send a bit for each gram slot, the rest of the sample its kernel rows.
    The documents to choose from and the sample are stored, so all texts are scanned twice.

    Of each language the same number of documents is taken, those with the smallest hashes of their
    ids (ties: the smaller id).  Hashes below a limit that follows from the language's number of documents are ranked,
    several times as many as are taken, so a frequent language is no hot spot.  Rows
    with a NULL id, NULL language or NULL or empty text are not learned from; of several texts of an id and
    language the smallest is.  No rows give a model that answers ``UNKNOWN``.
    """
    config = config or LangConfig()
    usable = docs.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id"), config)
    )
    ids = materialize(usable.select("doc_id", "lang", F.xxhash64("doc_id").alias("h")).distinct(), "usable")
    # Stored, so that the planner knows how small the table is.
    counts = materialize(ids.groupBy("lang").count(), "languages")
    n_languages = max(1, counts.count())
    each = max(1, config.sample // n_languages)
    order = ["h", "doc_id"]
    # Hashes are even over all longs: the limit leaves 4 * each + 64 of a language's documents, give or take their root.
    share = F.lit(4.0 * each + 64) / F.col("count")
    low = ids.join(counts, "lang").where((share >= 1) | (F.col("h") < (share - 0.5) * F.lit(2.0**64)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    chosen = low.withColumn("rank", rank).where(F.col("rank") <= each).select("doc_id", "lang", "rank")
    # At most config.sample rows are sent to all tasks.
    picked = usable.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"])
    sample = materialize(picked.groupBy("doc_id", "lang", "rank").agg(F.min("text").alias("text")), "sample")

    def bits(batches):
        grams = Grams(config.slot_bits)
        for batch in batches:
            yield batch[["doc_id", "lang", "rank"]].assign(x=[np.packbits(grams.presence([t])[0]).tobytes() for t in batch["text"]])

    wanted = sample.where(F.col("rank") <= max(1, config.landmarks // n_languages))
    kind = sample.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang string, rank int, x binary"
    order = lambda r: (r["rank"], r["lang"], r["doc_id"])
    first = sorted(wanted.mapInPandas(bits, schema).collect(), key=order)
    found = np.zeros((len(first), 1 << config.slot_bits), dtype=bool)
    for row, r in zip(found, first, strict=True):
        row[:] = np.unpackbits(np.frombuffer(r["x"], dtype=np.uint8), count=len(row))
    model = landmark_model(found, config)
    if not first:
        return model

    def kernels(batches):
        for batch in batches:
            values = batch["text"].tolist()
            parts = [model.kernel(values[i : i + _GROUP_DOCS]) for i in range(0, len(values), _GROUP_DOCS)]
            yield batch[["doc_id", "lang", "rank"]].assign(x=[row.tobytes() for part in parts for row in part])

    got = sorted(sample.mapInPandas(kernels, schema).collect(), key=order)
    rows = np.stack([np.frombuffer(r["x"]) for r in got])
    return fit_languages(model, model.kernel_of(found), rows, [r["lang"] for r in got])


def identify(model: LangModel):
    """A function of a text column: a struct of ``lang_pred`` and ``score``.

    NULL texts and those without a letter are ``UNKNOWN`` with score 0; equal values go to the smaller name.
    Whole texts count, however long; repeated rows are judged alike.
    """

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        names, scores = model.predict(text.tolist())
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict
