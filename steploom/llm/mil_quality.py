"""Text quality by attention-based multiple-instance learning: a document is a bag of passages."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steploom.session import materialize

from .common import crc_of
from .wordhash import GROUP_BYTES, mixed, normalized, span_hashes

FEATURES = (
    "log_words", "word_chars", "upper", "digit", "symbol", "bang", "bar", "stop", "comma", "other_script",
    "repeated", "distinct", "single", "long", "symbol_words", "upper_words", "bag_distinct", "log_bag_words",
)


@dataclass(frozen=True)
class MilConfig:
    """``sample_per_class`` labelled documents of each class are learned from, fewer if they have over half of
    ``passages`` passages together; learning and scoring use every passage of a document."""

    passage_words: int = 48
    hidden: int = 16
    attention: int = 8
    sample_per_class: int = 2000
    passages: int = 512_000
    epochs: int = 250
    rate: float = 0.02
    decay: float = 1e-3
    held_out: tuple[int, int] = (3, 1)
    seed: int = 5


def _byte_table(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[list(characters.encode("ascii"))] = 1
    return table


_TABLES = {
    "upper": _byte_table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "lower": _byte_table("abcdefghijklmnopqrstuvwxyz"),
    "digit": _byte_table("0123456789"),
    "symbol": _byte_table("#*$%&|<>~^_=+\\/@[]{}"),
    "bang": _byte_table("!"),
    "bar": _byte_table("|"),
    "stop": _byte_table(".?"),
    "comma": _byte_table(",;:"),
    "lead": (np.arange(256) >= 0xC0).astype(np.uint8),
    "follow": ((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0)).astype(np.uint8),
}


def passage_features(texts: list[str | None], passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages and the number of passages of each text.

    Passages are runs of ``passage_words`` words.  A text without words is one passage of zeros.
    """
    bags, group, size = [], [], 0
    for t in (normalized(x, lower=False) for x in texts):
        if group and size + len(t) > GROUP_BYTES:
            bags.append(_group_features(group, passage_words))
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        bags.append(_group_features(group, passage_words))
    if not bags:
        return np.zeros((0, len(FEATURES))), np.zeros(0, dtype=np.int64)
    return np.concatenate([b[0] for b in bags]), np.concatenate([b[1] for b in bags])


def _group_features(texts: list[bytes], passage_words: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(t or b"\x00 " for t in texts), dtype=np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    text_ends = np.cumsum([len(t) or 2 for t in texts])
    last = np.searchsorted(ends, text_ends, side="left")
    first = np.concatenate([[0], last[:-1]])
    counts = -(-(last - first) // passage_words)
    bag = np.repeat(np.arange(len(texts)), counts)
    inner = np.arange(len(bag)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = first[bag] + inner * passage_words
    n = np.minimum(begin + passage_words, last[bag]) - begin
    per_word = lambda table: np.add.reduceat(table[data], starts, dtype=np.int32)
    sums = {k: np.add.reduceat(per_word(t), begin, dtype=np.int64) for k, t in _TABLES.items()}
    chars = (ends - starts) - per_word(_TABLES["follow"])
    letters = np.maximum(sums["upper"] + sums["lower"] + sums["lead"], 1)
    all_chars = np.maximum(np.add.reduceat(chars, begin), 1)
    word_id = span_hashes(data, starts, ends)
    passage = np.repeat(np.arange(len(begin)), n)
    same = np.concatenate([[False], (word_id[1:] == word_id[:-1])])
    same[begin] = False
    share = lambda flags: np.add.reduceat(flags.astype(np.int64), begin) / n
    bag_words = last - first
    columns = [
        np.log1p(n), all_chars / n, sums["upper"] / letters, sums["digit"] / all_chars, sums["symbol"] / all_chars,
        sums["bang"] / n, sums["bar"] / n, sums["stop"] / n, sums["comma"] / n, sums["lead"] / letters,
        share(same), _distinct(word_id, passage, len(begin)) / n, share(chars == 1), share(chars > 15),
        share(per_word(_TABLES["symbol"]) > 0), share(per_word(_TABLES["upper"]) > 1),
        (_distinct(word_id, np.repeat(np.arange(len(texts)), bag_words), len(texts)) / bag_words)[bag], np.log1p(bag_words)[bag],
    ]
    features = np.stack(columns, axis=1)
    empty = np.array([not t for t in texts])
    features[empty[bag]] = 0
    return features, counts


def _distinct(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Number of different values of each owner."""
    own = mixed(values + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(own, return_index=True)
    return np.bincount(owner[first], minlength=n)


@dataclass
class MilModel:
    """Standardised features, a tanh encoding of each passage, gated attention, and a logistic score."""

    config: MilConfig
    centre: np.ndarray
    spread: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        w, starts = self.weights, np.cumsum(counts) - counts
        h = np.tanh(x @ w["encode"] + w["encode_0"])
        gate_a, gate_b = np.tanh(h @ w["signal"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = (gate_a * gate_b) @ w["attend"]
        top = np.maximum.reduceat(e, starts)
        a = np.exp(e - np.repeat(top, counts))
        a /= np.repeat(np.add.reduceat(a, starts), counts)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        logit = z @ w["score"] + w["score_0"]
        return {"h": h, "gate_a": gate_a, "gate_b": gate_b, "a": a, "z": z, "logit": logit}

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x, counts = passage_features(texts, self.config.passage_words)
        if not len(counts):
            return np.zeros(0)
        logit = self.forward((x - self.centre) / self.spread, counts)["logit"]
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    def attention(self, text: str | None) -> np.ndarray:
        """Weight of each passage of a text."""
        x, counts = passage_features([text], self.config.passage_words)
        return self.forward((x - self.centre) / self.spread, counts)["a"]


def fit_mil(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, config: MilConfig) -> MilModel:
    """Weights by Adam on the mean log loss of the documents, with weight decay.

    Classes count equally.  Without documents of both classes the score is the share of label 1 (0.5 without any).
    """
    random = np.random.default_rng(config.seed)
    d, k, m = len(FEATURES), config.hidden, config.attention
    model = MilModel(config, np.zeros(d), np.ones(d))
    draw = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = model.weights = {
        "encode": draw(d, k), "encode_0": np.zeros(k), "signal": draw(k, m), "gate": draw(k, m),
        "attend": draw(m), "score": draw(k), "score_0": np.zeros(1),
    }
    if len(np.unique(labels)) < 2:
        share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
        w["score"][:] = 0
        w["score_0"][:] = np.log(share / (1 - share))
        return model
    model.centre, model.spread = x.mean(0), x.std(0) + 1e-6
    x = (x - model.centre) / model.spread
    starts = np.cumsum(counts) - counts
    each = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    first = {n: np.zeros_like(v) for n, v in w.items()}
    second = {n: np.zeros_like(v) for n, v in w.items()}
    for epoch in range(1, config.epochs + 1):
        f = model.forward(x, counts)
        d_logit = (1 / (1 + np.exp(-f["logit"])) - labels) * each
        d_z = d_logit[:, None] * w["score"]
        d_z_each = np.repeat(d_z, counts, axis=0)
        d_a = (d_z_each * f["h"]).sum(1)
        d_e = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, starts), counts))
        d_gates = d_e[:, None] * w["attend"]
        d_signal = d_gates * f["gate_b"] * (1 - f["gate_a"] ** 2)
        d_gate = d_gates * f["gate_a"] * f["gate_b"] * (1 - f["gate_b"])
        d_h = f["a"][:, None] * d_z_each + d_signal @ w["signal"].T + d_gate @ w["gate"].T
        d_pre = d_h * (1 - f["h"] ** 2)
        grads = {
            "encode": x.T @ d_pre, "encode_0": d_pre.sum(0), "signal": f["h"].T @ d_signal, "gate": f["h"].T @ d_gate,
            "attend": (f["gate_a"] * f["gate_b"]).T @ d_e, "score": f["z"].T @ d_logit, "score_0": d_logit.sum(keepdims=True),
        }
        for n, g in grads.items():
            g = g + config.decay * w[n]
            first[n] = 0.9 * first[n] + 0.1 * g
            second[n] = 0.999 * second[n] + 0.001 * g * g
            w[n] -= config.rate * (first[n] / (1 - 0.9**epoch)) / (np.sqrt(second[n] / (1 - 0.999**epoch)) + 1e-8)
    return model


def held_out(key, config: MilConfig):
    """Whether a document is kept out of learning; false for a NULL id."""
    modulus, rest = config.held_out
    return F.coalesce(crc_of(key) % modulus == rest, F.lit(False))


def within_bound(sizes: list[tuple[int, int, int]], config: MilConfig) -> set[int]:
    """Ids of the documents to learn from, of ids, labels and numbers of passages in the order of choice.

    A document is taken whole if its passages still fit, and left out whole if not; the first of a class is always taken.
    """
    room, taken = {}, set()
    for doc_id, label, n in sizes:
        if label not in room or n <= room[label]:
            room[label] = room.get(label, config.passages // 2) - n
            taken.add(doc_id)
    return taken


def train_quality(docs: DataFrame, labels: DataFrame, config: MilConfig | None = None) -> MilModel:
    """Learn from a bounded sample of the labelled documents that are not held out.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``quality``.  Of
    each class the documents with the smallest hashes of their ids are taken, each with all its passages.
    Features are made where the texts are; only they reach the driver, at most ``passages`` rows
    unless a class's first document alone has more than half as many.
    Rows with a NULL id or label are not learned from; of several labels of a document
    the mean decides (from 0.5 up: 1).
    """
    config = config or MilConfig()
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"), config))
    marked = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    hashed = F.xxhash64("doc_id")
    chosen = marked.where("label = 1").orderBy(hashed, "doc_id").limit(config.sample_per_class)
    chosen = chosen.unionByName(marked.where("label = 0").orderBy(hashed, "doc_id").limit(config.sample_per_class))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(batches):
        for batch in batches:
            x, counts = passage_features(batch["text"].tolist(), config.passage_words)
            parts = np.split(x.astype("f4"), np.cumsum(counts)[:-1]) if len(counts) else []
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "n": counts, "x": [p.tobytes() for p in parts]})

    # Stored, so that numbers of passages can be compared before features reach the driver.
    made = materialize(rows.mapInPandas(features, "doc_id long, label int, n long, x binary"), "passages")
    sizes = made.groupBy("doc_id", "label").agg(F.sum("n").alias("n")).orderBy(hashed, "doc_id").collect()
    taken = within_bound([tuple(r) for r in sizes], config)
    left_out = [r["doc_id"] for r in sizes if r["doc_id"] not in taken]
    got = (made.where(~F.col("doc_id").isin(left_out)) if left_out else made).collect()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.concatenate([np.frombuffer(r["x"], "f4").reshape(r["n"], -1) for r in got]).astype(float) if got else np.zeros((0, len(FEATURES)))
    return fit_mil(x, np.array([r["n"] for r in got], dtype=int), np.array([r["label"] for r in got], dtype=float), config)


def quality_score(model: MilModel):
    """A function of a text column: the probability of label 1, for NULL and empty texts too."""

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        values = text.tolist()
        return pd.Series(np.concatenate([model.scores(values[i : i + 512]) for i in range(0, len(values), 512)] or [np.zeros(0)]))

    return score
