"""A quality classifier by attention over passages (multiple-instance learning).

A text is a bag of passages of ``PASSAGE_WORDS`` words. Each is described by shares of kinds of bytes, by repetition, and by hashed
words and byte pairs, and encoded into a small vector. Gated attention weighs the vectors, a logistic unit scores their weighted sum, and
all of it is learned together from the labels of documents: nothing says which passage is good.

Training takes a bounded sample of labelled texts (``SAMPLE_PER_LABEL``, the smallest hashes of each label) with at most
``TRAIN_PASSAGES`` evenly spaced passages each. Scoring reads every whole text where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import pick, table
from gradlake.session import materialise

PASSAGE_WORDS = 64
HASHED = 48
SAMPLE_PER_LABEL, TRAIN_PASSAGES = 1500, 32
WIDTH, ATTENTION = 24, 12
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.02, 1e-4
CUT = 0.3

#: Kinds of bytes: lower case, upper case, digits, spaces, sentence marks, brackets and quotes, other signs, non-ASCII.
KINDS = 8
KIND = np.full(256, 6, np.uint8)
for _kind, _letters in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\r\x0b\x0c", b".,;:", b"()[]{}\"'", b"")):
    KIND[list(_letters)] = _kind
KIND[128:] = 7
FEATURES = KINDS + 9 + HASHED


def describe(word: bytes) -> int:
    """A word as one number: its 32-bit hash, its length (255 at most), and four flags."""
    flags = (word.isalpha() or word[:-1].isalpha()) | word.isupper() << 1 | (word[-1:] in b".!?") << 2 | (len(word) == 1) << 3
    return xxhash.xxh32_intdigest(word) << 16 | min(len(word), 255) << 8 | flags


class Words(dict):
    """Words seen so far with their numbers, bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        value = self[word] = describe(word)
        return value


WORDS = Words()


def passages(text: bytes, words: int = PASSAGE_WORDS) -> np.ndarray:
    """One row of features per passage; an empty text is one passage without words."""
    tokens = text.split()
    if not tokens:
        return np.zeros((1, FEATURES), np.float32)
    kinds = KIND[np.frombuffer(text, np.uint8)]
    inside = kinds != 3
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = np.flatnonzero(begins)[::words]
    n = len(edges)
    owner = np.repeat(np.arange(n), np.diff([*edges, len(text)]))
    counts = np.bincount(owner * KINDS + kinds[edges[0] :], minlength=n * KINDS).reshape(n, KINDS)
    codes = np.fromiter(map(WORDS.__getitem__, tokens), np.int64, len(tokens))
    hashes, row = codes >> 16, np.arange(len(tokens)) // words
    size = np.bincount(row, minlength=n)
    out = np.zeros((n, FEATURES), np.float32)
    out[:, :KINDS] = counts / counts.sum(1, keepdims=True)
    distinct = np.unique(row << 32 | hashes) >> 32
    columns = [np.bincount(distinct, minlength=n)]
    for lag in (1, 2):
        columns.append(np.bincount(row[lag:][(hashes[lag:] == hashes[:-lag]) & (row[lag:] == row[:-lag])], minlength=n))
    columns.append(np.bincount(row, codes >> 8 & 255, minlength=n) / 10)
    columns += [np.bincount(row, codes >> bit & 1, minlength=n) for bit in range(4)]
    out[:, KINDS : KINDS + 8] = np.stack(columns, 1) / size[:, None]
    out[:, KINDS + 8] = size / words
    out[:, KINDS + 9 :] = np.bincount(row * HASHED + hashes % HASHED, minlength=n * HASHED).reshape(n, HASHED) / size[:, None]
    return out


@dataclass
class Model:
    """Weights: scaling, encoder, the two gates of the attention, and the logistic unit."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags; ``starts`` are the rows at which each bag begins."""
        w = self.weights
        h = np.tanh(x @ w["enc"] + w["enc0"])
        t, g = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        e = (t * g) @ w["a"]
        sizes = np.diff([*starts, len(x)])
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        a = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes, "p": 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -30, 30)))}

    def score(self, bags: list[np.ndarray]) -> np.ndarray:
        """The probability of label 1 of each bag."""
        x = (np.concatenate(bags) - self.mean) / self.scale
        sizes = [len(b) for b in bags]
        return self.forward(x, np.cumsum([0, *sizes[:-1]]))["p"]


def train(bags: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, seed: int = 7) -> Model:
    """Fit by Adam on the weighted log loss; deterministic for a seed."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags)
    mean, scale = every.mean(0), np.maximum(every.std(0), 0.02)
    w = {
        "enc": rng.normal(0, FEATURES**-0.5, (FEATURES, WIDTH)), "enc0": np.zeros(WIDTH), "v": rng.normal(0, WIDTH**-0.5, (WIDTH, ATTENTION)),
        "u": rng.normal(0, WIDTH**-0.5, (WIDTH, ATTENTION)), "a": rng.normal(0, ATTENTION**-0.5, ATTENTION), "out": rng.normal(0, WIDTH**-0.5, WIDTH), "out0": np.zeros(1),
    }
    model = Model(mean, scale, w)
    bags = [(b - mean) / scale for b in bags]
    first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in chosen])
            sizes = np.array([len(bags[i]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            f = model.forward(x, starts)
            d_out = weights[chosen] * (f["p"] - labels[chosen]) / weights[chosen].sum()
            d_z = np.repeat(d_out[:, None] * w["out"], sizes, axis=0)
            d_a = (d_z * f["h"]).sum(1)
            d_e = f["a"] * (d_a - np.repeat(np.add.reduceat(f["a"] * d_a, starts), sizes))
            d_gate = d_e[:, None] * w["a"]
            d_t, d_g = d_gate * f["g"] * (1 - f["t"] ** 2), d_gate * f["t"] * f["g"] * (1 - f["g"])
            d_h = (f["a"][:, None] * d_z + d_t @ w["v"].T + d_g @ w["u"].T) * (1 - f["h"] ** 2)
            grad = {"enc": x.T @ d_h, "enc0": d_h.sum(0), "v": f["h"].T @ d_t, "u": f["h"].T @ d_g, "a": (f["t"] * f["g"]).T @ d_e, "out": f["z"].T @ d_out, "out0": np.array([d_out.sum()])}
            step += 1
            for k, value in grad.items():
                value = value + DECAY * w[k]
                first[k] = 0.9 * first[k] + 0.1 * value
                second[k] = 0.999 * second[k] + 0.001 * value**2
                w[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def bag_of(text: str | None) -> np.ndarray:
    return passages((text or "").encode())


def fit_quality(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """Learn from the labelled texts whose crc32 of the id is not divisible by 5; None without any.

    The sample holds at most ``per_label`` texts of each label, those with the smallest hash of the id; it stands for all of them by
    weights. Rows without id, text or label are left out; repeated ids take their largest label.
    """
    known = pick(labels, id=id_column, label=label).filter("id is not null and label in (0, 1) and crc32(cast(id as string)) % 5 <> 0")
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    counts = dict(known.groupBy("label").count().collect())
    if not counts:
        return None
    picked = [known.filter(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(per_label) for v in (0, 1)]
    sample = materialise(picked[0].union(picked[1]), "sample")  # two per_label rows at most
    texts = pick(df, id=id_column, text=text).filter("text is not null").join(F.broadcast(sample), "id").dropDuplicates(["id"])

    def encode(batches):
        for batch in batches:
            bags = []
            for value in batch.column("text").to_pylist():
                bag = bag_of(value)
                keep = np.unique(np.linspace(0, len(bag) - 1, TRAIN_PASSAGES).astype(int)) if len(bag) > TRAIN_PASSAGES else slice(None)
                bags.append(bag[keep].astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(bags, pa.binary())], ["id", "label", "bag"])

    kind = texts.schema["id"].dataType.simpleString()
    rows = sorted(texts.select("id", F.col("label").cast("int").alias("label"), "text").mapInArrow(encode, f"id {kind}, label int, bag binary").collect())
    if not rows:
        return None
    found = np.array([r["label"] for r in rows])
    taken = np.bincount(found, minlength=2)
    weights = np.array([counts.get(v, 0) / max(1, taken[v]) for v in (0, 1)])[found]
    return train([np.frombuffer(r["bag"], "<f4").reshape(-1, FEATURES).astype(np.float64) for r in rows], found, weights)


def score_batches(model: Model | None, place: int, emit):
    """A batch function that scores column ``place`` and hands batch and scores to ``emit``."""

    def run(batches):
        for batch in batches:
            scores: list[float] = []
            bags: list[np.ndarray] = []
            rows = 0
            for value in batch.column(place):
                bags.append(bag_of(value.as_py()))
                rows += len(bags[-1])
                if rows >= 1 << 14:
                    scores.extend(model.score(bags).tolist() if model else [1.0] * len(bags))
                    bags, rows = [], 0
            if bags:
                scores.extend(model.score(bags).tolist() if model else [1.0] * len(bags))
            yield emit(batch, np.array(scores))

    return run


def score_quality(df: DataFrame, model: Model | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The id and ``score`` of every row. A null text counts as empty and is scored like any other; without a model all score 1.

    Ids are passed on, null and repeated ones too; other columns are left out.
    """
    rows = pick(df, row=id_column, text=text)
    kind = rows.schema["row"].dataType.simpleString()

    def emit(batch, scores):
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [id_column, "score"])

    return rows.mapInArrow(score_batches(model, 1, emit), f"`{id_column}` {kind}, score double")


def keep_good(df: DataFrame, model: Model | None, text: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``df`` that score at least ``cut``, with all their columns."""
    place = df.columns.index(text)

    def emit(batch, scores):
        return batch.filter(pa.array(scores >= cut, pa.bool_()))

    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(df.schema.fields))
    return plain.mapInArrow(score_batches(model, place, emit), fields).toDF(*df.columns)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
