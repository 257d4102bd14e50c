"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words, and only the bag has a label. Each passage is encoded: how often each
word shape occurs in it (letters, capitals, digits and kinds of punctuation, hashed to 64 numbers), word length and
variety, and how many repeat the one before, through a layer of 16 hidden units. Gated attention, softmax of w . (tanh(V h) * sigmoid(U h)), weighs the passages; the
document's score is a logistic unit on the weighted sum. So a page of junk inside a long clean text can be found,
and the weights say where.

The weights are fitted on at most ``TRAIN_ROWS`` labelled documents, of which passages, never texts, come to the
driver. Every document is scored over all its passages where it is read: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import slices
from gaugeline.llm.labelled import id_remainder, training_rows

PASSAGE = 64  # words
SHAPES = 64
FEATURES = SHAPES + 4
HIDDEN, GATES = 16, 8
LONGEST = 64  # bytes of a word; a longer one counts as several
#: Bounds of the sample that is learned from: documents, and passages of all of them together.
TRAIN_ROWS, TRAIN_PASSAGES = 4_000, 100_000
STEPS = 300


def _classes() -> bytes:
    """Byte to class: capitals U, small and non-ASCII letters l, digits d, stops s, white space stays, other marks by value."""
    table = bytearray(b"p" * 256)
    for b in range(256):
        c = chr(b)
        if b >= 128 or "a" <= c <= "z":
            table[b] = ord("l")
        elif "A" <= c <= "Z":
            table[b] = ord("U")
        elif "0" <= c <= "9":
            table[b] = ord("d")
        elif c in ".,;:'\"?-()":
            table[b] = ord("s")
        elif b in b" \t\n\r\x0b\x0c":
            table[b] = b
        elif c in "!|":
            table[b] = ord(c)
    return bytes(table)


CLASSES = _classes()


class Shapes(dict):
    """Number of a word's shape: its classes with repeats and length left out."""

    def __missing__(self, word: bytes) -> int:
        h = 0
        for i, c in enumerate(word):
            if not i or c != word[i - 1]:
                h = (h * 131 + c) % 1_000_003
        if len(self) > 100_000:
            self.clear()
        self[word] = h % SHAPES
        return self[word]


SHAPE_OF = Shapes()


def words_of(data: bytes) -> list[bytes]:
    """Words between ASCII white space; long ones in pieces of ``LONGEST`` bytes, each a word of its own."""
    words = data.split()
    if max(map(len, words), default=0) <= LONGEST:
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def passages(text: str | None) -> np.ndarray:
    """One row of features per passage of the whole text; a text without words is one passage of its own kind."""
    data = (text or "").encode()
    words = words_of(data.translate(CLASSES))
    if not words:
        out = np.zeros((1, FEATURES), "f4")
        out[0, -1] = 1
        return out
    n = len(words)
    shape = np.fromiter(map(SHAPE_OF.__getitem__, words), "i8", n)
    length = np.fromiter(map(len, words), "i8", n)
    rows = -(-n // PASSAGE)
    place = np.arange(n) // PASSAGE
    size = np.bincount(place, minlength=rows).astype("f4")
    out = np.zeros((rows, FEATURES), "f4")
    out[:, :SHAPES] = np.bincount(place * SHAPES + shape, minlength=rows * SHAPES).reshape(rows, SHAPES) / size[:, None]
    out[:, SHAPES] = np.bincount(place, length, rows) / size / 10
    plain = words_of(data)
    out[:, SHAPES + 1] = [len(set(plain[i : i + PASSAGE])) / (min(n, i + PASSAGE) - i) for i in range(0, n, PASSAGE)]
    # How often a word is that before it: words said twice, or over and over.
    again = np.fromiter(map(bytes.__eq__, plain[1:], plain), bool, n - 1)
    out[:, SHAPES + 2] = np.bincount(place[1:], again, rows) / size
    return out


@dataclass
class Model:
    """Weights, by name; ``prior`` is given when there was nothing to learn from."""

    weights: dict[str, np.ndarray] | None
    prior: float = 1.0

    def forward(self, x: np.ndarray, begins: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-(h @ w["U"])))
        s = (t * g) @ w["a"]
        bag = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(x))))
        e = np.exp(s - np.maximum.reduceat(s, begins)[bag])
        alpha = e / np.add.reduceat(e, begins)[bag]
        z = np.add.reduceat(h * alpha[:, None], begins)
        p = 1 / (1 + np.exp(-np.clip(z @ w["u"] + w["c"], -30, 30)))
        return {"h": h, "t": t, "g": g, "bag": bag, "alpha": alpha, "z": z, "p": p}

    def gradients(self, x: np.ndarray, begins: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of documents with labels ``y``, by every weight."""
        w = self.weights
        f = self.forward(x, begins)
        d_logit = (f["p"] - y) / len(y)
        d_z = d_logit[:, None] * w["u"]
        d_h = f["alpha"][:, None] * d_z[f["bag"]]
        d_alpha = (f["h"] * d_z[f["bag"]]).sum(axis=1)
        d_s = f["alpha"] * (d_alpha - np.add.reduceat(f["alpha"] * d_alpha, begins)[f["bag"]])
        d_t = d_s[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2)
        d_g = d_s[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
        d_h += d_t @ w["V"].T + d_g @ w["U"].T
        d_pre = d_h * (1 - f["h"] ** 2)
        return {
            "W": x.T @ d_pre, "b": d_pre.sum(axis=0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_g,
            "a": (f["t"] * f["g"]).T @ d_s, "u": f["z"].T @ d_logit, "c": d_logit.sum(keepdims=True)}

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(bags), self.prior)
        begins = np.cumsum([0] + [len(b) for b in bags[:-1]])
        return self.forward(np.concatenate(bags), begins)["p"]


def fit(bags: list[np.ndarray], y: np.ndarray, steps: int = STEPS, seed: int = 11) -> Model:
    """Gradient descent with momentum (Adam) on the documents' log loss; one class alone gives a constant score."""
    if not len(bags) or len(set(y.tolist())) < 2:
        return Model(None, float(y[0]) if len(bags) else 1.0)
    rng = np.random.default_rng(seed)
    model = Model({
        "W": rng.normal(0, 0.5, (FEATURES, HIDDEN)), "b": np.zeros(HIDDEN), "V": rng.normal(0, 0.5, (HIDDEN, GATES)),
        "U": rng.normal(0, 0.5, (HIDDEN, GATES)), "a": rng.normal(0, 0.5, GATES), "u": np.zeros(HIDDEN), "c": np.zeros(1)})
    w, first, second = model.weights, {}, {}
    x, begins = np.concatenate(bags).astype("f8"), np.cumsum([0] + [len(b) for b in bags[:-1]])
    for step in range(1, steps + 1):
        grads = model.gradients(x, begins, y)
        for k, g in grads.items():
            g = g + 1e-5 * w[k]
            first[k] = 0.9 * first.get(k, 0) + 0.1 * g
            second[k] = 0.99 * second.get(k, 0) + 0.01 * g * g
            w[k] -= 0.03 * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, rows: int = TRAIN_ROWS, label: str = "quality",
          key: str = "doc_id", text: str = "text", passages_held: int = TRAIN_PASSAGES) -> Model:
    """The model of at most ``rows`` labelled documents that meet ``learn`` (a condition on k, the key).

    Documents are taken in the order of a hash of their texts as long as all of them together have at most ``passages_held``
    passages; one that does not fit is passed over. Of a document that is taken every passage counts.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = passages_held
        for batch in slices(batches, 64):
            found = [(y, passages(t)) for y, t in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            kept = []
            for y, bag in found:
                if len(bag) <= left:
                    left -= len(bag)
                    kept.append((y, bag.astype("<f4").tobytes()))
            yield pa.RecordBatch.from_arrays([
                pa.array([y for y, _ in kept], pa.int32()), pa.array([b for _, b in kept], pa.binary())], names=["y", "bag"])

    # A key that many rows share brings many texts: these are bounded too, before anything is collected.
    sample = training_rows(docs, labels, label, learn, rows, key, text).orderBy(F.xxhash64("t"), "t", "y").limit(rows)
    found = sample.mapInArrow(encode, "y int, bag binary").collect()
    found.sort(key=lambda r: (r.y, bytes(r.bag)))  # the order in which tasks end must not matter
    bags = [np.frombuffer(bytes(r.bag), "<f4").reshape(-1, FEATURES) for r in found]
    return fit(bags, np.array([r.y for r in found], "f8"))


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """Score of each whole text, 0 to 1; null texts are scored as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = [np.zeros(0)]
            for begin in range(0, len(texts), 256):
                out.append(shared.value.scores([passages(t) for t in texts.iloc[begin : begin + 256]]))
            yield pd.Series(np.concatenate(out), dtype="float64")

    return F.pandas_udf(scores, T.DoubleType())(F.coalesce(F.col(text).cast("string"), F.lit("")))


def quality(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """One row per document: key, held_out, score, predicted. Labels of held-out keys are never learned from.

    Empty and null texts have a score like any other. Without labels of both classes the score is constant (1 without
    any). Rows that share a key are scored each; other columns are not looked at; an empty table gives no rows.
    """
    model = train(docs, labels, id_remainder(F.col("k"), modulus) != held, key=key, text=text)
    scored = docs.select(F.col(key), (id_remainder(F.col(key), modulus) == held).alias("held_out"), score(docs, model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The documents, all columns, whose score is 0.5 or more."""
    model = train(docs, labels, id_remainder(F.col("k"), modulus) != held, key=key, text=text)
    return docs.where(score(docs, model, text) >= 0.5)
