"""Toxicity scores by FTRL-proximal logistic regression over hashed word features.

A text is a set of hashed features: its words, its word pairs, and its skip-grams (pairs with one
word left out). FTRL-proximal keeps a learning rate per feature and sets the weights of features
that never mattered to exactly zero, so that the fitted model is a short table of
(feature, weight), small enough to travel to every task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import text_of

BITS = 20
BIAS = -1
#: Score of a model that has seen no labelled row: nothing is known to be toxic.
UNKNOWN = -6.0
WORDS_KEPT = 200_000

EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”‘’…–—"


class WordCodes(dict):
    """Word -> 32-bit code, remembered for the words seen last."""

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        code = self[word] = zlib.crc32(word.strip(EDGES).encode("utf-8", "surrogatepass"))
        return code


_CODES = WordCodes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(64 - BITS - 8)) & np.uint64((1 << BITS) - 1)


def occurrences(text: str) -> np.ndarray:
    """The feature numbers of a text, repeats included; none for a text without words."""
    words = text.lower().split()
    code = np.fromiter(map(_CODES.__getitem__, words), dtype=np.uint64, count=len(words))
    first, second = code * np.uint64(0xC2B2AE3D27D4EB4F), code * np.uint64(0x165667B19E3779F9)
    parts = [
        _mixed(first + np.uint64(1)),
        _mixed(first[:-1] + second[1:] + np.uint64(2)),
        _mixed(first[:-2] + second[2:] + np.uint64(3)),
    ]
    return np.concatenate(parts).astype(np.int64)


class Ftrl:
    """FTRL-proximal state; the last coordinate is the bias, which is not regularised."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == 1 << BITS, 0.0, self.l1)
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / rate)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, 1 << BITS)
        w, n = self.weights(at), self.n[at]
        g = _sigmoid(w.sum()) - label
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g

    def table(self) -> pd.DataFrame:
        at = np.flatnonzero(self.n)
        w = self.weights(at)
        at, w = at[w != 0], w[w != 0]
        return pd.DataFrame({"feature": np.where(at == 1 << BITS, BIAS, at), "weight": w})


def _sigmoid(x: float) -> float:
    return 1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, x))))


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    epochs: int = 3,
    alpha: float = 1.0,
    beta: float = 1.0,
    l1: float = 5.0,
    l2: float = 0.0,
) -> DataFrame:
    """Weights as (feature, weight), one row for each weight that is not zero.

    ``labelled`` is a bounded sample (see ``labelled_sample``): FTRL is sequential, so one task reads
    its rows as a stream, in a fixed shuffled order, ``epochs`` times. Only the state of 2^20
    coordinates stays in memory. Rows without a label are left out, a null text is an empty one,
    repeated rows count each time. No rows give an empty table.
    """
    rows = labelled.where(F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"),
        text_of(text_col).alias("text"),
        F.col(label_col).cast("int").alias("label"),
    )
    rounds = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch"))
    ordered = rounds.repartition(1).sortWithinPartitions("epoch", F.xxhash64("id", "epoch"), "id", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = Ftrl(alpha, beta, l1, l2)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                state.learn(np.unique(occurrences(text)), int(label > 0))
        yield state.table()

    return ordered.mapInPandas(run, "feature long, weight double")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, id_col: str = "doc_id", label_col: str = "toxic"
) -> DataFrame:
    """At most ``max_rows`` labelled documents, chosen by a hash of the id: (id, text, label).

    The bound is on the labels, before their texts are read; ids with more than one label take
    the larger one.
    """
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.max(label_col).alias(label_col))
        .orderBy(F.xxhash64(id_col), id_col)
        .limit(max_rows)
    )
    return docs.select(id_col, "text").join(chosen, id_col)


def _probability(text: str, dense: np.ndarray, bias: float) -> float:
    found = occurrences(text)
    # Most features weigh nothing; only the others must be made distinct.
    return float(_sigmoid(bias + dense[np.unique(found[dense[found] != 0])].sum()))


class Model:
    """A fitted table, sent once to each executor (at most 2^20 numbers)."""

    def __init__(self, weights: DataFrame) -> None:
        table = weights.toPandas()
        bias = table.loc[table["feature"] == BIAS, "weight"]
        self.bias = float(bias.iloc[0]) if len(bias) else (UNKNOWN if table.empty else 0.0)
        table = table[table["feature"] != BIAS]
        self.size = len(table)
        self._sent = weights.sparkSession.sparkContext.broadcast(
            (table["feature"].to_numpy(np.int64), table["weight"].to_numpy(np.float64))
        )

    def score(self, text: str | Column) -> Column:
        """Probability of the label, 0 to 1; a null or empty text has the score of the bias alone."""
        sent, bias = self._sent, self.bias

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            dense = np.zeros(1 << BITS)
            dense[sent.value[0]] = sent.value[1]
            for texts in batches:
                yield pd.Series([_probability(text, dense, bias) for text in texts], dtype="float64")

        return scored(text_of(text))


def reject_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    return docs.where(model.score(text_col) < threshold)
