"""Toxicity by FTRL-proximal logistic regression (operator 5)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays
from larkmetric.llm.decontaminate import WORD

BITS = 20
#: The value of a feature of two words; of a word it is 1.
PAIR = 0.3
SHARDS = 1
#: Labelled rows that the model learns from, at most (about).
MAX_ROWS = 20_000


def features(data: np.ndarray, bounds: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """For each text the hashed words, pairs, and pairs with one or two words between, each once.

    Words have the lower half of the ``2 ** bits`` places.
    """
    half = np.uint64(1 << (bits - 1))
    data = arrays.LOWER[data]
    starts, ends, first = arrays.word_spans(WORD[data], bounds)
    words = arrays.span_hashes(arrays.BYTE_VALUE[data], starts, ends)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    keys, of = [words & (half - np.uint64(1))], [text]
    for gap in (1, 2, 3):
        same = np.flatnonzero(text[gap:] == text[:-gap])
        pair = arrays.mix(words[same] * np.uint64(2 * gap + 1) + words[same + gap])
        keys.append(pair & (half - np.uint64(1)) | half)
        of.append(text[same])
    found = np.unique(np.concatenate(of).astype(np.uint64) << np.uint64(bits) | np.concatenate(keys))
    cuts = np.searchsorted(found, np.arange(len(bounds), dtype=np.uint64) << np.uint64(bits))
    index = (found & np.uint64((1 << bits) - 1)).astype(np.int32)
    return [index[i:j] for i, j in zip(cuts[:-1], cuts[1:])]


@dataclass
class Ftrl:
    """Per-coordinate learning rates and L1 sparsity: most weights stay exactly zero."""

    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1.0
    l2: float = 0.3
    epochs: int = 3

    def fit(self, rows: list[np.ndarray], y: np.ndarray, bits: int = BITS) -> np.ndarray:
        z, n = np.zeros(1 << bits), np.zeros(1 << bits)
        bias_z = bias_n = 0.0
        value = np.where(np.arange(1 << bits) < 1 << (bits - 1), 1.0, PAIR)
        for _ in range(self.epochs):
            for index, label in zip(rows, y.tolist()):
                zi, ni = z[index], n[index]
                root = np.sqrt(ni)
                w = self._weight(zi, root)
                b = self._weight(np.array([bias_z]), np.array([bias_n**0.5]), l1=0.0)[0]
                x = value[index]
                g = 1.0 / (1.0 + np.exp(-np.clip(w @ x + b, -35, 35))) - label
                gx = g * x
                z[index] = zi + gx - (np.sqrt(ni + gx * gx) - root) / self.alpha * w
                n[index] = ni + gx * gx
                bias_z += g - ((bias_n + g * g) ** 0.5 - bias_n**0.5) / self.alpha * b
                bias_n += g * g
        weights = self._weight(z, np.sqrt(n)) * value
        return np.append(weights, self._weight(np.array([bias_z]), np.array([bias_n**0.5]), l1=0.0))

    def _weight(self, z: np.ndarray, root: np.ndarray, l1: float | None = None) -> np.ndarray:
        l1 = self.l1 if l1 is None else l1
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((self.beta + root) / self.alpha + self.l2), 0.0)


def learn(sample: DataFrame, ftrl: Ftrl = Ftrl(), shards: int = SHARDS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the nonzero weights, the bias at place ``2 ** bits``, from ``doc_id``, ``text``, ``y``.

    The method takes rows one by one, in the order of a hash; the sample is
    bounded, so one task may do it. With more shards, each learns in a task of
    its own and weights are their mean. Without rows all are zero, and so every score is one half; with
    rows of one class alone scores lean to it. Null texts are empty and teach the bias alone; rows that repeat count each; rows of one
    id and hash are taken in the order of their ids, then as they come.
    """

    def fit(table: pa.Table) -> pa.Table:
        table = table.take(np.lexsort((table["doc_id"].to_numpy(), table["at"].to_numpy())))
        rows = []
        for batch in table.combine_chunks().to_batches():
            for _, data, bounds in arrays.chunks(batch):
                rows += features(data, bounds, bits)
        weights = ftrl.fit(rows, table["y"].to_numpy(), bits)
        some = np.flatnonzero(weights)
        return pa.table({"place": some, "weight": weights[some]})

    at = F.xxhash64(F.col("doc_id").cast("string"), F.lit(7))
    dealt = sample.select("doc_id", "text", "y", at.alias("at"), F.pmod(at, F.lit(shards)).alias("shard"))
    found = dealt.groupBy("shard").applyInArrow(fit, "place long, weight double")
    # At most ``2 ** bits + 1`` rows, however many documents there are.
    mean = found.groupBy("place").agg((F.sum("weight") / shards).alias("weight")).toArrow()
    order = np.argsort(mean["place"].to_numpy())
    return mean["place"].to_numpy()[order], mean["weight"].to_numpy()[order].astype(np.float32)


def score(model: tuple[np.ndarray, np.ndarray], text: Column, bits: int = BITS) -> Column:
    """The probability that the text is toxic; a null or empty text gets what the bias gives."""
    place, weight = model

    @F.arrow_udf("double")
    def predict(texts: pa.Array) -> pa.Array:
        table = np.zeros((1 << bits) + 1)
        table[place] = weight
        out = [np.empty(0)]
        for _, data, bounds in arrays.chunks(pa.RecordBatch.from_arrays([texts], names=["text"])):
            sums = np.array([table[x].sum() for x in features(data, bounds, bits)]) + table[-1]
            out.append(1.0 / (1.0 + np.exp(-np.clip(sums, -35, 35))))
        return pa.array(np.concatenate(out))

    return predict(F.coalesce(text.cast("string"), F.lit("")))
