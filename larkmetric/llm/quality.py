"""Quality by a factorisation machine over words, structure and metadata (operator 10)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays
from larkmetric.llm.decontaminate import WORD

WORD_BITS = 15
FACTORS = 6
SHARDS = 4
#: Labelled rows that the model learns from, at most (about).
MAX_ROWS = 24_000
PUNCTUATION = np.array([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])
#: One place for each kind of punctuation, then the other statistics.
STATISTICS = len(PUNCTUATION) + 10


def features(data: np.ndarray, bounds: np.ndarray, n_chars: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and values of each text: hashed words, structure statistics, and the size that its metadata states."""
    n_texts, n = len(bounds) - 1, np.maximum(np.diff(bounds), 1).astype(float)
    lower = arrays.LOWER[data]
    starts, ends, first = arrays.word_spans(WORD[lower], bounds)
    words = arrays.span_hashes(arrays.BYTE_VALUE[lower], starts, ends)
    text = np.repeat(np.arange(n_texts), np.diff(first))
    low = words & np.uint64((1 << WORD_BITS) - 1)
    found = np.unique(text.astype(np.uint64) << np.uint64(WORD_BITS) | low)
    cuts = np.searchsorted(found, np.arange(n_texts + 1, dtype=np.uint64) << np.uint64(WORD_BITS))
    index = (found & np.uint64((1 << WORD_BITS) - 1)).astype(np.int64)
    count = np.maximum(np.diff(first), 1).astype(float)

    def per_text(of: np.ndarray) -> np.ndarray:
        sums = np.append(0, np.cumsum(of))
        return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)

    stats = np.zeros((n_texts, STATISTICS))
    for i, byte in enumerate(PUNCTUATION):
        stats[:, i] = np.minimum(1.0, per_text(data == byte) / count)
    upper, lines = per_text((data >= 65) & (data <= 90)), per_text(data == 10) + 1
    line_starts = np.union1d(bounds[:-1][np.diff(bounds) > 0], np.flatnonzero(data == 10) + 1)
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    of_line = np.searchsorted(bounds, line_starts, side="right") - 1
    line_hash = arrays.span_hashes(arrays.BYTE_VALUE[data], line_starts, line_ends)
    distinct = np.unique(np.stack([of_line.astype(np.uint64), line_hash]), axis=1)[0].astype(np.int64)
    i = len(PUNCTUATION)
    stats[:, i] = upper / n
    stats[:, i + 1] = per_text((data >= 48) & (data <= 57)) / n
    stats[:, i + 2] = per_text(data > 127) / n
    stats[:, i + 3] = np.log1p(count) / 10
    stats[:, i + 4] = np.minimum(1.0, n / count / 20)
    stats[:, i + 5] = np.diff(cuts) / count
    stats[:, i + 6] = np.minimum(1.0, lines / count)
    stats[:, i + 7] = np.bincount(distinct, minlength=n_texts) / lines
    known = np.isfinite(n_chars)
    stats[:, i + 8] = np.where(known, np.log1p(np.maximum(np.where(known, n_chars, 0), 0)) / 12, 0.0)
    stats[:, i + 9] = ~known
    places = (1 << WORD_BITS) + np.arange(STATISTICS)
    out = []
    for t in range(n_texts):
        own = index[cuts[t] : cuts[t + 1]]
        value = np.concatenate([np.full(len(own), 1.0 / np.sqrt(max(1, len(own)))), stats[t]])
        out.append((np.concatenate([own, places]), value))
    return out


@dataclass
class Machine:
    """Bias, weights and factors of each place."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray

    def raw(self, place: np.ndarray, value: np.ndarray) -> float:
        """In time linear in the places: the square of sums less the sum of squares is twice all pairs."""
        vx = self.factor[place] * value[:, None]
        return self.bias + self.weight[place] @ value + 0.5 * ((vx.sum(axis=0) ** 2).sum() - (vx**2).sum())


def _start(factors: int) -> Machine:
    size = (1 << WORD_BITS) + STATISTICS
    rng = np.random.Generator(np.random.PCG64(5))
    return Machine(0.0, np.zeros(size), rng.normal(0, 0.05, (size, factors)))


def fit(
    rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, start: Machine, epochs: int = 6, rate: float = 0.1, decay: float = 1e-4
) -> Machine:
    """AdaGrad over logistic loss, row by row; classes weigh the same."""
    m = Machine(start.bias, start.weight.copy(), start.factor.copy())
    g_bias, g_weight, g_factor = 1.0, np.ones(len(m.weight)), np.ones(m.factor.shape)
    share = np.clip(y.mean() if len(y) else 0.5, 0.02, 0.98)
    for _ in range(epochs):
        for (place, value), label in zip(rows, y.tolist()):
            v = m.factor[place]
            vx = v * value[:, None]
            total = vx.sum(axis=0)
            raw = m.bias + m.weight[place] @ value + 0.5 * ((total**2).sum() - (vx**2).sum())
            g = 1.0 / (1.0 + np.exp(-np.clip(raw, -35, 35))) - label
            g *= 0.5 / share if label else 0.5 / (1 - share)
            gw = g * value + decay * m.weight[place]
            gv = g * value[:, None] * (total - vx) + decay * v
            g_bias += g * g
            g_weight[place] += gw * gw
            g_factor[place] += gv * gv
            m.bias -= rate * g / g_bias**0.5
            m.weight[place] -= rate * gw / np.sqrt(g_weight[place])
            m.factor[place] -= rate * gv / np.sqrt(g_factor[place])
    return m


def _shard_task(start: Machine) -> Callable[[pa.Table], pa.Table]:
    def task(table: pa.Table) -> pa.Table:
        table = table.take(np.lexsort((table["doc_id"].to_numpy(), table["at"].to_numpy())))
        rows = []
        for batch in table.combine_chunks().to_batches():
            for part, data, bounds in arrays.chunks(batch):
                sizes = part.column(part.schema.get_field_index("n_chars")).to_numpy(zero_copy_only=False)
                rows += features(data, bounds, sizes.astype(float))
        m = fit(rows, table["y"].to_numpy(), start)
        return pa.table(
            {"bias": [m.bias], "weight": [m.weight.astype("<f4").tobytes()], "factor": [m.factor.astype("<f4").tobytes()]}
        )

    return task


def learn(sample: DataFrame, factors: int = FACTORS, shards: int = SHARDS, rounds: int = 2) -> Machine:
    """From ``doc_id``, ``text``, ``n_chars``, ``y``: shards learn apart from one start, and their means start the next round.

    What reaches the driver is one machine a shard, of a size that does not
    depend on the data. Without rows it stays the start, whose scores are near one half; with rows of one class alone scores
    lean to it. Null texts are empty and, as those, known by their statistics; a null ``n_chars`` is a feature of its own.
    Rows that repeat count each; shards without rows are left out of the mean.
    """
    at = F.xxhash64(F.col("doc_id").cast("string"), F.lit(11))
    dealt = sample.select("doc_id", "text", "n_chars", "y", at.alias("at"), F.pmod(at, F.lit(shards)).alias("shard"))
    now = _start(factors)
    for _ in range(rounds):
        task = _shard_task(now)
        found = dealt.groupBy("shard").applyInArrow(task, "bias double, weight binary, factor binary").toArrow().to_pylist()
        if not found:
            break
        now = Machine(
            float(np.mean([r["bias"] for r in found])),
            np.mean([np.frombuffer(r["weight"], "<f4") for r in found], axis=0),
            np.mean([np.frombuffer(r["factor"], "<f4").reshape(now.factor.shape) for r in found], axis=0),
        )
    return now


def score(model: Machine, text: Column, n_chars: Column) -> Column:
    """The probability of good quality; null and empty texts are scored by their statistics alone."""
    model = Machine(model.bias, model.weight.astype(np.float32), model.factor.astype(np.float32))

    @F.arrow_udf("double")
    def predict(texts: pa.Array, sizes: pa.Array) -> pa.Array:
        out = []
        for part, data, bounds in arrays.chunks(pa.RecordBatch.from_arrays([texts, sizes], names=["text", "n_chars"])):
            of = part.column(1).to_numpy(zero_copy_only=False).astype(float)
            out += [model.raw(place, value) for place, value in features(data, bounds, of)]
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(np.array(out, dtype=float), -35, 35))))

    return predict(F.coalesce(text.cast("string"), F.lit("")), n_chars.cast("double"))
