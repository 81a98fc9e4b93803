"""Language identification by multilingual mixture inference (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays

GRAM = 3
BUCKETS = 1 << 16
SLICES = 16
UNKNOWN = "und"
RESULT = "lang_pred string, score double, languages array<string>, shares array<double>, other_share double"
#: Letters as they are, lower-cased; all other ASCII as one space.
FOLD = np.full(256, 32, dtype=np.uint8)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def _grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of all texts, each with a space before and after, and where each text's begin."""
    at = bounds + np.arange(len(bounds))
    held = np.full(len(data) + len(bounds), 32, dtype=np.uint8)
    held[np.delete(np.arange(len(held)), at)] = FOLD[data]
    # Runs of spaces become one.
    keep = np.ones(len(held), dtype=bool)
    keep[1:] = (held[1:] != 32) | (held[:-1] != 32)
    place = np.cumsum(keep) - 1
    held = held[keep]
    first = place[at]
    value = np.zeros(max(0, len(held) - GRAM + 1), dtype=np.uint64)
    for i in range(GRAM):
        value = value * np.uint64(257) + held[i : i + len(value)]
    grams = (arrays.mix(value + np.uint64(1)) & np.uint64(BUCKETS - 1)).astype(np.int32)
    begin = np.minimum(first[:-1], len(grams))
    # A text's n-grams lie between its own spaces; two texts share the space between them.
    end = np.maximum(begin, np.minimum(first[1:] - GRAM + 2, len(grams)))
    return grams, np.stack([begin, end])


@dataclass
class Languages:
    """For each language, the log-probability of each hashed n-gram."""

    names: list[str]
    probability: np.ndarray  # n-grams by languages
    penalty: float = 3.0
    rounds: int = 30

    def infer(self, grams: np.ndarray) -> tuple[list[int], np.ndarray, float]:
        """The languages of one text, largest first, with their shares, and what none of them explains.

        Expectation-maximisation over the text's n-grams, each distinct one once with how often
        it is there, estimates the shares of a mixture. Languages join the set, by their share in the mixture of all, while the
        likelihood grows by more than ``penalty * log(n)``.
        """
        n = len(grams)
        grams, times = np.unique(grams, return_counts=True)
        p = self.probability[grams]
        other = 1.0 / BUCKETS
        cost = self.penalty * np.log(n + 1.0)

        def mixture(of: list[int]) -> tuple[np.ndarray, float]:
            q = np.column_stack([p[:, of], np.full(len(grams), other)])
            share = np.full(len(of) + 1, 1.0 / (len(of) + 1))
            for _ in range(self.rounds):
                total = q @ share
                new = share * (q.T @ (times / total)) / n
                moved = np.abs(new - share).max()
                share = new
                if moved < 1e-3:
                    break
            return share, float(times @ np.log(q @ share))

        whole, best = mixture(list(range(len(self.names))))
        order = sorted(range(len(self.names)), key=lambda i: (-whole[i], i))
        chosen, (share, now) = order[:1], mixture(order[:1])
        for i in order[1:]:
            if best - now <= cost:
                break
            more, likely = mixture([*chosen, i])
            if likely - now <= cost:
                break
            chosen, share, now = [*chosen, i], more, likely
        rank = sorted(range(len(chosen)), key=lambda i: (-share[i], chosen[i]))
        return [chosen[i] for i in rank], share[rank], float(share[-1])


def _counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``slice``, ``counts``: n-gram counts of each language, from all of its documents."""
    kind = "lang string, slice int, counts array<long>"
    width = BUCKETS // SLICES

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, part), counts in held.items():
            yield pa.RecordBatch.from_pydict(
                {"lang": [lang], "slice": pa.array([part], pa.int32()), "counts": pa.array([counts], pa.list_(pa.int64()))}
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for part, data, bounds in arrays.chunks(batch):
                grams, (begin, end) = _grams(data, bounds)
                langs = part.column(part.schema.get_field_index("lang")).dictionary_encode()
                names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy()
                of = np.repeat(code, end - begin).astype(np.int64)
                used = grams[arrays.ragged(begin, end - begin)]
                table = np.bincount(of * BUCKETS + used, minlength=len(names) * BUCKETS).reshape(len(names), SLICES, width)
                for i, name in enumerate(names):
                    for j in range(SLICES):
                        held[name, j] = held[name, j] + table[i, j] if (name, j) in held else table[i, j]
        yield from rows(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            for lang, part, counts in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.array(counts, np.int64)
                held[lang, part] = held[lang, part] + counts if (lang, part) in held else counts
        yield from rows(held)

    return docs.mapInArrow(count, kind).repartition("lang", "slice").mapInArrow(add, kind)


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Languages:
    """Learns from all rows of ``docs`` with a language; their counts, not they, reach the driver.

    The model has ``BUCKETS`` numbers a language, whatever the number of documents.
    """
    rows = docs.select(F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"), docs[lang_col].cast("string").alias("lang"))
    tables: dict[str, np.ndarray] = {}
    for row in _counts(rows.where(F.col("lang").isNotNull())).toLocalIterator():
        width = BUCKETS // SLICES
        table = tables.setdefault(row.lang, np.zeros(BUCKETS))
        table[row.slice * width : (row.slice + 1) * width] = row.counts
    names = sorted(tables)
    smooth = [(tables[x] + smoothing) / (tables[x] + smoothing).sum() for x in names]
    return Languages(names, np.stack(smooth, axis=1) if names else np.empty((BUCKETS, 0)))


def identify(model: Languages, text: Column) -> Column:
    """A struct: ``lang_pred``, ``score`` (its share), all ``languages`` with ``shares``, and ``other_share``.

    ``und``, with score 0, for a null text, one without letters, or a model
    that learned no language. Equal shares go to the first name.
    """

    @F.arrow_udf(RESULT)
    def predict(texts: pa.Array) -> pa.Array:
        out = []
        for part, data, bounds in arrays.chunks(pa.RecordBatch.from_arrays([texts], names=["text"])):
            grams, (begin, end) = _grams(data, bounds)
            ascii_letter = np.append(0, np.cumsum((data | 32) - np.uint8(97) < 26))
            has = ascii_letter[bounds[1:]] > ascii_letter[bounds[:-1]]
            wide = np.append(0, np.cumsum(data > 127))
            for i in np.flatnonzero(~has & (wide[bounds[1:]] > wide[bounds[:-1]])):
                has[i] = any(map(str.isalpha, part.column(0)[int(i)].as_py()))
            for letter, i, j in zip(has.tolist(), begin.tolist(), end.tolist()):
                if not letter or not model.names or i == j:
                    out.append((UNKNOWN, 0.0, [], [], 1.0))
                    continue
                of, shares, other = model.infer(grams[i:j])
                out.append((model.names[of[0]], float(shares[0]), [model.names[k] for k in of], shares.tolist(), other))
        columns = list(zip(*out)) or [[]] * 5
        kinds = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64()), pa.float64()]
        names = ["lang_pred", "score", "languages", "shares", "other_share"]
        return pa.StructArray.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return predict(F.coalesce(text.cast("string"), F.lit("")))
