"""Ranked lexical search over an inverted index in shards of documents (operator 12).

The index lies where its documents were read: each shard holds the posting
lists of some thousand documents, so building it moves nothing. Queries visit
every shard in blocks of bounded size. In a shard, a sparse table over each posting list
answers which document of any interval has the list's largest impact. These maxima,
summed over a query's terms, bound the interval; intervals are opened best
first, at the document of the largest impact, until none can reach the best found.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkmetric.llm import arrays
from larkmetric.llm.store import stored

#: Bytes of text whose postings make a shard (the text that fills it is in it whole).
SHARD_BYTES = 4 << 20
#: Distinct terms of the queries that visit the index together, and their number; a single longer query is a block.
BLOCK_TERMS = 1 << 16
BLOCK_QUERIES = 1 << 10
#: Intervals of so few postings are scored whole.
LEAF = 256
#: Intervals opened at a time for each query.
OPENED = 8
#: Parts of each query's hits that are cut to the best before they meet.
PARTS = 64
#: Weights of the scores. A document of mean length counts as 100, of which 75 follow its length.
LENGTH_PART, LENGTH_FULL = 75, 100
IMPACT_UNIT, WEIGHT_UNIT, TF_UNIT, LENGTH_UNIT = 1_000_000_000, 1000, 1000, 8
TERM = np.zeros(256, dtype=bool)
TERM[0x30:0x3A] = TERM[0x41:0x5B] = TERM[0x61:0x7B] = TERM[0x80:] = True


def _windows(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of all texts in a row, each of about a chunk, that cut no term."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + arrays.CHUNK_BYTES, n)
        stop = int(bounds[np.searchsorted(bounds, end)])
        while end < stop:
            free = np.flatnonzero(~TERM[data[end : min(stop, end + arrays.CHUNK_BYTES)]])
            if len(free):
                end += int(free[0])
                break
            end = min(stop, end + arrays.CHUNK_BYTES)
        yield at, end
        at = end


def _summed(keys: tuple[np.ndarray, ...], counts: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Distinct keys in order, the first sorted by first, and the sum of each one's counts."""
    order = np.lexsort(keys[::-1])
    keys = tuple(k[order] for k in keys)
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    return tuple(k[at] for k in keys), np.add.reduceat(counts[order], at) if len(at) else counts[:0]


def _terms(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``text``, ``term`` and how often it is there, by text and term."""
    held = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))]
    for low, high in _windows(data, bounds):
        part = data[low:high]
        inner = bounds[np.searchsorted(bounds, low, side="right") : np.searchsorted(bounds, high)] - low
        starts, ends, _ = arrays.word_spans(TERM[part], np.concatenate([[0], inner, [high - low]]))
        text = np.searchsorted(bounds, starts + low, side="right") - 1
        hashes = arrays.span_hashes(arrays.BYTE_VALUE[arrays.LOWER[part]], starts, ends)
        (text, hashes), n = _summed((text, hashes), np.ones(len(starts), np.int64))
        held.append((text, hashes, n))
    text, hashes, n = (np.concatenate(x) for x in zip(*held))
    (text, hashes), n = _summed((text, hashes), n)
    return text, hashes, n


def _packed(values: np.ndarray, kind: str = "<u4") -> bytes:
    return np.ascontiguousarray(values.astype(kind)).tobytes()


def _unpacked(held: bytes, kind: str = "<u4") -> np.ndarray:
    return np.frombuffer(held, kind).astype(np.int64)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all rows, written to the shared folder: one row a shard.

    Terms are runs of letters and digits (all characters beyond ASCII count as letters), A-Z lower-cased; a
    null or empty text has none. A shard has its rows' ids in order, null last, their
    numbers of terms, and each term's postings. An empty table has no shards.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            ids = pa.concat_arrays([h[0] for h in held])
            first = np.cumsum([0] + [len(h[0]) for h in held])
            doc, term, tf = (np.concatenate([h[k] + first[i] if k == 1 else h[k] for i, h in enumerate(held)]) for k in (1, 2, 3))
            order = pc.sort_indices(ids, null_placement="at_end")
            place = np.empty(len(ids), np.int64)
            place[order.to_numpy()] = np.arange(len(ids))
            doc = place[doc]
            by = np.lexsort((doc, term))
            doc, term, tf = doc[by], term[by], tf[by]
            terms, n_of = np.unique(term, return_counts=True)
            lengths = np.bincount(doc, weights=tf, minlength=len(ids)).astype(np.int64)
            return pa.RecordBatch.from_pydict(
                {
                    "n_docs": pa.array([int((lengths > 0).sum())], pa.int64()),
                    "n_terms": pa.array([int(lengths.sum())], pa.int64()),
                    "ids": arrays_of([ids.take(order)], ids.type),
                    "lengths": [_packed(lengths, "<i8")],
                    "terms": [terms.tobytes()],
                    "n_of": [_packed(n_of)],
                    "docs": [_packed(doc)],
                    "tfs": [_packed(tf)],
                }
            )

        for batch in batches:
            texts = batch.column("text")
            data, bounds = arrays.flat(texts)
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SHARD_BYTES - size, side="right")) - 1)
                own = bounds[at : end + 1] - bounds[at]
                held.append((batch.column(0).slice(at, end - at), *_terms(data[bounds[at] : bounds[end]], own)))
                size += int(own[-1])
                at = end
                if size >= SHARD_BYTES or at < batch.num_rows:
                    yield shard()
                    held.clear()
                    size = 0
            arrays.release()
        if held:
            yield shard()
        arrays.release()

    schema = f"n_docs long, n_terms long, ids array<{kind}>, lengths binary, terms binary, n_of binary, docs binary, tfs binary"
    return stored(rows.mapInArrow(make, schema), "lexical-index")


def arrays_of(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    """One list for each of ``parts``."""
    bounds = np.cumsum([0] + [len(p) for p in parts])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.concat_arrays([p.cast(kind) for p in parts]))


@dataclass
class Queries:
    """A block of queries: for each its place among the sorted terms of the block and how often the query has it."""

    ids: pa.Array
    terms: np.ndarray  # distinct hashes, sorted
    first: np.ndarray  # where each query's terms begin, the end last
    term: np.ndarray
    times: np.ndarray


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    """The rows of ``items`` as blocks of queries of a bounded size, one after another."""
    rows = items.select(items[id_col].alias("id"), F.coalesce(items[text_col].cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                _, term, n = _terms(*arrays.flat(one.column("text")))
                yield pa.RecordBatch.from_pydict({"id": one.column(0), "terms": [term.tobytes()], "times": [_packed(n, "<i8")]})

    packed = stored(rows.mapInArrow(make, f"id {kind}, terms binary, times binary"), "lexical-queries")
    # The type of an empty block, for the ids.
    as_arrow = packed.select("id").limit(0).toArrow().schema.field("id").type
    held: list[tuple] = []
    n = 0

    def block() -> Queries:
        every = np.concatenate([h[1] for h in held])
        terms, term = np.unique(every, return_inverse=True)
        first = np.cumsum([0] + [len(h[1]) for h in held])
        return Queries(pa.array([h[0] for h in held], as_arrow), terms, first, term.astype(np.int64), np.concatenate([h[2] for h in held]))

    for row in packed.toLocalIterator():
        terms = np.frombuffer(row["terms"], np.uint64)
        if held and (n + len(terms) > BLOCK_TERMS or len(held) == BLOCK_QUERIES):
            yield block()
            held, n = [], 0
        held.append((row["id"], terms, _unpacked(row["times"], "<i8")))
        n += len(terms)
    if held:
        yield block()


def _weights(index: DataFrame, terms: np.ndarray, n_docs: int) -> np.ndarray:
    """Each term's weight, from the number of documents that hold it; 0 for a term that none holds."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for held, n_of in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(held, np.uint64)
                at, here = _found(own, terms)
                total[here] += _unpacked(n_of)[at[here]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "n"])

    counted = index.select("terms", "n_of").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    weights = np.zeros(len(terms), np.int64)
    for row in counted.collect():
        weights[row["term"]] = math.floor(WEIGHT_UNIT * math.log((2 * n_docs + 2) / (2 * row["n"] + 1)))
    return weights


def _found(own: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of ``wanted`` would be in sorted ``own``, and whether it is there."""
    at = np.searchsorted(own, wanted)
    here = at < len(own)
    here[here] = own[at[here]] == wanted[here]
    return at, here


class Postings:
    """The posting lists of a block's terms in one shard, with sparse tables of their largest impacts."""

    def __init__(self, shard: dict, terms: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> None:
        own, n_of = np.frombuffer(shard["terms"], np.uint64), _unpacked(shard["n_of"])
        at, here = _found(own, terms)
        some = np.flatnonzero(here & (weights > 0))
        begin = (np.cumsum(n_of) - n_of)[at[some]]
        size = n_of[at[some]]
        posts = arrays.ragged(begin, size)
        self.doc, tf = _unpacked(shard["docs"])[posts], _unpacked(shard["tfs"])[posts]
        lengths = _unpacked(shard["lengths"], "<i8")
        norm = LENGTH_FULL - LENGTH_PART + (LENGTH_PART * lengths * n_docs) // max(n_terms, 1)
        impact = (IMPACT_UNIT * tf) // (TF_UNIT * tf + LENGTH_UNIT * norm[self.doc])
        self.impact = impact * np.repeat(weights[some], size)
        #: A list's number, or -1 for a term without postings here.
        self.list_of = np.full(len(terms), -1, np.int64)
        self.list_of[some] = np.arange(len(some))
        self.key = np.repeat(np.arange(len(some)), size) << 32 | self.doc
        # Row k holds, for each place, that of the largest impact among the 2 ** k places from there on. What crosses
        # into the next list is never asked for.
        best = np.arange(len(posts), dtype=np.int32)
        self.best = [best]
        longest = int(size.max()) if len(size) else 0
        for k in range(1, longest.bit_length()):
            half = 1 << (k - 1)
            left, right = best[: len(best) - half], best[half:]
            best = np.where(self.impact[left] >= self.impact[right], left, right)
            self.best.append(best)
        self.flat = np.concatenate(self.best) if len(posts) else np.empty(0, np.int32)
        self.level = np.cumsum([0] + [len(b) for b in self.best])[:-1]

    def places(self, lists: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Where each list's first posting of ``doc`` or a later document is."""
        return np.searchsorted(self.key, lists << 32 | doc)

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of the largest impact in each non-empty ``low:high`` within a list."""
        k = np.frexp((high - low).astype(np.float64))[1] - 1
        level = self.level[k]
        a, b = self.flat[level + low], self.flat[level + high - (1 << k)]
        return np.where(self.impact[a] >= self.impact[b], a, b)


def _search(posts: Postings, queries: Queries, rank: np.ndarray, top: np.ndarray, top_rank: np.ndarray, ref: np.ndarray, k: int) -> None:
    """Takes a shard's best documents into ``top`` (scores), ``top_rank`` and ``ref``, one row a query, best first.

    ``rank`` puts the documents of the shard in the order that settles equal scores.
    """
    list_of = posts.list_of[queries.term]
    here = list_of >= 0
    lists, times = list_of[here], queries.times[here]
    counts = np.add.reduceat(np.append(here, False).astype(np.int64), queries.first[:-1]) * (np.diff(queries.first) > 0)
    first = np.cumsum(counts) - counts

    def terms_of(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For all terms of each of ``q``: which of ``q``, the list, and how often the query has it."""
        at = arrays.ragged(first[q], counts[q])
        return np.repeat(np.arange(len(q)), counts[q]), lists[at], times[at]

    def bounded(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each interval's bound, the document of its largest impact, and its number of postings."""
        bound, split, size = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        of, lst, n = terms_of(q)
        a, b = posts.places(lst, low[of]), posts.places(lst, high[of])
        some = b > a
        of, a, b, n = of[some], a[some], b[some], n[some]
        if not len(of):
            return bound, split, size
        place = posts.largest(a, b)
        value = posts.impact[place] * n
        start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        bound[of[start]] = np.add.reduceat(value, start)
        size[of[start]] = np.add.reduceat(b - a, start)
        most = np.repeat(np.maximum.reduceat(value, start), np.diff(np.append(start, len(of))))
        largest = np.flatnonzero(value == most)
        split[of[largest]] = posts.doc[place[largest]]
        return bound, split, size

    def whole(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The query, document and score of all postings in the intervals."""
        of, lst, n = terms_of(q)
        a, b = posts.places(lst, low[of]), posts.places(lst, high[of])
        at = arrays.ragged(a, b - a)
        (found_q, doc), score = _summed((np.repeat(q[of], b - a), posts.doc[at]), posts.impact[at] * np.repeat(n, b - a))
        return found_q, doc, score

    def take(q: np.ndarray, doc: np.ndarray, score: np.ndarray) -> None:
        good = (score > top[q, -1]) | ((score == top[q, -1]) & (rank[doc] < top_rank[q, -1]))
        good &= score > 0
        q, doc, score = q[good], doc[good], score[good]
        if not len(q):
            return
        which = np.unique(q)
        every_q = np.concatenate([np.repeat(which, k), q])
        every = np.concatenate([top[which].ravel(), score])
        every_rank = np.concatenate([top_rank[which].ravel(), rank[doc]])
        every_ref = np.concatenate([ref[which].ravel(), doc])
        order = np.lexsort((every_rank, -every, every_q))
        begin = np.searchsorted(every_q[order], which)
        best = order[begin[:, None] + np.arange(k)]
        top[which], top_rank[which], ref[which] = every[best], every_rank[best], every_ref[best]

    q = np.flatnonzero(counts > 0)
    low, high = np.zeros(len(q), np.int64), np.full(len(q), len(rank), np.int64)
    bound, split, size = bounded(q, low, high)
    while True:
        # An interval may still matter if it can beat the last of the best, or equal it with an earlier document.
        live = (bound > top[q, -1]) | ((bound == top[q, -1]) & (rank[np.minimum(low, len(rank) - 1)] < top_rank[q, -1]))
        live &= bound > 0
        q, low, high, bound, split, size = (x[live] for x in (q, low, high, bound, split, size))
        if not len(q):
            return
        order = np.lexsort((-bound, q))
        q, low, high, bound, split, size = (x[order] for x in (q, low, high, bound, split, size))
        start = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
        nth = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
        now = nth < OPENED
        leaf, inner = now & (size <= LEAF), now & (size > LEAF)
        if leaf.any():
            take(*whole(q[leaf], low[leaf], high[leaf]))
        if inner.any():
            iq, at = q[inner], split[inner]
            take(*whole(iq, at, at + 1))
            child_q = np.concatenate([iq, iq])
            child_low, child_high = np.concatenate([low[inner], at + 1]), np.concatenate([at, high[inner]])
            child = (child_q, child_low, child_high, *bounded(child_q, child_low, child_high))
        else:
            child = tuple(np.empty(0, np.int64) for _ in range(6))
        rest = ~now
        q, low, high, bound, split, size = (np.concatenate([x[rest], c]) for x, c in zip((q, low, high, bound, split, size), child))


def search(index: DataFrame, items: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text", item_name: str = "item_id") -> DataFrame:
    """The ``k`` documents of the highest score above 0 for each row of ``items``: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Terms are as in ``build_index``. A document's score sums, over the query's
    terms with repeats, the term's weight times its impact, which grows with its frequency and falls with the
    document's length; all sums are of whole numbers, so equal in any order. Equal
    scores go by ascending id, null last. A query without terms, or of terms
    that no document has, has no rows; equal item rows have rows each. Every shard is asked for every query.
    """
    spark = index.sparkSession
    totals = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = int(totals["docs"] or 0), int(totals["terms"] or 0)
    doc_kind = index.schema["ids"].dataType.elementType.simpleString()
    item_kind = items.schema[id_col].dataType.simpleString()
    schema = f"q int, item {item_kind}, score long, doc_id {doc_kind}"
    parts: list[DataFrame] = []
    for queries in _blocks(items, id_col, text_col):
        weights = _weights(index, queries.terms, n_docs)
        found = index.select("ids", "lengths", "terms", "n_of", "docs", "tfs").mapInArrow(_visit(queries, weights, n_docs, n_terms, k), schema)
        best = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        # First the best of parts, so that no task gets the hits of all shards for a query.
        some = found.withColumn("part", F.spark_partition_id() % PARTS)
        some = some.withColumn("nth", F.row_number().over(Window.partitionBy("q", "part").orderBy(*best))).where(F.col("nth") <= k)
        rank = F.row_number().over(Window.partitionBy("q").orderBy(*best))
        ranked = some.withColumn("rank", rank).where(F.col("rank") <= k)
        parts.append(stored(ranked.select(F.col("item").alias(item_name), "rank", "doc_id", "score"), "lexical-hits"))
    if not parts:
        return spark.createDataFrame([], f"{item_name} {item_kind}, rank int, doc_id {doc_kind}, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _visit(queries: Queries, weights: np.ndarray, n_docs: int, n_terms: int, k: int):
    """Asks all queries of a block of the shards of a task; what is found in one bounds the search in the next."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(queries.ids)
        top = np.zeros((n, k), np.int64)
        ids = None
        ref = np.full((n, k), -1, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                shard = {name: batch.column(name)[i].as_py() for name in ("lengths", "terms", "n_of", "docs", "tfs")}
                own = batch.column("ids")[i].values
                held = own if ids is None else pa.concat_arrays([own, ids])
                # Ranks of this shard's documents and of the best so far, to settle equal scores.
                ranks = pc.rank(held, "ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
                some = ref >= 0
                ref[some] += len(own)
                top_rank = np.full((n, k), np.iinfo(np.int64).max)
                top_rank[some] = ranks[ref[some]]
                posts = Postings(shard, queries.terms, weights, n_docs, n_terms)
                if len(posts.doc):
                    _search(posts, queries, ranks[: len(own)], top, top_rank, ref, k)
                some = ref >= 0
                ids = held.take(pa.array(ref[some]))
                ref[some] = np.arange(int(some.sum()))
                arrays.release()
        if ids is not None and len(ids):
            q, nth = np.nonzero(ref >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q.astype(np.int32)), queries.ids.take(pa.array(q)), pa.array(top[q, nth]), ids.take(pa.array(ref[q, nth]))],
                names=["q", "item", "score", "doc_id"],
            )

    return make
