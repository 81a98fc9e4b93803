"""Tokens of two tokenizers aligned by divide and conquer at shared cuts (operator 11).

Both tokenizers cut the same bytes. An interval of tokens is divided at an end
that both share, searched outward from its middle by bisecting the other side's
ends, and both halves are divided again; an interval without such an end is a
group. All intervals of many texts are divided together, level by level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkmetric.llm import arrays, pretokens
from larkmetric.llm.store import stored
from larkmetric.llm.token_counts import _pack, _unpack

#: Bytes of text that are aligned together; longer texts are cut between words.
PART_BYTES = 1 << 20
#: Bytes of text, and rows, whose pairs are counted together.
BLOCK_BYTES = 8 << 20
BLOCK_ROWS = 1 << 16
#: Distinct words that a worker holds for each tokenizer.
HELD_WORDS = 400_000
PAIR_BITS = 32
#: Fixed value: the mark that stands for a space in a piece.
SPACE_MARK = "▁"


class BytePieces(pretokens.Pieces):
    """Byte-level BPE of a ``tokenizers`` file; the words are its pre-tokens."""

    def __init__(self, path: str) -> None:
        super().__init__(path, HELD_WORDS, plain=True)
        to_byte = _byte_of_character()
        pieces = {i: bytes(to_byte[c] for c in t) if all(c in to_byte for c in t) else t.encode() for t, i in self.tokenizer.get_vocab().items()}
        self.table = _Table([pieces.get(i, b"") for i in range(max(pieces) + 1)])

    def words(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return pretokens.split(data, bounds)


class MarkedPieces(pretokens.Pieces):
    """A ``sentencepiece`` model that marks spaces; words begin where a run of spaces does.

    No piece has a mark behind another character, so no merge goes beyond a word.
    """

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.special, self.limit = (), HELD_WORDS
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            raise ValueError("pieces of this model go beyond words")
        self.table = _Table(
            [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        )
        self.lead = len(model.encode("x"))
        self._clear()

    def words(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        start = np.zeros(len(data) + 1, dtype=bool)
        start[1:-1] = (data[1:] == 32) & (data[:-1] != 32)
        start[bounds] = True
        return np.flatnonzero(start[:-1])

    def _encode(self, words: list[str]) -> list[list[int]]:
        # The model adds a space of its own, and none to what is empty: spaces alone are encoded behind a letter.
        blank = [w.strip(" ") == "" for w in words]
        found = self.model.encode(["x" + w if b else w[1:] for w, b in zip(words, blank)], num_threads=1)
        return [ids[self.lead :] if b else ids for ids, b in zip(found, blank)]


def _byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class _Table:
    """The bytes of each id."""

    def __init__(self, pieces: list[bytes]) -> None:
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(pieces), np.uint8)
        names = [str(i) for i in range(len(pieces))]
        self.inner = np.array([f"{n}," for n in names], object)
        self.last = {end: np.array([n + end for n in names], object) for end in "|;"}


@lru_cache(maxsize=2)
def _pieces(kind: type, path: str):
    """One holder for each tokenizer in a Python worker."""
    return kind(path)


def _tokens(holder, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of all texts, where each text's ids begin (the end last), and whether a text's tokens are its bytes."""
    starts = holder.words(data, bounds)
    ends, keys = pretokens.hashes(data, starts)
    keys, one, back = np.unique(keys, return_index=True, return_inverse=True)
    at = holder.look_up(keys, data.tobytes(), starts[one], ends[one])
    # Each distinct word's bytes against those of its pieces.
    size = holder.count[at]
    ids = holder.ids[arrays.ragged(holder.start[at], size)].astype(np.int64)
    length = np.bincount(np.repeat(np.arange(len(at)), size), weights=holder.table.size[ids], minlength=len(at)).astype(np.int64)
    same = length == (ends - starts)[one]
    right = np.repeat(same, size)
    joined = holder.table.data[arrays.ragged(holder.table.start[ids[right]], holder.table.size[ids[right]])]
    own = data[arrays.ragged(starts[one][same], length[same])]
    wrong = np.repeat(np.flatnonzero(same), length[same])[joined != own]
    same[wrong] = False
    text = pretokens.text_of(starts, bounds)
    n = np.bincount(text, weights=size[back], minlength=len(bounds) - 1).astype(np.int64)
    good = np.bincount(text, weights=~same[back], minlength=len(bounds) - 1) == 0
    ids = holder.ids[arrays.ragged(holder.start[at][back], size[back])].astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(n)]), good


def _divide(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each group's tokens end on both sides, for texts that begin at ``first_a`` and ``first_b``.

    The ends of both sides ascend over all texts, and each text's last ends agree.
    """
    some = np.flatnonzero(np.diff(first_a) > 0)
    a0, a1, b0, b1 = first_a[some], first_a[some + 1], first_b[some], first_b[some + 1]
    cuts_a, cuts_b = [a1], [b1]
    while len(a0):
        open_ = (a1 - a0 > 1) & (b1 - b0 > 1)
        a0, a1, b0, b1 = a0[open_], a1[open_], b0[open_], b1[open_]
        cut_a, cut_b = _near_middle(ends_a, ends_b, a0, a1)
        found = cut_a >= 0
        a0, a1, b0, b1, cut_a, cut_b = (x[found] for x in (a0, a1, b0, b1, cut_a, cut_b))
        cuts_a.append(cut_a)
        cuts_b.append(cut_b)
        a0, a1 = np.concatenate([a0, cut_a]), np.concatenate([cut_a, a1])
        b0, b1 = np.concatenate([b0, cut_b]), np.concatenate([cut_b, b1])
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def _near_middle(ends_a: np.ndarray, ends_b: np.ndarray, a0: np.ndarray, a1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Behind which tokens of both sides each interval may be cut nearest to its middle; -1 where there is no cut within.

    Each end of the one side is bisected in the other's; distances from the middle double.
    """
    cut_a, cut_b = np.full(len(a0), -1, np.int64), np.full(len(a0), -1, np.int64)
    last = a1 - 2  # the last token's end is the interval's own
    middle = (a0 + last) >> 1
    left, near, far = np.arange(len(a0)), 0, 1
    while len(left):
        m, low, high = middle[left], a0[left], last[left]
        before, after = np.maximum(m - far + 1, low), np.minimum(m + far - 1, high)
        n_before = np.maximum(0, m - near - before + 1)
        n_after = np.maximum(0, after - (m + max(near, 1)) + 1)
        place = np.concatenate([arrays.ragged(before, n_before), arrays.ragged(m + max(near, 1), n_after)])
        of = np.concatenate([np.repeat(np.arange(len(left)), n_before), np.repeat(np.arange(len(left)), n_after)])
        at = np.searchsorted(ends_b, ends_a[place])
        hit = np.flatnonzero(ends_b[at] == ends_a[place])
        hit = hit[np.lexsort((np.abs(place[hit] - m[of[hit]]), of[hit]))]
        which, one = np.unique(of[hit], return_index=True)
        cut_a[left[which]], cut_b[left[which]] = place[hit[one]] + 1, at[hit[one]] + 1
        # Beyond both edges there is nothing left to search.
        more = (m - far >= low) | (m + far <= high)
        more[which] = False
        left, near, far = left[more], far, 2 * far
    return cut_a, cut_b


class _Aligned:
    """The tokens and groups of some texts, each of which begins with a space."""

    def __init__(self, path_a: str, path_b: str, data: np.ndarray, bounds: np.ndarray) -> None:
        a, b = _pieces(BytePieces, path_a), _pieces(MarkedPieces, path_b)
        ids_a, first_a, good_a = _tokens(a, data, bounds)
        ids_b, first_b, good_b = _tokens(b, data, bounds)
        self.good = good_a & good_b
        if not self.good.all():
            ids_a, first_a = _only(ids_a, first_a, self.good)
            ids_b, first_b = _only(ids_b, first_b, self.good)
        self.a, self.b, self.first_a, self.first_b = ids_a, ids_b, first_a, first_b
        self.table_a, self.table_b = a.table, b.table
        self.ends_a, self.ends_b = np.cumsum(a.table.size[ids_a]), np.cumsum(b.table.size[ids_b])
        self.cut_a, self.cut_b = _divide(self.ends_a, self.ends_b, first_a, first_b)
        #: The text of each group.
        self.text = np.searchsorted(first_a, self.cut_a - 1, side="right") - 1

    def pairs(self) -> np.ndarray:
        """Each group's last tokens, which end together, as one number."""
        return self.a[self.cut_a - 1] << PAIR_BITS | self.b[self.cut_b - 1]

    def written(self) -> list[str]:
        """Each text's groups: the ids of both sides, ``a1,a2|b1;a3|b2,b3``."""
        size_a, size_b = np.diff(self.cut_a, prepend=0), np.diff(self.cut_b, prepend=0)
        out = np.empty(len(self.a) + len(self.b), object)
        strings = self.table_a.inner[self.a]
        strings[self.cut_a - 1] = self.table_a.last["|"][self.a[self.cut_a - 1]]
        out[np.arange(len(self.a)) + np.repeat(self.cut_b - size_b, size_a)] = strings
        strings = self.table_b.inner[self.b]
        strings[self.cut_b - 1] = self.table_b.last[";"][self.b[self.cut_b - 1]]
        out[np.arange(len(self.b)) + np.repeat(self.cut_a, size_b)] = strings
        at = (self.first_a + self.first_b).tolist()
        return ["".join(out[i:j])[:-1] for i, j in zip(at[:-1], at[1:])]


def _only(ids: np.ndarray, first: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(first)
    return ids[np.repeat(good, n)], np.concatenate([[0], np.cumsum(np.where(good, n, 0))])


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Non-empty texts, each behind a space, about ``PART_BYTES`` at a time: the bytes, their bounds, and the row of each.

    A longer text comes in several parts, cut before a space that follows a printable ASCII
    character. Both tokenizers cut there; a text without such a place is one part.
    """
    data, bounds = arrays.flat(batch.column("text"))
    sizes = np.diff(bounds)
    begin, end, row = [], [], []
    for r in np.flatnonzero(sizes).tolist():
        low, high = int(bounds[r]), int(bounds[r + 1])
        while high - low > PART_BYTES:
            at = low + PART_BYTES
            while at < high:
                some = data[at - 1 : min(high, at + PART_BYTES)]
                free = np.flatnonzero((some[1:] == 32) & (some[:-1] > 32) & (some[:-1] < 127))
                at += int(free[0]) if len(free) else PART_BYTES
                if len(free):
                    break
            if at >= high:
                break
            begin.append(low)
            end.append(at)
            row.append(r)
            low = at
        begin.append(low)
        end.append(high)
        row.append(r)
    begin, end, row = (np.array(x, np.int64) for x in (begin, end, row))
    size = end - begin
    at = 0
    total = np.cumsum(size)
    while at < len(begin):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PART_BYTES, side="right")))
        # A text's first part gets a space; the others begin with their own.
        lead = (begin[at:stop] == bounds[row[at:stop]]).astype(np.int64)
        whole = size[at:stop] + lead
        inner = np.concatenate([[0], np.cumsum(whole)])
        joined = np.full(int(inner[-1]), 32, np.uint8)
        joined[arrays.ragged(inner[:-1] + lead, size[at:stop])] = data[arrays.ragged(begin[at:stop], size[at:stop])]
        yield joined, inner, row[at:stop]
        at = stop


class _Block:
    """What some rows give together: their counts, and how often each has each pair."""

    def __init__(self) -> None:
        self.ids: list[pa.Array] = []
        self.n, self.size = 0, 0
        self.counts: list[tuple[np.ndarray, ...]] = []
        self.pairs: list[tuple[np.ndarray, ...]] = []
        self.digest: dict[int, object] = {}

    def add(self, batch: pa.RecordBatch, path_a: str, path_b: str) -> None:
        for data, bounds, row in _parts(batch):
            found = _Aligned(path_a, path_b, data, bounds)
            row = row + self.n
            n_groups = np.bincount(found.text, minlength=len(row))
            self.counts.append((row, np.diff(found.first_a), np.diff(found.first_b), n_groups, found.good))
            for r, text in zip(row.tolist(), found.written()):
                if r in self.digest:
                    self.digest[r].update(b";" + text.encode())
                else:
                    self.digest[r] = hashlib.sha256(text.encode())
            pairs = found.pairs()
            order = np.lexsort((pairs, row[found.text]))
            of, pairs = row[found.text][order], pairs[order]
            new = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (pairs[1:] != pairs[:-1])) if len(of) else [])
            self.pairs.append((of[new], pairs[new], np.diff(np.append(new, len(of)))))
            self.size += len(data)
        self.ids.append(batch.column(0))
        self.n += batch.num_rows

    def row(self) -> pa.RecordBatch:
        none = np.empty(0, np.int64)
        of, n_a, n_b, n_groups, good = (np.concatenate(x) for x in zip((none,) * 4 + (none.astype(bool),), *self.counts))
        bad = np.zeros(self.n, dtype=bool)
        bad[of[~good]] = True
        sums = [np.where(bad, 0, np.bincount(of, weights=x, minlength=self.n).astype(np.int64)) for x in (n_a, n_b, n_groups)]
        digest = [self.digest[r].hexdigest() if r in self.digest and not bad[r] else "" for r in range(self.n)]
        doc, pair, n = (np.concatenate(x) for x in zip((none,) * 3, *self.pairs))
        doc, pair, n = doc[~bad[doc]], pair[~bad[doc]], n[~bad[doc]]
        order = np.lexsort((doc, pair))
        doc, pair, n = doc[order], pair[order], n[order]
        at = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]) if len(pair) else [])
        ids = pa.concat_arrays(self.ids)
        one = [0, self.n]
        return pa.RecordBatch.from_pydict(
            {
                "ids": pa.ListArray.from_arrays(pa.array(one, pa.int32()), ids),
                **{name: arrays.lists(x, [self.n], pa.int64()) for name, x in zip(("n_a", "n_b", "n_groups"), sums)},
                "digests": pa.ListArray.from_arrays(pa.array(one, pa.int32()), pa.array(digest, pa.string())),
                "pairs": arrays.lists(pair[at], [len(at)], pa.int64()),
                "totals": arrays.lists(np.add.reduceat(n, at) if len(at) else none, [len(at)], pa.int64()),
                "n_docs_of": [_pack(np.diff(np.append(at, len(pair))))],
                "docs": [_pack(doc)],
                "counts": [_pack(n)],
            }
        )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def _aligned_blocks(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """One row a block of documents."""
    rows = _texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for batch in batches:
            for part, _, _ in arrays.chunks(batch, PART_BYTES):
                block.add(part, path_a, path_b)
                if block.size >= BLOCK_BYTES or block.n >= BLOCK_ROWS:
                    yield block.row()
                    block = _Block()
        if block.n:
            yield block.row()
        arrays.release()

    schema = (
        f"ids array<{kind}>, n_a array<long>, n_b array<long>, n_groups array<long>, digests array<string>, "
        "pairs array<long>, totals array<long>, n_docs_of binary, docs binary, counts binary"
    )
    return stored(rows.mapInArrow(make, schema).withColumn("block", F.monotonically_increasing_id()), "aligned")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, ``n``, ``best``: how many links hold each pair of ids, and whether no pair of its second id has more."""
    each = blocks.select(F.explode(F.arrays_zip("pairs", "totals")).alias("p"))
    counted = stored(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.totals").alias("n")), "pair-counts")
    second = F.col("pair").bitwiseAND(F.lit((1 << PAIR_BITS) - 1))
    most = counted.groupBy(second.alias("of")).agg(F.max("n").alias("most"))
    return counted.join(most, second == F.col("of")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's rows, from what the whole corpus says of its pairs."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = {name: batch.column(name)[i] for name in batch.schema.names}
            ids = block["ids"].values
            n_of = _unpack(block["n_docs_of"].as_py())
            count, best = np.zeros(len(n_of), np.int64), np.zeros(len(n_of), np.int64)
            if block["found"].is_valid:
                found = block["found"].values
                place = found.field("place").to_numpy()
                count[place] = found.field("n").to_numpy()
                best[place] = found.field("best").to_numpy(zero_copy_only=False)
            doc, n = _unpack(block["docs"].as_py()), _unpack(block["counts"].as_py())
            n_best, count_sum = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            np.add.at(n_best, doc, n * np.repeat(best, n_of))
            np.add.at(count_sum, doc, n * np.repeat(count, n_of))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    *(block[name].values for name in ("n_a", "n_b", "n_groups", "n_groups")),
                    pa.array(n_best),
                    pa.array(count_sum),
                    block["digests"].values,
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )
    arrays.release()


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's alignment of a byte-level BPE file (a) with a sentencepiece model (b), and what its links are worth.

    Returns ``doc_id``, ``n_a``, ``n_b`` (tokens), ``n_groups``, ``n_links``, ``n_best`` (links of a pair that
    no other pair of its second id exceeds over all rows, ties included), ``count_sum`` (over links, how many links hold the same pair)
    and ``groups_sha256``. A space goes before each text; special strings are plain text. Null and empty texts, and
    those that the pieces of either side do not spell, have no tokens: zeros and an empty digest. Rows that
    repeat count each. An empty table gives no rows.

    Texts are read once and stay in blocks of about ``BLOCK_BYTES``. A block sends each of its distinct pairs once to be counted
    and once for the pair's count, however many links have it; what comes back meets the block's packed frequencies.
    """
    blocks = _aligned_blocks(docs, path_a, path_b, id_col, text_col)
    counts = pair_counts(blocks).select(F.col("pair").alias("of"), "n", "best")
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, F.col("pair") == F.col("of")).groupBy(F.col("block").alias("to"))
    answers = answers.agg(F.collect_list(F.struct("place", "n", "best")).alias("found"))
    whole = blocks.drop("pairs", "totals").join(answers, F.col("block") == F.col("to"), "left").drop("block", "to")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return whole.mapInArrow(_summed_up, schema)


def groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``part``, ``place``, ``n_bytes``, ``a_ids``, ``b_ids``: one row a group, in order within each part of a text.

    The first group of a text begins with the space before it. Texts without tokens have no rows.
    """
    rows = _texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, _, _ in arrays.chunks(batch, PART_BYTES):
                yield from _groups_of(texts, path_a, path_b)

    return rows.mapInArrow(make, f"doc_id {kind}, part int, place int, n_bytes long, a_ids array<int>, b_ids array<int>")


def _groups_of(texts: pa.RecordBatch, path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    held = [(_Aligned(path_a, path_b, data, bounds), row) for data, bounds, row in _parts(texts)]
    bad = [r for found, row in held for r in row[~found.good].tolist()]
    seen: dict[int, int] = {}
    for found, row in held:
        part = np.array([_next(seen, r) for r in row.tolist()], np.int64)
        keep = np.flatnonzero(~np.isin(row[found.text], bad))
        first = np.searchsorted(found.text, np.arange(len(row)))
        size_a, size_b = np.diff(found.cut_a, prepend=0), np.diff(found.cut_b, prepend=0)
        text = found.text[keep]
        yield pa.RecordBatch.from_arrays(
            [
                texts.column(0).take(pa.array(row[text])),
                pa.array(part[text].astype(np.int32)),
                pa.array((keep - first[text]).astype(np.int32)),
                pa.array(np.diff(found.ends_a[found.cut_a - 1], prepend=0)[keep]),
                arrays.lists(found.a.astype(np.int32), size_a, pa.int32()).take(pa.array(keep)),
                arrays.lists(found.b.astype(np.int32), size_b, pa.int32()).take(pa.array(keep)),
            ],
            names=["doc_id", "part", "place", "n_bytes", "a_ids", "b_ids"],
        )


def _next(seen: dict[int, int], key: int) -> int:
    """How often ``key`` was asked for before."""
    seen[key] = seen.get(key, -1) + 1
    return seen[key]
