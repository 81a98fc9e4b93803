"""Flat arrays, pre-tokens, Bloom filters, suffix sorting, planning: no Spark needed."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkmetric.llm import arrays, bloom, line_dedup, packing, pretokens, suffix_sort

HOLDER = pretokens.Pieces(public_tokenizers.path("byte_bpe_50k.json"))
PARTS = ["a", "b's", "'", "'re", "'sre", " ", "  ", "\n", "\r\n", "\t", "1", "²", "é", "!", "<|endoftext|>", "<|endof", "日本", "😀", "\x1c", "\x85", "I'LL"]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.lists(st.sampled_from(PARTS), max_size=12).map("".join)), max_size=6))
def test_pieces_are_the_tokenizers(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    data, bounds = arrays.flat(pa.array(texts, pa.string()))
    starts = pretokens.split(data, bounds, HOLDER.special)
    ends, keys = pretokens.hashes(data, starts)
    keys, one, back = np.unique(keys, return_index=True, return_inverse=True)
    at = HOLDER.look_up(keys, data.tobytes(), starts[one], ends[one])[back]
    of = pretokens.text_of(starts, bounds)
    got = [[] for _ in texts]
    for text, row in zip(of.tolist(), at.tolist()):
        got[text] += HOLDER.ids[HOLDER.start[row] : HOLDER.start[row] + HOLDER.count[row]].tolist()
    assert got == [HOLDER.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def twins(n):
    """Two words that share every polynomial hash modulo 2**64 if ``n`` is a power of two from 1,024 on."""
    odd = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[k] for k in odd), "".join("ba"[k] for k in odd)


@pytest.mark.parametrize("n", [1024, 4096])
def test_structured_words_have_hashes_of_their_own(n):
    a, b = twins(n)
    data = np.frombuffer(f"{a} {b} {a}".encode(), np.uint8)
    at = np.array([0, n + 1, 2 * n + 2])
    first, second, third = arrays.span_hashes(arrays.BYTE_VALUE[data], at, at + n)
    assert first == third and first != second


def test_chunks_keep_every_row():
    texts = ["x" * n for n in (0, 5, 100, 3, 0, 0, 7, 300, 1)]
    batch = pa.record_batch({"text": pa.array(texts)})
    parts = list(arrays.chunks(batch, limit=50))
    assert [t for p, _, _ in parts for t in p.column(0).to_pylist()] == texts
    for p, data, bounds in parts:
        assert [data[i:j].tobytes().decode() for i, j in zip(bounds[:-1], bounds[1:])] == p.column(0).to_pylist()


def test_bloom_never_misses():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    held = np.zeros(1 << 13, np.uint8)
    for at in bloom.probes(keys, 1 << 16):
        np.bitwise_or.at(held, at >> 3, (1 << (at & 7)).astype(np.uint8))
    assert bloom.may_hold(held, keys).all()


@pytest.mark.parametrize("shallow", [0, 8, 32])
def test_suffix_sort(shallow):
    rng = random.Random(5)
    for t in range(40):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 3, 30, 40]))) for _ in range(rng.randint(1, 50))]
        texts = [(b"abcabcab" * 5)[: rng.randint(28, 40)] if t % 2 and rng.random() < 0.5 else x for x in texts]
        group, lengths = np.array([rng.randint(0, 2) for _ in texts]), np.array([len(x) for x in texts])
        rows = np.zeros((len(texts), 40), np.uint8)
        for i, x in enumerate(texts):
            rows[i, : len(x)] = np.frombuffer(x, np.uint8)
        order, shared = suffix_sort.sort(group, rows, lengths, shallow)
        got = [(group[i], texts[i]) for i in order]
        assert got == sorted(got)
        for i in range(1, len(got)):
            (g, a), (h, b) = got[i - 1], got[i]
            want = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[i] == (want if g == h else -1)


def best_fit_decreasing(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    return len(room)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_plan_is_best_fit_decreasing(lengths):
    counts = Counter(lengths)
    rows = packing.plan(counts, 40)
    used = Counter()
    places = set()
    for length, low, high, first, offset in rows:
        for rank in range(low, high):
            used[length] += 1
            span = {(first + rank - low, offset + i) for i in range(length)}
            assert not span & places and offset + length <= 40
            places |= span
    assert used == counts
    top = Counter(s for s, _ in places)
    assert all(set(range(n)) == {o for s, o in places if s == seq} for seq, n in top.items())
    assert len(top) == best_fit_decreasing(lengths, 40)


def test_plan_size_does_not_follow_the_counts():
    few, many = ({n: k * (n % 7 + 1) for n in range(1, 1025)} for k in (10, 10_000_000))
    assert len(packing.plan(many)) < 3 * len(packing.plan(few)) + 5000


def test_patience_aligns_in_order():
    assert line_dedup.patience([1, 2, 3, 4, 5], [9, 2, 3, 8, 5]) == [(1, 1), (2, 2), (4, 4)]
    assert line_dedup.patience([], [1]) == []
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 9))] for _ in range(2))
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p < r and q < s for (p, q), (r, s) in zip(pairs, pairs[1:]))
    assert line_dedup.common_blocks([1, 2, 3], [1, 2, 3], [10, 10, 10], 30) == [0, 1, 2]
    assert line_dedup.common_blocks([1, 2, 9, 3], [1, 2, 3], [10, 10, 10], 20) == [0, 1]
