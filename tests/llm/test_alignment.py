"""Alignment of two tokenizers (operator 11) against the libraries on whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from larkmetric.llm import alignment, queries

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"


@pytest.fixture(scope="session")
def both():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    to_byte = alignment._byte_of_character()
    b = sentencepiece.SentencePieceProcessor(model_file=PATH_B)

    def encode(text):
        """Ids and bytes of both sides; nothing where they do not spell the text."""
        want = (" " + (text or "")).encode()
        found = a.encode(want.decode(), add_special_tokens=False)
        left = [(i, bytes(to_byte[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
        right = []
        for i in b.encode(text or ""):
            piece = b.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace(MARK, " ").encode()))
        ok = text and b"".join(x for _, x in left) == want and b"".join(x for _, x in right) == want
        return (left, right) if ok else ([], [])

    return encode


def groups_of(left, right):
    """Groups by walking both sides' ends."""
    ends = [set(np.cumsum([len(x) for _, x in side]).tolist()) for side in (left, right)]
    shared = sorted(ends[0] & ends[1])
    out = [([], []) for _ in shared]
    for k, side in enumerate((left, right)):
        at = g = 0
        for i, x in side:
            at += len(x)
            out[g][k].append(i)
            g += at == shared[g]
    return out


def brute(rows, both):
    aligned = [(i, *both(t)) for i, t in rows]
    grouped = [groups_of(left, right) for _, left, right in aligned]
    counts = Counter((a[-1], b[-1]) for groups in grouped for a, b in groups)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for (i, left, right), groups in zip(aligned, grouped):
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        n_best = sum(counts[x] == most[x[1]] for x in links)
        yield (i, len(left), len(right), len(groups), len(links), n_best, sum(counts[x] for x in links), digest)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def compared(df, rows, both):
    assert sorted(repr(tuple(r)) for r in df.select(NAMES).collect()) == sorted(map(repr, brute(rows, both)))


AWKWARD = [None, "", " ", "  ", "a", " a", "a ", "a  ", "\n", "a\n b", "a \n  b", "x▁y", "▁", "日本語  😀 ok", "<|endoftext|> <s> <0x41>", "don't  we'll", "\x00 \x7f", "é" * 40, "1234567890" * 3, "a b" * 50]


def test_whole_query(workers, corpus, frame, tmp_path, both):
    rows = corpus[1] + [(1000 + i, t) for i, t in enumerate(AWKWARD)]
    frame(rows, 4).write.parquet(f"{tmp_path}/documents.parquet")
    compared(queries.op11_token_alignment(workers, str(tmp_path)), rows, both)


def test_long_texts_in_parts(workers, frame, both, monkeypatch):
    """Parts and blocks leave the result as it is, and so do texts that cannot be cut."""
    monkeypatch.setattr(alignment, "PART_BYTES", 60)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 400)
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(["the ", "cat", "  ", "\n", "é", "'s", ". ", "日", "x1 "]) for _ in range(rng.randint(0, 200)))) for i in range(25)]
    rows += [(100, "x" * 300), (101, " " * 200), (102, "word " * 60 + MARK), (103, "日本 語" * 40), (103, "日本 語" * 40)]
    made = alignment.alignments(frame(rows, 2), PATH_A, PATH_B)
    compared(made, rows, both)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, ""), (None, "a b"), (2, MARK)]])
def test_few_rows(frame, both, rows):
    compared(alignment.alignments(frame(rows, 0), PATH_A, PATH_B), rows, both)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=25), st.lists(st.sampled_from([" ", "  ", "\n", "a", "the", "'re", "É", "日本", "😀", "<s>", "1", MARK, "\t", "　", "\x85"]), max_size=14).map("".join)), min_size=1, max_size=5))
def test_words_are_the_libraries(both, texts):
    import pyarrow as pa

    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts, pa.string())})
    held = {i: both(t) for i, t in enumerate(texts)}
    got = {i: [] for i in held}
    for part in alignment._groups_of(batch, PATH_A, PATH_B):
        for r in part.to_pylist():
            got[r["doc_id"]].append((r["a_ids"], r["b_ids"]))
    assert got == {i: groups_of(*x) for i, x in held.items()}


def test_division_finds_every_cut():
    rng = np.random.default_rng(5)
    for t in range(200):
        texts = [rng.integers(1, 60) for _ in range(rng.integers(1, 5))]
        sides = []
        for side in range(2):
            ends, first, base = [], [0], 0
            for n in texts:
                inner = np.flatnonzero(rng.random(n) < rng.choice([0.02, 0.3, 0.9])) + 1
                ends += [base + x for x in sorted({*inner.tolist(), int(n)})]
                base += n
                first.append(len(ends))
            sides.append((np.array(ends), np.array(first)))
        (a, fa), (b, fb) = sides
        cut_a, cut_b = alignment._divide(a, b, fa, fb)
        shared = sorted(set(a.tolist()) & set(b.tolist()))
        assert a[cut_a - 1].tolist() == shared == b[cut_b - 1].tolist()


def test_groups_spell_the_text(workers, corpus, frame, both):
    rows = [(i, t) for i, t in corpus[1] if i is not None and i < 60]
    found = alignment.groups(frame(rows), PATH_A, PATH_B).collect()
    for i, t in rows:
        own = sorted((r for r in found if r.doc_id == i), key=lambda r: (r.part, r.place))
        assert [(list(r.a_ids), list(r.b_ids)) for r in own] == groups_of(*both(t))
        assert sum(r.n_bytes for r in own) == len((" " + t).encode())
