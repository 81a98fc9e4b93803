"""Each operator on small documents against brute force, with all awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from test_arrays import twins

from larkmetric.llm import (
    decontaminate,
    exact_dedup,
    folds,
    language,
    line_dedup,
    packing,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LAST = 1 << 62


@pytest.fixture(scope="session")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def plain(df, *columns):
    """Rows as a multiset of plain values."""
    return Counter(repr(tuple(r)) for r in df.select(*columns).collect())


def multiset(rows):
    return Counter(repr(tuple(r)) for r in rows)


@pytest.fixture
def docs(workers, corpus):
    return workers.read.parquet(corpus[0])


@pytest.fixture(scope="session")
def ordered(workers, corpus):
    """(id, text) in the order of the scan."""
    return [(r.doc_id, r.text) for r in workers.read.parquet(corpus[0]).select("doc_id", "text").collect()]


# 1


def brute_spans(rows):
    """rows: (id, text) in scan order; the spans of each."""
    seen, out = set(), {}
    for i in sorted(range(len(rows)), key=lambda i: (LAST if rows[i][0] is None else rows[i][0], i)):
        data, spans = (rows[i][1] or "").encode(), []
        for at in range(len(data) - 99):
            string = data[at : at + 100]
            if string in seen:
                if spans and at <= spans[-1][1]:
                    spans[-1][1] = at + 100
                else:
                    spans.append([at, at + 100])
            seen.add(string)
        edges = [0, *(x for s in spans for x in s), len(data)]
        out[i] = (rows[i][0], len(data), len(spans), b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
    return [out[i] for i in range(len(rows))]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 1])
def test_suffix_dedup(docs, ordered, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    found = suffix_dedup.without_repeats(docs)
    got = multiset((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in found.collect())
    want = brute_spans(ordered)
    assert got == multiset(want) and sum(x[2] for x in want) > 10


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 5])
def test_phrases_in_many_texts(workers, frame, tmp_path, monkeypatch, hot):
    """Phrases of 60 to 130 bytes between other text, some cut at an end: those under 100 bytes stay whole."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(12)

    def noise(n):
        return "".join(rng.choice("abcdefghijklmnopqrst ") for _ in range(n))

    rows = []
    for size in (60, 95, 99, 100, 101, 115, 130):
        phrase = noise(size)
        for k in range(14):
            cut = rng.choice([0, 0, 5, 20]) if size > 101 else 0
            rows.append((len(rows), noise(rng.randint(0, 90)) + phrase[cut:] + noise(rng.randint(0, 90))))
    rows.append((None, rows[40][1] + rows[90][1]))
    frame(rows, 4).write.parquet(f"{tmp_path}/documents")
    docs = workers.read.parquet(f"{tmp_path}/documents")
    in_order = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = multiset((r.doc_id, r.n_bytes, len(r.spans), bytes(r.kept)) for r in suffix_dedup.without_repeats(docs).collect())
    want = brute_spans(in_order)
    assert got == multiset(want) and 30 < sum(x[2] for x in want) < 90


# 2


def test_language(workers, frame):
    words = {"aa": "kala mala tala", "bb": "xoru zoru voru", "cc": "ßenn łenn øenn"}
    rows = [(i, " ".join(words[k].split()[(i + j) % 3] for j in range(12)), k) for i in range(60) for k in [list(words)[i % 3]]]
    model = language.learn(frame(rows))
    assert model.names == ["aa", "bb", "cc"]
    probe = frame([(1, "mala tala kala"), (2, None), (3, ""), (4, "12 !!"), (5, "ß"), (6, "kala mala tala kala mala " * 8 + "zoru voru xoru zoru " * 8)])
    found = {r.doc_id: r.r for r in probe.select("doc_id", language.identify(model, F.col("text")).alias("r")).where("doc_id > 0").collect()}
    assert found[1].lang_pred == "aa" and found[1].score > 0.9
    assert [found[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and found[2].score == 0
    assert found[5].lang_pred == "cc"
    assert set(found[6].languages) == {"aa", "bb"} and abs(sum(found[6].shares) + found[6].other_share - 1) < 1e-6
    empty = language.learn(frame([]))
    assert frame([(1, "some")]).select(language.identify(empty, F.col("text"))["lang_pred"]).first()[0] == "und"


# 3


def test_token_counts(docs, ordered, library):
    got = plain(token_counts.token_counts(docs, TOKENIZER), "doc_id", "n_bytes", "n_tokens")
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ordered]
    assert got == multiset(want)


def test_words_of_one_polynomial(workers, frame, library):
    """Long words that differ but share polynomial hashes modulo 2**64."""
    rows = [(2 * k + i, t) for k, n in enumerate((1024, 4096)) for i, t in enumerate(twins(n))]
    docs = frame(rows, 1)
    assert plain(token_counts.token_counts(docs, TOKENIZER), "doc_id", "n_tokens") == multiset((i, len(library.encode(t).ids)) for i, t in rows)
    got = {(r.doc_id, r.start): r.ids for r in packing.cut(docs, TOKENIZER).collect()}
    for i, t in rows:
        assert [x for k in sorted(got) if k[0] == i for x in got[k]] == [*library.encode(t).ids, packing.END]
    kept, _, lost = line_dedup.without_repeats(docs)
    assert all(r[lost] == 0 for r in kept.collect())


def test_token_counts_of_many_small_rows(frame, library):
    rows = [(i, f"the cat {i % 9}") for i in range(300)]
    got = plain(token_counts.token_counts(frame(rows), TOKENIZER), "doc_id", "n_tokens")
    assert got == multiset((i, len(library.encode(t).ids)) for i, t in rows)


# 4


def brute_groups(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append(i)
    for text, members in groups.items():
        best = min(members, key=lambda i: (-len(rows[i][1] or ""), rows[i][0] is None, rows[i][0] or 0, i))
        for i in members:
            yield rows[i][0], rows[best][0], len(members), i == best, hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("bits", [1 << 10, 1 << 25])
def test_exact_dedup(docs, ordered, bits):
    found = exact_dedup.exact_groups(docs, bits=bits)
    assert plain(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == multiset(brute_groups(ordered))


# 5 and 10


def _labels(workers, rows):
    return workers.createDataFrame(rows, "doc_id long, toxic int, quality int")


def test_toxicity(workers, frame):
    rows = [(i, f"word{i % 13} plain text {i % 7} " + ("vile scum here" if i % 4 == 0 else "kind person here")) for i in range(400)]
    labels = _labels(workers, [(i, int(i % 4 == 0), 1) for i in range(400)] + [(8, None, None), (12, 1, 1), (None, 1, 1)])
    docs = frame(rows + [(900, None), (901, ""), (None, "vile scum")])
    sample = folds.labelled_sample(docs, labels, "toxic", 4, 2, 10_000)
    assert {zlib.crc32(str(r.doc_id).encode()) % 4 for r in sample.select("doc_id").collect()} == {0, 1, 3}
    got = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score(toxicity.learn(sample), F.col("text")).alias("s")).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all((got[i] >= 0.3) == (i % 4 == 0) for i in held)
    assert got[900] == got[901] < 0.5 and got[None] > 0.5
    none = toxicity.learn(sample.where("false"))
    assert docs.select(toxicity.score(none, F.col("text"))).distinct().collect() == [(0.5,)]


def test_quality(workers, frame):
    rows = [(i, f"word{i % 17} fine text of number {i % 7}, so." if i % 3 else f"word{i % 17} ### | fine ### | {i % 7} ###") for i in range(300)]
    labels = _labels(workers, [(i, 0, int(i % 3 > 0)) for i in range(300)])
    docs = frame(rows + [(900, None), (901, ""), (None, "fine text")])
    sample = folds.labelled_sample(docs, labels, "quality", 3, 1, 10_000, extra=("n_chars",))
    scores = docs.select("doc_id", quality.score(quality.learn(sample), F.col("text"), F.col("n_chars")).alias("s"))
    got = {r.doc_id: r.s for r in scores.collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((got[i] >= 0.5) == (i % 3 > 0) for i in held) >= 0.97 * len(held)
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == 303


def test_factorisation_machine_counts_all_pairs():
    import numpy as np

    rng = np.random.default_rng(1)
    m = quality.Machine(0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    place, value = np.array([0, 3, 8]), np.array([1.0, 0.5, 2.0])
    pairs = sum(m.factor[place[i]] @ m.factor[place[j]] * value[i] * value[j] for i in range(3) for j in range(i))
    assert abs(m.raw(place, value) - (0.3 + m.weight[place] @ value + pairs)) < 1e-9


def test_sample_is_bounded(workers, frame):
    rows = [(i, "x") for i in range(3000)]
    sample = folds.labelled_sample(frame(rows), _labels(workers, [(i, 1, 1) for i in range(3000)]), "toxic", 4, 2, 200)
    assert 100 < sample.count() < 300


# 6


def brute_hits(rows, items, window=10):
    def words(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[s : s + n])].add(None if item is None else str(item))
    sizes = {len(x) for x in windows}
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (key := tuple(w[s : s + n])) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[key]
        yield doc, len(w), len(hit), len(found - {None}), ",".join(sorted(found - {None}))


def test_decontamination(workers, docs, ordered):
    passage = next(t for i, t in ordered if i == 505)
    cut = " ".join(passage.split()[3:14])
    items = [(1, "FOO bar " + cut.upper() + " baz"), (10, cut), (2, None), (3, ""), (4, "zzg zzh"), (5, "AB"), (6, "日本語"), (None, passage), (1, cut)]
    found = decontaminate.contamination(docs, workers.createDataFrame(items, "item_id long, text string"))
    got = plain(found.withColumn("ids", F.array_join("items", ",")), "doc_id", "n_words", "n_hit", "n_items", "ids")
    want = list(brute_hits(ordered, items))
    assert got == multiset(want) and sum(x[2] > 0 for x in want) > 5


def test_decontamination_without_items(workers, docs):
    none = workers.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(docs, none).where("n_hit > 0 OR n_items > 0").isEmpty()


# 7


def test_packing(docs, ordered, library):
    got = packing.packed(docs, TOKENIZER).collect()
    want = []
    for doc, text in ordered:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) - (-(-len(ids) // 1024) - 1) * 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for piece, (i, j) in enumerate(zip(cuts, cuts[1:])):
            crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[i:j]))
            want.append((doc, piece, i, j - i, crc))
    assert multiset((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == multiset(want)
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) <= 1024
    assert len(used) <= 1.05 * sum(r.length for r in got) / 1024 + 1


# 8


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, distance):
    left, out = set(nodes), {}
    while left:
        queue = [left.pop()]
        group = set(queue)
        while queue:
            x = queue.pop()
            near = {y for y in left if (x ^ y).bit_count() <= distance}
            left -= near
            group |= near
            queue += near
        out |= dict.fromkeys(group, frozenset(group))
    return out


def test_simhash(docs, ordered):
    got = plain(simhash.near_groups(docs).withColumn("f", F.lower(F.lpad(F.hex("fp"), 16, "0"))), "doc_id", "f", "component_id")
    fps = [brute_fingerprint(t) for _, t in ordered]
    of = brute_components(set(fps), 4)
    least = {fp: min((d for (d, _), f in zip(ordered, fps) if f in of[fp] and d is not None), default=None) for fp in set(fps)}
    assert got == multiset((d, f"{f:016x}", least[f]) for (d, _), f in zip(ordered, fps))


@pytest.mark.parametrize("distance,segments", [(4, (22, 21, 21)), (3, (16, 16, 16, 16)), (5, (22, 21, 21))])
def test_links_connect_all_near_fingerprints(workers, distance, segments):
    import numpy as np

    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    rows = set(int(c) for c in centres)
    for c in centres[:20]:
        for _ in range(40 if c != centres[0] else 900):
            x = int(c)
            for b in rng.integers(0, 64, rng.integers(1, 7)):
                x ^= 1 << int(b)
            rows.add(x)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in rows]
    links = simhash.links(workers.createDataFrame(signed, "fp long"), distance, segments).collect()
    up = {x: x for x in rows}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= distance
        up[root(a)] = root(b)
    want = brute_components(rows, distance)
    groups = defaultdict(set)
    for x in rows:
        groups[root(x)].add(x)
    assert {frozenset(g) for g in groups.values()} == set(want.values())
    assert len(links) < 20 * len(rows)


# 9


def brute_lines(rows):
    """Removed lines of each row: aligned with the first holder of each of its long lines."""
    lines = [[x.strip(" \t\x0b\x0c\r") for x in (t or "").split("\n")] for _, t in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    home = {}
    for i in order:
        for x in lines[i]:
            if len(x.encode()) >= 32:
                home.setdefault(x, i)
    for i, own in enumerate(lines):
        gone = set()
        for a in {home[x] for x in own if x in home} - {i}:
            gone |= set(line_dedup.common_blocks(lines[a], own, [len(x.encode()) for x in own], 32))
        text = rows[i][1]
        kept = text if not gone else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
        yield rows[i][0], kept, len(gone)


def test_line_dedup(docs, ordered):
    kept, had, lost = line_dedup.without_repeats(docs)
    assert kept.columns[: len(docs.columns)] == docs.columns
    want = list(brute_lines(ordered))
    assert plain(kept, "doc_id", "text", lost) == multiset(want) and sum(x[2] for x in want) > 10


def test_empty_tables(workers, frame):
    none = frame([])
    items = workers.createDataFrame([(1, "a b")], "item_id long, text string")
    frames = [
        suffix_dedup.without_repeats(none),
        token_counts.token_counts(none, TOKENIZER),
        exact_dedup.exact_groups(none),
        decontaminate.contamination(none, items),
        packing.packed(none, TOKENIZER),
        simhash.near_groups(none),
        line_dedup.without_repeats(none)[0],
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
