import random

import pytest

from larkmetric.llm.queries import reach_workers

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, fp string, key int, _RID int"


@pytest.fixture(scope="session")
def workers(spark):
    reach_workers(spark)
    return spark


@pytest.fixture(scope="session")
def frame(workers):
    """Documents with clashing extra columns, from (id, text) or (id, text, lang)."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1]), 7, "x", None, 1) for r in rows]
        return workers.createDataFrame(full, SCHEMA).repartition(parts) if parts and full else workers.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def corpus(frame, tmp_path_factory):
    """Nulls, empty and long texts, copies, near copies, shared passages and lines, a repeated row."""
    rng = random.Random(4)

    def words(n):
        return " ".join(rng.choice(("ab", "cé", "do", "Efg", "hi'", "x1", "it's", "zz,")) + rng.choice("abcdefgh") for _ in range(n))

    passage, line = words(40), words(12)
    rows = [(i, "\n".join(words(rng.randint(1, 40)) for _ in range(rng.randint(1, 5)))) for i in range(40)]
    rows += [(100 + i, rows[i % 7][1]) for i in range(14)]
    rows += [(200 + i, rows[i][1].replace("ab", "ba", 1) + " end") for i in range(10)]
    rows += [(300 + i, words(30) + " " + passage + " " + words(i)) for i in range(8)]
    rows += [(400 + i, words(9) + "\n" + line + "\n" + words(7)) for i in range(8)]
    rows += [(500, None), (501, ""), (None, "no id " + passage), (502, " \t\n"), (503, words(6000)), (504, "日本語 😀 <|endoftext|> ok")]
    rows += [(505, passage), (505, passage), (506, passage * 3), (507, "ab"), (508, "!!! 123"), (500_000_000_000, passage)]
    rows += [(600, long := words(400)), (601, long + " end"), (602, "start " + long)]
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    frame(rows, 4).write.parquet(path)
    return path, rows
