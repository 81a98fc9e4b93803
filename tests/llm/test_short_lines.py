"""Repeated blocks of lines that are each too short to be evidence."""

import random

from larkmetric.llm import line_dedup


def test_short_lines(workers, frame, tmp_path):
    rng = random.Random(3)
    line = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(1, 4) for _ in range(4))
    verse, tail = [line() for _ in range(12)], [line() for _ in range(3)]
    rows = [(1, "\n".join(verse)), (2, "\n".join([line(), *verse[3:9], line()])), (3, "\n".join(verse))]
    rows += [(4, "\n".join([line(), "", " " + tail[0], "", tail[1], tail[2]])), (5, "\n".join([tail[0], "", tail[1], tail[2], line()]))]
    rows += [(6, "春眠不覺曉\n處處聞啼鳥\n夜來風雨聲"), (7, "x\n春眠不覺曉\n處處聞啼鳥\n夜來風雨聲"), (8, verse[0]), (9, ""), (10, None)]
    assert max(len(x.encode()) for _, t in rows for x in (t or "").split("\n")) < 32
    frame(rows).write.parquet(f"{tmp_path}/documents")
    kept, had, lost = line_dedup.without_repeats(workers.read.parquet(f"{tmp_path}/documents"))
    assert {r.doc_id: r[lost] for r in kept.collect()} == {1: 0, 2: 6, 3: 12, 4: 0, 5: 4, 6: 0, 7: 3, 8: 0, 9: 0, 10: 0}
