"""Threshold-scaled sketches of word shingles (operator 13), in DataFrame expressions alone.

A sketch holds every shingle hash below a fixed part of all hashes, so the
sketch of a union is the union of the sketches, and what two sketches share
estimates what the texts share, however unequal they are.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
#: One of so many shingle hashes is kept.
SCALE = 4
#: Longer texts are looked at in blocks of about so many characters.
BLOCK_CHARS = 1 << 16
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _word_hashes(text: Column) -> Column:
    return F.transform(F.array_remove(F.split(F.lower(text), f"{SPACE}+"), ""), lambda w: F.xxhash64(w))


def _blocks(text: Column, shingle: int) -> Column:
    """Parts of a text that end with a word, each with the ``shingle - 1`` words after it."""
    block = rf"(?s)(.{{1,{BLOCK_CHARS}}}{WORD}*)(?=((?:{SPACE}+{WORD}+){{0,{shingle - 1}}}))"
    parts = F.arrays_zip(
        F.regexp_extract_all(text, F.lit(block), F.lit(1)).alias("own"), F.regexp_extract_all(text, F.lit(block), F.lit(2)).alias("after")
    )
    whole = F.array(F.struct(text.alias("own"), F.lit("").alias("after")))
    return F.when(F.char_length(text) <= BLOCK_CHARS, whole).otherwise(parts)


def _shingles(block: Column, shingle: int) -> Column:
    """The hashes of the shingles that begin in the block."""

    def of_words(words: Column) -> Column:
        own, h = words["own"], words["all"]
        starts = F.greatest(F.lit(0), F.least(F.size(own), F.size(h) - (shingle - 1)))
        return F.transform(F.slice(h, 1, starts), lambda x, i: F.xxhash64(x, *(h[i + k] for k in range(1, shingle))))

    def joined(own: Column) -> Column:
        return F.struct(own.alias("own"), F.concat(own, _word_hashes(block["after"])).alias("all"))

    return _let(_let(_word_hashes(block["own"]), joined), of_words)


def sketch(text: Column, scale: int = SCALE, shingle: int = SHINGLE) -> Column:
    """The sorted distinct hashes, of one in ``scale``, of a text's shingles of ``shingle`` words.

    Words are what stands between white space, lower-cased. A text of fewer
    words is one shingle; one without words, or null, has an empty sketch. Of a
    text of which no hash is low enough the lowest is kept, so that only texts
    without words have empty sketches. Equal texts have equal sketches. Texts
    beyond ``BLOCK_CHARS`` are looked at in blocks, whose words are held one block at a time.
    """
    if scale < 2 or shingle < 2:
        raise ValueError("a sketch needs a scale and a shingle of 2 or more")
    limit = F.lit(-(1 << 63) + (1 << 64) // scale)

    def of_block(block: Column) -> Column:
        return _let(
            _shingles(block, shingle),
            lambda h: F.struct(F.array_min(h).alias("low"), F.array_distinct(F.filter(h, lambda x: x < limit)).alias("kept")),
        )

    def of_blocks(blocks: Column) -> Column:
        kept = F.array_distinct(F.flatten(F.transform(blocks, lambda b: b["kept"])))
        low = F.array_min(F.transform(blocks, lambda b: b["low"]))
        return _let(F.struct(kept.alias("kept"), low.alias("low")), lambda s: F.when(F.size(s["kept"]) > 0, F.array_sort(s["kept"])).otherwise(F.array_compact(F.array(s["low"]))))

    text = F.coalesce(text.cast("string"), F.lit(""))
    few = _let(_word_hashes(text), lambda h: F.when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>")))
    many = _let(F.transform(_blocks(text, shingle), of_block), of_blocks)
    enough = rf"\A{SPACE}*(?:{WORD}++{SPACE}++){{{shingle - 1}}}{WORD}"
    return F.when(text.rlike(enough), many).otherwise(few)


def merged(sketches: DataFrame, by: str, column: str = "sketch") -> DataFrame:
    """``by``, ``hash``: the distinct hashes of each group's sketches, which are the sketch of its texts together.

    One row a hash: the sketch of a group may be too large for a cell.
    """
    return sketches.select(by, F.explode(column).alias("hash")).distinct()


def shared_part(a: Column, b: Column) -> Column:
    """The part of the smaller sketch that is in the other, 0 to 1; estimates the containment of the shorter text.

    Two empty sketches are alike (1); an empty one and another have nothing in common (0).
    """
    smaller = F.least(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b)) / smaller
    return F.when(smaller > 0, both).otherwise((F.size(a) == F.size(b)).cast("double"))


def text_of(sketch: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _constants(values: list[int]) -> Column:
    """A constant array, of any length."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _number_below(bounds: list[int], value: Column, or_equal: bool) -> Column:
    """How many of the sorted ``bounds`` are below ``value`` (or equal), by bisection."""
    if not bounds:
        return F.lit(0)
    held, n = _constants(bounds), len(bounds)

    def step(low: Column, width: Column) -> Column:
        at = low + width
        fits = F.get(held, at - 1) <= value if or_equal else F.get(held, at - 1) < value
        return F.when((at <= n) & fits, at).otherwise(low)

    widths = [1 << k for k in reversed(range(n.bit_length()))]
    return F.aggregate(F.array(*map(F.lit, widths)), F.lit(0), step)


def with_next(docs: DataFrame, add: dict[str, Callable[[Column], Column]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``, what ``add`` makes of the text, and the same of the next row as ``next_…``.

    Rows are in ascending order of the id, which must be a whole number; null ids come last,
    and rows of one id are in the order of a hash of their text. The first row follows the last; the only row follows
    itself. A null text is an empty one. No row gives none.

    Rows meet by ranges of ids with about equally many rows. Only the bounds and
    the first id of each of the ranges, whose number is that of the shuffle partitions, reach the driver.
    The first row of a range also goes to the range before. Whole texts move once. The rows of a repeated id are
    dealt over several ranges; only rows equal in all stay together.
    """
    spark = docs.sparkSession
    n_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    shares = [k / n_ranges for k in range(1, n_ranges)] or [0.5]
    found = rows.agg(
        F.percentile_approx("doc_id", shares, max(10_000, 20 * n_ranges)).alias("bounds"),
        F.count("*").alias("n"),
        F.count("doc_id").alias("n_ids"),
    ).first()
    bounds = sorted(found["bounds"] or [])
    # Rows of one id, and those without, are dealt over the ranges that such rows fill.
    n_null = -(-(found["n"] - found["n_ids"]) * n_ranges // max(1, found["n"]))
    mixed = F.shiftrightunsigned(F.xxhash64("text"), 11)
    part = F.col("mixed") / F.lit(float(1 << 53))
    low, high = (_number_below(bounds, F.col("doc_id"), or_equal) for or_equal in (False, True))
    ranged = rows.withColumn("mixed", mixed).withColumns({"low": low, "high": high})
    of_id = F.col("low") + F.floor(part * (F.col("high") - F.col("low") + 1))
    of_null = F.lit(len(bounds) + 1) + F.floor(part * n_null)
    ranged = ranged.withColumn("range", F.when(F.col("doc_id").isNull(), of_null).otherwise(of_id).cast("int")).drop("low", "high")
    keys = ranged.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mixed")).alias("k"))
    firsts = sorted((r["range"], r["k"]["none"], r["k"]["doc_id"] or 0, r["k"]["mixed"]) for r in keys.collect())
    top = len(bounds) + n_null + 1
    before = {b[0]: a[0] for a, b in pairwise(firsts)}
    if firsts:
        before[firsts[0][0]] = firsts[-1][0]
    at = {f[0]: f for f in firsts}
    first_id, first_mixed, back = (_constants([f(r) for r in range(top + 1)]) for f in (lambda r: at[r][2] if r in at else 0, lambda r: at[r][3] if r in at else -1, lambda r: before.get(r, -1)))
    is_first = (F.coalesce("doc_id", F.lit(0)) == F.get(first_id, F.col("range"))) & (F.col("mixed") == F.get(first_mixed, F.col("range")))
    home = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    also = F.struct(F.get(back, F.col("range")).cast("int").alias("range"), F.lit(True).alias("guest"))
    dealt = ranged.withColumn("to", F.explode(F.when(is_first, F.array(home, also)).otherwise(F.array(home))))
    dealt = dealt.select("to.range", "to.guest", "doc_id", "mixed", "text").repartitionById(top + 1, "range")
    made = dealt.withColumns({name: f(F.col("text")) for name, f in add.items()})
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").isNull(), "doc_id", "mixed", "text")
    names = ["text", *add]
    both = made.withColumns({f"next_{c}": F.lead(c).over(order) for c in names})
    return both.where("NOT guest").select("doc_id", *names, *[f"next_{c}" for c in names])


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scale: int = SCALE, shingle: int = SHINGLE) -> DataFrame:
    """Each row's sketch beside that of an edited text and that of the next row.

    In the edited text the last ``floor(n_chars / 2)`` characters are the first as many, or all, of the next row's text.
    Returns ``doc_id``, ``n_chars``, ``edited``, ``sketch``, ``edited_sketch``, ``near_edited``, ``near_next``; see
    ``with_next`` for the order and for nulls, and ``shared_part`` for the likeness.
    """
    rows = with_next(docs, {"sketch": lambda text: sketch(text, scale, shingle)}, id_col, text_col)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited"), scale, shingle))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "sketch",
        "edited_sketch",
        shared_part(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        shared_part(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
