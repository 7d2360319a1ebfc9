"""Document fingerprints by winnowing, with built-in functions only.

Every window of ``K`` code points is hashed. Of every ``W`` neighbouring hashes
the smallest is kept, the rightmost one on ties, with its position. Two texts
that share ``K + W - 1`` code points in a row therefore share a fingerprint
entry, wherever it stands in them.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as Over
from pyspark.sql import functions as F

from funnelwright.llm.common import bound, documents

K = 12
W = 16
LAST = 0xFFFFFFFF
# Documents are brought together with their successors in this many ranges at most.
MAX_RANGES = 10_000
RANGE_ROWS = 256


def _gram(wide: Column, at: Column, k: int) -> Column:
    """Hash of the k code points that start at a position; four bytes each."""
    return F.xxhash64(F.substring(wide, at * 4 + 1, F.lit(4 * k)))


def n_grams(n: Column, k: int = K) -> Column:
    """Texts shorter than k are one gram, empty ones none."""
    return F.when(n > 0, F.greatest(n - (k - 1), F.lit(1))).otherwise(0)


def n_windows(n: Column, k: int = K, w: int = W) -> Column:
    return F.when(n > 0, F.greatest(n - (k + w - 2), F.lit(1))).otherwise(0)


def _wide(text: Column, body) -> Column:
    """``body`` of the text at four bytes a code point, where substring needs no search.

    Bound as a lambda variable, so that no projection is merged into the loops.
    """
    return bound(F.encode(text, "UTF-32"), body)


def _doubled(packed: Column, step: int) -> Column:
    return bound(packed, lambda v: F.transform(v, lambda x, i: F.least(x, F.get(v, i + step))))


def window_minima(text: Column, shift: Column, k: int = K, w: int = W) -> Column:
    """The minimum of each window as hash and position in one number.

    The upper half holds 31 bits of the hash, the lower half a position that
    falls from left to right; so the smallest number is the smallest hash and,
    among equals, the rightmost. ``shift`` is added to the positions. Minima of
    1, 2, 4, ... neighbours build on each other.
    """
    if w & (w - 1):
        raise ValueError("the window must be a power of two")

    def packed(wide: Column, n: Column) -> Column:
        grams = F.sequence(F.lit(0), n_grams(n, k) - 1)
        out = bound(
            F.lit(LAST) - shift,
            lambda last: F.transform(
                grams,
                lambda i: F.shiftleft(_gram(wide, i, k).bitwiseAND(F.lit(0x7FFFFFFF)), 32) + (last - i),
            ),
        )
        step = 1
        while step < w:
            out = _doubled(out, step)
            step *= 2
        return F.slice(out, F.lit(1), n_windows(n, k, w))

    def minima(wide: Column) -> Column:
        n = (F.octet_length(wide) / 4).cast("int")
        return F.when(n > 0, packed(wide, n)).otherwise(F.array().cast("array<bigint>"))

    return _wide(text, minima)


def position(entry: Column) -> Column:
    return (F.lit(LAST) - entry.bitwiseAND(F.lit(LAST))).cast("int")


def hashes_at(text: Column, entries: Column, k: int = K) -> Column:
    """The full 64-bit hashes of the chosen grams."""
    return _wide(text, lambda wide: F.transform(entries, lambda e: _gram(wide, position(e), k)))


def likeness(a: Column, b: Column) -> Column:
    """Shared share of two fingerprints as sets; two empty ones are alike."""
    common = F.size(F.array_intersect(a, b))
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - common
    return F.when(total == 0, F.lit(1.0)).otherwise(common / total)


def fingerprint(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Add ``fingerprint``: entries of ``hash`` and code point ``position``, by position.

    Null and empty texts have an empty fingerprint; a text shorter than ``k``
    has one entry. A column named ``fingerprint`` is replaced. No shuffle.
    """
    text = F.coalesce("text", F.lit(""))
    chosen = F.array_distinct(window_minima(text, F.lit(0), k, w))
    entries = _wide(
        text,
        lambda wide: F.transform(
            chosen, lambda e: F.struct(_gram(wide, position(e), k).alias("hash"), position(e).alias("position"))
        ),
    )
    return docs.withColumn("fingerprint", entries)


def _ranges(docs: DataFrame) -> list[int]:
    """Ids that split the table into ranges of about equal row counts."""
    count = docs.count()
    wanted = max(1, min(MAX_RANGES, math.ceil(count / RANGE_ROWS)))
    steps = [i / wanted for i in range(1, wanted)]
    least = F.min("doc_id").alias("least")
    if not steps:
        row = docs.agg(least).first()
        return [row.least] if row.least is not None else [0]
    row = docs.agg(least, F.percentile_approx("doc_id", steps, 4 * wanted).alias("steps")).first()
    return sorted({row.least, *row.steps}) if row.least is not None else [0]


def with_next(docs: DataFrame) -> DataFrame:
    """Bring each document into one ordered range with its successor.

    Columns ``doc_id``, ``text`` (never null), ``range``, ``guest``, ``tie``. The
    first document of a range is also a guest at the end of the range before
    (that of the first range: of the last), so ``lead`` over ``next_order()``
    always finds the next document without a global sort. Null ids come first;
    repeated ids are ordered by a hash of their texts.
    """
    bounds = _ranges(docs.select("doc_id"))
    width = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    table = F.from_json(F.lit(json.dumps(rows)), "array<array<bigint>>")
    heads = F.from_json(F.lit(json.dumps([r[0] for r in rows])), "array<bigint>")
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(bounds[0]))
    row = F.greatest(F.size(F.filter(heads, lambda b: b <= F.col("_key"))), F.lit(1)) - 1
    inner = F.get(table, F.col("_row"))
    place = F.greatest(F.size(F.filter(inner, lambda b: b <= F.col("_key"))), F.lit(1)) - 1
    home = F.col("_row") * width + F.col("_place")
    first = F.get(inner, F.col("_place")) == F.col("_key")
    here = F.struct(home.alias("range"), F.lit(False).alias("guest"))
    before = F.struct(((home + (len(bounds) - 1)) % len(bounds)).alias("range"), F.lit(True).alias("guest"))
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("_key"))
        .withColumn("_row", row)
        .withColumn("_place", place)
        .withColumn("_seat", F.explode(F.when(first, F.array(here, before)).otherwise(F.array(here))))
        .select("doc_id", "text", F.col("_seat.range"), F.col("_seat.guest"), F.xxhash64("text").alias("tie"))
    )


def next_order():
    return Over.partitionBy("range").orderBy("guest", F.col("doc_id").asc_nulls_first(), "tie")


def _digest(*arrays: str) -> Column:
    return F.concat(*[F.lpad(F.hex(F.xxhash64(a)), 16, "0") for a in arrays])


def compare_edited(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they are.

    The edited text ends in the beginning of the next document. Windows that lie
    wholly in its unchanged first half are those of the text itself and are not
    computed again. One shuffle, of each text once; both ``lead`` columns use it.
    """
    over = next_order()
    n, half = F.col("n_chars"), F.floor(F.col("n_chars") / 2).cast("int")
    kept = F.greatest(F.col("n_chars") - half - (k + w - 2), F.lit(0))
    texts = (
        with_next(docs)
        .withColumn("next_text", F.coalesce(F.lead("text").over(over), F.lit("")))
        .withColumn("n_chars", F.char_length("text"))
        .withColumn(
            "edited", F.concat(F.left("text", n - half), F.left("next_text", half))
        )
        .select(
            "doc_id", "range", "guest", "tie", "n_chars", "edited",
            F.sha2("edited", 256).alias("edited_sha256"),
            F.char_length("edited").alias("n_edited"), "text", kept.alias("same"),
        )
    )
    same, n_edited = F.col("same"), F.col("n_edited")
    tail = F.substring("edited", same + 1, n_edited)
    new_windows = F.greatest(n_windows(n_edited, k, w) - same, F.lit(0))
    prints = (
        texts.withColumn("minima", window_minima(F.col("text"), F.lit(0), k, w))
        .withColumn("tail_minima", window_minima(tail, same, k, w))
        .withColumn("entries", F.array_distinct("minima"))
        .withColumn(
            "edited_entries",
            F.array_distinct(
                F.concat(F.slice("minima", F.lit(1), same), F.slice("tail_minima", F.lit(1), new_windows))
            ),
        )
        .withColumn("hashes", hashes_at(F.col("text"), F.col("entries"), k))
        .withColumn("edited_hashes", hashes_at(F.col("edited"), F.col("edited_entries"), k))
        .select(
            "doc_id", "range", "guest", "tie", "n_chars", "edited_sha256", "hashes",
            _digest("hashes", "entries").alias("fingerprint"),
            _digest("edited_hashes", "edited_entries").alias("edited_fingerprint"),
            F.size("entries").alias("n_entries"),
            likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        )
    )
    return (
        prints.withColumn("next_hashes", F.lead("hashes").over(over))
        .filter(~F.col("guest"))
        .select(
            "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256", "fingerprint",
            "edited_fingerprint", "near_edited", likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
            "n_entries",
        )
    )


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(documents(spark, sf_dir))
