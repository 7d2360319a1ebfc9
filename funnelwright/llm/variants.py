"""Spelling variants: words one edit apart, found by sorted permuterm rotations.

A word ends in a terminator and is rotated. Two words ``u a v`` and ``u b v`` that
differ by one replaced character have rotations ``v $ u a`` and ``v $ u b``: one
prefix range, ``v $ u``, with the edited character skipped. A word ``u v`` is what
``u a v`` becomes by a deletion, and its whole rotation ``v $ u`` heads the same
range. So the rotations, sorted, fall into ranges of one prefix each, and a scan of
a range finds all neighbours by every kind of edit. A range holds at most one
word for each character of the alphabet, and one row a word leaves it: how many
neighbours it has there and the most frequent of them, never the pairs.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import discard, documents, stored, workers_import

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {upper: upper + 32 for upper in range(ord("A"), ord("Z") + 1)}
#: No letter of a word.
TERMINATOR = "$"
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form is at least so many times as frequent as its variant.
MORE_FREQUENT = 2
#: One in so many words of a document loses a character in the registered query.
DAMAGED = 97
#: Words that a task counts before it hands the counts on.
COUNTED = 200_000


def _damaged(word: str, doc: int, one_in: int) -> str:
    h = zlib.crc32(word.encode(), doc)
    if h % one_in:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, damage: int | None = None) -> DataFrame:
    """``word`` and ``n``: the lower-cased letter runs of all texts and how often each occurs.

    Null and empty texts have no words. With ``damage`` one in so many pairs of
    document and word, by checksum, loses a character, the same one wherever the
    pair recurs; rows without a doc_id stay as they are. Words that are lost whole
    are not counted. Tasks count before they shuffle, so a hot word costs a row a
    task and a flush. Columns other than doc_id and text are not read.
    """
    workers_import(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = Counter(RUN.findall((text.as_py() or "").translate(LOWER)))
                start = zlib.crc32(f"{doc}:".encode())
                for word, n in found.items():
                    if damage and doc is not None:
                        word = _damaged(word, start, damage)
                    held[word] = held.get(word, 0) + n
                if len(held) >= COUNTED:
                    yield flush()
        yield flush()

    found = docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(count, "word string, n bigint")
    return found.filter("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """Each word's ranges: ``prefix``, the ``edited`` character that the range skips, ``n``.

    For every character the rotation that ends in it, less that character; and every
    whole rotation, with a null character, as what a deletion in a longer word gives.
    A rotation holds its word, so the word itself is not carried.
    """
    length = F.char_length("word")
    at = F.col("at")
    cut = F.when(at < length, at + 2).otherwise(at - length + 1)
    before = F.when(at < length, at).otherwise(at - length)
    prefix = F.concat(
        F.substring("word", cut, length), F.lit(TERMINATOR), F.substring("word", F.lit(1), before)
    )
    edited = F.when(at < length, F.substring("word", at + 1, F.lit(1)))
    return words.withColumn("at", F.explode(F.sequence(F.lit(0), 2 * length))).select(
        prefix.alias("prefix"), edited.alias("edited"), "n"
    )


def _word(member: Column) -> Column:
    """The word of a member of a range: the character goes back between the parts."""
    return F.concat(
        F.substring_index("prefix", TERMINATOR, -1),
        F.coalesce(member["edited"], F.lit("")),
        F.substring_index("prefix", TERMINATOR, 1),
    )


def _neighbours(member: Column) -> Column:
    """Members of the range that are near one of them, each pair in one range only.

    A replacement has one range. A deletion out of a row of equal characters has
    one for each of them; that of the first counts, which the character before it
    in the word, the last of the prefix, tells.
    """

    def first_of_row(m: Column) -> Column:
        return F.right(F.col("prefix"), F.lit(1)) != m["edited"]

    def near(other: Column) -> Column:
        replaced = member["edited"].isNotNull() & other["edited"].isNotNull() & (member["edited"] != other["edited"])
        longer = F.when(member["edited"].isNull(), other["edited"].isNotNull() & first_of_row(other))
        return replaced | F.coalesce(longer.otherwise(other["edited"].isNull() & first_of_row(member)), F.lit(False))

    return F.filter("members", near)


def near_words(words: DataFrame) -> DataFrame:
    """``word``, ``n_near`` and ``best`` (negated count and word) of every word with a near word."""
    ranges = (
        rotations(words)
        .groupBy("prefix")
        .agg(F.collect_list(F.struct("edited", "n")).alias("members"))
        .filter(F.size("members") > 1)
    )

    def seen(member: Column) -> Column:
        others = F.transform(_neighbours(member), lambda o: F.struct((-o["n"]).alias("less"), _word(o).alias("word")))
        return F.struct(
            _word(member).alias("word"), F.size(others).cast("bigint").alias("here"), F.array_min(others).alias("best")
        )

    found = ranges.select(F.inline(F.transform("members", seen))).filter("here > 0")
    return found.groupBy("word").agg(F.sum("here").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, most: int) -> DataFrame:
    """``word`` and ``root``: where following ``form`` ends, for words that have one.

    Pointers double: each round a word takes the root of its root. Counts at least
    double along a chain, so with ``most`` the largest count a chain has at most
    log2(most) forms, and the rounds are the logarithm of that.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(math.ceil(math.log2(max(2.0, math.log2(max(most, 2)))))):
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = at.select("word", "root").join(onward, "root", "left")
        moved = stored(joined.select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        discard(at)
        at = moved
        if at.filter("next IS NOT NULL").isEmpty():
            break
    return at.select("word", "root")


def spelling_variants(words: DataFrame) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every word.

    ``words`` has each word once with its count ``n``. Words are near if one inserted,
    deleted or replaced character makes them equal. The form is the most frequent
    near word, the smallest of those in code-point order, if it is at least
    ``MORE_FREQUENT`` times as frequent, else null; the root is where forms lead, or
    the word itself. Words without a near word have n_near 0. An empty table gives none.
    """
    words = stored(words.select("word", "n"), "vocabulary")
    best_n = -F.col("best.less")
    is_form = best_n >= MORE_FREQUENT * F.col("n")
    judged = stored(
        words.join(near_words(words), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
            F.when(is_form, F.col("best.word")).alias("form"),
            F.when(is_form, best_n).alias("form_n"),
        ),
        "judged",
    )
    discard(words)
    forms = judged.filter("form IS NOT NULL")
    most = judged.agg(F.max("n")).first()[0] or 0
    return judged.join(roots(forms, most), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = word_counts(documents(spark, sf_dir), DAMAGED)
    return spelling_variants(counts.filter((F.char_length("word") >= LEAST_LENGTH) & (F.col("n") >= LEAST_COUNT)))
