"""Removal of lines that repeat earlier lines, exactly or nearly: an exact set-similarity join.

A line is the set of its words. Two sets match if their Jaccard likeness is at
least PERCENT / 100, so of their words at most D differ, by the sum of their sizes.
Words are dealt by their hash over more than D + 1 parts; in matching sets the others
agree whole, and one of those is among the D + 1 rarest parts of both. A line posts
these, so lines meet that share a few words at once, not one. Pairs that share a part
pass length and parity filters, none of which loses a match, and are then
verified on full sets. A line goes if any earlier line of the corpus matches it.

Equal sets are one class throughout. A part's list is compared in blocks of
bounded size; first each class is tried with a few others, and only classes for
which that found no earlier match go on to all their candidates, so a crowd of
near copies costs little more than its size.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import discard, documents, quoted, stored, workers_import
from funnelwright.llm.shingles import _bytes, chunks, mix, words

PERCENT = 80
#: Lines with fewer distinct words are left alone: only those without any.
LEAST_WORDS = 1
#: Word counts are kept for so many hash slots; a word is as rare as its slot.
SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
#: Bits of a word's hash by which the words of a line are sorted.
TOKEN_BITS = 44
#: A list of more classes than this is split into spans of so many.
LONG_LIST = 1 << 18
SPAN = 1 << 16
#: Slots whose counts travel in one row.
VECTOR = 1 << 14
#: Lines to take out are broadcast up to so many documents and lines.
BROADCAST_DOCS, BROADCAST_LINES = 300_000, 3_000_000
#: Postings of one part's list that are compared at once.
BLOCK = 1024
#: Candidates before it that a posting is tried with first.
FIRST = 1
#: Numbers of differing words by which pairs are banded; no line is longer than the last. A band has its own parts.
DIFFER = np.array([0, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, *(int(144 * 1.6**k) for k in range(36))], dtype=np.int64)
#: Parts of rarer words are stronger: a word weighs so many times the binary logarithm of how rare it is.
WEIGHT = 16
#: Bits of a signature and of a set's digest that a posting drops. Sets that agree in
#: the others meet too and are told apart by what is looked up for them.
SIGNATURE_DROPPED, KEY_DROPPED = 24, 24
#: Bits of a set's parity that a posting carries where up to FEW words may differ, and elsewhere; MANY or more are not told apart.
FEW, MANY = 14, 127
SHORT_BITS, LONG_BITS = 32, 56
#: Postings before it in its list that a posting is compared with by those; longer lists are kept.
NEAR = 32
#: Lines whose parts are found together.
LINES_AT_ONCE = 1 << 16
#: Digests of lines whose postings a task remembers, so that copies are posted once.
REMEMBERED = 500_000

_LATEST = 2**63 - 1
_LOW_BITS = np.uint64(TOKEN_BITS - SLOT_BITS)
_AT = np.uint64(TOKEN_BITS)


def _line_sets(texts: pa.Array):
    """Distinct words of each line that has any: text, line number, bounds, tokens (sorted in a line), hashes.

    A token is the upper bits of a word's 64-bit hash and only sorts the words of a
    line; words are told apart, counted and compared by the hash.
    """
    data, offsets = _bytes(texts)
    hashes, starts, _, bounds = words(texts)
    if not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(1, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    breaks = np.flatnonzero(data == 10)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    place = np.searchsorted(breaks, starts) + doc
    new = np.concatenate([[True], place[1:] != place[:-1]])
    first = np.flatnonzero(new)
    line = np.cumsum(new) - 1
    tokens = hashes >> np.uint64(64 - TOKEN_BITS)
    order = None
    if len(first) < 1 << (64 - TOKEN_BITS):
        key = (line.astype(np.uint64) << _AT) | tokens
        order = np.argsort(key)
        key, sorted_hashes = key[order], hashes[order]
        if ((key[1:] == key[:-1]) & (sorted_hashes[1:] != sorted_hashes[:-1])).any():
            order = None  # two words of one token in a line
    if order is None:
        order = np.lexsort((hashes, tokens, line))
    line, tokens, hashes = line[order], tokens[order], hashes[order]
    kept = np.concatenate([[True], (line[1:] != line[:-1]) | (hashes[1:] != hashes[:-1])])
    line, tokens, hashes = line[kept], tokens[kept], hashes[kept]
    base = np.searchsorted(breaks, offsets[:-1]) + np.arange(len(offsets) - 1)
    cuts = np.searchsorted(line, np.arange(len(first) + 1))
    return doc[first], place[first] - base[doc[first]], cuts, tokens, hashes


def _digest(bounds: np.ndarray, hashes: np.ndarray, salt: int = 0) -> np.ndarray:
    if len(bounds) < 2:
        return np.zeros(0, np.int64)
    return np.add.reduceat(mix(hashes ^ np.uint64(salt)), bounds[:-1]).view(np.int64)


def _parities(bounds: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """One bit of 128 for each word, flipped, in two columns."""
    if len(bounds) < 2:
        return [np.zeros(0, np.int64)] * 2
    mixed = mix(hashes)
    bit = np.uint64(1) << (mixed >> np.uint64(58))
    second = (mixed & np.uint64(1)).astype(bool)
    halves = np.where(second, np.uint64(0), bit), np.where(second, bit, np.uint64(0))
    return [np.bitwise_xor.reduceat(half, bounds[:-1]).view(np.int64) for half in halves]


_LINE_FIELDS = "kind int, doc bigint, twin bigint, line int, s1 bigint, s2 bigint, m int, parity bigint, parity2 bigint, counts binary"


def _line_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: a line with its set's digest, size and parity. Kind 1: a stretch of slots and their counts of words."""
    slots = np.zeros(SLOTS, dtype=np.int64)
    names = ["kind", "doc", "twin", "line", "s1", "s2", "m", "parity", "parity2", "counts"]
    for batch in batches:
        ids, twins = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for lo, hi in chunks(batch.column(2)):
            doc, number, bounds, tokens, hashes = _line_sets(batch.column(2)[lo:hi])
            slots += np.bincount((tokens >> _LOW_BITS).astype(np.int64), minlength=SLOTS)
            size = np.diff(bounds)
            kept = size >= LEAST_WORDS
            doc = doc[kept]
            columns = [
                pa.array(np.zeros(len(doc), np.int32)),
                pa.array(ids[lo:hi][doc]),
                pa.array(twins[lo:hi][doc]),
                pa.array(number[kept].astype(np.int32)),
                pa.array(_digest(bounds, hashes)[kept]),
                pa.array(_digest(bounds, hashes, 0xD6E8FEB86659FD93)[kept]),
                pa.array(size[kept].astype(np.int32)),
                *[pa.array(half[kept]) for half in _parities(bounds, hashes)],
                pa.nulls(len(doc), pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)
    if slots.any():
        n = SLOTS // VECTOR
        blank = pa.array(np.zeros(n, np.int64))
        small = pa.array(np.zeros(n, np.int32))
        # a task's counts are small numbers, mostly zero bytes
        vectors = pa.array([zlib.compress(slots[k * VECTOR : (k + 1) * VECTOR].tobytes(), 1) for k in range(n)], pa.binary())
        columns = [pa.array(np.ones(n, np.int32)), pa.array(np.arange(n)), blank, small, blank, blank, small, blank, blank, vectors]
        yield pa.RecordBatch.from_arrays(columns, names)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the vectors of each stretch that came to this task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[at] = total.get(at, 0) + np.frombuffer(zlib.decompress(vector), dtype=np.int64)
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
            ["doc", "counts"],
        )


def may_match_others(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether a set of so many words can match any but an equal set; the nearest is one with one word more."""
    return 100 * size >= percent * (size + 1)


def _bands(size: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last band of the sets that a set of so many words may match, and in how many words they differ at most.

    Matching sets of a and b words differ in at most (a + b) * (100 - percent) / (100 + percent) words.
    """
    share, whole = 100 - percent, 100 + percent
    fewest = (size - (-size * percent) // 100) * share // whole
    most = (size + size * 100 // percent) * share // whole
    # that differ in none are equal
    return np.maximum(np.searchsorted(DIFFER, fewest), 1), np.searchsorted(DIFFER, most), most


def _strongest_parts(
    size: np.ndarray, hashes: np.ndarray, weight: np.ndarray, band: np.ndarray, differ: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Line and signature of the D + 1 strongest parts of every line (D: ``differ``), and of any that are as strong.

    Strength is a function of a part's words alone. Of two sets of a band that differ
    in at most D parts the strongest part they agree in has at most D stronger
    ones in either set, so both post it.
    """
    parts = DIFFER[band] + 1 + (DIFFER[band] + 8) // 8
    first = np.cumsum(parts) - parts
    line = np.repeat(np.arange(len(size)), size)
    spread = mix(hashes ^ np.uint64(0x8CB92BA72F3D8DD7)) >> np.uint64(32)
    cell = first[line] + ((spread * parts[line].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    n = int(parts.sum())
    # sums of 32-bit halves are exact in floating point
    low = np.bincount(cell, (hashes & np.uint64(0xFFFFFFFF)).astype(np.float64), n).astype(np.uint64)
    high = np.bincount(cell, (hashes >> np.uint64(32)).astype(np.float64), n).astype(np.uint64)
    strength = np.minimum(np.bincount(cell, weight, n), (1 << 24) - 1).astype(np.uint64)
    owner = np.repeat(np.arange(len(size)), parts)
    place = np.arange(n) - first[owner]
    salt = (band[owner].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64)
    signature = mix(low + (high << np.uint64(32)) + mix(salt))
    weakness = np.uint64((1 << 40) - 1) - ((strength << np.uint64(16)) | (signature & np.uint64(0xFFFF)))
    key = (owner.astype(np.uint64) << np.uint64(40)) | weakness
    last = np.sort(key)[first + differ]
    chosen = key <= last[owner]
    return owner[chosen], signature[chosen].view(np.int64)


def _postings(weights: np.ndarray, percent: int):
    """Signatures of the strongest parts of every line that may match an unequal one, in each of its bands, and its set's key."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for lo, hi in chunks(batch.column(0)):
                _, _, bounds, tokens, hashes = _line_sets(batch.column(0)[lo:hi])
                if not len(tokens):
                    continue
                s1 = _digest(bounds, hashes)
                size = np.diff(bounds)
                wanted = may_match_others(size, percent)
                if len(seen) > REMEMBERED:
                    seen.clear()
                for i in np.flatnonzero(wanted).tolist():
                    key = int(s1[i])
                    wanted[i] = key not in seen
                    seen.add(key)
                parity = np.bitwise_xor(*_parities(bounds, hashes))
                weight = weights[(tokens >> _LOW_BITS).astype(np.int64)]
                for start in range(0, len(size), LINES_AT_ONCE):
                    here = np.zeros(len(size), dtype=bool)
                    here[start : start + LINES_AT_ONCE] = wanted[start : start + LINES_AT_ONCE]
                    lowest, highest, most = _bands(size, percent)
                    band = lowest
                    while (here := here & (band <= highest)).any():
                        words_here = np.repeat(here, size)
                        differ = np.minimum(DIFFER[band], most)[here]
                        line, signature = _strongest_parts(size[here], hashes[words_here], weight[words_here], band[here], differ)
                        near = parity[here] & np.where(differ <= FEW, (1 << SHORT_BITS) - 1, (1 << LONG_BITS) - 1)
                        near |= np.minimum(differ, MANY) << LONG_BITS
                        columns = signature >> SIGNATURE_DROPPED, s1[here][line] >> KEY_DROPPED, near[line]
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "key", "near"])
                        band = band + 1

    return post


def _may_meet(rows: dict[str, np.ndarray], group: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which rows may match one of their group, by the parities that postings carry; all of a large group.

    A word that two sets do not share flips one bit at most.
    """
    kept = size > NEAR + 1
    at = np.flatnonzero((size > 1) & ~kept)
    for back in range(1, NEAR + 1):
        at = at[at >= back]
        at = at[group[at] == group[at - back]]
        if not len(at):
            break
        a, b = rows["near"][at], rows["near"][at - back]
        differ = np.minimum(a, b) >> LONG_BITS
        mask = np.where(differ <= FEW, (1 << SHORT_BITS) - 1, (1 << LONG_BITS) - 1)
        hit = at[(np.bitwise_count((a ^ b) & mask) <= differ) | (differ == MANY)]
        kept[hit] = True
        kept[hit - back] = True
    return kept


def _met(long_list: int, span: int):
    """Postings of parts that several sets share that may match, once for each set; rows are sorted by (token, key).

    ``span`` is 0, or tells the part of a long list.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_lists(batches, ["token"]):
            token, key, near = rows["token"], rows["key"], rows["near"]
            new = np.concatenate([[True], token[1:] != token[:-1]])
            # sets of one key are mostly told apart by their parities
            once = new | np.concatenate([[True], (key[1:] != key[:-1]) | (near[1:] != near[:-1])])
            rows = {c: column[once] for c, column in rows.items()}
            starts = np.flatnonzero(new[once])
            n = np.diff(np.append(starts, once.sum()))
            of_list = np.repeat(n, n)
            group = np.repeat(np.arange(len(n)), n)
            kept = _may_meet(rows, group, of_list)
            place = np.arange(len(group)) - starts[group]
            part = np.where(of_list > long_list, 1 + place // span, 0)
            token, key = rows["token"], rows["key"]
            if kept.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[kept]), pa.array(part[kept]), pa.array(key[kept])], ["token", "span", "key"]
                )

    return keep


def candidates(left: dict, right: dict, percent: int) -> np.ndarray:
    """For pairs of postings of one part, row by row, whether their sets may match.

    Sizes are near enough, and the parities (a bit for each word, flipped) differ
    in no more bits than a match's sets differ in words.
    """
    a, b = left["size"], right["size"]
    ok = left["s1"] != right["s1"]
    ok &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    least = -(-percent * (a + b) // (100 + percent))
    apart = sum(np.bitwise_count((left[c] ^ right[c]).view(np.uint64)).astype(np.int64) for c in ("parity", "parity2"))
    return ok & (apart <= a + b - 2 * least)


_FOUND = "kind int, y bigint, x bigint, token bigint, parity bigint, parity2 bigint, size bigint"


def _found(kind: int, y: np.ndarray, x: np.ndarray, *posting: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(np.full(len(y), kind, np.int32)), pa.array(y), pa.array(x.astype(np.int64))]
    columns += [pa.array(c) for c in posting] or [pa.nulls(len(y), pa.int64())] * 4
    return pa.RecordBatch.from_arrays(columns, ["kind", "y", "x", "token", "parity", "parity2", "size"])


def _whole_lists(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Sorted rows in pieces that end where a key does."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, dtype=bool)
        for c in key:
            column = batch.column(c).to_numpy()
            same &= column == column[-1]
        tail = int(np.argmax(same))  # the last list may go on in the next batch
        if held and not tail and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in key):
            yield _plain(held)
            held = []
        if tail:
            yield _plain([*held, batch.slice(0, tail)])
            held = [batch.slice(tail)]
        else:
            held.append(batch)
    if held:
        yield _plain(held)


def _plain(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    table = pa.Table.from_batches(batches)
    return {c: table.column(c).to_numpy() for c in table.column_names}


def _first_pairs(percent: int, first: int):
    """Kind 0: pairs of sets, a posting with the nearest ``first`` candidates before it in its list.
    Kind 1: a posting of set y in a list where some had more of them, or may have; x is 1 for those.

    Rows are sorted by (token, span) and the place of each set's first line. All lists
    of a piece are compared at once, with the rows 1, 2, ... BLOCK before.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_lists(batches, ["token", "span"]):
            group = np.concatenate([[0], np.cumsum((np.diff(rows["token"]) != 0) | (np.diff(rows["span"]) != 0))])
            tried = np.zeros(len(group), dtype=np.int64)
            more = rows["span"] != 0  # other spans are untried
            at = np.arange(1, len(group))
            back = 1
            while True:
                at = at[at >= back]
                at = at[group[at] == group[at - back]]
                if not len(at):
                    break
                if back > BLOCK:
                    more[at] = True
                    break
                left = {c: rows[c][at] for c in ("s1", "parity", "parity2", "size")}
                right = {c: rows[c][at - back] for c in ("s1", "parity", "parity2", "size")}
                hit = at[candidates(left, right, percent)]
                full = tried[hit] >= first
                more[hit[full]] = True
                hit = hit[~full]
                tried[hit] += 1
                if len(hit):
                    yield _found(0, rows["s1"][hit], rows["s1"][hit - back])
                at = at[~more[at]]
                back += 1
            listed = np.isin(group, group[more])
            if listed.any():
                yield _found(1, rows["s1"][listed], more[listed], *[rows[c][listed] for c in ("token", "parity", "parity2", "size")])

    return join


def _all_pairs(percent: int):
    """All candidates of the postings of side 0 among those of side 1, by (token, i, j)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_lists(batches, ["token", "i", "j"]):
            keys = np.column_stack([rows[c] for c in ("token", "i", "j")])
            cuts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1), [True]]))
            out = []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = {c: rows[c][lo:hi] for c in ("s1", "parity", "parity2", "size", "side")}
                asks, answers = np.flatnonzero(part["side"] == 0), np.flatnonzero(part["side"] == 1)
                for y in asks.tolist():
                    left = {c: part[c][np.full(len(answers), y)] for c in ("s1", "parity", "parity2", "size")}
                    right = {c: part[c][answers] for c in ("s1", "parity", "parity2", "size")}
                    hit = answers[candidates(left, right, percent)]
                    if len(hit):
                        out.append((np.full(len(hit), part["s1"][y]), part["s1"][hit]))
            if out:
                y, x = (np.concatenate(c) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(y), pa.array(x)], ["y", "x"])

    return join


def _blocks(postings: DataFrame) -> DataFrame:
    """Number of blocks of each token whose list is longer than one."""
    counts = postings.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK)
    return stored(counts.select("token", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "blocks")


def _first(postings: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    met = postings.repartition("token").sortWithinPartitions("token", "key")
    met = met.mapInArrow(_met(LONG_LIST, SPAN), "token bigint, span bigint, key bigint")
    sets = classes.select(F.shiftright("s1", KEY_DROPPED).alias("key"), "s1", "doc", "twin", "line", "parity", "parity2", F.col("m").cast("bigint").alias("size"))
    spread = met.join(sets, "key").repartition("token", "span")
    spread = spread.sortWithinPartitions("token", "span", "doc", "twin", "line")
    return spread.select("token", "span", "s1", "parity", "parity2", "size").mapInArrow(_first_pairs(percent, FIRST), _FOUND)


def _rest(lists: DataFrame, open_: DataFrame, percent: int) -> DataFrame:
    """All candidate pairs (y, x) of the open sets y in these lists, in blocks of bounded size."""
    asks = lists.join(open_, "s1", "left_semi")
    blocks = _blocks(lists)
    few = F.broadcast(blocks) if blocks.count() <= 200_000 else blocks
    columns = ["token", "i", "j", "side", "s1", "parity", "parity2", "size"]
    block = F.pmod(F.xxhash64("s1"), F.col("blocks")).cast("int")

    def counted(rows: DataFrame) -> DataFrame:
        return rows.join(few, "token", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))

    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = counted(asks).withColumn("i", block).withColumn("j", every).withColumn("side", F.lit(0))
    right = counted(lists).withColumn("j", block).withColumn("i", every).withColumn("side", F.lit(1))
    both = left.select(*columns).unionByName(right.select(*columns))
    spread = both.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
    return spread.mapInArrow(_all_pairs(percent), "y bigint, x bigint")


def _word_sets(docs: DataFrame, involved: DataFrame) -> DataFrame:
    """s1 and the 64-bit word hashes of the first line of each class that takes part in a pair."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = batch.column(1).to_pylist()
            for lo, hi in chunks(batch.column(0)):
                doc, number, bounds, _, hashes = _line_sets(batch.column(0)[lo:hi])
                at = {(int(d), int(k)): i for i, (d, k) in enumerate(zip(doc, number, strict=True))}
                rows = []
                for d in range(lo, hi):
                    for need in wanted[d]:
                        i = at[d - lo, need["line"]]
                        rows.append((need["s1"], hashes[bounds[i] : bounds[i + 1]].view(np.int64)))
                if rows:
                    s1, sets = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s1, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["s1", "words"]
                    )

    needed = involved.groupBy("doc", "twin").agg(F.collect_list(F.struct("line", "s1")).alias("needed"))
    if involved.count() <= 500_000:
        needed = F.broadcast(needed)
    found = docs.join(needed, ["doc", "twin"]).select("text", "needed")
    return found.mapInArrow(cut, "s1 bigint, words array<bigint>").dropDuplicates(["s1"])


def _matching(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets match."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = a.values.to_numpy(), b.values.to_numpy()
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep))

    with_y = pairs.join(sets.select(F.col("s1").alias("y"), F.col("words").alias("left")), "y")
    both = with_y.join(sets.select(F.col("s1").alias("x"), F.col("words").alias("right")), "x")
    return both.select("y", "x", "left", "right").mapInArrow(verify, "y bigint, x bigint")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LATEST)).alias("doc"),
        F.xxhash64("text").alias("twin"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def repeated_lines(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc``, ``twin`` and ``gone``: the numbers (from 0) of the lines that go, where any do.

    Lines are ordered by document id (null last), a hash of the text, and number;
    rows equal in id and text count as one. Lines without a word stay.
    """
    spark = docs.sparkSession
    workers_import(spark)
    keyed = _keyed(docs)
    table = stored(keyed.mapInArrow(_line_table, _LINE_FIELDS), "lines")
    lines = table.filter("kind = 0").drop("kind", "counts")
    vectors = table.filter("kind = 1").select("doc", "counts").repartition("doc")
    count = np.zeros(SLOTS, dtype=np.int64)
    for row in vectors.mapInArrow(_added, "doc bigint, counts binary").collect():  # SLOTS numbers in all
        count[row["doc"] * VECTOR : (row["doc"] + 1) * VECTOR] = np.frombuffer(row["counts"], dtype=np.int64)
    rarity = np.log2((count.sum() + 1) / (count + 1))
    weights = 1 + np.round(WEIGHT * rarity).astype(np.int16)

    by_set = ["s1", "s2", "m"]
    classes = lines.groupBy(*by_set).agg(
        F.min(F.struct("doc", "twin", "line")).alias("first"),
        *[F.first(c).alias(c) for c in ("parity", "parity2")],
        F.count("*").alias("n"),
    )
    classes = stored(classes.select(*by_set, "parity", "parity2", "n", "first.doc", "first.twin", "first.line"), "classes")
    order = classes.select("s1", F.struct("doc", "twin", "line").alias("at"))

    def matching(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs whose sets match."""
        involved = pairs.select(F.explode(F.array("y", "x")).alias("s1")).distinct()
        where = classes.join(involved, "s1").select("s1", "doc", "twin", "line")
        return stored(_matching(pairs, _word_sets(keyed, where), percent), f"matches-{name}")

    def later(good: DataFrame) -> DataFrame:
        """Of each pair the set whose first line comes later."""
        placed = good.join(order.select(F.col("s1").alias("y"), F.col("at").alias("at_y")), "y").join(
            order.select(F.col("s1").alias("x"), F.col("at").alias("at_x")), "x"
        )
        return placed.select(F.when(F.col("at_x") < F.col("at_y"), F.col("y")).otherwise(F.col("x")).alias("s1")).distinct()

    def unordered(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.least("y", "x").alias("y"), F.greatest("y", "x").alias("x")).distinct()

    postings = keyed.select("text").mapInArrow(_postings(weights, percent), "token bigint, key bigint, near bigint")
    found = stored(_first(postings, classes, percent), "found")
    once = stored(found.filter("kind = 0").select("y", "x").distinct(), "pairs")
    late = stored(matching(once, "first").select(F.col("y").alias("s1")).distinct(), "late")  # y comes after x
    # Of a set that has been found late there is nothing more to learn.
    lists = found.filter("kind = 1").withColumnRenamed("y", "s1")
    tried = lists.filter("x = 1").select("s1", "token")
    open_ = stored(tried.join(late, "s1", "left_anti").distinct(), "open")
    if not open_.isEmpty():
        tokens = open_.select("token").distinct()
        if open_.count() <= 1_000_000:
            tokens = F.broadcast(tokens)
        lists = lists.select("token", "s1", "parity", "parity2", "size").join(tokens, "token", "left_semi")
        rest = unordered(_rest(lists, open_.select("s1").distinct(), percent))
        rest = stored(rest.join(unordered(once), ["y", "x"], "left_anti"), "rest")
        late = stored(late.unionByName(later(matching(rest, "rest"))).distinct(), "all-late")
        discard(rest)
    for step in (found, once, open_):
        discard(step)

    firsts = classes.join(late.withColumn("late", F.lit(True)), "s1", "left").filter("late OR n > 1").select(
        *by_set, F.struct("doc", "twin", "line").alias("first"), "late"
    )
    judged = lines.join(firsts, by_set)
    gone = judged.filter(
        F.col("late").isNotNull() | (F.col("first") != F.struct("doc", "twin", "line"))
    )
    return gone.groupBy("doc", "twin").agg(F.sort_array(F.collect_set("line")).alias("gone"))


def without_repeats(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Documents with such lines taken out of the text, and ``n_removed``.

    A null text stays null. A document may end up empty, but stays. A column
    named ``n_removed`` is replaced; all others stay, whatever their names.
    """
    kept_columns = [c for c in docs.columns if c != "n_removed"]
    key = {c: f"_{c}_{uuid.uuid4().hex}" for c in ("doc", "twin", "gone")}
    gone = stored(repeated_lines(docs, percent).withColumnsRenamed(key), "gone")
    keyed = docs.select(
        *map(quoted, kept_columns),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LATEST)).alias(key["doc"]),
        F.xxhash64("text").alias(key["twin"]),
    )
    numbers = F.col(key["gone"])
    size = gone.agg(F.count("*").alias("docs"), F.sum(F.size(numbers)).alias("lines")).first()
    if size.docs <= BROADCAST_DOCS and (size.lines or 0) <= BROADCAST_LINES:
        gone = F.broadcast(gone)
    joined = keyed.join(gone, [key["doc"], key["twin"]], "left")
    kept = F.filter(F.split("text", "\n", -1), lambda line, i: ~F.array_contains(numbers, i))
    text = F.when(numbers.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text")
    n_removed = F.greatest(F.coalesce(F.size(numbers), F.lit(0)), F.lit(0)).cast("long").alias("n_removed")
    return joined.select(*[text if c == "text" else F.col(quoted(c)) for c in kept_columns], n_removed)


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(documents(spark, sf_dir)).select("doc_id", "text", "n_removed")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the pipeline: documents without lines that came before.

    A document of which nothing but white space is left repeats others throughout
    and goes; documents that lost no line stay, empty ones too.
    """
    done = without_repeats(docs).filter((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(*map(quoted, docs.columns))
