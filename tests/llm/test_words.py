"""Spelling variants, source mixing and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from funnelwright.llm import mixing, periods, variants
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = ["", None, "\n \t\n", "one", "a b c d", "x " * 3000, "ab ba " * 700, "é中 " * 9]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def written(spark, tmp_path, rows):
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# -- spelling variants


def runs_by_force(rows, damage):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{word}".encode())
            if damage and doc is not None and h % damage == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    n.pop("", None)
    return n


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_force(n):
    form, seen = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        seen[w] = len(others)
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], seen[w], n[form[w]] if form[w] is not None else None))
    return out


def misspelt(seed):
    rng = random.Random(seed)
    letters = "abcÀéÿ÷"
    bases = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(12)] + ["aaaaa", "aaaaaa", "ababa"]
    texts = list(EDGE) + ["AAAAA aaaaa AaAaAaA", "日本語 naïve-Été"]
    for _ in range(150):
        words = []
        for _ in range(rng.randint(1, 60)):
            w = rng.choice(bases)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                i = rng.randrange(len(w) + 1)
                w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :]])
            words.append(rng.choice([w, w.upper(), w.title()]) if w.isascii() else w)
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("damage", [None, 5])
def test_variants_equal_brute_force(spark, damage):
    rows = [(i if i != 20 else None, t) for i, t in enumerate(misspelt(3))] + [(0, "again again")] * 3
    counts = variants.word_counts(frame(spark, [(i, t, "en", "s", 0) for i, t in rows]), damage)
    assert {(r.word, r.n) for r in counts.collect()} == set(runs_by_force(rows, damage).items())
    kept = counts.filter((F.char_length("word") >= 5) & (F.col("n") >= 2))
    want = variants_by_force({w: n for w, n in runs_by_force(rows, damage).items() if len(w) >= 5 and n >= 2})
    got = [tuple(r) for r in variants.spelling_variants(kept).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(want) and set(got) == want


def test_variant_chains_end_at_their_roots(spark):
    letters = "abcdefghijklmnopq"
    words = [(letters[:k] + "z" * (16 - k), 3 * 2**k) for k in range(17)]
    words += [("y" + "z" * 15, 1), ("other", 1)]
    df = spark.createDataFrame(words, "word string, n bigint")
    got = {tuple(r) for r in variants.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == variants_by_force(dict(words))
    assert {r[2] for r in got} == {letters[:16], "other"}


def test_variants_leave_one_row_a_word_and_range(spark):
    df = spark.createDataFrame([(f"{c}ords", 5) for c in "bcdefghijklmnop"], "word string, n bigint")
    got = {r.word: (r.n_near, tuple(r.best)) for r in variants.near_words(df).collect()}
    assert got["bords"] == (14, (-5, "cords"))
    assert got["cords"] == (14, (-5, "bords"))
    assert variants.spelling_variants(df.limit(0)).count() == 0


def test_variants_query(spark, tmp_path):
    rows = [(i, t, None, None, None) for i, t in enumerate(misspelt(5))]
    want = {w: n for w, n in runs_by_force([r[:2] for r in rows], 97).items() if len(w) >= 5 and n >= 3}
    got = variants.op11_variants(spark, written(spark, tmp_path, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == variants_by_force(want)


# -- mixing


def targets_by_force(sizes, most=3):
    """Exact shares: fill by weight, stop the sources that are full, share what they leave."""
    total, left, target = sum(s for _, s in sizes.values()), dict(sizes), {}
    while left:
        unit = Fraction(total - sum(target.values()), sum(w for w, _ in left.values()))
        full = [k for k, (w, s) in left.items() if most * s < unit * w]
        for k in full:
            target[k] = Fraction(most * left.pop(k)[1])
        if not full:
            return {k: float(v) for k, v in target.items()} | {k: float(unit * w) for k, (w, _) in left.items()}
    return {k: float(v) for k, v in target.items()}


def mixed_rows(seed, n=900):
    rng = random.Random(seed)
    sources = ["hot"] * 6 + ["b", "a", "é", "Z", "", None, "tiny"]
    rows = [(i, t, "en", "edge", 0) for i, t in enumerate(EDGE)]
    for i in range(n):
        source = rng.choice(sources)
        words = rng.randint(0, 3) if source == "tiny" else rng.choice([0, 1, 5, 40, 200])
        rows.append((rng.choice([None, 7, 100 + i]), "w " * words, None, source, 0))
    return rows + [(5000, "same row here", "en", "hot", 0)] * 800


def check_mix(rows, got, slack=0.5):
    size = lambda t: len(WORD.findall(t or ""))
    total, longest = Counter(), Counter()
    for _, t, _, s, _ in rows:
        total[s] += size(t)
        longest[s] = max(longest[s], size(t))
    ordered = sorted([s for s in total if s is not None]) + ([None] if None in total else [])
    want = targets_by_force({s: (1 + k % 3, total[s]) for k, s in enumerate(ordered)})
    assert Counter((r.doc_id, r.size, r.source) for r in got) == Counter((d, size(t), s) for d, t, _, s, _ in rows)
    taken = Counter()
    for r in got:
        assert r.source_size == total[r.source]
        assert r.target == pytest.approx(want[r.source], rel=1e-12)
        ratio = r.target / r.source_size if r.source_size else 0
        assert int(ratio + 1e-9) <= r.copies <= min(3, int(ratio - 1e-9) + 1)
        assert r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in total:
        assert abs(taken[s] - want[s]) <= slack * longest[s] + 1e-6


def test_mix_keeps_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 32)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    monkeypatch.setattr(mixing, "AT_ONCE", 7)
    rows = mixed_rows(2)
    got = mixing.mix(frame(spark, rows)).collect()
    check_mix(rows, got)
    random.Random(1).shuffle(rows)
    again = mixing.mix(frame(spark, rows).repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    rows = mixed_rows(4, 200)
    check_mix(rows, mixing.mix(frame(spark, rows)).collect())


def test_mix_edges(spark, tmp_path):
    assert mixing.mix(frame(spark, [])).count() == 0
    empty = mixing.mix(frame(spark, [(1, None, None, None, None), (2, "", "en", "a", 0)])).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in empty] == [(0, 0, 0.0, 0)] * 2
    clash = frame(spark, mixed_rows(3, 50)).withColumns({c: F.lit(1) for c in ("size", "rows", "rank", "target", "node", "a.b")})
    check_mix(mixed_rows(3, 50), mixing.mix(clash).collect())
    rows = mixed_rows(6, 300)
    got = mixing.op12_mixing(spark, written(spark, tmp_path, rows))
    assert got.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    check_mix(rows, got.collect())


def test_pivot_keeps_sums_and_expectations():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 400, 60).astype(float)
    fraction = rng.uniform(0, 1, 60)
    mean = np.zeros(60)
    for k in range(3000):
        out, open_ = mixing.pivot(fraction, size, np.random.default_rng(k).random(60))
        assert out @ size == pytest.approx(fraction @ size)
        assert all(x in (0.0, 1.0) for i, x in enumerate(out) if i != open_)
        mean += out / 3000
    assert np.abs(mean - fraction).max() < 0.05


# -- periodic runs


def runs_of_words(words):
    n, out = len(words), {}
    for p in range(1, n // 4 + 1):
        start = None
        for i in range(n - p + 1):
            if i < n - p and words[i] == words[i + p]:
                start = i if start is None else start
            elif start is not None:
                if i + p - start >= max(6, 4 * p):
                    out.setdefault((start, i + p), p)
                start = None
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode())
    n, g = len(words), h // 10
    if doc is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def repetitive(seed, n=300):
    rng = random.Random(seed)
    texts = list(EDGE)
    for _ in range(n):
        words = []
        for _ in range(rng.randint(1, 6)):
            kind = rng.random()
            if kind < 0.5:
                period = [f"w{rng.randint(0, rng.choice([2, 9, 500]))}" for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 70]))]
                length = int(len(period) * rng.uniform(2, 7))
                words += [period[i % len(period)] for i in range(length)]
            else:
                words += [f"v{rng.randint(0, rng.choice([1, 3, 900]))}" for _ in range(rng.randint(1, 80))]
        texts.append(rng.choice([" ", "\n", " \t"]).join(words))
    return texts


def test_runs_equal_brute_force(spark):
    texts = repetitive(1)
    rows = [(i if i % 9 else None, t, None, None, None) for i, t in enumerate(texts)]
    df = frame(spark, rows * 2).withColumns({"runs": F.lit(1), "collapsed": F.lit("x"), "a.b": F.lit(0)})
    got = Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in periods.periodic_runs(df).collect())
    want = Counter()
    for i, t, *_ in rows * 2:
        words = WORD.findall(t or "")
        runs = runs_of_words(words)
        want[i, len(words), tuple(runs), collapsed(words, runs)] += 1
    assert got == want
    assert periods.periodic_runs(df.limit(0)).count() == 0


def test_runs_of_few_letters():
    """Words over two or three letters hold nested and overlapping runs of many periods."""
    for seed in range(60):
        rng = random.Random(seed)
        texts = []
        for _ in range(5):
            words = [bytes([97 + rng.randrange(rng.choice([2, 3]))]) for _ in range(rng.randint(0, 90))]
            words = words * rng.choice([1, 1, 4, 5]) + words[: rng.randint(0, 20)]
            texts.append([b"a"] * rng.randint(0, 30) + words)
        assert periods._texts_runs(texts) == [runs_of_words(t) for t in texts]


def test_long_periods():
    rng = random.Random(4)
    for period in (255, 256, 257, 1000, 2048, 2049):
        base = [b"%d" % rng.randrange(10**6) for _ in range(period)]
        text = [b"x"] * 37 + base * 4 + base[: period // 3] + [b"y"] * 11
        found = periods._texts_runs([[b"z"], text, base * 3])
        assert found[0] == [] and found[2] == []
        assert (37, 4 * period + period // 3, period) in found[1]


def test_periods_query(spark, tmp_path):
    rows = [(i, t, None, None, None) for i, t in enumerate(repetitive(7, 200))] + [(None, "a b " * 9, "", "", 0)]
    got = periods.op13_periods(spark, written(spark, tmp_path, rows))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = defaultdict(list)
    for i, t, *_ in rows:
        words = planted(i, t)
        runs = runs_of_words(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        milli = 1000 * best[1] // best[2] if runs else None
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed(words, runs))]
        want[i] = (len(runs), *best, milli, *digests)
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == dict(want)
    assert sum(planted(i, t) != WORD.findall(t or "") for i, t, *_ in rows) > 5
