"""The operators that run numpy in tasks, against brute force, round trips and held-out accuracy."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from funnelwright.llm import linededup, neardup, packing, pieces, quality, shingles, sketch, toxicity
from funnelwright.llm.components import components
from tests.llm.test_native import docs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = ["", None, "\n \t\n", "one", "a b c d", "same line of words here\nsame line of words here", "x " * 3000, "é中 " * 9]


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def noisy(rng, words, share):
    return [f"w{rng.randint(0, 9999)}" if rng.random() < share else w for w in words]


def corpus(seed=1):
    """Texts with families of near copies of every closeness, exact copies and long chains."""
    rng = random.Random(seed)
    texts = list(EDGE)
    for _ in range(25):
        base = [f"b{rng.randint(0, 99999)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 6)):
            texts.append(" ".join(noisy(rng, base, rng.choice([0, 0.01, 0.02, 0.04, 0.1]))))
    chain = [f"c{i}" for i in range(200)]
    for k in range(12):
        texts.append(" ".join(chain[8 * k : 8 * k + 100]))
    rng.shuffle(texts)
    return texts


def shingle_sets(texts):
    out = []
    for t in texts:
        words = WORD.findall(lowered(t))
        out.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    return out


def groups_by_force(sets, ids):
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(lambda: 10**9)
    for i in range(len(sets)):
        least[root(i)] = min(least[root(i)], ids[i])
    return [least[root(i)] for i in range(len(sets))]


def test_hashed_shingles_are_the_words_shingles():
    texts = corpus()
    column = pa.array(texts)
    hashed = []
    for lo, hi in shingles.chunks(column):
        hashed += shingles.shingle_sets(column[lo:hi])
    plain = shingle_sets(texts)
    assert [len(h) for h in hashed] == [len(p) for p in plain]
    for i in range(0, len(texts), 3):
        for j in range(0, i, 5):
            assert len(set(hashed[i].tolist()) & set(hashed[j].tolist())) == len(plain[i] & plain[j])


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(2)
    assert (sketch.sketch(rng.integers(0, 2**63, 1, dtype=np.uint64)) != sketch._UNSET).all()
    base = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    for shared in (250, 500, 900):
        a, b = base[:shared], base
        agree = [
            (sketch.sketch(shingles.mix(a + np.uint64(k))) == sketch.sketch(shingles.mix(b + np.uint64(k)))).mean()
            for k in range(20)
        ]
        assert abs(np.mean(agree) - shared / 1000) < 0.03


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates_as_by_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "PIVOTS", 3)
    texts = corpus()
    ids = [3 * i + 1 for i in range(len(texts))]
    random.Random(4).shuffle(ids)
    want = dict(zip(ids, groups_by_force(shingle_sets(texts), ids), strict=True))
    out = neardup.near_duplicates(docs_of(spark, texts, ids)).collect()
    assert {r.doc_id: r.component_id for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out) and len(out) == len(texts)


def test_near_duplicates_of_odd_tables(spark):
    assert neardup.near_duplicates(docs_of(spark, [])).count() == 0
    rows = neardup.near_duplicates(docs_of(spark, ["a b c d e f", "a b c d e f", "a b c d e f", None], [5, 5, None, 2]))
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in rows.collect()) == [
        (-1, 5, False),
        (2, 2, True),
        (5, 5, True),
        (5, 5, True),
    ]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    out = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.component for r in out} == {i: 0 for i in range(41)} | {x: 100 for x in range(100, 140)}


def lines_by_force(texts, ids):
    """The remaining text of each document."""
    seen, out = [], {}
    for i, text in sorted(zip(ids, texts, strict=True)):
        kept = []
        for line in (text or "").split("\n"):
            words = frozenset(WORD.findall(lowered(line)))
            if len(words) >= linededup.LEAST_WORDS:
                gone = any(100 * len(words & s) >= 80 * len(words | s) for s in seen)
                seen.append(words)
                if gone:
                    continue
            kept.append(line)
        out[i] = "\n".join(kept)
    return out


@pytest.mark.parametrize(("block", "first"), [(1024, 2), (4, 1)])
def test_lines_as_by_force(spark, monkeypatch, block, first):
    monkeypatch.setattr(linededup, "BLOCK", block)
    monkeypatch.setattr(linededup, "FIRST", first)
    monkeypatch.setattr(linededup, "LONG_LIST", 20 if block == 4 else 10**9)
    monkeypatch.setattr(linededup, "SPAN", 8)
    rng = random.Random(9)
    pool = [" ".join(f"p{rng.randint(0, 40)}" for _ in range(rng.randint(1, 25))) for _ in range(30)]
    texts = ["\n".join(" ".join(noisy(rng, rng.choice(pool).split(), rng.choice([0, 0.1]))) for _ in range(4)) for _ in range(60)]
    texts += EDGE
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    out = linededup.without_repeats(docs_of(spark, texts, ids)).collect()
    want = lines_by_force(texts, ids)
    assert {r.doc_id: r.text or "" for r in out} == want and len(out) == len(texts)
    assert [r.text for r in out if r.doc_id == ids[texts.index(None)]] == [None]


def test_lines_of_odd_tables(spark):
    assert linededup.without_repeats(docs_of(spark, [])).count() == 0
    line = "one two three four five six"
    out = linededup.without_repeats(docs_of(spark, [line, line, line], [1, 1, None])).collect()
    assert sorted((r.doc_id or 9, r.text) for r in out) == [(1, line), (1, line), (9, "")]


def test_short_lines_take_part(spark):
    texts = ["ok\na b c d\n\n中文没有空格的一行\n \nx y", "OK\na b c d e\n\n中文没有空格的一行\n \nx z\ny x x", "a b c e f\nok ok\nd c b a"]
    out = linededup.without_repeats(docs_of(spark, texts)).orderBy("doc_id").collect()
    # (4, 5) words at exactly 0.80 match; lines without a word stay
    assert [r.text for r in out] == [texts[0], "\n \nx z", "a b c e f"]
    assert [r.n_removed for r in out] == [0, 4, 2]


def test_long_lines_that_share_words_make_few_pairs(spark, monkeypatch):
    """Lines of 120 out of 400 words: any two share some, and few pairs are compared in full."""
    compared, matching = [], linededup._matching

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return matching(pairs, sets, percent)

    monkeypatch.setattr(linededup, "_matching", counted)
    rng = random.Random(11)
    lines = [rng.sample([f"v{i}" for i in range(400)], 120) for _ in range(600)]
    lines += [[*line[:108], *(f"n{i}" for i in range(12))] for line in lines[:20]]  # 108 of 132: they match
    lines += [[*line[:106], *(f"n{i}" for i in range(14))] for line in lines[20:40]]  # 106 of 134 do not
    out = linededup.without_repeats(docs_of(spark, [" ".join(line) for line in lines])).collect()
    assert {r.doc_id for r in out if r.n_removed} == set(range(600, 620))
    assert 20 <= sum(compared) <= 200


@pytest.mark.parametrize("size", [4, 7, 23, 61, 150, 400])
def test_sets_at_the_bound_share_a_part(size):
    """Both sets of a matching pair post a part of the same signature, whatever differs."""
    rng = np.random.default_rng(size)
    for _ in range(60):
        other = rng.integers(-(-size * 80 // 100), size * 125 // 100 + 1)
        common = -(-80 * (size + other) // 180)
        if common > min(size, other):
            continue
        words = rng.integers(0, 2**64, size + other - common, dtype=np.uint64)
        weight = rng.integers(1, 300, len(words)).astype(np.int16)
        sides = np.arange(size), np.r_[np.arange(common), np.arange(size, len(words))]
        met = []
        for side in sides:
            n = np.array([len(side)])
            lowest, highest, most = linededup._bands(n, 80)
            found = set()
            for band in range(int(lowest[0]), int(highest[0]) + 1):
                differ = np.minimum(linededup.DIFFER[[band]], most)
                found |= set(linededup._strongest_parts(n, words[side], weight[side], np.array([band]), differ)[1].tolist())
            met.append(found)
        assert size == other == common or met[0] & met[1]


def counts_by_force(text):
    words = WORD.findall(text or "")
    seen = defaultdict(list)
    for i in range(len(words) - 4):
        seen[tuple(words[i : i + 5])].append(i)
    covered = {i + k for v in seen.values() if len(v) > 1 for i in v for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_counts_and_outliers(spark):
    rng = random.Random(8)
    good = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(30, 300))) for _ in range(400)]
    junk = [" ".join(f"w{rng.randint(0, 9999)}###" for _ in range(200)) for _ in range(8)]
    texts = EDGE + ["a b c d e f g h i j " * 4] + good + junk
    rows = quality.verdicts(docs_of(spark, texts)).collect()
    assert len(rows) == len(texts)
    by_id = {r.doc_id: r for r in rows}
    for i, text in enumerate(texts):
        r = by_id[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts_by_force(text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
    first = len(EDGE) + 1
    assert all(by_id[i].kept for i in range(first, first + len(good)))
    assert not any(by_id[i].kept for i in range(first + len(good), len(texts)))
    assert quality.verdicts(docs_of(spark, [])).count() == 0


def test_each_statistic_rejects_by_itself(spark):
    """Texts that pass the base rules and are far off in one statistic, among clean ones of a large and of a small source."""
    rng = random.Random(11)
    word = lambda lo=2, hi=8: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(lo, hi)))
    clean = lambda n: [word() for _ in range(n)]
    passage = clean(36)
    lines = "\n".join("Click here" if k % 2 else " ".join(clean(9)) for k in range(40))
    outliers = [
        " ".join(word(25, 30) for _ in range(200)),
        " ".join(w + "###" for w in clean(200)),
        " ".join(clean(100) + passage + clean(200) + passage + clean(20)),
        lines,
        " ".join(w.upper() for w in clean(200)),
    ]
    sources = ["big"] * 400 + ["few"] * 12
    rows = [(i, " ".join(clean(rng.randint(80, 400))), "en", s) for i, s in enumerate(sources)]
    rows += [(1000 + i, t, "en", s) for s in ("big", "few") for i, t in enumerate(outliers, 100 if s == "few" else 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.verdicts(docs.selectExpr("*", "1 AS n", "2 AS g", "3 AS `a.b`")).collect()}
    assert not any(got[i].base_failed for i in got)
    assert all(got[i].kept for i in range(len(sources)))
    assert [i for i in got if i >= 1000 and got[i].kept] == []


def test_verdicts_move_smoothly_with_the_size_of_a_group(spark):
    """No jump where a source grows: the distance of one text changes little from 190 to 210 rows."""
    rng = random.Random(12)
    text = lambda hi: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, hi))) for _ in range(120))
    probe, big, small = text(12), [text(8) for _ in range(500)], [text(10) for _ in range(230)]
    found = []
    for n in (190, 200, 210):
        rows = [(i, t, "en", "big") for i, t in enumerate(big)] + [(1000 + i, t, "en", "small") for i, t in enumerate(small[:n])]
        docs = spark.createDataFrame([(-1, probe, "en", "small"), *rows], "doc_id bigint, text string, lang string, source string")
        found.append(quality.verdicts(docs).filter("doc_id = -1").first().distance)
    assert max(found) - min(found) < 0.15 * max(found)


def test_estimates_equal_a_search_from_many_starts(spark):
    """Centre and scatter of each group against the best of many random starts, in numpy."""
    rng = np.random.default_rng(8)
    groups = {}
    for g in ("a", "b", "c"):
        mix_ = rng.normal(0, 0.4, (5, 5))
        groups[g] = np.concatenate([rng.normal(0, 1, (400, 5)) @ mix_ + rng.normal(0, 1, 5), rng.normal(9, 0.3, (80, 5))])
    rows = [(g, [float(x) for x in v]) for g, data in groups.items() for v in data]
    found = quality.estimates(spark.createDataFrame(rows, "g string, x array<double>")).collect()
    for row in found:
        data, best = groups[row.g], None
        h = int(quality.SHARE * len(data))
        for _ in range(60):
            near = rng.choice(len(data), 8, replace=False)
            for _ in range(15):
                centre, scatter = data[near].mean(0), np.cov(data[near].T) + 1e-6 * np.eye(5)
                d2 = ((data - centre) @ np.linalg.inv(scatter) * (data - centre)).sum(1)
                near = np.argsort(d2)[:h]
            det = np.linalg.det(np.cov(data[near].T))
            if best is None or det < best[0]:
                best = (det, near)
        centre, scatter = data[best[1]].mean(0), np.cov(data[best[1]].T) / quality._kept_scatter(quality.SHARE)
        want = ((data - centre) @ np.linalg.inv(scatter) * (data - centre)).sum(1) > quality.chi_square_limit(1e-6)
        off = data - np.array(row.mean)
        got = (off @ np.reshape(row.inverse, (5, 5)) * off).sum(1) > quality.chi_square_limit(1e-6)
        assert (got == want).mean() > 0.99 and got[400:].all() and got[:400].mean() < 0.01


def test_concentration_resists_a_third_of_outliers(spark):
    rng = np.random.default_rng(3)
    clean = rng.normal(0, 0.5, (700, 5))
    far = rng.normal(4, 0.1, (300, 5))
    rows = [("g", [float(x) for x in v]) for v in np.concatenate([clean, far])]
    found = quality.estimates(spark.createDataFrame(rows, "g string, x array<double>")).first()
    assert np.abs(np.array(found.mean)).max() < 0.15


def test_marginals_sum_over_all_label_paths():
    rng = np.random.default_rng(5)
    step = np.exp(rng.normal(0, 1, (2, 2)))
    lengths = [3, 1, 0, 6]
    odds = np.exp(rng.normal(0, 1, sum(lengths)))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    saved, toxicity.LANE = toxicity.LANE, 2
    try:
        p = toxicity.marginals(odds, step, toxicity.Lanes(bounds))[4]
    finally:
        toxicity.LANE = saved
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        n, total, on = hi - lo, 0.0, np.zeros(hi - lo)
        for path in range(2**n):
            labels = [path >> k & 1 for k in range(n)]
            for before in (0, 1):
                weight, last = 0.5, before
                for k, y in enumerate(labels):
                    weight *= step[last, y] * (odds[lo + k] if y else 1.0)
                    last = y
                total += weight
                on += weight * np.array(labels)
        assert np.allclose(p[lo:hi], on / total if n else [])


def test_toxicity_finds_spans_held_out(spark):
    rng = random.Random(6)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(300)]
    texts, toxic = [], []
    for _ in range(300):
        words = [rng.choice(plain) for _ in range(40)]
        bad = rng.random() < 0.3
        for at in rng.sample(range(40), 3 if bad else 0):
            words[at] = rng.choice(["zounds", "zounding!", "fie"])
        texts.append(" ".join(words))
        toxic.append(int(bad))
    model = toxicity.fit(texts[:200], toxic[:200])
    docs = docs_of(spark, texts[200:] + ["", None])
    out = sorted(toxicity.tag(docs, model).collect(), key=lambda r: r.doc_id)
    assert [int(r.score >= 0.3) for r in out[:100]] == toxic[200:]
    assert all(0 <= r.score < 0.3 and r.spans == [] for r in out[100:])
    for r in out[:100]:
        words = re.findall(r"\w+", " ".join(r.text[s.start : s.end] for s in r.spans))
        assert set(words) <= {"zounds", "zounding", "fie"}
    flat = toxicity.fit(["a", "b"], [0, 0])
    assert toxicity.tag(docs_of(spark, ["x", None]), flat).count() == 2
    assert toxicity.fit([], []).curve[0] == 0.0


def test_training_takes_one_text_of_an_id(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "held_out", lambda doc_id: toxicity.F.lit(False))
    texts = [f"text {i}" for i in range(50)] + ["other"]
    ids = [7] * 50 + [8]
    marks = spark.createDataFrame([(7, 1), (8, 0), (None, 1), (9, None)], "doc_id bigint, toxic int")
    ahead = toxicity.labelled_sample(docs_of(spark, texts, ids), marks).collect()
    back = toxicity.labelled_sample(docs_of(spark, texts[::-1], ids[::-1]).repartition(3), marks).collect()
    assert ahead == back and sorted((r.doc_id, r.toxic) for r in ahead) == [(7, 1), (8, 0)]
    assert {r.text for r in ahead} & {"other"}
    none = toxicity.train(docs_of(spark, texts, ids), marks.limit(0))
    assert len(none.keys) == 0


def test_training_is_bounded_in_bytes():
    texts = ["aa", None, "ü" * 4, "b" * 50, "", "c" * 3]
    batch = pa.record_batch([pa.array([5, 4, 3, 2, 1, 0]), pa.array([1, 0, 1, 1, 0, 0]), pa.array(texts)], ["d", "t", "x"])
    assert toxicity.within(iter([batch, batch.slice(0, 0)]), 13) == (["ccc", "", "ü" * 4, "", "aa"], [0, 0, 1, 0, 1])


def test_columns_with_any_name_pass_through(spark):
    docs = docs_of(spark, ["a b", None]).selectExpr("*", "1 AS `a.b`")
    tagged = toxicity.tag(docs, toxicity.fit([], []))
    assert set(docs.columns) - {"score"} <= set(tagged.columns) and tagged.count() == 2
    assert "a.b" in pieces.encode(docs).columns and pieces.encode(docs).count() == 2


def test_lines_of_words_with_one_token_stay_apart(spark):
    """Pairs of words whose hashes agree in the bits that make a token, and words that share all else."""
    rng, seen, pairs = np.random.default_rng(5), {}, []
    bits = linededup.TOKEN_BITS
    for _ in range(40):
        made = [f"u{n:08d}" for n in rng.integers(0, 10**8, 50_000)]
        hashes = shingles.words(pa.array([" ".join(made)]))[0] >> np.uint64(64 - bits)
        for word, token in zip(made, hashes.tolist(), strict=True):
            other = seen.setdefault(token, word)
            if other != word:
                pairs.append((other, word))
        if pairs and len(seen) > 1_000_000:
            break
    pairs = pairs or [("u00185208", "u04511032")]
    for a, b in pairs[:3]:
        h = shingles.words(pa.array([f"{a} {b}"]))[0]
        assert h[0] >> np.uint64(64 - bits) == h[1] >> np.uint64(64 - bits) and h[0] != h[1]
        texts = [f"{a}\nother words here now", f"{b}\nfive more words stand alone", f"{a} {b} {a} x y z", f"{b} {a} x y z"]
        docs = docs_of(spark, texts).selectExpr("*", "7 AS _doc", "8 AS _twin", "9 AS _gone", "1 AS n_removed")
        out = linededup.without_repeats(docs).orderBy("doc_id").collect()
        assert [r.n_removed for r in out] == [0, 0, 0, 1]
        assert {(r["_doc"], r["_twin"], r["_gone"]) for r in out} == {(7, 8, 9)}


def test_words_are_remembered_in_halves(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 64)
    fresh, coder = packing.WordIds(packing.default_tokenizer()), packing.WordIds(packing.default_tokenizer())
    rng = random.Random(2)
    for _ in range(60):
        text = " ".join(f"w{rng.randint(0, 400)}" for _ in range(40)) + " the and of"
        want = np.array(fresh.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert coder.encode(text) == want
        assert len(coder.ids) + len(coder.older) <= 3 * 64


def test_words_of_many_texts_are_looked_up_once(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 50)
    coder, looked_up = packing.WordIds(packing.default_tokenizer()), []
    of_words = coder._of_words
    coder._of_words = lambda words: looked_up.append(words) or of_words(words)
    texts = [None, "", " \t lead and, trail\n", "Don't 12 \u00c0\u00c9 a\xa0b \x1cc", "lead " * 50, "\u6f22\u5b57 a<|b lead"]
    texts += [" ".join(f"w{k}" for k in range(100))]
    for _ in range(3):
        for lo in (0, 3):
            ids, bounds = coder.encode_all(pa.array(texts, pa.string())[lo:])
            for k, text in enumerate(texts[lo:]):
                want = coder.tokenizer.encode(text or "", add_special_tokens=False).ids
                assert ids[bounds[k] : bounds[k + 1]].tolist() == want
    assert all(len(set(words)) == len(words) for words in looked_up)
    assert sum("lead" in words for words in looked_up) == 1


def test_encoding_is_the_best_segmentation_and_decodes():
    import sentencepiece

    coder = pieces.Pieces(pieces.default_model())
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    scores = {model.id_to_piece(i): model.get_score(i) for i in range(3 + 256, model.get_piece_size())}
    rng = random.Random(1)
    texts = ["".join(rng.choice("aeé  tn\n.,中<0xthe and") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    for text in texts + ["", "  ", "\n\n", "x" * 5000]:
        ids = np.frombuffer(coder.encode(text), dtype="<i4").tolist()
        assert coder.decode(ids) == text
        marked = pieces.SPACE + text.replace(" ", pieces.SPACE) if text else ""
        best = [0.0] + [float("-inf")] * len(marked)
        for end in range(1, len(marked) + 1):
            for start in range(max(0, end - 20), end):
                part = marked[start:end]
                score = scores.get(part, coder.unknown_score if len(part) == 1 else None)
                if score is not None:
                    best[end] = max(best[end], best[start] + score)
        got, run = 0.0, b""
        for i in ids:
            if model.is_byte(i):
                run += coder.bytes[i]
                try:
                    got += coder.unknown_score * len(run.decode())
                    run = b""
                except UnicodeDecodeError:
                    pass
            else:
                got += model.get_score(i)
        if len(marked) < 200:
            assert got == best[-1]


def test_encoding_tables(spark):
    out = pieces.decode(pieces.encode(docs_of(spark, EDGE))).orderBy("doc_id").collect()
    assert [r.decoded for r in out] == [t or "" for t in EDGE]
    assert pieces.encode(docs_of(spark, [])).count() == 0


def test_word_ids_are_the_tokenizers():
    words = packing.WordIds(packing.default_tokenizer())
    rng = random.Random(1)
    alphabet = "aBcé's .,\t\n12½²ªºßİıĳŉ'tT'LL_-—ΣσςA<|endoftext|>́\x85\xa0\x1c 中"
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        ids = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids == np.frombuffer(words.encode(text), dtype="<u4").tolist()


def test_packing_is_gapless_and_close_to_the_bound(spark):
    rng = random.Random(7)
    texts = EDGE + [" ".join(rng.choice(["la", "ti", "do", "re!"]) for _ in range(rng.randint(1, 2500))) for _ in range(150)]
    rows = packing.pack(packing.pieces(docs_of(spark, texts))).collect()
    words = packing.WordIds(packing.default_tokenizer())
    used = defaultdict(list)
    per_doc = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
        per_doc[r.doc_id].append(r)
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    for i, text in enumerate(texts):
        data = words.encode(text or "") + b"\0\0\0\0"
        own = sorted(per_doc[i], key=lambda r: r.piece)
        assert [r.start for r in own] == [2048 * k for k in range(len(own))]
        assert sum(r.length for r in own) == len(data) // 4
        assert all(r.ids_crc32 == zlib.crc32(data[4 * r.start : 4 * (r.start + r.length)]) for r in own)
    total = sum(r.length for r in rows)
    assert len(used) <= -(-total // 2048) + 2
    assert packing.pack(packing.pieces(docs_of(spark, []))).count() == 0
    again = packing.pack(packing.pieces(docs_of(spark, ["a b", "a b", None], [4, 4, None]))).collect()
    assert len(again) == 3 and len({(r.sequence_id, r.offset) for r in again}) == 3


def test_histogram_packing_uses_every_piece():
    rng = np.random.default_rng(0)
    for capacity, lengths in ((10, [3, 4, 5, 10]), (2048, list(range(1, 2049, 37))), (7, [7])):
        counts = rng.integers(1, 500, len(lengths))
        kinds = packing.pack_histogram(np.array(lengths), counts, capacity)
        got = Counter()
        for content, n in kinds:
            assert sum(k * c for k, c in content.items()) <= capacity
            for k, c in content.items():
                got[k] += n * c
        assert got == Counter(dict(zip(lengths, counts.tolist(), strict=True)))


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(2)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    rows, labels = [], []
    for i in range(120):
        words = [rng.choice(plain) for _ in range(30)]
        bad = i % 4 == 0
        if bad:
            words[3] = words[9] = words[20] = "zounds"
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    rows.append((200, rows[1][1], "en", "s", 0))  # a copy
    rows.append((201, rows[2][1] + " 4111111111111111", "en", "s", 0))  # a near copy
    rows += [(202, None, None, None, None), (203, "", "en", "s", 0)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = corpus_pipeline.documents(spark, str(tmp_path)), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert name == "packing" or docs.columns == columns
    clean = {i for i in range(120) if i % 4}
    assert kept["toxicity"] == clean | {200, 201, 202, 203}
    assert kept["line_dedup"] == clean | {202, 203}
    assert kept["near_dedup"] == kept["pseudonyms"] == kept["packing"] == clean | {202, 203}
