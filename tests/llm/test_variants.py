"""Near vectors, spelling variants and phrases against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from leafmill.llm import phrases, spelling, vectors

# ---- vectors


def brute_vectors(rows, cosine=0.98):
    def usable(vec, label):
        return label is not None and vec is not None and len(vec) and all(x is not None and np.isfinite(x) for x in vec) and any(vec)

    n = len(rows)
    links, parent = [0] * n, list(range(n))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if usable(a, la) and usable(b, lb) and la == lb and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                a, b = a / abs(a).max(), b / abs(b).max()
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (id_, *_) in enumerate(rows):
        if id_ is not None:
            least[find(i)].append(id_)
    out = []
    for i, (id_, *_) in enumerate(rows):
        component = min(least[find(i)], default=None)
        out.append((id_, links[i], component, id_ is not None and id_ == component))
    return sorted(out, key=repr)


def vector_rows():
    rng = np.random.default_rng(5)
    rows = []

    def add(vec, label):
        rows.append((len(rows), None if vec is None else [None if x is None else float(x) for x in vec], label))

    for label in (1, 2):
        for _ in range(60):
            add(rng.standard_normal(64), label)
        for spread in (0.005, 0.02, 0.025):  # around the threshold as well
            centre = rng.standard_normal(64)
            for _ in range(60):
                add(centre + spread * np.linalg.norm(centre) * rng.standard_normal(64), label)
    for k in range(40):
        add(rows[k % 3][1], 1)  # equal vectors
        add(np.array(rows[70][1]) * 10.0**k, 1)  # equal directions
        add([1.0, 0.01 * k], 1)
        add([1.0 + k], None if k % 2 else 7)
    for vec in (None, [], [0.0] * 64, [None] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [1e300, 1e300], [1e-310, 1e-310]):
        add(vec, 1)
        add(vec, 1)
    rows.append((None, rows[0][1], 1))
    rows.append((None, [5.0, 1.0, 1.0], 9))
    rows.append((None, [5.0, 1.0, 1.0], 9))
    rows.append((3, rows[3][1], 1))
    return rows


@pytest.mark.parametrize(("chunk", "blocks"), [(1024, 8), (16, 8), (8, 5)])
def test_vectors_by_brute_force(spark, monkeypatch, chunk, blocks):
    """In one tile, and in many tiles with chunks that meet in pairs."""
    monkeypatch.setattr(vectors, "MOST_TILES", 100_000 if chunk > 8 else 0)
    data = vector_rows()
    df = spark.createDataFrame([(*r, "x") for r in data], "vec_id long, embedding array<double>, label int, node string")
    got = vectors.vector_classes(df.repartition(5), chunk=chunk, blocks=blocks).collect()
    assert sorted(map(tuple, got), key=repr) == brute_vectors(data)


def test_vectors_without_labels_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0])], "k long, v array<float>")
    got = vectors.vector_classes(df, "k", "v", None).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert vectors.vector_classes(df.limit(0), "k", "v", None).collect() == []


def test_tiles_hold_all_near_pairs():
    """Any two points within the budget meet: at home in one tile, or the one of the lower tile visits the other's."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 16)) * 0.2
    tiles = vectors.Tiles(x, 4, 5)
    for block in range(4):
        part = x[:, block * 4 : block * 4 + 4]
        row, tile, home = tiles.places(block, part, 0.02)
        at = dict(zip(row[home].tolist(), tile[home].tolist(), strict=True))
        seen = set(zip(row.tolist(), tile.tolist(), strict=True))
        assert len(at) == 400 and len(seen) == len(row)
        d = ((part[:, None] - part[None]) ** 2).sum(-1)
        for i, j in zip(*np.nonzero(d <= 0.02), strict=True):
            low, high = sorted((int(i), int(j)), key=at.get)
            assert at[low] == at[high] or (low, at[high]) in seen


# ---- spelling


def brute_spelling(docs, letters=5, times=3):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 97 == 0:
                k = h % len(word)
                word = word[:k] + word[k + 1 :]
            n[word] += 1
    n = {w: c for w, c in n.items() if len(w) >= letters and c >= times}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, count = {}, {}
    for w, c in n.items():
        others = [o for o in n if o != w and abs(len(o) - len(w)) < 2 and near(w, o)]
        count[w] = len(others)
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 2 * c else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), c, count[w], n[form[w]] if form[w] else -1) for w, c in n.items())


def spelling_docs():
    rng = random.Random(4)
    words = ["".join(rng.choice("abeÀéÿstn") for _ in range(rng.randint(3, 9))) for _ in range(60)]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "ababab", "bababa", "x" * 400, "x" * 401, "x" * 200 + "y" + "x" * 199]
    docs = []
    for k in range(300):
        some = []
        for w in rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=40):
            at = rng.randrange(len(w))
            some.append(rng.choice([w, w, w.upper(), w[:at] + w[at + 1 :], w[:at] + rng.choice("abé") + w[at + 1 :], w[:at] + "n" + w[at:]]))
        docs.append((k, rng.choice([" ", "-", "1"]).join(some)))
    return [*docs, (None, docs[0][1]), (None, None), (5, docs[5][1]), (7, ""), (8, "words " * 3000)]


def test_spelling_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spelling, "_HELD", 50)
    docs = spelling_docs()
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, n int").repartition(4)
    got = [(r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in spelling.spelling_groups(df).collect()]
    expected = brute_spelling(docs)
    assert sorted(got) == expected
    assert sum(r[1] != "" for r in expected) > 50 and any(r[1] not in ("", r[2]) for r in expected)
    assert spelling.spelling_groups(df.limit(0)).collect() == []


def test_reduced_neighbourhoods_are_whole():
    """Of any two words one edit apart, the reduced words are equal or one's keys hold the other's own."""
    rng = random.Random(9)

    def keys(word):
        own, _, near = spelling.neighbour_keys(spelling.symbols(np.array([[ord(c) for c in word]])))
        return int(own[0]), {int(own[0]), *map(int, near)}

    for _ in range(3000):
        a = "".join(rng.choice("abcdeÿ") for _ in range(rng.randint(1, 8)))
        at = rng.randrange(len(a))
        b = rng.choice([a[:at] + a[at + 1 :] or "a", a[:at] + rng.choice("abcdeÿ") + a[at + 1 :], a[:at] + rng.choice("abcÿ") + a[at:]])
        (one, ones), (two, twos) = keys(a), keys(b)
        assert one in twos or two in ones, (a, b)


# ---- phrases


def brute_phrases(docs, times, longest, first, covered=50):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= times}
    holders = defaultdict(int)
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                key = lang, words[i : i + size]
                holders[key] = max(holders[key], a)
    rows = defaultdict(list)
    for (lang, words), a in found.items():
        if 100 * holders[lang, words] >= covered * a:
            continue
        score, _, l, r = min(
            (1_000_000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]], f[lang, words[k:]])
            for k in range(1, len(words))
        )
        rows[lang].append((-score, -a, " ".join(words).encode(), l, r))
    return sorted(
        (lang, rank, p.decode(), -a, l, r, n[lang], -score)
        for lang, own in rows.items()
        for rank, (score, a, p, l, r) in enumerate(sorted(own)[:first], 1)
    )


def phrase_docs():
    rng = random.Random(8)
    words = ["the", "The", "of", "und", "ÉTÉ", "été", "a", "b", "c", "\x00", "x y", "\U0001f600", "￿", "new", "york"]
    docs = []
    for _ in range(200):
        parts = [rng.choice([*words, "new york city", "as well as"]) + rng.choice([" ", "  ", "\t", ". ", "\n", ",", "\x0b", "\r\n", " "]) for _ in range(60)]
        docs.append((rng.choice(["en", "de", None, "und", ""]), "".join(parts)))
    return [*docs, ("en", None), (None, ""), ("en", "one"), ("fr", "go " * 5000), docs[0], docs[0]]


@pytest.mark.parametrize(("longest", "times", "first", "bits"), [(3, 10, 2000, 1 << 26), (2, 10, 7, 1 << 26), (5, 3, 40, 1 << 15)])
def test_phrases_by_brute_force(spark, monkeypatch, longest, times, first, bits):
    """The last case lets much through its small bitmap; the counts stay exact."""
    monkeypatch.setattr(phrases, "_UNIT", 1000)
    monkeypatch.setattr(phrases.frequent_phrases, "__defaults__", (times, longest, bits))
    docs = phrase_docs()
    df = spark.createDataFrame([(*d, "y", 1) for d in docs], "lang string, text string, phrase string, f int").repartition(3)
    got = phrases.collocations(df, times=times, longest=longest, first=first)
    assert sorted(map(tuple, got.collect())) == brute_phrases(docs, times, longest, first)
    assert phrases.collocations(df.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark):
    """Counts of ten digits: products of the score pass 64 bits and stay whole."""
    a, l, r = 9_876_543_211, 9_999_999_967, 9_999_999_943
    df = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    wide = "decimal(19,0)"
    got = df.selectExpr(f"(cast(a as {wide}) * cast(a as {wide}) * 1000000) div (cast(l as {wide}) * cast(r as {wide})) as score")
    assert got.first().score == 1_000_000 * a * a // (l * r)
