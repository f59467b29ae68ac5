"""Operators over the whole corpus: repeated strings, near-duplicates, benchmark items, and the pipeline."""

import hashlib
import random
import time
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from leafmill.llm import decontaminate, order_minhash, repeats, secret_scan
from leafmill.llm.queries import ENTRIES

RNG = random.Random(11)
SYLLABLES = ["the", "and", "of", "thion", "erth", "é", "ß", "ing", "re", "on"]


def prose(n, rng=RNG):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


# ---- repeated strings

def brute_repeats(texts, length=200):
    raws, seen = [(t or "").encode() for t in texts], defaultdict(int)
    for r in raws:
        for i in range(len(r) - length + 1):
            seen[r[i : i + length]] += 1
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        runs = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        left = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


@pytest.fixture(scope="module")
def repeated():
    rng = random.Random(3)
    base = [prose(rng.randint(5, 300), rng) for _ in range(25)]
    hot = prose(80, rng)
    texts = list(base)
    for _ in range(40):
        a, b = rng.choice(base), rng.choice(base)
        k, m = rng.randint(0, len(a)), rng.randint(0, len(b))
        texts.append(a[:k] + b[m : m + rng.randint(100, 900)] + a[k:])
    texts += [prose(rng.randint(0, 60), rng) + hot + prose(rng.randint(0, 60), rng) for _ in range(40)]
    texts += [None, "", None, "a" * 199, "a" * 200, "a" * 201, "ab" * 400, "a" * 3000, "x" * 150 + "y" * 300]
    texts += [prose(900, rng) * 2, "é" * 300, "日本" * 120, base[0], base[0], base[3]]
    return texts


@pytest.mark.parametrize(("shard", "most"), [(1 << 20, 300_000), (3000, 0)])
def test_repeats_by_brute_force(spark, monkeypatch, repeated, shard, most):
    """With one shard and broadcasts, and with many shards, texts cut over shards, and shuffles."""
    monkeypatch.setattr(repeats, "SHARD", shard)
    monkeypatch.setattr(repeats, "MOST_TEXTS", most)
    monkeypatch.setattr(repeats, "MOST_GRAMS", most)
    rows = [(i if i % 37 else None, t, 1, 2) for i, t in enumerate(repeated)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key int, size int").repartition(5)
    got = [
        str((r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest()))
        for r in repeats.remove_repeats(df).collect()
    ]
    want = [str((r[0], *b)) for r, b in zip(rows, brute_repeats(repeated), strict=True)]
    assert sorted(got) == sorted(want)


def test_no_repeats(spark):
    df = spark.createDataFrame([(1, prose(400)), (2, None)], "doc_id long, text string")
    assert [r.spans for r in repeats.remove_repeats(df).collect()] == [[], []]
    assert repeats.remove_repeats(df.limit(0)).count() == 0


def test_suffixes_and_prefixes():
    rng = np.random.default_rng(1)
    part = rng.integers(97, 99, 500).astype(np.uint8)
    raw = np.concatenate([part, part[:450], rng.integers(97, 99, 300).astype(np.uint8), part[100:], np.full(400, 97, np.uint8)])
    cuts = [0, 500, 950, 1250, 1650, 2050]
    end = np.concatenate([np.full(b - a, b) for a, b in zip(cuts, cuts[1:], strict=False)])
    order, rank, half = repeats.suffix_array(raw, end)
    data = raw.tobytes()
    suffixes = [data[i : min(i + repeats.DEEP, end[i])] for i in order.tolist()]
    assert suffixes == sorted(suffixes) and sorted(order.tolist()) == list(range(len(raw)))
    again = repeats.repeats_before(raw, end, order, rank, half)
    for k in range(1, len(order)):
        a, b = (data[i : end[i]] for i in order[k - 1 : k + 1].tolist())
        assert again[k] == (len(a) >= 200 and len(b) >= 200 and a[:200] == b[:200])


# ---- near-duplicates

def distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d = d, [i]
        for j, y in enumerate(b, 1):
            d.append(min(p[j] + 1, d[-1] + 1, p[j - 1] + (x != y)))
    return d[-1]


def test_banded_distance_by_brute_force():
    rng = random.Random(5)
    for _ in range(4000):
        a, b = ([rng.randrange(3) for _ in range(rng.randint(0, 14))] for _ in range(2))
        most = rng.randint(0, 9)
        want = distance(a, b)
        assert order_minhash.distance_within(a, b, most) == (want if want <= most else None)


def brute_classes(rows, threshold=0.8):
    words = [order_minhash.words_of(t or "") for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if words[i] or words[j]:
                same = words[i] and words[j] and distance(words[i], words[j]) <= int((1 - threshold) * max(len(words[i]), len(words[j])) + 1e-9)
                shared = set(zip(*(words[i][k:] for k in range(5)), strict=False)) & set(zip(*(words[j][k:] for k in range(5)), strict=False))
                if same and (shared or words[i] == words[j]):
                    root[find(i)] = find(j)
            elif (rows[i][1] or "") == (rows[j][1] or ""):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    out = [None] * len(rows)
    for ids in members.values():
        least = min((rows[i][0] for i in ids if rows[i][0] is not None), default=None)
        for i in ids:
            out[i] = (rows[i][0], least, len(ids))
    return out


def near_rows():
    rng = random.Random(8)
    texts, passage = [], prose(60, rng)
    for _ in range(12):
        own = prose(rng.randint(60, 160), rng)
        texts.append(own)
        for _ in range(3):
            w = own.split()
            for _ in range(rng.randint(1, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = "changed"
            texts.append(" ".join(w))
        texts.append(own.replace(" ", ", ").capitalize() + " !")
    texts += [passage + " " + prose(60, rng) for _ in range(10)]
    half = prose(80, rng)
    texts += [half + " " + passage, passage + " " + half]  # the same passages in another order
    texts += [None, "", "!!!", "???", "!!!", "one two", "one two", "one two three", prose(3000, rng)]
    rows = [(i if i % 19 else None, t) for i, t in enumerate(texts)]
    return [*rows, rows[1], rows[5]]


def test_classes_by_brute_force(spark):
    rows = near_rows()
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, text string, node int, class_id int").repartition(4)
    got = [tuple(r) for r in order_minhash.near_duplicates(df).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_classes(rows)))
    assert order_minhash.near_duplicates(df.limit(0)).count() == 0


def test_large_mixed_buckets_by_brute_force(spark):
    rng = random.Random(21)
    rows = []
    for share in (30, 40):  # two passages of 30 and 40 of 60 words, each common to 108 texts
        passage = prose(share, rng)
        for _ in range(36):
            own = prose(60 - share, rng).split()
            for _ in range(3):
                w = list(own)
                for _ in range(4):
                    w[rng.randrange(len(w))] = "".join(rng.choice(SYLLABLES) for _ in range(5))
                rows.append((len(rows), passage + " " + " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in order_minhash.near_duplicates(df).collect()]
    want = brute_classes(rows)
    assert len({c for _, c, _ in want}) > 60
    assert sorted(got) == sorted(want)


def test_similar_texts_share_a_rare_pair():
    rng = random.Random(6)
    for _ in range(3000):
        a = [rng.randrange(6) for _ in range(rng.randint(5, 40))]
        b = list(a)
        for _ in range(rng.randint(0, len(a) // 4)):
            at, how = rng.randrange(len(b)), rng.randrange(3)
            b[at : at + (how != 0)] = [rng.randrange(6)] * (how != 1)
        size, threshold = rng.choice([(1, 0.6), (2, 0.8)])
        if distance(a, b) <= int(max(len(a), len(b)) * (1 - threshold) + 1e-9):
            cut = [set(np.sort(order_minhash._tuples(np.array(x, np.uint32).tobytes(), size))[: order_minhash.prefix_size(len(x), size, threshold)]) for x in (a, b)]
            assert cut[0] & cut[1]


def test_signatures_leave_out_no_similar_pair(spark):
    rng = random.Random(11)
    rows = []
    for n in (3, 20, 100, 700, 3000):
        for share in (0.02, 0.15, 0.2, 0.5):
            a = [rng.randrange(60 if n % 20 else 5000) for _ in range(n)]
            b = list(a)
            for _ in range(int(n * share)):
                at = rng.randrange(len(b))
                b[at : at + rng.randrange(2)] = [rng.randrange(9000)] * rng.randrange(1, 3) if rng.random() < 0.7 else []
            seqs = [np.array(x, np.uint32) for x in (a, b)]
            signs = [order_minhash.signature(order_minhash._tuples(x.tobytes(), 1)).tolist() for x in seqs]
            rows.append((len(a), signs[0], len(b), signs[1], order_minhash.similar(*seqs, 0.8)))
    df = spark.createDataFrame(rows, "n_first long, sig_first array<long>, n_words long, sig array<long>, near boolean")
    told = df.select("n_first", "near", order_minhash._signs_allow(0.8).alias("allowed")).collect()
    assert all(r.allowed for r in told if r.near) and sum(r.near for r in told) > 4
    assert not all(r.allowed for r in told if not r.near)


def test_signatures_tell_long_unlike_texts(spark):
    """Of 40 pairs of 800 words that have 70 of 100 words in common, none is left to be compared."""
    rng = np.random.default_rng(13)
    rows = []
    for _ in range(40):
        common, own = rng.integers(0, 1 << 32, 560, dtype=np.uint32), rng.integers(0, 1 << 32, (2, 240), dtype=np.uint32)
        signs = [order_minhash.signature(order_minhash._tuples(np.concatenate([common, x]).tobytes(), 1)).tolist() for x in own]
        rows.append((800, signs[0], 800, signs[1]))
    df = spark.createDataFrame(rows, "n_first long, sig_first array<long>, n_words long, sig array<long>")
    assert df.where(order_minhash._signs_allow(0.8)).count() == 0


def test_one_of_each_class_stays(spark):
    rows = [r for r in near_rows() if r[0] is not None]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, _rows string")
    left = order_minhash.one_of_each(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, c, _ in brute_classes(rows)})


def test_one_of_each_class_by_text(spark):
    a, b, c, d, e = (prose(50).replace("ß", "s") for _ in range(5))
    rows = [(None, a), (None, b), (None, c), (1, c), (2, d), (2, e), (3, d + " !"), (None, a), (None, a.upper()), (None, None), (None, "")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, _hash int").repartition(3)
    left = order_minhash.one_of_each(df)
    assert left.columns == df.columns
    got = sorted((str(r.doc_id), (r.text or "").lower()) for r in left.collect())
    assert got == sorted([("None", a), ("None", b), ("None", ""), ("1", c), ("2", d), ("2", e)])


def test_chains_are_one_class(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 103), (102, 103)]
    RNG.shuffle(edges)
    got = {r.node: r.root for r in order_minhash.components(spark.createDataFrame(edges, "first long, node long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100, 103: 100}


def test_moved_passages_differ():
    a, b = prose(80), prose(80)
    keys = [order_minhash.band_keys(order_minhash.labelled(order_minhash._hashes(x.split()))) for x in (f"{a} {b}", f"{b} {a}", f"{a} {b} z")]
    assert (keys[0] == keys[1]).sum() < (keys[0] == keys[2]).sum()


def test_long_texts_are_sketched_in_blocks(monkeypatch):
    items = order_minhash.labelled(order_minhash._hashes(prose(700).split()))
    whole = order_minhash.band_keys(items)
    monkeypatch.setattr(order_minhash, "_BLOCK", 50)
    assert (order_minhash.band_keys(items) == whole).all()


# ---- benchmark items

def test_items_by_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    items = [(k, prose(n, rng)) for k, n in enumerate([5, 6, 9, 14, 30, 59, 4, 3])] + [(8, None), (None, prose(20, rng)), (0, prose(5, rng))]
    docs = []
    for i in range(120):
        text = prose(rng.randint(0, 80), rng)
        for _ in range(rng.randint(0, 2)):
            w = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                if w:
                    w[rng.randrange(len(w))] = "zz"
            text += " " + ", ".join(w).upper() + " " + prose(rng.randint(0, 40), rng)
        docs.append((i, text))
    docs += [(200, None), (201, ""), (None, items[4][1]), docs[0], (202, items[4][1] * 2 + prose(5000, rng))]

    def shingles(text):
        w = [x for x in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
        return set(zip(*(w[k:] for k in range(5)), strict=False))

    want = set()
    for d, t in docs:
        for k, x in items:
            s = shingles(x)
            if d is not None and k is not None and s and len(s & shingles(t)) >= 0.8 * len(s):
                want.add((d, k, len(s & shingles(t)), len(s)))
    df = spark.createDataFrame([(*d, 1, 1) for d in docs], "doc_id long, text string, item_id int, _h int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for most in (decontaminate.MOST_SKETCH, 0):
        monkeypatch.setattr(decontaminate, "MOST_SKETCH", most)
        monkeypatch.setattr(decontaminate, "MOST_FOUND", most)
        got = decontaminate.find_items(df, bench)
        assert sorted((r[0], r[1], r[2], r[3]) for r in got.collect()) == sorted(want)
    clean = decontaminate.decontaminated(df, bench)
    bad = {d for d, *_ in want}
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in bad)
    assert decontaminate.find_items(df.limit(0), bench).count() == 0 == decontaminate.find_items(df, bench.limit(0)).count()


@pytest.mark.parametrize("name", ["op10_decontamination"])
def test_main_path_is_native(spark, sf_dir, name):
    plan = ENTRIES.queries[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"))


# ---- queries and pipeline

@pytest.mark.parametrize("name", sorted(ENTRIES.queries))
def test_queries_give_a_row_for_each_input(spark, sf_dir, name):
    got = ENTRIES.queries[name](spark, sf_dir)
    source = "pages" if name.startswith("op7") else "documents"
    if name.split("_")[0] not in ("op1", "op8", "op10"):
        assert got.count() == spark.read.parquet(f"{sf_dir}/{source}.parquet").count()


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, rows = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, rows = rows, stage(spark, rows, sf_dir)
        assert k == len(corpus_pipeline.STAGES) - 1 or rows.columns == columns, name
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        if name == "secret scans":
            texts = [r.text for r in rows.collect()]
            assert not any(secret_scan.base_spans(t) for t in texts) and rows.count() == before.count()
        if name == "MinHash near-dedup":
            classes = order_minhash.near_duplicates(before)
            assert sorted(r.doc_id for r in rows.collect()) == sorted(r[0] for r in classes.select("class_id").distinct().collect())
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 50
    whole = corpus_pipeline.run(spark, sf_dir)
    assert sorted(whole.collect()) == sorted(rows.collect())


def test_pipeline_of_odd_rows(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    good = prose(60)
    rows = [(1, good, "en", "s", len(good)), (1, good, "en", "s", len(good)), (2, None, None, None, None), (3, "", "en", "s", 0), (None, prose(70), None, "s", None)]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.limit(0)):
        out = table
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, out, sf_dir)
        assert out.count() == (2 if table is docs else 0)


def test_long_texts_with_few_edits():
    """Two texts of 200,000 words: time and memory follow their length."""
    rng = np.random.default_rng(3)
    a = rng.integers(0, 5000, 200_000).astype(np.uint32)
    b = np.delete(a, [7, 100_000])
    b[150_000] = 6000
    tracemalloc.start()
    begin = time.perf_counter()
    assert order_minhash.similar(a, b, 0.8) and not order_minhash.similar(a, a[::-1].copy() + np.uint32(5000), 0.8)
    assert time.perf_counter() - begin < 20 and tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def test_unlike_texts_of_a_template(spark):
    """Texts that share 75 of 100 words: none are similar, and few pairs are tried."""
    rng = random.Random(12)
    frame = [f"word{i}" for i in range(75)]
    rows = [(k, " ".join(frame[:40] + [f"own{rng.randrange(10**6)}" for _ in range(25)] + frame[40:])) for k in range(400)]
    tried = []
    verified = order_minhash.verified

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return verified(pairs, *rest)

    order_minhash.verified = counted
    try:
        got = order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    finally:
        order_minhash.verified = verified
    assert all(r.class_id == r.doc_id and r.class_size == 1 for r in got) and len(got) == 400
    assert sum(tried) < 10_000
