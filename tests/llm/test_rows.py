"""Operators that work row by row: against libraries, brute force and odd rows."""

import hashlib
import re
import time

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from leafmill.llm import licenses, pieces, quality, secret_scan, sharding, token_counts, urls

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["  ", "\n\n", "▁▁▁ x", "a" * 3000, " " * 700 + "x", "{\r\n\t}", "日本語 text😀", "word " * 500, "\x00\x85 é"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def odd_rows(spark, texts):
    """Rows with a null text, an empty one, a null id, a repeated row and columns with inner names."""
    rows = [(i, t, "en", "s", 1, "x") for i, t in enumerate([*texts, None, ""])]
    rows += [(None, texts[0], None, None, 1, "x"), rows[0]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int, kept string")


def test_pieces_equal_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in pieces.encode_decode(docs, MODEL).collect():
        assert r.ids == library.encode(texts[r.doc_id])
        assert r.decoded == library.decode(r.ids)


def test_pieces_of_odd_rows(spark, library):
    df = odd_rows(spark, ODD)
    got = pieces.encode_decode(df, MODEL).collect()
    assert len(got) == df.count()
    want = sorted((str(r.doc_id), library.encode(r.text or "")) for r in df.collect())
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    assert pieces.encode_decode(df.limit(0), MODEL).count() == 0
    again = pieces.decode(pieces.encode_decode(df, MODEL).select("doc_id", "ids"), MODEL)
    assert sorted(r.decoded for r in again.collect()) == sorted(r.decoded for r in got)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="  ▁▁abcdething()\n\t{};\r'\"01éß日😀", max_size=40), st.lists(st.integers(0, 31_999), max_size=8))
def test_pieces_by_example(text, ids):
    lib = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    enc = pieces.encoder(pieces.read_model(MODEL))
    assert enc.encode(text) == lib.encode(text)
    assert enc.model.decode(ids) == lib.decode(ids)


def test_token_spans_add_up(spark, sf_dir):
    ranks = token_counts.read_ranks(RANKS)
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = odd_rows(spark, ODD)
    total = {}
    for r in token_counts.token_counts(df, RANKS, public_tokenizers.PATTERN).collect():
        total.setdefault(r.doc_id, 0)
        total[r.doc_id] += r.n_tokens
    for r in df.collect():
        n = len(lib.encode_ordinary(r.text or "")) * (2 if r.doc_id == 0 else 1)
        assert total[r.doc_id] == n
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 40")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in token_counts.token_counts(docs, RANKS, public_tokenizers.PATTERN).collect():
        assert texts[r.doc_id].split("\n", r.section + 1)[r.section] == texts[r.doc_id][r.start : r.end].rstrip("\n")


def test_token_sections_by_brute_force(spark):
    ranks = token_counts.read_ranks(RANKS)
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = "The tokenisation of naïve words,\n\n\n\nand  gaps 日本 end"
    cuts = [(0, 7), (7, 7), (9, 20), (18, 33), (40, 500)]
    df = spark.createDataFrame([(1, text, cuts), (2, text, None), (3, None, cuts)], "doc_id long, text string, s array<struct<start: int, end: int>>")
    got = {}
    for r in token_counts.token_counts(df, RANKS, public_tokenizers.PATTERN, sections_col="s").collect():
        got.setdefault(r.doc_id, {})[r.section] = r.n_tokens
    ids = lib.encode_ordinary(text)
    owner, upto = {}, 0
    for k, (a, b) in enumerate(cuts):
        owner |= {c: k for c in range(max(a, upto), min(b, len(text)))}
        upto = max(upto, b)
    raw, at, want = text.encode(), 0, dict.fromkeys(range(len(cuts)), 0)
    for i in ids:
        end = at + len(lib.decode_single_token_bytes(i))
        chars = sorted({len(raw[: k + 1].decode(errors="ignore")) if raw[: k + 1].decode(errors="ignore") != raw[:k].decode(errors="ignore") else len(raw[: k + 1].decode(errors="ignore")) + 1 for k in range(at, end)})
        votes = {}
        for c in chars:
            k = owner.get(c - 1)
            votes[k] = votes.get(k, 0) + 1
        best = max(votes, key=lambda k: (votes[k], -min(c for c in chars if owner.get(c - 1) == k)))
        want[best] = want.get(best, 0) + 1
        at = end
    assert got[1] == want
    assert got[2] == {None: len(ids)}
    assert set(got[3].values()) == {0}


def test_very_long_white_space():
    spans = token_counts.Spans(token_counts.read_ranks(RANKS), public_tokenizers.PATTERN)
    starts, ends, _ = spans.of(" " * 1_000_000 + "x")
    assert ends[-1] == 1_000_001 and (starts[1:] == ends[:-1]).all()


def test_quality_of_odd_rows(spark):
    df = odd_rows(spark, [*ODD, "one two three four five " * 30, "clean words only in this text of twelve words for now"])
    got = quality.judged(df)
    assert got.columns.count("n_words") == 1 and got.count() == df.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[9].base_failed and not rows[9].kept and rows[9].n_repeat_words == 150
    assert rows[11].n_words == 0 and rows[11].base_failed
    left = quality.quality_filter(df)
    assert left.columns == df.columns and left.where("doc_id = 10").count() == 1
    assert quality.judged(df.limit(0)).count() == 0


def test_quality_fences_follow_their_group(spark):
    """Long words are usual in one source and outliers in the other; a repeated line is rare in one and usual in the other."""
    def text(i, length, lines):
        words = [chr(97 + (i + k) % 26) * (length + (i + k) % 3) + str(10_000 + i * 31 + k) for k in range(12)]
        return "\n".join([" ".join(words)] + ["same"] * lines)

    rows = [(i, text(i, 4, 2 if i in (0, 1) else 0), "en", "short") for i in range(300)]
    rows += [(1000 + i, text(i, 14, i % 4), "en", "long") for i in range(300)]
    rows += [(5000, text(7, 14, 0), "en", "short"), (5001, text(7, 4, 0), "en", "long"), (5002, text(7, 14, 3), "en", "long")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    limits = {r._source: r for r in quality.thresholds(quality.with_counts(df), "lang", "source", 3, 200).collect()}
    assert limits["short"]._word_len_top < limits["long"]._word_len_bottom
    assert limits["short"]._dup_lines_top == 0 < limits["long"]._dup_lines_top
    out = {r.doc_id for r in quality.judged(df).where("not kept").collect()}
    assert out == {0, 1, 5000, 5001}


def test_repeated_windows_by_brute_force():
    for text in ("a b c d e a b c d e f", "x " * 9, "a b c d", "a b c d e f g a b c d e h a b c d e"):
        words = text.encode().split()
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        cover = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
        assert quality._repeat_words(words) == len(cover)


def test_buckets_are_ordered_and_close(spark):
    df = spark.range(0, 5000).select("id", quality.bucket(F.col("id")).alias("b"))
    rows = df.select("id", "b", quality.bucket_top(F.col("b")).alias("top"), quality.bucket_bottom(F.col("b")).alias("low")).orderBy("id").collect()
    assert all(x.b <= y.b for x, y in zip(rows, rows[1:], strict=False))
    assert all(r.low <= r.id <= r.top <= r.id * 1.016 + 1 for r in rows)


def brute_base(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["token", "API_KEY", "passwd", "ſecret", ":", "=", " ", "'", '"', "AKIA", "ABCD1234", "0123456789abcdef", "é", "xyz_9.w", "\n"]), max_size=14))
def test_secret_patterns_by_example(parts):
    text = "".join(parts)
    assert secret_scan.base_spans(text) == brute_base(text)


def test_secret_novelty_and_masks(spark):
    good = "the secret of the house was its private garden and the token gesture of the page_2024_index was known " * 3
    bad = "client credential follows: zQ8kV2xN7pLw4RtY9sB1mC6d and nothing else in the text"
    assert [k for _, k, _ in secret_scan.spans(bad)] == [3]
    assert secret_scan.spans(good) == []
    df = odd_rows(spark, [bad, good, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x'])
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.find_secrets(df).collect()}
    assert found[1] == [] and found[3] == [] and [s[0] for s in found[2]] == ["assign", "hex"]
    masked = secret_scan.mask_secrets(df)
    rows = {r.doc_id: r.text for r in masked.collect()}
    assert masked.columns == df.columns and rows[2] == '[SECRET]" x' and rows[3] is None and rows[1] == good
    assert "zQ8k" not in rows[0]


def brute_url(url):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("", "") if not m else ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2])
    fit = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fit, key=lambda x: len(x[0]), default=(None, "allow"))
    return host, path, rule, verdict


def test_urls_by_brute_force(spark, monkeypatch):
    given = [None, "", "no scheme", "http://A.NET", "http://a.net/", "http://EXAMPLE.net/en/x?y#z", "x://b.example.net/en", "https://example.com/de/?",
             "ftp://u@w.org/fr/a/b", "http://org/fr/", "http://netx/a", "http://a.net?/x", "http://a.net#/en/", "://net/://", "http://.net/", "http://É.org/fr/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate([*given, given[4]])] + [(None, given[5], "h")], "page_id long, url string, host string")
    rules = urls.rule_table(spark, ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"])
    want = sorted((str(r.page_id), *map(str, brute_url(r.url))) for r in df.collect())
    for most in (urls.MOST_INDEX_BYTES, 0):
        monkeypatch.setattr(urls, "MOST_INDEX_BYTES", most)
        got = urls.judge_urls(df, rules)
        assert sorted((str(r.page_id), *map(str, r[1:])) for r in got.collect()) == want
        assert urls.judge_urls(df, rules.limit(0)).where("verdict = 'block'").count() == 0


def test_equal_digests_are_told_apart(monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda s, seed=0: 7)
    index = urls.RuleIndex([("a.org/", "block"), ("b.org/", "allow")])
    assert index.lookup(["b.org/", "c.org/", "a.org/"]) == [("b.org/", "allow"), None, ("a.org/", "block")]


def brute_table(shards, slots):
    from leafmill.llm.sharding import xxhash

    lists = []
    for s in shards:
        a, b = xxhash.xxh64_intdigest(s, seed=1) % slots, xxhash.xxh64_intdigest(s, seed=2) % (slots - 1) + 1
        lists.append([(a + j * b) % slots for j in range(slots)])
    table, turn = {}, 0
    while len(table) < slots:
        slot = next(x for x in lists[turn % len(shards)] if x not in table)
        table[slot] = turn % len(shards)
        turn += 1
    return [table[i] for i in range(slots)]


def test_lookup_table(spark):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 211)
    assert table.tolist() == brute_table(names, 211)
    less = sharding.lookup_table(names[:-1], 211)
    moved = sum(a != b and a != 6 for a, b in zip(table.tolist(), less.tolist(), strict=True))
    assert moved < 211 / 5
    df = odd_rows(spark, ODD).withColumn("slot", F.lit("old"))
    got = sharding.place(df, names, slots=211).collect()
    assert len(got) == df.count()
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 211
        assert (r.slot, r.shard) == (slot, names[table[slot]])


def test_shards_are_written(spark, tmp_path):
    df = spark.range(0, 500).withColumnRenamed("id", "doc_id")
    sharding.write_shards(df, str(tmp_path / "out"), ["a", "b", "c"])
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500 and {r.shard for r in back.select("shard").distinct().collect()} == {"a", "b", "c"}


def test_licenses_of_odd_rows(spark):
    texts = ["Intro.\nreleased under the MIT licence\nReleased under the MIT License!", licenses.TEMPLATES["MIT"].replace(". ", ".\n"),
             "Some words.\n\n" + licenses.TEMPLATES["ISC"].replace(", ", ",\n") + "\n\nMore.", "MIT", *ODD]
    df = odd_rows(spark, texts)
    got = licenses.scan_licenses(df, licenses.template_table(spark)).collect()
    found = {(r.doc_id, r.unit, r.unit_no, r.license) for r in got}
    assert (0, "line", 2, "MIT-notice") in found and (1, "paragraph", 0, "MIT") in found and (2, "paragraph", 1, "ISC") in found
    assert not any(r.doc_id is not None and r.doc_id > 2 for r in got)
    assert all(abs(r.dice - 2 * r.n_common / (r.n_unit + r.n_template)) < 1e-12 for r in got)
    assert licenses.scan_licenses(df.limit(0), licenses.template_table(spark)).count() == 0


def test_licenses_inside_longer_texts(spark):
    code = " ".join(f"value{i} = step{i}({i})" for i in range(400))
    mit = licenses.TEMPLATES["MIT"].replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")
    wrapped = "Some words before it.\nReleased under\nthe MIT License.\nSome words after it and more of them."
    texts = [f"# Title\n\n{mit}\n\n{code}\n\n{mit}\n\n{code}", wrapped, f"{code} Licensed under CC BY-NC 4.0. {code}", licenses.TEMPLATES["ISC"], code]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = licenses.scan_licenses(df, licenses.template_table(spark)).collect()
    assert sorted((r.doc_id, r.unit, r.license) for r in got) == [
        (0, "passage", "MIT"), (0, "passage", "MIT"), (1, "passage", "MIT-notice"), (2, "passage", "CC-BY-NC-4.0-notice"), (3, "line", "ISC")
    ]
    assert all(r.dice == 1 for r in got)


def test_size_bounds_lose_no_template(spark):
    words = [f"w{i}" for i in range(14)]
    rows = [(i, " ".join(words[a : a + n])) for i, (a, n) in enumerate((a, n) for a in range(5) for n in range(2, 10))]
    templates = spark.createDataFrame([(f"t{k}", " ".join(words[k : k + 4 + k])) for k in range(5)], "license string, template string")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.license) for r in licenses.scan_licenses(df, templates).where("unit = 'line'").collect()}

    def pairs(t):
        w = t.split()
        return set(zip(w, w[1:], strict=False))

    want = {
        (i, t.license) for i, x in rows for t in templates.collect()
        if 2 * len(pairs(x) & pairs(t.template)) >= 0.8 * (len(pairs(x)) + len(pairs(t.template)))
    }
    assert got == want


def test_decode_skips_what_shows_nothing(library):
    enc = pieces.encoder(pieces.read_model(MODEL))
    for ids in ([1, 475], [2, 1, 475, 475], [475, 1, 475], [1, 2], [0, 475], [1, 0, 475], []):
        assert enc.model.decode(ids) == library.decode(ids)


def test_encoder_keeps_few_cuts():
    """A worker of the pipeline keeps 200,000 cuts at most, however many there are."""
    enc = pieces.Encoder(pieces.Model(pieces.read_model(MODEL)), corpus_pipeline.CUTS)
    enc.encode(" ".join(map(str, range(210_000))))
    assert len(enc) + len(enc.older) < 200_010
    assert enc.encode("12 209999") == enc.encode("12") + enc.encode("209999")


def test_secrets_in_long_texts():
    """Time follows the length, whatever is repeated."""
    begin = time.perf_counter()
    assert secret_scan.spans("the token of a word " * 100_000) == []
    key = "x9F3kLq8Zr2Vt7Wb4Ns6"
    text = "the token of a word " * 50_000 + f"bearer {key} " + "a1" * 500_000
    assert (text.index(key), 3, text.index(key) + len(key)) in secret_scan.spans(text)
    assert time.perf_counter() - begin < 10


def test_masks_beside_a_column_of_that_name(spark):
    df = spark.createDataFrame([("password=abcdefgh1", 1)], "text string, _masked int")
    assert [tuple(r) for r in secret_scan.mask_secrets(df).collect()] == [("[SECRET]", 1)]
