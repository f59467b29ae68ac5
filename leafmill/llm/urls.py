"""Operator 7: URL rules looked up in a sorted array of 64-bit digests.

A rule is a host and the start of a path, written together (`example.net/en/`). The index holds the xxhash64 digests of
all rules in order, and beside them the rules' full texts and verdicts. A URL asks for each of its host's suffixes with
each start of its path that has the length of some rule's path; all questions of a batch are answered by one binary
search, and a digest that is found counts only if the stored text is the text asked for.
"""

from __future__ import annotations

import mmap
from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import over_texts

#: Most bytes of rules for which one index is sent to every executor; more are joined instead.
MOST_INDEX_BYTES = 64 << 20

_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str) -> tuple[str, str]:
    """Host and path: both empty without `://`."""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_UPPER), slash + path


class RuleIndex:
    """Digests, text ends, texts and verdicts, each an array in a memory map of its own."""

    def __init__(self, rules: Iterable[tuple[str, str]]):
        # Of two verdicts for one rule, block wins.
        best: dict[str, str] = {}
        for rule, verdict in rules:
            best[rule] = "block" if "block" in (verdict, best.get(rule)) else verdict
        rows = sorted((xxhash.xxh64_intdigest(r), r, v) for r, v in best.items())
        texts = [r.encode() for _, r, _ in rows]
        self.parts = {
            "digests": np.array([d for d, _, _ in rows], np.uint64).tobytes(),
            "ends": np.cumsum([0, *map(len, texts)], dtype=np.int64).tobytes(),
            "texts": b"".join(texts),
            "blocks": np.array([v == "block" for _, _, v in rows], np.uint8).tobytes(),
            "lengths": np.array(sorted({len(r[r.index("/"):]) for r in best if "/" in r}), np.int64).tobytes(),
        }
        self._open = None

    def __getstate__(self):
        return self.parts

    def __setstate__(self, parts):
        self.parts, self._open = parts, None

    def arrays(self) -> tuple:
        """Views of the parts, mapped once in each Python worker."""
        if self._open is None:
            views = {}
            for name, part in self.parts.items():
                held = mmap.mmap(-1, max(1, len(part)))
                held[: len(part)] = part
                views[name] = memoryview(held)[: len(part)]
            number = {"digests": np.uint64, "ends": np.int64, "blocks": np.uint8, "lengths": np.int64}
            self._open = {k: np.frombuffer(v, number[k]) if k in number else v for k, v in views.items()}
            self.parts = {}
        return self._open

    def lookup(self, asked: list[str]) -> list[tuple[str, str] | None]:
        """For each text its rule and verdict, or None."""
        a = self.arrays()
        digests, ends = a["digests"], a["ends"]
        out: list[tuple[str, str] | None] = [None] * len(asked)
        if not len(digests) or not asked:
            return out
        want = np.fromiter(map(xxhash.xxh64_intdigest, asked), np.uint64, len(asked))
        at = np.searchsorted(digests, want)
        for k in np.flatnonzero(digests[np.minimum(at, len(digests) - 1)] == want):
            text, i = asked[k].encode(), int(at[k])
            while i < len(digests) and digests[i] == want[k]:  # different texts can have one digest
                if bytes(a["texts"][ends[i]:ends[i + 1]]) == text:
                    out[k] = (asked[k], "block" if a["blocks"][i] else "allow")
                    break
                i += 1
        return out

    def questions(self, host: str, path: str) -> list[str]:
        """All rules that would fit, the longest text first (of equal lengths, the longer host)."""
        lengths = self.arrays()["lengths"]
        labels = host.split(".")
        hosts = [".".join(labels[k:]) for k in range(len(labels))]
        starts = [path[:n] for n in lengths.tolist() if n <= len(path)]
        return sorted((h + p for h in hosts for p in starts if h), key=lambda x: (-len(x), x.index("/")* -1))

    def judge(self, urls: list[str]) -> list[list]:
        """Columns host, path, rule, verdict."""
        parts = [split_url(u) for u in urls]
        asked, owner = [], []
        for k, (host, path) in enumerate(parts):
            more = self.questions(host, path) if path else []
            asked += more
            owner += [k] * len(more)
        rules: list[str | None] = [None] * len(urls)
        verdicts = ["allow"] * len(urls)
        for k, hit in zip(owner, self.lookup(asked), strict=True):
            if hit and rules[k] is None:
                rules[k], verdicts[k] = hit
        return [[h for h, _ in parts], [p for _, p in parts], rules, verdicts]


def judge_urls(df: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for each row of `df` under the table `rules` (rule, verdict).

    The longest rule whose host is the URL's or one above it, and whose path starts the URL's path, decides; a URL that
    no rule fits is allowed and has a null rule. Null URLs and those without `://` have an empty host and path and are
    allowed. Rules without a path, null rules and null verdicts are ignored. Repeated rows and null ids each give their
    row. Nothing is shuffled up to `MOST_INDEX_BYTES` of rules; beyond, candidates are joined with the rules by digest.
    """
    rules = rules.select("rule", "verdict").where("rule is not null and verdict is not null and instr(rule, '/') > 1")
    size = rules.agg(F.sum(F.octet_length("rule") + 40)).first()[0] or 0
    if size > MOST_INDEX_BYTES:
        return _joined(df, rules, id_col, url_col)
    index = df.sparkSession.sparkContext.broadcast(RuleIndex((r[0], r[1]) for r in rules.collect()))
    return over_texts(
        df, id_col, url_col, lambda: index.value.judge, "host string, path string, rule string, verdict string"
    )


def _joined(df: DataFrame, rules: DataFrame, id_col: str, url_col: str) -> DataFrame:
    """The same for rules of any number: distinct URLs meet the rules by digest and text in one shuffled join."""
    lengths = rules.select(F.expr("length(rule) - instr(rule, '/') + 1").alias("n")).groupBy().agg(
        F.array_sort(F.collect_set("n")).alias("lengths")  # path lengths: a few hundred values at most
    )
    split = over_texts(
        df.select(url_col).distinct().withColumn("_key", F.col(url_col)), "_key", url_col,
        lambda: lambda urls: [list(x) for x in zip(*map(split_url, urls), strict=True)], "host string, path string",
    )
    labels = F.split("host", "[.]", -1)
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, 1 << 20), "."))
    asked = (
        split.crossJoin(F.broadcast(lengths))  # one row
        .withColumn("_host", F.explode(hosts)).withColumn("_n", F.explode("lengths"))
        .where("_n <= length(path) and _host <> ''")
        .select("_key", F.expr("_host || substr(path, 1, _n)").alias("rule"))
    )
    one = rules.groupBy("rule").agg(F.max(F.col("verdict") == "block").alias("blocks"))
    best = asked.join(one, "rule").groupBy("_key").agg(
        F.max(F.struct(F.length("rule").alias("n"), F.expr("instr(rule, '/')").alias("h"), "rule", "blocks")).alias("b")
    )
    told = split.join(best, "_key", "left").select(
        "_key", "host", "path", F.col("b.rule").alias("rule"),
        F.when(F.col("b.blocks"), "block").otherwise("allow").alias("verdict"),
    )
    return (
        df.select(F.col(id_col), F.col(url_col).alias("_url"))
        .join(told, F.col("_url").eqNullSafe(F.col("_key")), "left")
        .select(id_col, F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "rule",
                F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    )


def rule_table(spark: SparkSession, block: list[str], allow: list[str]) -> DataFrame:
    rows = [(r, "block") for r in block] + [(r, "allow") for r in allow]
    return spark.createDataFrame(rows, "rule string, verdict string")
