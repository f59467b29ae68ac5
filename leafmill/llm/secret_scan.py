"""Operator 9: secrets in text, by patterns and by what a compressor that knows the surroundings can't foresee.

A candidate is a token of `MIN_CHARS` or more characters, with letters and digits, at most `NEAR` characters after a
sensitive word. A zstandard compressor is primed with a dictionary of usual identifiers and the text around the candidate
(without it). What the candidate adds to the compressed size of its surroundings is its novelty; a password or key adds
nearly its own length, while an identifier, a path or a repeated value adds little.
"""

from __future__ import annotations

import bisect
import re

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import over_texts, with_columns

KINDS = ("assign", "access", "hex", "novel")
MIN_CHARS = 16
NEAR = 60
AROUND = 1000
#: Marginal compressed bytes for each character of a candidate from which it is reported.
NOVELTY = 0.6

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # all of a run, as in AKIA[A-Z0-9]+ with 16 characters or more
_HEX = re.compile(r"[0-9a-f]{32,}")
_HINTS = ("passw", "secret", "token", "api")
_SENSITIVE = re.compile(
    r"passw|passphrase|secret|token|api.?key|private.?key|access.?key|credential|authoriz|bearer|signature", re.ASCII | re.I
)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CHARS)
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+")
_PLAIN = re.compile(r"[A-Za-z]*|[0-9_/=+-]*")

#: Words that code and configuration use everywhere: the start of the dictionary.
IDENTIFIERS = (
    "authorization access_token refresh_token client_secret client_id api_key apikey private_key public_key secret_key "
    "password username credentials certificate signature session cookie header request response environment variable "
    "config configuration settings default production development localhost endpoint function return import export "
    "const static public private class string integer boolean null true false http https www com org net index update "
    "created_at updated_at version license application content type json xml html text base64 encoded example test"
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all that the patterns find, leftmost and non-overlapping for each kind."""
    found = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def novelty(text: str, start: int, end: int) -> float:
    """Marginal compressed bytes per character of text[start:end], given the text around it and usual identifiers."""
    around = f"{text[max(0, start - AROUND):start]} {text[end:end + AROUND]} "
    primed = zstandard.ZstdCompressionDict(
        f"{IDENTIFIERS} {around}".encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    packer = zstandard.ZstdCompressor(level=9, dict_data=primed, write_content_size=False, write_checksum=False)
    tail = around[-64:].encode()
    return (len(packer.compress(tail + text[start:end].encode())) - len(packer.compress(tail))) / (end - start)


def novel_spans(text: str, taken: list[tuple[int, int, int]], least: float = NOVELTY) -> list[tuple[int, int, int]]:
    """Candidates near sensitive words that the compressor can't foresee, apart from the spans in `taken`."""
    out, upto = [], 0
    for hint in _SENSITIVE.finditer(text):
        latest = hint.end() + NEAR
        # A candidate shows its first MIN_CHARS characters by here; its end is looked for once it is known to start in time.
        while m := _CANDIDATE.search(text, max(hint.end(), upto), min(latest + MIN_CHARS, len(text))):
            start, end = m.start(), _TOKEN.match(text, m.start()).end()
            upto = end
            token = text[start:end]
            if not _PLAIN.fullmatch(token) and not any(a < end and start < b for a, _, b in _around(taken, start, end)):
                if novelty(text, start, end) >= least:
                    out.append((start, 3, end))
    return out


def _around(taken: list[tuple[int, int, int]], start: int, end: int) -> list[tuple[int, int, int]]:
    """Of spans in order of their start, those that may meet [start, end): the ones that start in it, and the last of each
    kind before it (spans of a kind don't overlap)."""
    low, high = bisect.bisect_left(taken, (start,)), bisect.bisect_left(taken, (end,))
    before, kinds = [], set()
    for span in reversed(taken[max(0, low - 64) : low]):
        if span[1] not in kinds:
            kinds.add(span[1])
            before.append(span)
    return before + taken[low:high]


def spans(text: str) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    return sorted(base + novel_spans(text, base))


def _finder():
    def work(texts: list[str]) -> list:
        return [[[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans(t)] for t in texts]]

    return work


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) for each row of `df`, in the order of start and kind.

    Offsets are code points, ends exclusive. Null and empty texts have no spans; repeated rows and null ids each give
    their row; an empty table gives none. Each whole text is searched in the task that reads it; nothing is shuffled.
    """
    return over_texts(df, id_col, text_col, _finder, "spans array<struct<kind: string, start: long, end: long>>")


def masked(text: str, mark: str = "[SECRET]") -> str:
    """The text with each run of overlapping spans replaced by `mark`."""
    out, upto = [], 0
    end = 0
    for a, _, b in spans(text):
        if a >= end:
            out += [text[upto:a], mark]
        end = max(end, b)
        upto = end
    return "".join(out) + text[upto:] if out else text


def _masker():
    return lambda texts: [[masked(t) for t in texts]]


def mask_secrets(df: DataFrame, text_col: str = "text") -> DataFrame:
    """`df` with the spans in its text column replaced by a mark; null texts stay null, other columns as they are."""
    name = "_masked"
    while name in df.columns:
        name += "_"
    done = with_columns(df, text_col, _masker, f"{name} string")
    text = F.when(F.col(text_col).isNotNull(), F.col(name))
    return done.withColumn(text_col, text).drop(name).select(*df.columns)
