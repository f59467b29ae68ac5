"""SQL expressions for the check, written apart from the library so that each side tests the other."""

from __future__ import annotations

TAG = r"</?[A-Za-z][^>]*>|<[!?][^>]*>"
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def rep(x: str, pattern: str, new: str = "") -> str:
    return f"regexp_replace({x}, '{pattern.replace(chr(39), chr(39) * 2)}', '{new}', 'g')"


def strip(x: str) -> str:
    return rep(x, f"^{WS}+|{WS}+$")


def collapse(x: str) -> str:
    return f"trim({rep(x, WS + '+', ' ')})"


def decode(x: str) -> str:
    for entity, char in (
        ("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "''"),
        ("&nbsp;", " "), ("&amp;", "&"),
    ):
        x = f"replace({x}, '{entity}', '{char}')"
    return x


def clean(x: str = "html") -> str:
    return rep(x, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->")


def plain(x: str) -> str:
    return collapse(decode(rep(x, TAG, " ")))


def markdown(x: str) -> str:
    x = rep(x, r"(?is)<head\b.*?</head>")
    for n in range(1, 7):
        x = rep(x, rf"(?is)<h{n}\b[^>]*>(.*?)</h{n}>", "\n\n" + "#" * n + r" \1" + "\n\n")
    x = rep(x, r'(?is)<img\b[^>]*\balt="([^"]*)"[^>]*\bsrc="([^"]*)"[^>]*>', r"![\1](\2)")
    x = rep(x, r'(?is)<img\b[^>]*\bsrc="([^"]*)"[^>]*>', r"![](\1)")
    x = rep(x, r'(?is)<a\b[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>', r"[\2](\1)")
    x = rep(x, r"(?i)<li\b[^>]*>", "\n- ")
    x = rep(x, r"(?is)<(?:b|strong)>([^<]*)</(?:b|strong)>", r"**\1**")
    x = rep(x, r"(?is)<(?:i|em)>([^<]*)</(?:i|em)>", r"*\1*")
    x = rep(x, r"(?i)<br\s*/?>", "\n")
    x = rep(x, r"(?i)</?(?:td|th)\b[^>]*>", " ")
    x = rep(
        x, r"(?i)</?(?:p|div|ul|ol|nav|article|footer|section|header|main|table|tr|dt|dd|pre|blockquote|figure|form)\b[^>]*>",
        "\n\n",
    )
    x = decode(rep(x, TAG))
    x = rep(rep(rep(x, r"[ \t]+", " "), r" ?\n ?", "\n"), r"\n{3,}", "\n\n")
    return rep(x, r"^\s+|\s+$")


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def title(x: str) -> str:
    return f"nullif({collapse(decode(f'regexp_extract({x}, {chr(39)}(?is)<title[^>]*>(.*?)</title>{chr(39)}, 1)'))}, '')"


def snake(x: str) -> str:
    # API keys with a set snake_case name.
    known = {
        "sourceURL": "source_url", "statusCode": "status_code", "scrapeId": "scrape_id",
        "creditsUsed": "credits_used", "cacheState": "cache_state", "rawHtml": "raw_html",
        "extractMainContent": "extract_main_content", "skipCache": "skip_cache", "jsonOptions": "json_options",
    }
    whens = " ".join(f"when {x} = '{k}' then '{v}'" for k, v in known.items())
    words = rep(x, r"(.)([A-Z][a-z]+)", r"\1_\2")
    return (
        f"case {whens} when contains({x}, '_') and lower({x}) = {x} then {x} "
        f"else lower({rep(words, r'([a-z0-9])([A-Z])', chr(92) + '1_' + chr(92) + '2')}) end"
    )


EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
SECRET = (
    r"""(?i:password|passwd|secret|token|api_key|api-key|apikey)["']? {0,3}[:=] {0,3}["']?[-+/_.=$!@#%^&*A-Za-z0-9]{6,}["']?"""
    r"|Bearer [-+/_.=~A-Za-z0-9]{16,}|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[opsru]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z]{20,}"
)
CARD = r"\b(?:\d[- ]?){12,18}\d\b"
PHONE = r"\+[1-9]\d{0,2}[- .]?(?:\(\d{1,4}\)[- .]?)?\d{2,4}(?:[- .]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[-.]\d{4}"
LOOSE_PHONE = PHONE + r"|\b\d{3}[- .]\d{3}[- .]\d{4}\b"


def quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def luhn(x: str) -> str:
    """Whether the digits pass the check: from the right, every second one is doubled."""
    digits = f"list_reverse(string_split(regexp_replace({x}, '[- ]', '', 'g'), ''))"
    digit = f"cast({digits}[i] as int)"
    return (
        f"list_sum(list_transform(range(1, len({digits}) + 1), lambda i: case when i % 2 = 0 "
        f"then ({digit} * 2) // 10 + ({digit} * 2) % 10 else {digit} end)) % 10 = 0"
    )
