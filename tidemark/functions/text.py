"""Text rules as column expressions. White space is Unicode's, spelt out, since neither engine's \\s covers it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that counts, and where lines end.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
NO_LINE_END = r"[^\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"

# Forms of an id in a text, tried in this order.
DETAIL_IDS = (r"detail/(\d+)", r"(?i)detail\(\s*['\"]?(\d+)", r"(?i)[?&](?:pkId|id|no)=(\d+)", r"(?i)data-(?:id|no)=['\"]?(\d+)")

# Names whose values are masked, where a space stands for `_`, `-` or nothing; names whose whole line is; how
# the tokens of known services begin, with how many characters follow at least.
SENSITIVE_NAMES = ("password", "passwd", "passphrase", "secret", "token", "signature", "sig", "api key", "access key", "private key", "request id", "database id", "data source id", "page id")
LINE_NAMES = ("authorization", "cookie")
TOKEN_HEADS = {"secret_": 8, "ntn_": 8, "github_pat_": 8, "ghp_": 8, "gho_": 8, "ghu_": 8, "ghs_": 8, "ghr_": 8, "sk-": 8, "AKIA": 12}


def _value_of(names: tuple[str, ...], bare: str) -> tuple[str, str]:
    """A rule for what is assigned to such a name: all between quotes, escaped ones included, else what `bare` matches."""
    words = "|".join(n.replace(" ", "[_-]?") for n in names)
    quoted = "|".join(rf"({q})(?:\\.|[^{q}\\\r\n])*{q}" for q in ("\"", "'"))
    return rf"(?i)((?:{words})[\"']?\s*[:=]\s*)(?:{quoted}|{bare})", "$1$2$3[REDACTED]$2$3"


#: What is masked, in this order, and by what: addresses to host and path, values by name, tokens by form, ids.
REDACTIONS = (
    (r"https?://(?:[^\s/@]*@)?([^\s/?#\"'<>]+)([^\s?#\"'<>]*)[^\s\"'<>]*", "$1$2"),
    _value_of(LINE_NAMES, r"[^\r\n]+"),
    _value_of(SENSITIVE_NAMES, r"[\"']?[^\s\"',;&}\]]+"),
    (r"(?i)\bbearer\s+[\w.~+/=-]{8,}", "[REDACTED]"),
    (r"\b(?:" + "|".join(rf"{head}[\w-]{{{least},}}" for head, least in TOKEN_HEADS.items()) + ")", "[REDACTED]"),
    (r"\beyJ[\w-]{8,}(?:\.[\w-]+){1,2}", "[REDACTED]"),
    (r"\b[0-9a-fA-F]{8}-?(?:[0-9a-fA-F]{4}-?){3}[0-9a-fA-F]{12}\b", "[ID]"),
)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), f"{WS}+", " "))


def title_key(c: Column) -> Column:
    return F.lower(squeeze(c))


def first_line(c: Column) -> Column:
    """The first line that is not blank, or empty."""
    return strip(F.regexp_extract(F.coalesce(c, F.lit("")), f"^{WS}*({NO_LINE_END}*)", 1))


def title_label(c: Column, default: str = "general") -> Column:
    """A leading `[label]`, with commas as slashes and single ones, or the default."""
    label = strip(F.regexp_extract(c, rf"^{WS}*\[([^\]]+)\]", 1))
    label = F.regexp_replace(F.regexp_replace(F.replace(label, F.lit(","), F.lit("/")), f"{WS}*/{WS}*", "/"), "/{2,}", "/")
    return F.coalesce(F.nullif(strip(F.regexp_replace(label, f"{WS}+", " ")), F.lit("")), F.lit(default))


def title_or_fallback(title: Column, body: Column, key: Column, date: Column) -> Column:
    """Own title, else the first body line, else one made of the id, else of the date, else a constant."""
    none = F.lit("")
    return F.coalesce(F.nullif(squeeze(title), none), F.nullif(first_line(body), none), F.concat(F.lit("untitled-"), F.nullif(strip(key), none)), F.concat(F.lit("untitled-"), F.nullif(F.left(date, F.lit(10)), none)), F.lit("untitled"))


def detail_id(c: Column) -> Column:
    return F.coalesce(*(F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in DETAIL_IDS))


def redact(c: Column) -> Column:
    for pattern, to in REDACTIONS:
        c = F.regexp_replace(c, pattern, to)
    return c


def sanitize(c: Column, limit: int = 500) -> Column:
    """Without control characters, redacted, squeezed and cut to a length."""
    return F.left(squeeze(redact(F.regexp_replace(F.coalesce(c, F.lit("")), CONTROL, ""))), F.lit(limit))


def chunks(c: Column, size: int = 1900) -> Column:
    """The text in pieces of so many characters; none for an empty one."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(c) - 1, F.lit(0)), F.lit(size))
    return F.when(F.length(c) > 0, F.transform(starts, lambda i: F.substring(c, i + 1, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def filename_from_url(url: Column, fallback: str = "file") -> Column:
    """The last part of the path, else the first of the usual query keys, else the fallback."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]*(?:/[^?#]*)?/([^/?#]+)", 1)
    keys = [F.regexp_extract(url, rf"(?i)[?&]{k}=([^&#]+)", 1) for k in ("filename", "file", "name", "sg")]
    return F.coalesce(*(F.try_url_decode(F.nullif(x, F.lit(""))) for x in [path, *keys]), F.lit(fallback))


def truncate_utf8(c: Column, size: int = 900) -> Column:
    """At most so many bytes, cut between characters, with the extension kept."""
    ext = F.regexp_extract(c, r"(\.[A-Za-z0-9]{1,16})$", 1)
    stem = F.substring(c, F.lit(1), F.length(c) - F.length(ext))
    room = F.lit(size) - F.octet_length(ext)
    # the longest prefix that fits: a character has one to four bytes, told by its code point
    sizes = F.transform(F.split(stem, ""), lambda x: F.octet_length(x))
    fits = F.aggregate(sizes, F.struct(F.lit(0).alias("b"), F.lit(0).alias("n")), lambda a, x: F.struct((a.b + x).alias("b"), (a.n + (a.b + x <= room).cast("int")).alias("n")), lambda a: a.n)
    return F.when(F.octet_length(c) <= size, c).otherwise(F.concat(F.substring(stem, F.lit(1), fits), ext))
