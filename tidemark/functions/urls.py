"""Addresses and links in texts. The functions that end in `_one`, and `split_links`, say the rules in plain Python; the tests hold
the column functions to them."""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterator
from urllib.parse import parse_qsl, quote, urlencode, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import WS, strip
from .values import allowed_host

# Query keys that say nothing of what an address is of.
DROPPED = frozenset({"page", "ref", "utm_source", "utm_medium", "utm_campaign"})
LINK = re.compile(r"https?://[^\s<>\"']+|www\.[^\s<>\"']+")


def canonical_one(url: str | None, hosts: tuple[str, ...] = ()) -> str | None:
    """https, lower host, default port, sorted query without the dropped keys, no fragment; null for anything else."""
    try:
        p = urlsplit((url or "").strip())
        port = p.port
    except ValueError:
        return None
    host = (p.hostname or "").lower()
    if p.scheme not in ("http", "https") or not host or p.username or port not in (None, 80, 443) or len(url) > 8192:
        return None
    if hosts and not any(host == h or host.endswith("." + h) for h in hosts):
        return None
    query = sorted((k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k not in DROPPED)
    return urlunsplit(("https", host, quote(p.path or "/", safe="/%:@!$&'()*+,;=~-._"), urlencode(query), ""))


ADDRESS = r"(?is)^(https?)://(?:([^/?#@]*)@)?(\[[^\]]*\]|[^/?#:@]*)(?::([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
#: Characters of a path that stand as they are, beside letters, digits and `-._`.
PLAIN = "/:@!$&'()*+,;=~"


def canonical(url: Column, hosts: tuple[str, ...] = ()) -> Column:
    """What `canonical_one` gives, by column functions. A query's escapes that are none are taken as they stand, a pair as a
    whole."""
    u = F.regexp_replace(strip(url), "[\t\r\n]", "")
    part = lambda i: F.regexp_extract(u, ADDRESS, i)
    host, port, path = F.lower(F.regexp_replace(part(3), r"[\[\]]", "")), part(4), F.coalesce(F.nullif(part(5), F.lit("")), F.lit("/"))
    told = lambda x: F.coalesce(F.try_url_decode(x), x)
    pairs = F.transform(F.filter(F.split(part(6), "&"), lambda x: x != ""), lambda x: F.struct(told(F.split_part(x, F.lit("="), F.lit(1))).alias("k"), told(F.regexp_extract(x, "=(.*)$", 1)).alias("v")))
    spelt = lambda x: F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    query = F.array_join(F.transform(F.array_sort(F.filter(pairs, lambda p: ~p["k"].isin(*DROPPED))), lambda p: F.concat(spelt(p["k"]), F.lit("="), spelt(p["v"]))), "&")
    for mark, to in ((" ", "%20"), *((c, c) for c in PLAIN), ("%", "%")):  # a blank is written as plus; the sign of escapes comes last
        path = F.url_encode(path) if mark == " " else path
        path = F.replace(path, F.lit("+" if mark == " " else f"%{ord(mark):02X}"), F.lit(to))
    good = u.rlike(ADDRESS) & (host != "") & (part(2) == "") & ((port == "") | port.try_cast("int").isin(80, 443)) & (F.length(url) <= 8192)
    good = good & allowed_host(host, list(hosts)) if hosts else good
    return F.when(good, F.concat(F.lit("https://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))))


def list_address(host: Column, source: Column, page: int) -> Column:
    return F.concat(F.lit("https://"), host, F.lit("/list?configFk="), source, F.lit(f"&page={page}"))


def detail_address(host: Column, source: Column, item: Column) -> Column:
    return F.concat(F.lit("https://"), host, F.lit("/"), source, F.lit("/"), item)


def official(url: Column, form: str) -> Column:
    """Source and item of an address that is of a form as a whole, told by the form's two groups; nulls for any other."""
    whole = url.rlike(f"^{form}$") & ~url.rlike("[\\r\\n]")
    return F.struct(*(F.when(whole, F.regexp_extract(url, f"^{form}$", i)).alias(name) for i, name in ((1, "source"), (2, "item"))))


def is_public(address: str | None) -> bool:
    try:
        return ipaddress.ip_address(address or "").is_global
    except ValueError:
        return False


@F.pandas_udf(T.BooleanType())
def public_address(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """FLT-08: whether an address is of the public network."""
    for s in batches:
        yield s.map(is_public).astype(bool)


def split_links(text: str | None) -> list[dict]:
    """A text as parts with and without a link; closing punctuation belongs to the text after a link."""
    out, at, text = [], 0, text or ""
    for m in LINK.finditer(text):
        link = m[0].rstrip(").,;]")
        if m.start() > at:
            out.append({"text": text[at : m.start()], "link": None})
        out.append({"text": link, "link": link if link.startswith("http") else "https://" + link})
        at = m.start() + len(link)
    return out + ([{"text": text[at:], "link": None}] if at < len(text) else [])


#: A link up to its last character that is no closing punctuation; and two marks that no text has.
WHOLE_LINK = f"https?://(?=[^{WS[1:-1]}<>\"'])(?:[^{WS[1:-1]}<>\"']*[^{WS[1:-1]}<>\"').,;\\]])?|www\\.[^{WS[1:-1]}<>\"']*[^{WS[1:-1]}<>\"').,;\\]]"
OPEN, CLOSE = "\ufdd0", "\ufdd1"


def text_with_links(text: Column) -> Column:
    """STR-05: a text as parts (text, link), a link being null or an address; what `split_links` gives, by column functions."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), f"({WHOLE_LINK})", f"{OPEN}$1{CLOSE}")
    parts = F.filter(F.split(marked, f"(?={OPEN})|{CLOSE}"), lambda x: x != "")
    bare = lambda x: F.replace(x, F.lit(OPEN), F.lit(""))
    link = lambda x: F.when(x.startswith(OPEN), F.when(bare(x).startswith("http"), bare(x)).otherwise(F.concat(F.lit("https://"), bare(x))))
    return F.transform(parts, lambda x: F.struct(bare(x).alias("text"), link(x).alias("link")))
