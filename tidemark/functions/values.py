"""Numbers, dates, colours, URLs and hashes as column expressions. Nothing reads the clock; `now` is a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Seoul"  # source dates without a zone are in this one

# Query keys that tell one file from another, and colour names.
IDENTITY_KEYS = ("attach_id", "attach_no", "attachid", "attachno", "file_id", "file_no", "file_seq", "fileid", "fileno", "fileseq", "sg")
COLOURS = {"black": "000000", "white": "ffffff", "red": "ff0000", "blue": "0000ff", "green": "008000", "yellow": "ffff00", "orange": "ffa500", "purple": "800080", "pink": "ffc0cb", "gray": "808080", "grey": "808080", "brown": "a52a2a"}
#: Upper hue in degrees of each named colour; from the last one on it is red again.
HUES = ((20, "red"), (45, "orange"), (65, "yellow"), (150, "green"), (250, "blue"), (290, "purple"), (345, "pink"))


def digits_int(c: Column) -> Column:
    """The digits of a text as a number: null without any, with over 18, or from a text of over 128 characters."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    return F.when((F.length(c) <= 128) & F.length(digits).between(1, 18), digits.try_cast("bigint"))


def whole_number(c: Column, default: int = 0) -> Column:
    """Rounded up, not negative; the default for what is no finite number."""
    x = c.try_cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(default).cast("bigint")).otherwise(F.greatest(F.lit(0).cast("bigint"), F.ceil(x).cast("bigint")))


def iso(c: Column) -> Column:
    """A timestamp as ISO text in the source's zone."""
    return F.concat(F.date_format(F.from_utc_timestamp(c, ZONE), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))


def source_date(c: Column) -> Column:
    """`YYYY-MM-DD` or with dots, and perhaps a time, or at least 8 or 14 digits: a timestamp, null if there is none such."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    full, day = F.length(digits) >= 14, F.length(digits) >= 8
    part = lambda at, n: F.substring(digits, at, n).try_cast("int")
    time = lambda at: F.when(full, part(at, 2)).otherwise(F.lit(0))
    made = F.try_make_timestamp(part(1, 4), part(5, 2), part(7, 2), time(9), time(11), time(13).cast("decimal(8,6)"), F.lit(ZONE))
    return F.when(day & (~full | ((time(13) < 60) & (time(11) < 60))), made)


def retry_after(c: Column, now: Column) -> Column:
    """Seconds to wait, between none and a week, from a number or from a date of HTTP's form."""
    x = F.trim(c).try_cast("double")
    day = r"^(?:[A-Za-z]{3,9}, *)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2})(?: *(?:GMT|UTC|([+-]\d{4})))?$"
    zone = F.coalesce(F.nullif(F.regexp_extract(F.trim(c), day, 2), F.lit("")), F.lit("+0000"))
    at = F.try_to_timestamp(F.concat_ws(" ", F.nullif(F.regexp_extract(F.trim(c), day, 1), F.lit("")), zone), F.lit("d MMM yyyy HH:mm:ss Z"))
    x = F.coalesce(F.when(~F.isnan(x), x), (F.unix_micros(at) - F.unix_micros(now)) / 1e6)
    return F.when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(604800.0), x)))


def css_colour(c: Column) -> Column:
    """A colour name, `#rgb`, `#rrggbb` or `rgb(r, g, b)` as one of nine names, null for anything else."""
    raw = F.lower(F.trim(c))
    named = F.create_map(*[F.lit(x) for kv in COLOURS.items() for x in kv])
    short = F.regexp_extract(raw, "^#([0-9a-f]{3})$", 1)
    hexed = F.coalesce(F.try_element_at(named, raw), F.nullif(F.regexp_extract(raw, "^#([0-9a-f]{6})$", 1), F.lit("")), F.nullif(F.regexp_replace(short, "(.)", "$1$1"), F.lit("")))
    told = [F.conv(F.substring(hexed, i, 2), 16, 10).cast("int") for i in (1, 3, 5)]
    number = [F.regexp_extract(raw, rf"^rgba?\(\s*{r'[0-9.]+[,\s/]+' * i}([0-9.]+)", 1).try_cast("double") for i in range(3)]
    given = [F.floor(F.when(x > 255, 255.0).otherwise(x)).cast("int") for x in number]
    r, g, b = (F.coalesce(x, y) / 255.0 for x, y in zip(told, given, strict=True))
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    light, d = (top + low) / 2, top - low
    sat = F.when(d == 0, 0.0).otherwise(d / F.when(light > 0.5, 2.0 - top - low).otherwise(top + low))
    hue = 60 * F.when(d == 0, 0.0).when(top == r, (g - b) / d + F.when(g < b, 6.0).otherwise(0.0)).when(top == g, (b - r) / d + 2.0).otherwise((r - g) / d + 4.0)
    name = F.lit("red")
    for upper, colour in reversed(HUES):
        name = F.when(hue < upper, F.lit(colour)).otherwise(name)
    return F.when(r.isNull() | g.isNull() | b.isNull(), F.lit(None)).when(sat < 0.15, F.when(light < 0.35, F.lit("default")).otherwise(F.lit("gray"))).otherwise(name)


def identity_url(url: Column) -> Column:
    """Scheme, host and path, with only the query keys that tell files apart, lower-cased and sorted; no fragment."""
    bare = F.regexp_replace(url, "#.*$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1))).isin(*IDENTITY_KEYS))
    pairs = F.array_sort(F.transform(pairs, lambda p: F.concat(F.lower(F.split_part(p, F.lit("="), F.lit(1))), F.lit("="), F.regexp_extract(p, "=(.*)$", 1))))
    base = F.regexp_replace(bare, r"\?.*$", "")
    head = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    kept = F.array_join(pairs, "&")
    return F.concat(F.lower(head), F.substring(base, F.length(head) + 1, F.length(base)), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(F.lit("")))


def allowed_host(host: Column, domains: list[str]) -> Column:
    """Equal to one of the domains, or below it."""
    h = F.rtrim(F.lower(F.trim(host)), F.lit("."))
    return F.coalesce(F.exists(F.array(*map(F.lit, domains)), lambda d: (h == d) | h.endswith(F.concat(F.lit("."), d))), F.lit(False))


def fingerprint(*fields: Column) -> Column:
    """SHA-256 over the fields in the order given, kept apart by NUL; null differs from empty."""
    return F.sha2(F.concat_ws("\0", *(F.coalesce(F.concat(F.lit("="), f.cast("string")), F.lit("-")) for f in fields)), 256)


def hash_bucket(key: Column, buckets: int = 7) -> Column:
    """The first 32 bits of the key's SHA-256, modulo the number of buckets."""
    return (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint") % buckets).cast("int")


def same_minute(a: Column, b: Column) -> Column:
    return F.date_trunc("minute", a).eqNullSafe(F.date_trunc("minute", b))
