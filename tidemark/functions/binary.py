"""What kind of file some bytes are, by their own evidence, and whether that fits the name they came under."""

from __future__ import annotations

import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# First bytes by kind, and which extensions a kind may have.
MAGIC = ((b"\x89PNG\r\n\x1a\n", "png"), (b"\xff\xd8\xff", "jpeg"), (b"GIF87a", "gif"), (b"GIF89a", "gif"), (b"BM", "bmp"), (b"%PDF-", "pdf"), (b"PK\x03\x04", "zip"), (b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "ole"), (b"Rar!\x1a\x07\x00", "rar"), (b"Rar!\x1a\x07\x01\x00", "rar"), (b"7z\xbc\xaf\x27\x1c", "7z"))
EXTENSIONS = {"png": ("png",), "jpeg": ("jpg", "jpeg"), "gif": ("gif",), "bmp": ("bmp",), "webp": ("webp",), "pdf": ("pdf",), "zip": ("zip",), "docx": ("docx",), "xlsx": ("xlsx",), "pptx": ("pptx",), "hwpx": ("hwpx",), "doc": ("doc",), "xls": ("xls",), "ppt": ("ppt",), "hwp": ("hwp",), "rar": ("rar",), "7z": ("7z",), "text": ("txt", "csv")}
STREAMS = {"WordDocument": "doc", "Workbook": "xls", "Book": "xls", "PowerPoint Document": "ppt", "FileHeader": "hwp"}
RATIO, UNPACKED = 200, 200 << 20


def _zip_kind(data: bytes) -> str | None:
    """zip, or the office format in it; none for unsafe paths, encryption, or contents that swell too far."""
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            items = z.infolist()
            size, packed = sum(i.file_size for i in items), sum(i.compress_size for i in items)
            names = [i.filename for i in items]
            unsafe = any(n.startswith("/") or ".." in n.split("/") or "\\" in n for n in names) or any(i.flag_bits & 1 for i in items)
            if unsafe or size > UNPACKED or size > RATIO * max(1, packed) or len(set(names)) < len(names):
                return None
            if "mimetype" in names and z.read("mimetype")[:64].strip() == b"application/hwp+zip":
                return "hwpx"
    except (zipfile.BadZipFile, RuntimeError, NotImplementedError, zlib.error, EOFError):
        return None
    if "[Content_Types].xml" in names:
        return next((k for p, k in (("word/", "docx"), ("xl/", "xlsx"), ("ppt/", "pptx")) if any(n.startswith(p) for n in names)), None)
    return "zip"


def ole_streams(data: bytes) -> list[str] | None:
    """Names in the directory of a compound file, walked over its allocation table with all bounds checked."""
    if len(data) < 512 or struct.unpack_from("<H", data, 28)[0] != 0xFFFE:
        return None
    shift, n_fat, first = struct.unpack_from("<H", data, 30)[0], struct.unpack_from("<I", data, 44)[0], struct.unpack_from("<I", data, 48)[0]
    if shift not in (9, 12) or not 0 < n_fat < len(data) >> shift:
        return None
    size, fat = 1 << shift, []
    places, (more, n_more) = list(struct.unpack_from("<109I", data, 76)), struct.unpack_from("<2I", data, 68)
    chain: set[int] = set()
    while len(places) < n_fat:  # the header has 109 places of the table's sectors; a chain of sectors has the others
        at = (more + 1) * size
        if more in chain or len(chain) >= n_more or at + size > len(data):
            return None
        chain.add(more)
        *own, more = struct.unpack_from(f"<{size // 4}I", data, at)
        places += own
    for s in places[:n_fat]:
        at = (s + 1) * size
        if at + size > len(data):
            return None
        fat += struct.unpack_from(f"<{size // 4}I", data, at)
    names, sector, seen = [], first, set()
    while sector < 0xFFFFFFFA:
        at = (sector + 1) * size
        if sector in seen or sector >= len(fat) or at + size > len(data):
            return None
        seen.add(sector)
        for e in range(at, at + size, 128):
            n, kind = struct.unpack_from("<H", data, e + 64)[0], data[e + 66]
            if kind and 2 <= n <= 64:
                names.append(data[e : e + n - 2].decode("utf-16-le", "replace"))
        sector = fat[sector]
    return names


def _crc_ok(data: bytes, kind: str) -> bool:
    """The header checksum of RAR 4, RAR 5 and 7z."""
    if kind == "7z":
        return len(data) >= 32 and zlib.crc32(data[12:32]) == struct.unpack_from("<I", data, 8)[0]
    if data[6] == 0:
        size = struct.unpack_from("<H", data, 12)[0] if len(data) >= 14 else 0
        return size >= 13 and len(data) >= 7 + size and zlib.crc32(data[9 : 7 + size]) & 0xFFFF == struct.unpack_from("<H", data, 7)[0]
    n = i = 0
    while i < 3 and 12 + i < len(data):
        n |= (data[12 + i] & 127) << (7 * i)
        i += 1
        if data[11 + i] < 128:
            break
    end = 12 + i + n
    return len(data) >= end and n > 0 and zlib.crc32(data[12:end]) == struct.unpack_from("<I", data, 8)[0]


def _text(data: bytes) -> bool:
    for code in ("utf-8-sig", "cp949"):
        try:
            x = data.decode(code)
        except UnicodeDecodeError:
            continue
        return not any(ord(c) < 32 and c not in "\t\r\n" or c == "\x7f" for c in x)
    return False


def sniff(data: bytes | None) -> str | None:
    """The kind that the bytes prove; none if they prove none, or are broken or dressed up as something else."""
    if not data:
        return None
    kind = next((k for m, k in MAGIC if data.startswith(m)), "webp" if data[:4] == b"RIFF" and data[8:12] == b"WEBP" else None)
    if kind == "png":
        return kind if data.endswith(b"IEND\xaeB`\x82") else None
    if kind == "jpeg":
        return kind if data.endswith(b"\xff\xd9") else None
    if kind == "gif":
        return kind if data.endswith(b";") else None
    if kind == "bmp":
        return kind if len(data) > 26 and struct.unpack_from("<I", data, 2)[0] == len(data) else None
    if kind == "webp":
        return kind if struct.unpack_from("<I", data, 4)[0] + 8 == len(data) else None
    if kind == "pdf":
        return kind if b"%%EOF" in data[-1024:] and b"PK\x03\x04" not in data[:1024] else None
    if kind == "zip":
        return _zip_kind(data)
    if kind == "ole":
        found = {STREAMS[n] for n in ole_streams(data) or () if n in STREAMS}
        return found.pop() if len(found) == 1 else None
    if kind in ("rar", "7z"):
        return kind if _crc_ok(data, kind) else None
    return "text" if _text(data) and not data.lstrip()[:256].lower().startswith((b"<svg", b"<!doctype", b"<html")) else None


def file_kind(content: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(sniff)

    return F.pandas_udf(run, "string")(content)


def fits_name(kind: Column, name: Column) -> Column:
    """Whether the proven kind is one that the name's extension stands for."""
    known = F.create_map(*[x for k, v in EXTENSIONS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.coalesce(F.array_contains(F.try_element_at(known, kind), F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))), F.lit(False))
