"""Signature sniffing of media columns.

An Aho-Corasick automaton over known magic bytes scans a column of bytes once.
Each hit is only a hint: the format's validator follows lengths, chunks and
check sums from there and says where the medium ends, or that it is none. A
valid medium at the start gives the column's true type, whatever was declared;
valid media further inside are carved out, the outermost of those that overlap.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 192
RATE = 8000


class Found(NamedTuple):
    type: str
    start: int
    end: int
    detail: str


Validator = Callable[[bytes, int], "tuple[str, int, str] | None"]


def _riff(data: bytes, at: int) -> tuple[str, int, str] | None:
    if len(data) < at + 12:
        return None
    size = struct.unpack_from("<I", data, at + 4)[0]
    end = at + 8 + size
    kind = {b"WAVE": "audio/wav", b"WEBP": "image/webp", b"AVI ": "video/x-msvideo"}.get(data[at + 8 : at + 12])
    if not kind or size < 4 or end > len(data):
        return None
    k, names, detail = at + 12, [], ""
    while k + 8 <= end:
        name, n = data[k : k + 4], struct.unpack_from("<I", data, k + 4)[0]
        if k + 8 + n > end:
            return None
        if name == b"fmt " and n >= 16:
            code, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", data, k + 8)
            detail = f"codec={code};channels={channels};rate={rate};bits={bits}"
        if name == b"data":
            detail += f";data={k + 8 - at}+{n}"
        names.append(name)
        k += 8 + n + (n & 1)
    if kind == "audio/wav" and not {b"fmt ", b"data"} <= set(names):
        return None
    return (kind, end, detail) if names else None


def _png(data: bytes, at: int) -> tuple[str, int, str] | None:
    k, detail = at + 8, ""
    while k + 12 <= len(data):
        n, name = struct.unpack_from(">I", data, k)[0], data[k + 4 : k + 8]
        if k + 12 + n > len(data) or zlib.crc32(data[k + 4 : k + 8 + n]) != struct.unpack_from(">I", data, k + 8 + n)[0]:
            return None
        if name == b"IHDR":
            w, h, bits, color = struct.unpack_from(">IIBB", data, k + 8)
            detail = f"width={w};height={h};bits={bits};color={color}"
        elif not detail:
            return None
        k += 12 + n
        if name == b"IEND":
            return "image/png", k, detail
    return None


def _gif(data: bytes, at: int) -> tuple[str, int, str] | None:
    if len(data) < at + 13:
        return None
    w, h, packed = struct.unpack_from("<HHB", data, at + 6)
    k = at + 13 + (3 << (packed & 7) + 1 if packed & 128 else 0)
    frames = 0
    while k < len(data):
        mark = data[k]
        if mark == 0x3B:
            return ("image/gif", k + 1, f"width={w};height={h};frames={frames}") if frames else None
        if mark == 0x21:
            k += 2
        elif mark == 0x2C and k + 10 < len(data):
            local = data[k + 9]
            k += 11 + (3 << (local & 7) + 1 if local & 128 else 0)
            frames += 1
        else:
            return None
        while k < len(data) and data[k]:
            k += data[k] + 1
        k += 1
    return None


def _jpeg(data: bytes, at: int) -> tuple[str, int, str] | None:
    k, detail = at + 2, ""
    while k + 4 <= len(data) and data[k] == 0xFF:
        mark = data[k + 1]
        if mark == 0xD9:
            return ("image/jpeg", k + 2, detail) if detail else None
        n = struct.unpack_from(">H", data, k + 2)[0]
        if n < 2 or k + 2 + n > len(data):
            return None
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC) and n >= 7:
            h, w = struct.unpack_from(">HH", data, k + 5)
            detail = f"width={w};height={h}"
        k += 2 + n
        if mark == 0xDA:
            while True:
                k = data.find(b"\xff", k)
                if k < 0 or k + 1 >= len(data):
                    return None
                if data[k + 1] == 0 or 0xD0 <= data[k + 1] <= 0xD7:
                    k += 2
                    continue
                break
    return None


def _bmp(data: bytes, at: int) -> tuple[str, int, str] | None:
    if len(data) < at + 30:
        return None
    size, _, offset, header = struct.unpack_from("<IIII", data, at + 2)
    if header not in (12, 40, 52, 56, 108, 124) or not 14 + header <= offset <= size or at + size > len(data):
        return None
    w, h = struct.unpack_from("<ii", data, at + 18)
    return "image/bmp", at + size, f"width={w};height={abs(h)}"


def _pdf(data: bytes, at: int) -> tuple[str, int, str] | None:
    version = data[at + 5 : at + 8]
    if len(version) < 3 or not version[:1].isdigit() or version[1:2] != b"." or not version[2:].isdigit():
        return None
    following = data.find(b"%PDF-", at + 5)
    end = data.rfind(b"%%EOF", at, following if following > 0 else len(data))
    if end < 0 or data.rfind(b"startxref", at, end) < 0:
        return None
    return "application/pdf", end + 5, f"version={version.decode()}"


def _zip(data: bytes, at: int) -> tuple[str, int, str] | None:
    k = data.find(b"PK\x05\x06", at)
    while k >= 0 and k + 22 <= len(data):
        entries, size, offset, note = struct.unpack_from("<HIIH", data, k + 10)
        if at + offset + size == k and (not entries or data[at + offset : at + offset + 4] == b"PK\x01\x02") and k + 22 + note <= len(data):
            return "application/zip", k + 22 + note, f"entries={entries}"
        k = data.find(b"PK\x05\x06", k + 4)
    return None


def _gzip(data: bytes, at: int) -> tuple[str, int, str] | None:
    if len(data) < at + 18 or data[at + 3] & 0xE0:
        return None
    stream, k, size = zlib.decompressobj(31), at, 0
    try:
        while not stream.eof and k < len(data):
            piece = stream.unconsumed_tail or data[k : k + 65536]
            if not stream.unconsumed_tail:
                k += len(piece)
            size += len(stream.decompress(piece, 1 << 20))
    except zlib.error:
        return None
    return ("application/gzip", k - len(stream.unused_data), f"size={size}") if stream.eof else None


def _ogg(data: bytes, at: int) -> tuple[str, int, str] | None:
    k, pages = at, 0
    while data[k : k + 5] == b"OggS\x00" and k + 27 <= len(data):
        table = data[k + 27 : k + 27 + data[k + 26]]
        end = k + 27 + data[k + 26] + sum(table)
        if end > len(data):
            return None
        last = data[k + 5] & 4
        k, pages = end, pages + 1
        if last:
            return "audio/ogg", k, f"pages={pages}"
    return None


def _mp4(data: bytes, at: int) -> tuple[str, int, str] | None:
    k, boxes = at, 0
    while k + 8 <= len(data):
        n, name = struct.unpack_from(">I", data, k)[0], data[k + 4 : k + 8]
        if n < 8 or k + n > len(data) or not name.isalnum():
            break
        k, boxes = k + n, boxes + 1
    return ("video/mp4", k, f"boxes={boxes}") if boxes > 1 else None


def _flac(data: bytes, at: int) -> tuple[str, int, str] | None:
    k, blocks = at + 4, 0
    while k + 4 <= len(data):
        last, n = data[k] & 128, int.from_bytes(data[k + 1 : k + 4], "big")
        if (blocks == 0 and (data[k] & 127 or n != 34)) or k + 4 + n > len(data):
            return None
        k, blocks = k + 4 + n, blocks + 1
        if last:
            return ("audio/flac", len(data), f"blocks={blocks}") if data[k : k + 1] == b"\xff" else None
    return None


# fixed values: magic bytes of the formats, and how far into the medium they lie
_MAGIC: list[tuple[bytes, int, Validator]] = [
    (b"RIFF", 0, _riff),
    (b"\x89PNG\r\n\x1a\n", 0, _png),
    (b"GIF87a", 0, _gif),
    (b"GIF89a", 0, _gif),
    (b"\xff\xd8\xff", 0, _jpeg),
    (b"BM", 0, _bmp),
    (b"%PDF-", 0, _pdf),
    (b"PK\x03\x04", 0, _zip),
    (b"\x1f\x8b\x08", 0, _gzip),
    (b"OggS", 0, _ogg),
    (b"ftyp", 4, _mp4),
    (b"fLaC", 0, _flac),
]

_AUTOMATON = ahocorasick.Automaton()
for _k, (_bytes, _, _) in enumerate(_MAGIC):
    _AUTOMATON.add_word(_bytes.decode("latin-1"), _k)
_AUTOMATON.make_automaton()


def sniff(data: bytes) -> tuple[Found | None, list[Found], int]:
    """The medium that ``data`` is, the media inside that are not part of another one inside, and the number of hits that proved none."""
    whole: Found | None = None
    inside: list[Found] = []
    wrong = 0
    for last, k in _AUTOMATON.iter(data.decode("latin-1")):
        magic, offset, valid = _MAGIC[k]
        start = last + 1 - len(magic) - offset
        if start < 0 or (inside and start < inside[-1].end):
            continue
        found = valid(data, start)
        if not found:
            wrong += 1
        elif start == 0 and whole is None:
            whole = Found(found[0], 0, found[1], found[2])
        else:
            inside.append(Found(found[0], start, found[1], found[2]))
    return whole, inside, wrong


def payload(text: str | None) -> tuple[bytes, int]:
    """The text's bytes, filled up with spaces to a positive multiple of BLOCK, and their number before."""
    raw = (text or "").encode()
    return raw.ljust(max(BLOCK, -(-len(raw) // BLOCK) * BLOCK)), len(raw)


def store_wav(samples: bytes) -> bytes:
    """``samples`` as a mono WAV of 8 bits a sample."""
    fill = len(samples) & 1
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples) + fill, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(samples))
    return head + samples + b"\0" * fill


def read_wav(stored: bytes, found: Found) -> bytes:
    """The samples of a WAV that :func:`sniff` has found."""
    start, size = found.detail.rpartition("data=")[2].split("+")
    at = found.start + int(start)
    return stored[at : at + int(size)]


_TYPES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, declared_type string, media_type string, feature string, carved array<struct<type:string,start:long,end:long>>, media binary"
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_sha256", pa.string()),
        ("tail_crc32", pa.int64()),
        ("media_bytes", pa.int64()),
        ("media_sha256", pa.string()),
        ("declared_type", pa.string()),
        ("media_type", pa.string()),
        ("feature", pa.string()),
        ("carved", pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("media", pa.binary()),
    ]
)


def _feature(found: Found, inside: list[Found], wrong: int) -> str:
    carved = ",".join(f"{x.type}@{x.start}-{x.end}" for x in inside)
    return f"{found.type};{found.detail};false_signatures={wrong};carved={carved or 'none'}"


def store_texts(docs: DataFrame, declared_type: str = "application/octet-stream", with_media: bool = True) -> DataFrame:
    """Texts as sampled media, read back from their stored bytes by signature.

    Per row: id, size before and after filling up, hashes of what was read
    back and of the stored form, the type declared and the one found, the
    features and carved media, and the stored bytes (null unless asked for).
    Null texts are empty; null ids stay; rows that repeat give rows that
    repeat; an empty table gives an empty table. Only doc_id and text are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    filled, n = payload(text)
                    stored = store_wav(filled)
                    found, inside, wrong = sniff(stored)
                    if found is None:
                        raise ValueError(f"the stored form of document {doc_id} is not a medium")
                    back = read_wav(stored, found)
                    carved = [{"type": x.type, "start": x.start, "end": x.end} for x in inside]
                    rows.append((doc_id, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), declared_type, found.type, _feature(found, inside, wrong), carved, stored if with_media else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * len(_SCHEMA), _SCHEMA.types, strict=True)], schema=_SCHEMA)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _TYPES)


def sniff_column(df: DataFrame, column: str, declared: str | None = None) -> DataFrame:
    """``df`` with ``media_type``, ``type_corrected`` and ``carved`` for a binary column.

    The type is that of a valid medium that starts with the bytes, null if
    there is none; it is a correction where ``declared``, a column of types,
    says otherwise. ``carved`` has type, start, end and bytes of media inside.
    Null bytes have no type and nothing inside. Columns of these names are
    replaced.
    """
    kind = "struct<media_type:string,carved:array<struct<type:string,start:long,end:long,bytes:binary>>>"
    arrow = pa.struct([("media_type", pa.string()), ("carved", pa.list_(pa.struct([("type", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("bytes", pa.binary())])))])

    @F.arrow_udf(kind)
    def look(values: pa.Array) -> pa.Array:
        out = []
        for data in values.to_pylist():
            found, inside, _ = sniff(data or b"")
            out.append({"media_type": found.type if found else None, "carved": [{"type": x.type, "start": x.start, "end": x.end, "bytes": data[x.start : x.end]} for x in inside]})
        return pa.array(out, arrow)

    seen = df.withColumn("_seen", look(F.col(column)))
    said = F.col(declared) if declared else F.lit(None).cast("string")
    seen = seen.withColumn("media_type", F.col("_seen.media_type")).withColumn("carved", F.col("_seen.carved"))
    return seen.withColumn("type_corrected", F.coalesce(F.col("media_type") != said, F.lit(False))).drop("_seen")
