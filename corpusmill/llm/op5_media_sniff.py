"""Media columns: what a blob is by its signatures and structure, not by its declared type."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.kernels import slices

# Magic bytes by media type, from the public format specifications.
MAGIC = {
    "audio/wav": b"RIFF",
    "image/bmp": b"BM",
    "image/gif": b"GIF8",
    "image/jpeg": b"\xff\xd8\xff",
    "image/png": b"\x89PNG\r\n\x1a\n",
    "application/gzip": b"\x1f\x8b\x08",
    "application/pdf": b"%PDF-",
    "application/zip": b"PK\x03\x04",
}


@dataclass(frozen=True)
class Found:
    """A validated medium: blob[start:end], its payload at blob[body:body + size], and facts about it."""

    kind: str
    start: int
    end: int
    body: int
    size: int
    facts: str


def _wav(b: bytes, at: int) -> Found | None:
    if at + 12 > len(b) or b[at + 8 : at + 12] != b"WAVE":
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    if end > len(b):
        return None
    pos, fmt, data = at + 12, None, None
    while pos + 8 <= end:
        name, size = b[pos : pos + 4], struct.unpack_from("<I", b, pos + 4)[0]
        if pos + 8 + size > end:
            return None
        if name == b"fmt " and size >= 16:
            fmt = struct.unpack_from("<HHIIHH", b, pos + 8)
        elif name == b"data":
            data = (pos + 8, size)
        pos += 8 + size + size % 2
    if not fmt or not data or fmt[1] == 0 or fmt[3] != fmt[2] * fmt[4] or fmt[4] != fmt[1] * ((fmt[5] + 7) // 8) or data[1] % fmt[4]:
        return None
    return Found("audio/wav", at, end, *data, f"{fmt[1]}x{fmt[2]}Hz{fmt[5]}bit")


def _bmp(b: bytes, at: int) -> Found | None:
    if at + 54 > len(b):
        return None
    total, zero, body, head, width, height, flat, depth = struct.unpack_from("<IIIIiiHH", b, at + 2)
    if zero or flat != 1 or depth not in (1, 4, 8, 16, 24, 32) or head < 40 or width <= 0 or height == 0 or body < 14 + head:
        return None
    size = (width * depth + 31) // 32 * 4 * abs(height)
    if body + size > total or at + total > len(b):
        return None
    return Found("image/bmp", at, at + total, at + body, size, f"{width}x{abs(height)}x{depth}")


def _png(b: bytes, at: int) -> Found | None:
    pos, facts = at + 8, ""
    while pos + 12 <= len(b):
        size, name = struct.unpack_from(">I4s", b, pos)
        if pos + 12 + size > len(b) or zlib.crc32(b[pos + 4 : pos + 8 + size]) != struct.unpack_from(">I", b, pos + 8 + size)[0]:
            return None
        if pos == at + 8:
            if name != b"IHDR" or size != 13:
                return None
            w, h, depth = struct.unpack_from(">IIB", b, pos + 8)
            facts = f"{w}x{h}x{depth}"
        pos += 12 + size
        if name == b"IEND":
            return Found("image/png", at, pos, at, pos - at, facts)
    return None


def _gif(b: bytes, at: int) -> Found | None:
    if at + 13 > len(b) or b[at : at + 6] not in (b"GIF87a", b"GIF89a"):
        return None
    w, h, flags = struct.unpack_from("<HHB", b, at + 6)
    pos = at + 13 + (3 << (flags & 7) + 1 if flags & 128 else 0)

    def blocks(p: int) -> int:
        while p < len(b) and b[p]:
            p += 1 + b[p]
        return p + 1

    while pos < len(b):
        if b[pos] == 0x3B:
            return Found("image/gif", at, pos + 1, at, pos + 1 - at, f"{w}x{h}")
        if b[pos] == 0x21:
            pos = blocks(pos + 2)
        elif b[pos] == 0x2C and pos + 10 < len(b):
            pos = blocks(pos + 10 + (3 << (b[pos + 9] & 7) + 1 if b[pos + 9] & 128 else 0) + 1)
        else:
            return None
    return None


def _jpeg(b: bytes, at: int) -> Found | None:
    pos, facts = at + 2, ""
    while pos + 4 <= len(b) and b[pos] == 0xFF:
        mark, size = b[pos + 1], struct.unpack_from(">H", b, pos + 2)[0]
        if size < 2 or pos + 2 + size > len(b):
            return None
        if mark in (0xC0, 0xC1, 0xC2) and size >= 8:
            h, w = struct.unpack_from(">HH", b, pos + 5)
            facts = f"{w}x{h}"
        pos += 2 + size
        if mark == 0xDA:
            while (pos := b.find(b"\xff", pos)) >= 0 and pos + 1 < len(b):
                if b[pos + 1] == 0xD9:
                    return Found("image/jpeg", at, pos + 2, at, pos + 2 - at, facts) if facts else None
                if b[pos + 1] != 0 and not 0xD0 <= b[pos + 1] <= 0xD7:
                    break
                pos += 2
            if pos < 0:
                return None
    return None


def _gzip(b: bytes, at: int) -> Found | None:
    try:
        d = zlib.decompressobj(31)
        view, n = memoryview(b)[at:], 0
        n += len(d.decompress(view, 1 << 20))
        while not d.eof and d.unconsumed_tail:
            n += len(d.decompress(d.unconsumed_tail, 1 << 20))
        if not d.eof:
            return None
        end = len(b) - len(d.unused_data)
        return Found("application/gzip", at, end, at, end - at, f"{n}B")
    except zlib.error:
        return None


def _pdf(b: bytes, at: int) -> Found | None:
    end = b.find(b"%%EOF", at)
    return Found("application/pdf", at, end + 5, at, end + 5 - at, b[at + 5 : at + 8].decode("latin-1")) if end > 0 and b.find(b"startxref", at, end) > 0 else None


def _zip(b: bytes, at: int) -> Found | None:
    tail = b.find(b"PK\x05\x06", at)
    if tail < 0 or tail + 22 > len(b):
        return None
    count, size, start, note = struct.unpack_from("<HIIH", b, tail + 10)
    end = tail + 22 + note
    if at + start + size != tail or end > len(b) or (count and b[at + start : at + start + 4] != b"PK\x01\x02"):
        return None
    return Found("application/zip", at, end, at, end - at, f"{count}files")


VALID: dict[str, Callable[[bytes, int], Found | None]] = {
    "audio/wav": _wav, "image/bmp": _bmp, "image/gif": _gif, "image/jpeg": _jpeg, "image/png": _png,
    "application/gzip": _gzip, "application/pdf": _pdf, "application/zip": _zip,
}


def automaton():
    """Aho-Corasick over all magic bytes, one character for each byte."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, magic in MAGIC.items():
        found.add_word(magic.decode("latin-1"), (kind, len(magic)))
    found.make_automaton()
    return found


def sniff(blob: bytes, auto) -> list[Found]:
    """Outermost validated media of a blob, left to right: a signature within one already found is part of it."""
    out, free = [], 0
    for last, (kind, size) in auto.iter(blob.decode("latin-1")):
        at = last - size + 1
        if at >= free and (found := VALID[kind](blob, at)):
            out.append(found)
            free = found.end
    return out


def wrap_wav(samples: bytes, rate: int = 8000) -> bytes:
    """Mono 8-bit PCM: a byte is a sample."""
    pad = len(samples) % 2
    return b"RIFF" + struct.pack("<I", 36 + len(samples) + pad) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, rate, 1, 8) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * pad


SNIFFED = "id long, media array<struct<kind: string, start: long, end: long, facts: string, sha256: string>>, true_type string, corrected boolean"


def sniff_media(blobs: DataFrame, id_col: str, blob_col: str, type_col: str) -> DataFrame:
    """(id, media, true_type, corrected): validated media of each blob, outermost, left to right, each with its span and
    digest. true_type is that of a medium that fills the blob from its first byte, else application/octet-stream;
    corrected, whether it differs from the declared type. A null or empty blob: no media, octet-stream. A signature whose
    structure fails its validator is no medium. Whole blobs; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        for batch in slices(batches, "blob"):
            media, kinds, fixed = [], [], []
            for blob, declared in zip(batch.column("blob").to_pylist(), batch.column("declared").to_pylist(), strict=True):
                found = sniff(blob or b"", auto)
                media.append([{"kind": f.kind, "start": f.start, "end": f.end, "facts": f.facts, "sha256": hashlib.sha256(blob[f.start : f.end]).hexdigest()} for f in found])
                kinds.append(found[0].kind if found and found[0].start == 0 and found[0].end == len(blob) else "application/octet-stream")
                fixed.append(kinds[-1] != declared)
            shape = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("facts", pa.string()), ("sha256", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(media, shape), pa.array(kinds), pa.array(fixed, pa.bool_())], names=["id", "media", "true_type", "corrected"])

    rows = blobs.select(F.col(id_col).cast("long").alias("id"), F.col(blob_col).cast("binary").alias("blob"), F.col(type_col).cast("string").alias("declared"))
    return rows.mapInArrow(run, SNIFFED).withColumnRenamed("id", id_col)


#: A text's payload is a whole number of blocks.
BLOCK = 576


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as a medium and back: UTF-8, filled with bytes 255 to a positive multiple of BLOCK, stored as 8-bit mono
    PCM under a wrong declared type; found by `sniff`, validated, and its samples read back out of the stored bytes.

    (id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, true_type). Null text: as
    empty. feature: type, format, and mean, deviation and zero crossings of the samples. Whole texts, each by itself.
    """
    schema = f"{id_col} long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, true_type string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        for batch in slices(batches, "blob"):
            rows = []
            for raw in batch.column("blob").to_pylist():
                raw = raw or b""
                stored = wrap_wav(raw + b"\xff" * (-len(raw) % BLOCK or (0 if raw else BLOCK)))
                found = sniff(stored, auto)
                if len(found) != 1 or found[0].start or found[0].end != len(stored):
                    raise ValueError("a stored medium was not read back whole")
                f = found[0]
                back = stored[f.body : f.body + f.size]
                x = np.frombuffer(back, np.uint8)
                high = x >= 128
                feature = f"{f.kind};{f.facts};mean={x.mean():.4f};dev={x.std():.4f};cross={np.count_nonzero(high[1:] != high[:-1])}"
                rows.append((len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, f.kind))
            cols = zip(*rows, strict=True)
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], names=[x.split()[0] for x in schema.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("blob")).mapInArrow(run, schema)
