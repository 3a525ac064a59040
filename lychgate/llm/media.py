"""Ogg containers: pages with checksums, packets in lacing values, multiplexed logical streams.

A text is kept losslessly as unsigned 8-bit mono samples: stream SAMPLES holds a header packet
and packets of at most PACKET samples whose granule position is the number of samples so far;
stream NOTES holds one packet, the number of bytes before padding. Pages of both streams are
interleaved, so reading has to demultiplex them.

Defined results: a null text counts as empty, an empty one becomes 64 zero samples; a text of any
length is cut into packets, and packets over as many pages as they need; null media read as null;
damaged pages are skipped and counted, and a packet that lost a part is dropped; equal texts give
equal bytes (no id or time goes in). Other columns of the table pass by untouched or are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lychgate.llm.common import docs_of, map_batches

RATE = 8000
PACKET = 16384
SAMPLES, NOTES = 0x50434D38, 0x4E4F5445
HEADER = b"\x01smp8" + struct.pack("<IB", RATE, 1)
_REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
_CONTINUED, _FIRST, _LAST = 1, 2, 4
_PAGE = struct.Struct("<4sBBqIIIB")
_NO_END = -1


def checksum(page: bytes) -> int:
    """The page checksum (polynomial 0x04C11DB7, most significant bit first, start 0, no final xor):
    zlib's CRC of the same polynomial runs least significant bit first, so bits are turned around."""
    crc = zlib.crc32(page.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "big").translate(_REVERSED), "little")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = _PAGE.pack(b"OggS", 0, flags, granule, serial, number, 0, len(lacing))
    page = head + lacing + body
    return page[:22] + struct.pack("<I", checksum(page)) + page[26:]


def pages_of(serial: int, packets: list[tuple[bytes, int]]) -> list[bytes]:
    """Pages of one logical stream from (packet, granule position at its end); the first packet has
    a page of its own."""
    out: list[bytes] = []
    lacing, body, granule, goes_on = bytearray(), bytearray(), _NO_END, False

    def flush(last: bool) -> None:
        nonlocal granule
        flags = _CONTINUED * goes_on | _FIRST * (not out) | _LAST * last
        out.append(_page(flags, granule, serial, len(out), bytes(lacing), bytes(body)))
        lacing.clear()
        body.clear()
        granule = _NO_END

    for k, (packet, end) in enumerate(packets):
        segments = len(packet) // 255 + 1
        done = 0
        while done < segments:
            take = min(255 - len(lacing), segments - done)
            ended = done + take == segments
            lacing += b"\xff" * (take - ended)
            body += packet[done * 255 : (done + take) * 255]
            if ended:
                lacing.append(len(packet) % 255)
                granule = end
            done += take
            last = ended and k == len(packets) - 1
            if len(lacing) == 255 or last or (ended and not out):
                flush(last)
                goes_on = not ended
    return out


def mux(streams: list[list[bytes]]) -> bytes:
    """All first pages, then the others in turn."""
    out = [s[0] for s in streams if s]
    for k in range(1, max(map(len, streams), default=0)):
        out += [s[k] for s in streams if len(s) > k]
    return b"".join(out)


def write_text(data: bytes) -> bytes:
    """data, padded to a positive multiple of 64, as an Ogg file."""
    payload = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
    packets = [(HEADER, 0)]
    packets += [(payload[i : i + PACKET], min(i + PACKET, len(payload))) for i in range(0, len(payload), PACKET)]
    notes = [(b"\x01note", 0), (struct.pack("<Q", len(data)), len(payload))]
    return mux([pages_of(SAMPLES, packets), pages_of(NOTES, notes)])


@dataclass
class Stream:
    serial: int
    packets: list[bytes] = field(default_factory=list)
    #: Granule position of the page on which the packet ended, if it is the last to end there, else -1.
    granules: list[int] = field(default_factory=list)
    ended: bool = False
    lost: int = 0
    _next: int | None = None
    _open: list[bytes] | None = None

    def seconds(self, rate: int = RATE) -> list[float | None]:
        return [g / rate if g >= 0 else None for g in self.granules]


def demux(media: bytes) -> tuple[dict[int, Stream], int]:
    """Logical streams by serial number, and how many pages were damaged or cut off."""
    streams: dict[int, Stream] = {}
    bad, at, end = 0, 0, len(media)
    while at < end:
        if media[at : at + 4] != b"OggS":
            bad += 1
            at = media.find(b"OggS", at + 1)
            if at < 0:
                break
            continue
        if at + 27 > end:
            bad += 1
            break
        _, version, flags, granule, serial, number, crc, n = _PAGE.unpack_from(media, at)
        lacing = media[at + 27 : at + 27 + n]
        body_at = at + 27 + n
        stop = body_at + sum(lacing)
        page = media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : stop]
        if version or len(lacing) < n or stop > end or checksum(page) != crc:
            bad += 1
            at = media.find(b"OggS", at + 4)
            if at < 0:
                break
            continue
        at = stop
        s = streams.setdefault(serial, Stream(serial))
        if s._next is not None and number != s._next or s._next is None and number:
            s.lost += 1
            s._open = None
        s._next = number + 1
        s.ended |= bool(flags & _LAST)
        part = s._open if flags & _CONTINUED else []
        whole = part is not None
        pos, first = body_at, body_at
        ends = []
        for v in lacing:
            pos += v
            if v < 255:
                if whole:
                    s.packets.append(b"".join([*part, media[first:pos]]))
                    ends.append(len(s.packets))
                part, whole, first = [], True, pos
        s.granules += [_NO_END] * (len(s.packets) - len(s.granules))
        if ends:
            s.granules[-1] = granule
        s._open = [*part, media[first:pos]] if whole and n and lacing[-1] == 255 else None
    return streams, bad


def read_text(media: bytes) -> tuple[bytes, int, dict]:
    """(payload, bytes before padding, what the pages tell); raises ValueError if any of it is lost."""
    streams, bad = demux(media)
    samples, notes = streams.get(SAMPLES), streams.get(NOTES)
    if bad or samples is None or notes is None or not samples.ended or samples.packets[0] != HEADER:
        raise ValueError("damaged media")
    payload = b"".join(samples.packets[1:])
    (n_bytes,) = struct.unpack("<Q", notes.packets[1])
    if len(payload) != samples.granules[-1] or n_bytes > len(payload):
        raise ValueError("damaged media")
    return payload, n_bytes, {"packets": len(samples.packets) - 1, "seconds": samples.seconds()[-1], "streams": len(streams)}


def feature_of(payload: bytes, told: dict) -> str:
    """Duration by granule position, packets, mean level, mean step between samples, distinct levels."""
    x = np.frombuffer(payload, np.uint8)
    steps = int(np.abs(np.diff(x.view(np.int8).astype(np.int16))).sum())
    levels = int(np.count_nonzero(np.bincount(x, minlength=256)))
    return (
        f"ms={round(told['seconds'] * 1000)};packets={told['packets']};mean={int(x.sum(dtype=np.int64)) * 1000 // len(x)};"
        f"step={steps * 1000 // max(1, len(x) - 1)};levels={levels}"
    )


def encode_media(df: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """df with the Ogg form of its text in column out (an existing one is replaced)."""
    plain = df.drop(out)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)

    def batch(cols):
        yield cols | {out: [write_text((t or "").encode()) for t in cols[text]]}

    return map_batches(plain, batch, f"{fields}, `{out}` binary")


def media_table(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """Per document: what its stored form and the bytes read back from it are."""

    def batch(cols):
        rows = []
        for t in cols["text"]:
            media = write_text((t or "").encode())
            payload, n_bytes, told = read_text(media)
            rows.append(
                (n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media),
                 hashlib.sha256(media).hexdigest(), feature_of(payload, told), media if keep_media else None)
            )
        names = ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media")
        out = dict(zip(names, map(list, zip(*rows, strict=True)), strict=True))
        if not keep_media:
            del out["media"]
        yield {"doc_id": cols["doc_id"]} | out

    schema = (
        "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, "
        "media_bytes long, media_sha256 string, feature string" + ", media binary" * keep_media
    )
    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), batch, schema)


def op10_ogg_media(spark, sf_dir: str) -> DataFrame:
    return media_table(docs_of(spark, sf_dir))
