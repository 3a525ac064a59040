import hashlib
import random
import zlib

import pytest

from lychgate.llm import media
from tests.llm.conftest import TEXTS


def slow_checksum(data):
    crc = 0
    for b in data:
        crc ^= b << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc >> 31 else crc << 1) & 0xFFFFFFFF
    return crc


def test_checksum():
    for data in (b"", b"a", bytes(range(256)), b"OggS" * 99):
        assert media.checksum(data) == slow_checksum(data)


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 254, 255, 256, 16383, 16384, 16385, 65025, 65026, 300_000])
def test_round_trip(n):
    data = random.Random(n).randbytes(n)
    payload, size, told = media.read_text(media.write_text(data))
    assert payload[:size] == data and size == n and len(payload) % 64 == 0 and not any(payload[n:]) and payload
    assert told["streams"] == 2 and told["seconds"] == len(payload) / media.RATE


def test_packets_over_pages_and_several_streams():
    big = [(bytes([i]) * (255 * 300 * i), i) for i in range(4)]
    data = media.mux([media.pages_of(1, big), media.pages_of(2, [(b"x", 0), (b"", 5)])])
    streams, bad = media.demux(data)
    assert bad == 0 and streams[1].packets == [p for p, _ in big] and streams[1].granules == [0, 1, 2, 3]
    assert streams[2].packets == [b"x", b""] and streams[2].seconds(5) == [0.0, 1.0] and streams[1].ended


def test_damage_is_found():
    data = bytearray(media.write_text(bytes(200_000)))
    data[len(data) // 2] ^= 1
    streams, bad = media.demux(bytes(data))
    assert bad == 1 and streams[media.SAMPLES].lost == 1
    with pytest.raises(ValueError):
        media.read_text(bytes(data))
    with pytest.raises(ValueError):
        media.read_text(b"")


def test_table(spark, make):
    texts = [*enumerate(TEXTS), (7, "x" * 100_000), (8, "x" * 100_000)]
    rows = {r["doc_id"]: r for r in media.media_table(make(texts), keep_media=True).collect()}
    for i, t in texts:
        data = (t or "").encode()
        padded = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        r = rows[i]
        assert (r["n_bytes"], r["payload_bytes"]) == (len(data), len(padded)) and r["payload_sha256"] == hashlib.sha256(padded).hexdigest()
        assert r["tail_crc32"] == zlib.crc32(padded[-64:]) and r["media_sha256"] == hashlib.sha256(r["media"]).hexdigest() and r["media_bytes"] == len(r["media"])
    assert rows[7][2:] == rows[8][2:] and media.media_table(make([])).count() == 0
    assert media.encode_media(make(texts), out="key").count() == len(texts)
