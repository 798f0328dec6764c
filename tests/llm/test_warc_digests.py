"""Payloads are held against the digest in their header when they are read."""

import base64
import hashlib
import io
import zlib

import pytest

from quire.llm import warc


@pytest.mark.parametrize("payload, chunk", [(b"", 4), (b"abcd", 4), (b"abcdefghi", 4)])
def test_payload_differs_from_its_digest(payload, chunk):
    def member(of: bytes) -> io.BytesIO:
        digest = base64.b32encode(hashlib.sha1(of).digest()).decode()
        z = zlib.compressobj(9, zlib.DEFLATED, 31)
        return io.BytesIO(z.compress(warc.record_head(7, "http://a/", digest, len(payload), None, "response", "2024-01-01T00:00:00Z") + payload + b"\r\n\r\n") + z.flush())

    good = list(warc.read_records(member(payload), chunk))
    assert b"".join(r[5] for r in good) == payload and [r[8] for r in good] == [False] * (len(good) - 1) + [True]
    with pytest.raises(ValueError, match="digest"):
        list(warc.read_records(member(payload + b"x"), chunk))
