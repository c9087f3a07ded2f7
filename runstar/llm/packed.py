"""Number arrays as short byte strings, for rows that carry many numbers at once through an exchange."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

#: Marks an array of doubles where else the bytes of a number stand.
DOUBLE = 255


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of doubles, or of numbers from 0 to 2**64 - 1 in as many bytes as the largest needs; equal bytes side by side."""
    head, body = [struct.pack("<B", len(arrays))], []
    for a in arrays:
        if a.dtype == np.float64:
            width, planes = DOUBLE, a.view(np.uint8).reshape(-1, 8).T
        else:
            width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
            planes = np.ascontiguousarray(a).astype("<u8").view(np.uint8).reshape(-1, 8).T[:width]
        head.append(struct.pack("<BI", width, len(a)))
        body.append(planes.tobytes())
    return b"".join(head) + pa.compress(b"".join(body), "zstd", asbytes=True)


def unpack(data: bytes, narrow: bool = False) -> list[np.ndarray]:
    """What ``pack`` was given; whole numbers as int64, those from 2**63 on as negative ones. With ``narrow``, arrays of numbers that fit
    into 1, 2 or 4 bytes are unsigned ones of that size."""
    n = data[0]
    sizes = [struct.unpack_from("<BI", data, 1 + 5 * i) for i in range(n)]
    total = sum((8 if w == DOUBLE else w) * k for w, k in sizes)
    body = np.frombuffer(pa.decompress(data[1 + 5 * n:], total, "zstd", asbytes=True), np.uint8) if total else np.zeros(0, np.uint8)
    out, at = [], 0
    for width, k in sizes:
        w = 8 if width == DOUBLE else width
        room = next(x for x in (1, 2, 4, 8) if x >= w) if narrow else 8
        full = np.zeros((k, room), np.uint8)
        full[:, :w] = body[at:at + w * k].reshape(w, k).T
        at += w * k
        out.append(full.reshape(-1).view(np.float64 if width == DOUBLE else np.int64 if room == 8 else f"<u{room}"))
    return out


def steps(rising: np.ndarray) -> np.ndarray:
    """Differences of rising numbers below 2**64, which ``np.cumsum`` undoes."""
    rising = rising.view(np.uint64)
    return np.diff(rising, prepend=np.uint64(0))
