"""Numbers as bytes for runs that are written and merged."""

from __future__ import annotations

import numpy as np
import zstandard


def squeeze(values: np.ndarray) -> bytes:
    """Values in transposed bytes under zstd, preceded by their width."""
    width = values.dtype.itemsize
    rows = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(rows.T.tobytes())


def stretch(packed: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[1:]), np.uint8)
    width = packed[0]
    rows = np.ascontiguousarray(raw.reshape(width, -1).T)
    return rows.view(np.dtype(f"<u{width}")).reshape(-1)
