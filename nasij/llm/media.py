"""Media columns: grey PNG images held in binary columns, and their hashes.

A payload of bytes becomes the samples of an 8-bit grey image of 64 columns:
zlib-packed scan lines in checked chunks, in a binary column of a written table.
Reading that back tests the signature,
every chunk's checksum and the sizes, and undoes the line filters in numpy. The
feature is a 64-bit hash of the low frequencies of a cosine transform.

Defined cases: a null or empty text is a payload of 64 zero bytes; equal texts
give equal values; a damaged image raises ``ValueError``. Very long texts are
handled one at a time. Further columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nasij.llm.common import Written, ready, text_bytes

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Side of the picture that is transformed, and of the kept corner.
SIDE, LOW = 32, 8


def payload_of(text: bytes) -> bytes:
    return text + b"\0" * ((-len(text)) % WIDTH or (WIDTH if not text else 0))


def _samples(text: bytes) -> np.ndarray:
    return np.frombuffer(payload_of(text), np.uint8).reshape(-1, WIDTH)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(samples: np.ndarray, level: int = 4) -> bytes:
    """An 8-bit grey PNG. The lines are stored as they are, or each less the
    line above, whichever has the smaller sum of differences."""
    h, w = samples.shape
    up = samples.copy()
    up[1:] -= samples[:-1]
    cost = [int(np.abs(x[: 4096].view(np.int8).astype(np.int16)).sum()) for x in (samples, up)]
    kind = int(cost[1] < cost[0])
    lines = np.empty((h, w + 1), np.uint8)
    lines[:, 0] = 2 * kind
    lines[:, 1:] = up if kind else samples
    head = struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def chunks(png: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The chunks of an image, each after its checksum was tested."""
    if png[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at = 8
    while at < len(png):
        if at + 12 > len(png):
            raise ValueError("chunk cut short")
        (n,) = struct.unpack_from(">I", png, at)
        kind, data = png[at + 4 : at + 8], png[at + 8 : at + 8 + n]
        if len(data) < n or struct.unpack_from(">I", png, at + 8 + n)[0] != zlib.crc32(kind + data):
            raise ValueError(f"chunk {kind!r} fails its checksum")
        yield kind, data
        at += 12 + n


def unfilter(lines: np.ndarray) -> np.ndarray:
    """Samples of one byte each from filtered lines; first column: filter types."""
    kinds, x = lines[:, 0], lines[:, 1:]
    if (kinds > 4).any():
        raise ValueError("unknown line filter")
    if not kinds.any():
        return np.ascontiguousarray(x)
    if (kinds == 2).all():
        return np.cumsum(x, axis=0, dtype=np.uint8)
    out = np.zeros_like(x)
    above = np.zeros(x.shape[1], np.uint8)
    for i, kind in enumerate(kinds):
        if kind == 0:
            out[i] = x[i]
        elif kind == 1:
            out[i] = np.cumsum(x[i], dtype=np.uint8)
        elif kind == 2:
            out[i] = x[i] + above
        else:
            left = corner = 0
            for j, (v, up) in enumerate(zip(x[i].tolist(), above.tolist(), strict=True)):
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    a, b, c = abs(p - left), abs(p - up), abs(p - corner)
                    guess = left if a <= b and a <= c else up if b <= c else corner
                left, corner = (v + guess) & 255, up
                out[i, j] = left
        above = out[i]
    return out


def decode_png(png: bytes) -> np.ndarray:
    size, parts, ended = None, [], False
    for kind, data in chunks(png):
        if kind == b"IHDR":
            w, h, depth, colour, packing, filtering, interlace = struct.unpack(">IIBBBBB", data)
            if (depth, colour, packing, filtering, interlace) != (8, 0, 0, 0, 0):
                raise ValueError("only plain 8-bit grey images are read")
            size = h, w
        elif kind == b"IDAT":
            parts.append(data)
        elif kind == b"IEND":
            ended = True
    if size is None or not ended:
        raise ValueError("no header or no end")
    raw = zlib.decompress(b"".join(parts))
    if len(raw) != size[0] * (size[1] + 1):
        raise ValueError("the lines do not fill the picture")
    return unfilter(np.frombuffer(raw, np.uint8).reshape(size[0], size[1] + 1))


_K = np.arange(LOW)[:, None] * (2 * np.arange(SIDE)[None, :] + 1) * np.pi / (2 * SIDE)
_COSINES = np.cos(_K)


def shrink(samples: np.ndarray) -> np.ndarray:
    """Means over a grid of SIDE x SIDE cells; small pictures repeat lines."""
    h, w = samples.shape
    rows = np.floor(np.arange(SIDE) * h / SIDE).astype(int)
    cols = np.floor(np.arange(SIDE) * w / SIDE).astype(int)
    tall = np.maximum(np.diff(np.append(rows, h)), 1)[:, None]
    wide = np.maximum(np.diff(np.append(cols, w)), 1)[None, :]
    return np.add.reduceat(np.add.reduceat(samples, rows, axis=0, dtype=np.int64), cols, axis=1) / (tall * wide)


def cosine_hash(samples: np.ndarray) -> bytes:
    """64 bits: which low frequencies lie above the median of all but the mean."""
    low = (_COSINES @ shrink(samples) @ _COSINES.T).round(6).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes()


def to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, png, hash: the images themselves, with binary hashes."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            pngs = [encode_png(_samples(bytes(t))) for t in texts]
            yield pd.DataFrame({"n_bytes": [len(t) for t in texts], "png": pngs, "hash": [cosine_hash(_samples(bytes(t))) for t in texts]})

    ready(docs.sparkSession)
    media = F.pandas_udf(run, "n_bytes long, png binary, hash binary")
    return docs.select("doc_id", media(text_bytes(F.col("text"))).alias("m")).select("doc_id", "m.*")


DIGEST = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def _digest(png: bytes) -> tuple:
    samples = decode_png(png)
    payload = samples.tobytes()
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(png), hashlib.sha256(png).hexdigest(), cosine_hash(samples).hex()


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and what was found in each document's image.

    The images are written to a table with a binary column in the shared folder,
    and read back from it.
    """
    media = Written(to_media(docs.select("doc_id", "text")), "media").df

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in DIGEST.split(", ")]
        for pngs in batches:
            yield pd.DataFrame([_digest(bytes(p)) for p in pngs], columns=names)

    digest = F.pandas_udf(run, DIGEST)
    return media.select("doc_id", "n_bytes", digest("png").alias("m")).select("doc_id", "n_bytes", "m.*")
