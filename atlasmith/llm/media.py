"""Media columns: AVI motion-JPEG in binary columns, cut into timed clips.

The codec is lossless sequential JPEG (SOF3, predictor 1) in an AVI container with an idx1 index: every
frame is intra-coded. The Huffman table gives a category s a code of 16 - s bits, so that each
sample takes 16 bits with its s extra bits; all frames of a file are then coded and decoded as arrays.
The reader walks the RIFF chunks of all parts, takes frames from idx1 or the OpenDML indexes (from the
movi lists and their rec groups if there is none), and reads each frame's markers. Frames of other writers are read too if they are baseline JPEG (see
jpeg.py; their luminance counts). Frames that can't be read get no histogram and start a clip of their own.

A shot ends where the histogram difference of neighbouring frames exceeds an adaptive threshold: the
mean of the RADIUS differences on each side plus FACTOR of their standard deviations, and LEAST.

Defined cases. A null text is an empty one; its payload is one unit of spaces. A null or broken file
has no clips. Equal texts give equal files. Repeated rows give repeated clips; an empty table none.
Other columns of the input of with_avi() and clips() pass through, but for columns of the same names.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from atlasmith.llm import _shared as S
from atlasmith.llm.jpeg import luminance

UNIT = 192
WIDTH, HEIGHT = 16, 12
FPS = 25
BINS = 16
RADIUS, FACTOR, LEAST = 8, 2.5, 0.35
#: Marks of a JPEG file.
SOI, EOI, DHT, SOS, SOF3 = b"\xff\xd8", b"\xff\xd9", 0xC4, 0xDA, 0xC3


def _codes() -> tuple[np.ndarray, np.ndarray]:
    """The 16 bits of each difference from -255 to 255, and the difference of each 16 bits (1000: none)."""
    encode, decode = np.zeros(511, ">u2"), np.full(1 << 16, 1000, np.int16)
    first = 0
    for s in range(8, -1, -1):  # codes grow with their length: 8 bits for s = 8, 16 bits for s = 0
        code = first << s
        for d in range(-255, 256):
            if abs(d).bit_length() == s:
                encode[d + 255] = code | (d if d >= 0 else d + (1 << s) - 1)
                decode[int(encode[d + 255])] = d
        first = (first + 1) << 1
    return encode, decode


ENCODE, DECODE = _codes()
#: One code each of 8 to 16 bits, for categories 8 down to 0.
TABLE = bytes([0] * 7 + [1] * 9) + bytes(range(8, -1, -1))


def _head(width: int, height: int) -> bytes:
    sof = struct.pack(">BHHB3B", 8, height, width, 1, 1, 0x11, 0)
    dht = bytes([0]) + TABLE
    sos = bytes([1, 1, 0, 1, 0, 0])
    return SOI + b"".join(struct.pack(">BBH", 0xFF, mark, len(x) + 2) + x for mark, x in ((SOF3, sof), (DHT, dht), (SOS, sos)))


def encode_frames(frames: np.ndarray) -> list[bytes]:
    """JPEG files of 8-bit frames (n, height, width)."""
    n, height, width = frames.shape
    x = frames.astype(np.int16)
    before = np.empty_like(x)
    before[:, :, 1:] = x[:, :, :-1]
    before[:, 1:, 0] = x[:, :-1, 0]
    before[:, 0, 0] = 128
    words = ENCODE[x - before + 255]
    head, data, size = _head(width, height), words.tobytes(), 2 * height * width
    return [head + data[i * size : (i + 1) * size].replace(b"\xff", b"\xff\x00") + EOI for i in range(n)]


def _scan(frame: bytes) -> tuple[int, int, bytes] | None:
    """Width, height and coded samples of a JPEG file of this process and table; else none."""
    at, size, table = 2, None, None
    if frame[:2] != SOI:
        return None
    while at + 4 <= len(frame) and frame[at] == 0xFF:
        mark, length = frame[at + 1], int.from_bytes(frame[at + 2 : at + 4], "big")
        body = frame[at + 4 : at + 2 + length]
        at += 2 + length
        if mark == SOF3 and len(body) >= 6 and body[0] == 8 and body[5] == 1:
            size = int.from_bytes(body[3:5], "big"), int.from_bytes(body[1:3], "big")
        elif mark == DHT:
            table = body[1:]
        elif mark == SOS:
            end = frame.rfind(EOI)
            if size is None or table != TABLE or body[3:4] != b"\x01" or end < at:
                return None
            data = frame[at:end].replace(b"\xff\x00", b"\xff")
            return (*size, data) if len(data) == 2 * size[0] * size[1] else None
    return None


def decode_frames(frames: list[bytes]) -> list[np.ndarray | None]:
    """8-bit samples (height, width) of JPEG files; none for what can't be read."""
    scans = [_scan(x) for x in frames]
    out: list[np.ndarray | None] = [None] * len(frames)
    known: dict[bytes, list] = {}
    sizes: dict[tuple[int, int], list[int]] = {}
    for i, scan in enumerate(scans):
        if scan:
            sizes.setdefault(scan[:2], []).append(i)
        else:
            out[i] = luminance(frames[i], known)
    for (width, height), rows in sizes.items():
        words = np.frombuffer(b"".join(scans[i][2] for i in rows), ">u2").reshape(len(rows), height, width)
        d = DECODE[words]
        d[:, :, 0] = np.cumsum(d[:, :, 0], axis=1) + 128
        samples = np.cumsum(d, axis=2, dtype=np.int16)
        good = (d[:, :, 1:] < 1000).all(axis=(1, 2)) & (samples >= 0).all(axis=(1, 2)) & (samples < 256).all(axis=(1, 2))
        for i, x, ok in zip(rows, samples.astype(np.uint8), good, strict=True):
            out[i] = x if ok else None
    return out


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\x00" * (len(data) % 2)


def write_avi(frames: list[bytes], width: int = WIDTH, height: int = HEIGHT, fps: int = FPS) -> bytes:
    """An AVI file with one motion-JPEG stream and an index."""
    n, most = len(frames), max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // fps, most * fps, 0, 0x10, n, 0, 1, most, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, fps, 0, n, most, 0xFFFFFFFF, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    header = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    sizes = np.array([len(x) for x in frames], np.int64)
    offsets = 4 + np.concatenate(([0], np.cumsum(8 + sizes + sizes % 2)[:-1])) if n else np.empty(0, np.int64)
    index = np.zeros((n, 4), "<u4")
    index[:, 0], index[:, 1], index[:, 2], index[:, 3] = int.from_bytes(b"00dc", "little"), 0x10, offsets, sizes
    body = b"AVI " + header + _chunk(b"LIST", b"movi" + b"".join(_chunk(b"00dc", x) for x in frames)) + _chunk(b"idx1", index.tobytes())
    return _chunk(b"RIFF", body)


def _chunks(data: bytes, start: int, stop: int) -> Iterator[tuple[bytes, int, int]]:
    while start + 8 <= stop:
        size = int.from_bytes(data[start + 4 : start + 8], "little")
        yield data[start : start + 4], start + 8, min(size, stop - start - 8)
        start += 8 + size + size % 2


def _is_video(name: bytes) -> bool:
    return name[2:] in (b"dc", b"db")


def _media_chunks(data: bytes, start: int, stop: int) -> Iterator[tuple[bytes, int, int]]:
    """The chunks of a movi list, those of its rec groups among them."""
    for name, at, size in _chunks(data, start, stop):
        if name == b"LIST" and data[at : at + 4] == b"rec ":
            yield from _chunks(data, at + 4, at + size)
        else:
            yield name, at, size


def _old_index(data: bytes, index: np.ndarray, movi: int) -> list[tuple[int, int]] | None:
    """Where the frames of an idx1 are. Offsets count from the movi list or from the start of the file: the chunks' names tell."""
    entries = [(int(name).to_bytes(4, "little"), offset, size) for name, _, offset, size in index.tolist()]
    entries = [x for x in entries if _is_video(x[0])]
    for base in (movi, 0):
        if entries and all(data[base + offset : base + offset + 4] == name for name, offset, _ in entries):
            return [(base + offset + 8, size) for _, offset, size in entries]
    return None


def _new_index(data: bytes, at: int, size: int) -> list[tuple[int, int]]:
    """Where the frames of an OpenDML index chunk (ix00) are."""
    if size < 24 or data[at : at + 4] != b"\x02\x00\x00\x01" or not _is_video(data[at + 8 : at + 12]):
        return []
    n, base = int.from_bytes(data[at + 4 : at + 8], "little"), int.from_bytes(data[at + 12 : at + 20], "little")
    entries = np.frombuffer(data[at + 24 : at + 24 + min(n, (size - 24) // 8) * 8], "<u4").reshape(-1, 2)
    return [(base + offset, length & 0x7FFFFFFF) for offset, length in entries.tolist()]


def read_avi(data: bytes | None) -> tuple[float, list[bytes]]:
    """Seconds per frame, and the video stream's frames by the index.

    That is idx1 if the file has one RIFF part; in files of several parts, or without idx1, the OpenDML
    indexes; where an index is missing or doesn't point to frames, the frames are those of the movi lists.
    """
    if not data or data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        return 0.0, []
    seconds, lists, index = 1 / FPS, [], None
    for riff, begin, length in _chunks(data, 0, len(data)):
        if riff != b"RIFF" or data[begin : begin + 4] not in (b"AVI ", b"AVIX"):
            continue
        for name, at, size in _chunks(data, begin + 4, begin + length):
            if name == b"LIST" and data[at : at + 4] == b"hdrl":
                for inner, start, _ in _chunks(data, at + 4, at + size):
                    if inner == b"avih":
                        seconds = int.from_bytes(data[start : start + 4], "little") / 1e6 or seconds
            elif name == b"LIST" and data[at : at + 4] == b"movi":
                lists.append((at, size))
            elif name == b"idx1":
                index = np.frombuffer(data[at : at + size // 16 * 16], "<u4").reshape(-1, 4)
    if index is not None and len(lists) == 1 and (frames := _old_index(data, index, lists[0][0])):
        return seconds, [data[s : s + n] for s, n in frames]
    chunks = [x for at, size in lists for x in _media_chunks(data, at + 4, at + size)]
    frames = [(s, n) for name, s, n in chunks if _is_video(name)]
    indexed = [x for name, s, n in chunks if name[:2] == b"ix" for x in _new_index(data, s, n)]
    if set(indexed) <= set(frames) and indexed:
        frames = indexed
    return seconds, [data[s : s + n] for s, n in frames]


@dataclass
class Clip:
    clip: int
    first_frame: int
    n_frames: int
    start_s: float
    end_s: float
    histogram: list[int]


def shots(histograms: np.ndarray) -> np.ndarray:
    """Frames at which a shot starts. histograms: (n, BINS) shares; a row of NaN can't be compared."""
    n = len(histograms)
    if n < 2:
        return np.arange(n)
    apart = np.abs(histograms[1:] - histograms[:-1]).sum(axis=1) / 2
    known = np.where(np.isnan(apart), 0.0, apart)
    near = sliding_window_view(np.pad(known, RADIUS, mode="edge"), 2 * RADIUS + 1)
    others = np.delete(near, RADIUS, axis=1)
    cut = np.isnan(apart) | (known > np.maximum(LEAST, others.mean(axis=1) + FACTOR * others.std(axis=1)))
    return np.concatenate(([0], np.flatnonzero(cut) + 1))


def clips_of(data: bytes | None) -> list[Clip]:
    """Timed clips of a file."""
    seconds, frames = read_avi(data)
    return _clips(seconds, decode_frames(frames))


def _clips(seconds: float, samples: list[np.ndarray | None]) -> list[Clip]:
    if not samples:
        return []
    counts = np.full((len(samples), BINS), np.nan)
    same: dict[tuple, list[int]] = {}
    for i, x in enumerate(samples):
        if x is not None:
            same.setdefault(x.shape, []).append(i)
    for shape, rows in same.items():
        level = np.stack([samples[i] for i in rows]).reshape(len(rows), -1) // (256 // BINS)
        flat = (level + np.arange(len(rows))[:, None] * BINS).ravel()
        counts[rows] = np.bincount(flat, minlength=len(rows) * BINS).reshape(-1, BINS) / (shape[0] * shape[1])
    starts = shots(counts)
    stops = [*starts[1:].tolist(), len(samples)]
    out = []
    for k, (s, e) in enumerate(zip(starts.tolist(), stops, strict=True)):
        mean = np.nan_to_num(counts[s:e]).mean(axis=0)
        out.append(Clip(k, s, e - s, round(s * seconds, 6), round(e * seconds, 6), np.rint(mean * 1000).astype(int).tolist()))
    return out


def payload_of(text: str | None) -> tuple[int, bytes]:
    """Bytes of a text, and the same with spaces up to a positive multiple of UNIT."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return len(raw), raw.ljust(max(1, -(-len(raw) // UNIT)) * UNIT, b" ")


def avi_of(text: str | None) -> bytes:
    """A text's bytes as grey frames of UNIT samples."""
    return write_avi(encode_frames(np.frombuffer(payload_of(text)[1], np.uint8).reshape(-1, HEIGHT, WIDTH)))


def with_avi(df: DataFrame, text: str = "text", media: str = "media") -> DataFrame:
    """df with the text's bytes as an AVI file in a binary column."""

    def write(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([avi_of(x) for x in texts], dtype=object)

    return df.withColumn(media, F.pandas_udf(write, T.BinaryType())(F.col(text)))


CLIP = "clip int, first_frame int, n_frames int, start_s double, end_s double, histogram array<int>"


def clips(df: DataFrame, media: str = "media") -> DataFrame:
    """A row for each clip of each file: df's other columns and those of CLIP."""

    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for files in parts:
            yield pd.Series([[vars(c) for c in clips_of(None if x is None else bytes(x))] for x in files])

    found = df.select(F.struct("*").alias("row"), F.explode(F.pandas_udf(cut, f"array<struct<{CLIP.replace(' ', ':').replace(',:', ',')}>>")(F.col(media))).alias("clip"))
    names = [x.split()[0] for x in CLIP.split(", ")]
    return found.select(*(F.col("row")[c].alias(c) for c in df.columns if c not in (media, *names)), *(F.col("clip")[n].alias(n) for n in names))


def _digest(text: str | None) -> tuple:
    n_bytes, _ = payload_of(text)
    media = avi_of(text)
    seconds, files = read_avi(media)
    frames = decode_frames(files)
    if any(x is None for x in frames):
        raise ValueError("a stored frame does not decode")
    stored = b"".join(x.tobytes() for x in frames)
    found = _clips(seconds, frames)
    whole = np.rint(np.average([c.histogram for c in found], axis=0, weights=[c.n_frames for c in found])).astype(int).tolist()
    feature = f"frames={len(frames)};clips={len(found)};longest={max(c.n_frames for c in found)};end={found[-1].end_s:.2f};histogram={','.join(map(str, whole))}"
    return n_bytes, len(stored), hashlib.sha256(stored).hexdigest(), zlib.crc32(stored[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    for batch in batches:
        rows = [_digest(x.as_py()) for x in batch.column("text")]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text goes into an AVI file and is read back from its bytes, file by file, in one pass."""
    docs = S.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    return docs.mapInArrow(
        _digests, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    )


S.by_value(__name__)
