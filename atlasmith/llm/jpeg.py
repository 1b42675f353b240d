"""Luminance of baseline JPEG frames (SOF0, one interleaved scan), as motion-JPEG writers make them.

Colour components are read past; only the first one is turned into samples. Frames that bring no
Huffman tables of their own, as most of motion-JPEG, use those of the standard. Progressive and broken
ones give none.
"""

from __future__ import annotations

import numpy as np

from atlasmith.llm import _shared as S

#: Row and column of the coefficients in their order along the diagonals.
_ZIGZAG = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
ORDER = np.array([r * 8 + c for r, c in _ZIGZAG])
_k = np.arange(8)
#: Rows: frequencies; columns: positions.
COSINES = np.sqrt(np.where(_k == 0, 1, 2) / 8)[:, None] * np.cos((2 * _k[None, :] + 1) * _k[:, None] * np.pi / 16)


def _standard(counts: list[int], first: str) -> bytes:
    """Counts of codes by length, and symbols: those given in hexadecimal, then all other runs and sizes in order."""
    symbols = bytes.fromhex(first)
    rest = bytes(r << 4 | s for r in range(16) for s in range(1, 11) if r << 4 | s not in symbols) if len(symbols) > 12 else b""
    return bytes(counts) + symbols + rest


#: The Huffman tables of ITU-T T.81, annex K.3, by class and number (0: luminance, 1: colour; from 16 on: AC).
STANDARD = {
    0: _standard([0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0], "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    1: _standard([0, 3, 1, 1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0], "00 01 02 03 04 05 06 07 08 09 0a 0b"),
    16: _standard([0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125], "01 02 03 00 04 11 05 12 21 31 41 06 13 51 61 07 22 71 14 32 81 91 a1 08 23 42 b1 c1 15 52 d1 f0 24 33 62 72 82"),
    17: _standard([0, 2, 1, 2, 4, 4, 3, 4, 7, 5, 4, 4, 0, 1, 2, 119], "00 01 02 03 11 04 05 21 31 06 12 41 51 07 61 71 13 22 32 81 08 14 42 91 a1 b1 c1 09 23 33 52 f0 15 62 72 d1 0a 16 24 34 e1 25 f1"),
}


def lookup(table: bytes) -> list[tuple[int, int]]:
    """Length and symbol of the code at the front of each 16 bits; length 0 where there is none."""
    out, code, at = [(0, 0)] * (1 << 16), 0, 16
    for length in range(1, 17):
        for symbol in table[at : at + table[length - 1]]:
            first = code << (16 - length)
            out[first : first + (1 << (16 - length))] = [(length, symbol)] * (1 << (16 - length))
            code += 1
        at += table[length - 1]
        code <<= 1
    return out[: 1 << 16]


class Bits:
    """The bits of one entropy-coded segment."""

    def __init__(self, data: bytes):
        self.data, self.at, self.end = data.replace(b"\xff\x00", b"\xff") + bytes(8), 0, 0
        self.end = (len(self.data) - 8) * 8

    def peek(self) -> int:
        i = self.at >> 3
        return int.from_bytes(self.data[i : i + 3], "big") >> (8 - (self.at & 7)) & 0xFFFF

    def symbol(self, codes: list[tuple[int, int]]) -> int:
        length, symbol = codes[self.peek()]
        self.at += length
        if not length or self.at > self.end:
            raise ValueError("no such code")
        return symbol

    def signed(self, size: int) -> int:
        """A value of so many bits; the lower half of the range is negative."""
        if not size:
            return 0
        value = self.peek() >> (16 - size)
        self.at += size
        if self.at > self.end:
            raise ValueError("segment ends early")
        return value if value >> (size - 1) else value - (1 << size) + 1


def _block(bits: Bits, dc: list, ac: list, out: np.ndarray | None) -> int:
    """The change of the first coefficient; the others go to out."""
    change, k = bits.signed(bits.symbol(dc)), 1
    while k < 64:
        run, size = divmod(bits.symbol(ac), 16)
        if not size:
            if run < 15:
                break
            k += 16
            continue
        k += run
        value = bits.signed(size)
        if k > 63:
            raise ValueError("too many coefficients")
        if out is not None:
            out[k] = value
        k += 1
    return change


def _segments(data: bytes) -> list[bytes]:
    """Entropy-coded segments up to the next marker that isn't a restart."""
    out, start, at = [], 0, 0
    while (at := data.find(b"\xff", at)) >= 0 and at + 1 < len(data):
        mark = data[at + 1]
        if mark == 0:
            at += 2
        elif 0xD0 <= mark <= 0xD7:
            out.append(data[start:at])
            start = at = at + 2
        elif mark == 0xFF:
            at += 1
        else:
            return [*out, data[start:at]]
    return [*out, data[start:]]


def luminance(frame: bytes, known: dict[bytes, list]) -> np.ndarray | None:
    """8-bit samples (height, width). known keeps lookups of Huffman tables from frame to frame."""
    try:
        return _luminance(frame, known)
    except (ValueError, KeyError, IndexError):
        return None


def _luminance(frame: bytes, known: dict[bytes, list]) -> np.ndarray | None:
    at, quantisers, codes, parts, every = 2, {}, {}, {}, 0
    if frame[:2] != b"\xff\xd8":
        return None
    while at + 4 <= len(frame) and frame[at] == 0xFF:
        mark, length = frame[at + 1], int.from_bytes(frame[at + 2 : at + 4], "big")
        body = frame[at + 4 : at + 2 + length]
        at += 2 + length
        if mark == 0xDB:
            while body:
                wide = body[0] >> 4
                quantisers[body[0] & 15] = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else "u1").astype(np.float64)
                body = body[65 + 64 * wide :]
        elif mark == 0xC4:
            while body:
                size = 17 + sum(body[1:17])
                table = body[1:size]
                if table not in known:
                    known[table] = lookup(table)
                codes[body[0]] = known[table]
                body = body[size:]
        elif mark == 0xDD:
            every = int.from_bytes(body[:2], "big")
        elif mark == 0xC0:
            height, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            parts = {body[i]: (body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * body[5], 3)}
            if body[0] != 8 or not height or not width:
                return None
        elif 0xC1 <= mark <= 0xCF and mark not in (0xC8, 0xCC):
            return None
        elif mark == 0xDA:
            break
    else:
        return None
    if not parts or body[0] != len(parts):
        return None
    for number in {x for i in range(1, 1 + 2 * body[0], 2) for x in (body[i + 1] >> 4, 16 | body[i + 1] & 15)} - set(codes):
        table = STANDARD[number]
        if table not in known:
            known[table] = lookup(table)
        codes[number] = known[table]
    first = next(iter(parts))
    scan = [(body[i], codes[body[i + 1] >> 4], codes[16 | body[i + 1] & 15]) for i in range(1, 1 + 2 * body[0], 2)]
    # A scan of one component has a block for each unit, whatever its sampling.
    sampling = {c: (h, v) if len(parts) > 1 else (1, 1) for c, (h, v, _) in parts.items()}
    most_h, most_v = (max(x[i] for x in sampling.values()) for i in (0, 1))
    across, down = -(-width // (8 * most_h)), -(-height // (8 * most_v))
    h, v = sampling[first]
    found = np.zeros((down * v, across * h, 64))
    segments = iter(_segments(frame[at:]))
    for unit in range(across * down):
        if unit == 0 or every and unit % every == 0:
            bits, last = Bits(next(segments, b"")), dict.fromkeys(parts, 0)
        y, x = divmod(unit, across)
        for c, dc, ac in scan:
            for i in range(sampling[c][1]):
                for j in range(sampling[c][0]):
                    out = found[y * v + i, x * h + j] if c == first else None
                    last[c] += _block(bits, dc, ac, out)
                    if out is not None:
                        out[0] = last[c]
    blocks = np.zeros_like(found)
    blocks[..., ORDER] = found * quantisers[parts[first][2]]
    blocks = blocks.reshape(*blocks.shape[:2], 8, 8)
    samples = np.einsum("fy,abfg,gx->aybx", COSINES, blocks, COSINES).reshape(down * v * 8, across * h * 8) + 128
    if (h, v) != (most_h, most_v):
        samples = samples.repeat(most_v // v, axis=0).repeat(most_h // h, axis=1)
    return np.clip(np.rint(samples), 0, 255).astype(np.uint8)[:height, :width]


S.by_value(__name__)
