"""PNG encoding and decoding with zlib and numpy: 8-bit images, not interlaced."""

from __future__ import annotations

import struct
import zlib

import numpy as np

SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}  # by colour type


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(image: np.ndarray, level: int = 6) -> bytes:
    """RGBA bytes, every line unfiltered."""
    h, w, _ = image.shape
    lines = np.zeros((h, 1 + 4 * w), dtype=np.uint8)
    lines[:, 1:] = np.ascontiguousarray(image, dtype=np.uint8).reshape(h, 4 * w)
    head = struct.pack(">IIBBBBB", w, h, 8, 6, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), level)) + _chunk(b"IEND", b"")


def _unfilter_slanted(kinds: np.ndarray, data: np.ndarray, step: int) -> np.ndarray:
    """Any mix of filters, a slanted column at a time: pixel i of line r lies on diagonal r + i, whose left, upper and corner neighbours are done."""
    h, n = data.shape
    w = n // step
    line, at = np.divmod(np.arange(h * w), w)
    slant = np.zeros((h + w, h, step), dtype=np.int16)
    slant[line + at, line] = data.reshape(h * w, step)
    done = np.zeros((h + w + 1, h + 1, step), dtype=np.int16)  # two diagonals and a line of zeros before the first
    of = kinds[:, None]
    for d in range(h + w - 1):
        a, z = max(0, d - w + 1), min(h, d + 1)
        left, up, corner, k = done[d + 1, a + 1 : z + 1], done[d + 1, a:z], done[d, a:z], of[a:z]
        to_left, to_up = np.abs(up - corner), np.abs(left - corner)
        to_corner = np.abs(left + up - 2 * corner)
        paeth = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
        guess = np.where(k == 4, paeth, np.where(k == 3, (left + up) >> 1, left * (k == 1) + up * (k == 2)))
        done[d + 2, a + 1 : z + 1] = (slant[d, a:z] + guess) & 255
    return done[line + at + 2, line + 1].reshape(h, n).astype(np.uint8)


def _unfilter(lines: np.ndarray, step: int) -> np.ndarray:
    kinds, data = lines[:, 0], lines[:, 1:].astype(np.int16)
    if (kinds >= 3).any():
        return _unfilter_slanted(kinds, data, step)
    above = np.zeros(data.shape[1], dtype=np.int16)
    for i, kind in enumerate(kinds):
        row = data[i]
        if kind == 1:
            for c in range(step):
                row[c::step] = np.cumsum(row[c::step]) & 255
        elif kind == 2:
            row += above
            row &= 255
        above = row
    return data.astype(np.uint8)


def decode(blob: bytes) -> np.ndarray:
    """An (h, w, 4) array of RGBA; raises ValueError on anything unreadable."""
    if blob[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, idat, palette, alpha, head = 8, [], None, b"", None
    while at + 8 <= len(blob):
        n, kind = struct.unpack(">I4s", blob[at : at + 8])
        data = blob[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"PLTE":
            palette = np.frombuffer(data, np.uint8).reshape(-1, 3)
        elif kind == b"tRNS":
            alpha = data
        elif kind == b"IDAT":
            idat.append(data)
        at += 12 + n
    if head is None or head[2] != 8 or head[6]:
        raise ValueError("only 8-bit PNGs without interlace are read")
    w, h, _, colour = head[:4]
    c = CHANNELS[colour]
    raw = np.frombuffer(zlib.decompress(b"".join(idat)), np.uint8)[: h * (1 + w * c)].reshape(h, 1 + w * c)
    px = _unfilter(raw, c).reshape(h, w, c)
    out = np.full((h, w, 4), 255, dtype=np.uint8)
    if colour == 3:
        table = np.full((256, 4), 255, dtype=np.uint8)
        table[: len(palette), :3] = palette
        table[: len(alpha), 3] = np.frombuffer(alpha, np.uint8)
        return table[px[..., 0]]
    if colour in (0, 4):
        out[..., :3] = px[..., :1]
        out[..., 3] = px[..., 1] if colour == 4 else 255
        if colour == 0 and alpha:
            out[..., 3] = np.where(px[..., 0] == struct.unpack(">H", alpha)[0], 0, 255)
        return out
    out[..., :c] = px
    if colour == 2 and alpha:
        out[..., 3] = np.where((px == np.array(struct.unpack(">HHH", alpha))).all(axis=2), 0, 255)
    return out


def palette(colours: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """For each colour the number of its box after a median cut into at most ``most`` boxes."""
    boxes = [np.arange(len(colours))]
    while len(boxes) < most:
        spans = [np.ptp(colours[b].astype(int), axis=0).max() if len(b) > 1 else -1 for b in boxes]
        k = int(np.argmax(spans))
        if spans[k] < 0:
            break
        b = boxes.pop(k)
        axis = int(np.ptp(colours[b].astype(int), axis=0).argmax())
        b = b[np.argsort(colours[b, axis], kind="stable")]
        run = np.cumsum(counts[b])
        cut = min(max(int(np.searchsorted(run, run[-1] / 2)) + 1, 1), len(b) - 1)
        boxes += [b[:cut], b[cut:]]
    out = np.zeros(len(colours), dtype=np.uint8)
    for i, b in enumerate(boxes):
        out[b] = i
    return out


def encode_palette(image: np.ndarray, most: int = 192) -> bytes:
    """An indexed PNG of at most ``most`` colours (alpha kept per colour); for previews, not for tiles."""
    h, w, _ = image.shape
    colours, at, counts = np.unique(image.reshape(-1, 4), axis=0, return_inverse=True, return_counts=True)
    box = palette(colours, counts, most)
    n = int(box.max()) + 1
    weight = np.bincount(box, counts, n)
    table = np.stack([np.rint(np.bincount(box, colours[:, c] * counts, n) / weight) for c in range(4)], axis=1).astype(np.uint8)
    lines = np.zeros((h, 1 + w), dtype=np.uint8)
    lines[:, 1:] = box[at.ravel()].reshape(h, w)
    head = struct.pack(">IIBBBBB", w, h, 8, 3, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"PLTE", table[:, :3].tobytes()) + _chunk(b"tRNS", table[:, 3].tobytes()) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 9)) + _chunk(b"IEND", b"")
