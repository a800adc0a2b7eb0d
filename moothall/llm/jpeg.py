"""Media columns of baseline JPEG: a numpy codec that works on many images at once.

Reading: parse the markers, Huffman-decode the scan and rebuild the luminance thumbnail from the DC coefficients, one
sample for each block of 8 x 8. The intervals between restart markers don't depend on each other, so the intervals of
all images of a batch that share their tables are decoded side by side, one numpy lane each. Grey and colour images
with one interleaved scan are read, with or without restart markers, whatever their sampling factors.

Writing: bytes become grey images 24 blocks wide. Each byte is a flat block: with a DC quantiser of 8 its DC
coefficient is the byte less 128 and no AC coefficient is set, so any decoder gives the bytes back exactly. Every row of
blocks is a restart interval. An image holds up to ``ROWS`` rows; longer payloads are several images, one after another.

Defined results: null text is stored as the empty text; a payload is padded with bytes 255 to a positive multiple of
576; equal texts give equal bytes and features. A binary value that isn't a chain of readable baseline images gives a
null feature and payload; so does null.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blocks across an image, rows of blocks in an image at most, and the unit that payloads are padded to.
ACROSS, ROWS, UNIT = 24, 8184, 576
#: Bytes of payload that are coded in one go.
BATCH = 1 << 20

# Code lengths of the luminance DC table of the JPEG standard, for categories 0 to 11.
DC_LENGTHS = [2, 3, 3, 3, 3, 3, 4, 5, 6, 7, 8, 9]


def _codes(lengths_and_symbols: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Canonical Huffman codes: (code, length, symbol)."""
    out, code, before = [], 0, 0
    for length, symbol in sorted(lengths_and_symbols, key=lambda x: x[0]):
        code <<= length - before
        out.append((code, length, symbol))
        code, before = code + 1, length
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _table_body(kind: int, pairs: list[tuple[int, int]]) -> bytes:
    counts = bytes(sum(n == i for n, _ in pairs) for i in range(1, 17))
    return bytes([kind]) + counts + bytes(s for _, s in sorted(pairs, key=lambda x: x[0]))


_DC = _codes([(n, s) for s, n in enumerate(DC_LENGTHS)])
_BEFORE_SIZE = b"\xff\xd8" + _segment(0xDB, b"\x00" + b"\x08" * 64)
_AFTER_SIZE = (
    _segment(0xC4, _table_body(0x00, [(n, s) for s, n in enumerate(DC_LENGTHS)]))
    + _segment(0xC4, _table_body(0x10, [(1, 0)]))
    + _segment(0xDD, struct.pack(">H", ACROSS))
    + _segment(0xDA, b"\x01\x01\x00\x00\x3f\x00")
)


def _header(rows: int) -> bytes:
    size = struct.pack(">BHHB", 8, rows * 8, ACROSS * 8, 1) + b"\x01\x11\x00"
    return _BEFORE_SIZE + _segment(0xC0, size) + _AFTER_SIZE


def _difference_codes() -> tuple[np.ndarray, np.ndarray]:
    """For DC differences -255 to 255: the bits of category, value and end of block, and how many they are."""
    bits, length = np.zeros(511, np.int64), np.zeros(511, np.int64)
    by_category = {s: (code, n) for code, n, s in _DC}
    for d in range(-255, 256):
        category = abs(d).bit_length()
        code, n = by_category[category]
        value = d if d >= 0 else d + (1 << category) - 1
        bits[d + 255], length[d + 255] = ((code << category) | value) << 1, n + category + 1
    return bits, length


_BITS, _LENGTH = _difference_codes()


def pad(data: bytes) -> bytes:
    n = max(UNIT, -(-len(data) // UNIT) * UNIT)
    return data + b"\xff" * (n - len(data))


def write(payloads: list[bytes]) -> list[bytes]:
    """Each payload as a chain of images."""
    sizes, of = [], []
    for k, p in enumerate(payloads):
        rows = len(p) // ACROSS
        for at in range(0, rows, ROWS):
            sizes.append(min(ROWS, rows - at))
            of.append(k)
    x = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, ACROSS).astype(np.int64) - 128
    lanes = len(x)
    d = np.diff(x, axis=1, prepend=0) + 255
    length = _LENGTH[d]
    bits = _BITS[d]
    end = np.cumsum(length, axis=1)
    n_bytes = (end[:, -1] + 7) // 8
    start = np.cumsum(n_bytes) - n_bytes
    raw = np.zeros(int(n_bytes.sum()) + 3, np.uint8)
    for j in range(ACROSS):
        at = end[:, j] - length[:, j]
        value = bits[:, j] << (24 - (at & 7) - length[:, j])
        at = start + (at >> 3)
        raw[at] |= (value >> 16).astype(np.uint8)
        raw[at + 1] |= (value >> 8).astype(np.uint8)
        raw[at + 2] |= value.astype(np.uint8)
    raw[start + n_bytes - 1] |= ((1 << (n_bytes * 8 - end[:, -1])) - 1).astype(np.uint8)
    raw = raw[:-3]

    # a byte 255 is followed by 0, each row by a restart marker, the last of an image by its end; headers go first
    sizes = np.array(sizes)
    head = [_header(int(n)) for n in sizes]
    h = len(head[0])
    first = np.cumsum(sizes) - sizes
    image = np.repeat(np.arange(len(sizes)), sizes)
    full = raw == 255
    moved = np.arange(len(raw)) + np.cumsum(full) - full
    row = np.repeat(np.arange(lanes), n_bytes)
    moved += 2 * row + h * (image[row] + 1)
    total = len(raw) + int(full.sum()) + 2 * lanes + h * len(sizes)
    out = np.zeros(total, np.uint8)
    out[moved] = raw
    last = start + n_bytes - 1
    marker = moved[last] + 1 + full[last]
    out[marker] = 255
    nth = np.arange(lanes) - first[image]
    out[marker + 1] = np.where(nth == sizes[image] - 1, 0xD9, 0xD0 + nth % 8)
    begin = np.append(0, marker[first[1:] - 1] + 2) if len(sizes) > 1 else np.array([0])
    for b, text in zip(begin, head):
        out[b : b + h] = np.frombuffer(text, np.uint8)
    stored = out.tobytes()
    cuts = [int(begin[i]) for i in range(len(of)) if i == 0 or of[i] != of[i - 1]] + [total]
    return [stored[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


@dataclass
class Image:
    """What the markers say: tables is a hashable key for what a scan's decoding depends on."""

    width: int
    height: int
    factors: list[tuple[int, int]]
    quantiser: int
    interval: int
    tables: tuple
    scan: tuple[int, int]


def parse(data: bytes) -> list[Image]:
    """The chain of baseline images in ``data``; ValueError where it isn't one."""
    at, images = 0, []
    a = np.frombuffer(data, np.uint8)
    ff = np.flatnonzero(a[:-1] == 255)
    after = a[ff + 1]
    stops = ff[(after != 0) & (after != 255) & ((after < 0xD0) | (after > 0xD7))]
    while at < len(data):
        if data[at : at + 2] != b"\xff\xd8":
            raise ValueError("no start of image")
        at += 2
        quantisers, huffman, size, interval = {}, {}, None, 0
        while True:
            while data[at : at + 2] == b"\xff\xff":  # fill bytes
                at += 1
            if at + 4 > len(data) or data[at] != 255:
                raise ValueError("no marker")
            marker, n = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            body = data[at + 4 : at + 2 + n]
            at += 2 + n
            if marker == 0xDB:
                while body:
                    wide = body[0] >> 4
                    quantisers[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                    body = body[1 + 64 * (1 + wide) :]
            elif marker == 0xC4:
                while body:
                    k = 17 + sum(body[1:17])
                    huffman[body[0]] = body[1:k]
                    body = body[k:]
            elif marker == 0xDD:
                interval = int.from_bytes(body, "big")
            elif marker in (0xC0, 0xC1):
                _, height, width, n_parts = struct.unpack(">BHHB", body[:6])
                size = (width, height, [tuple(body[6 + 3 * i : 9 + 3 * i]) for i in range(n_parts)])
            elif 0xC2 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
                raise ValueError("not baseline")
            elif marker == 0xDA:
                break
        if size is None or not size[0] or not size[1] or body[0] != len(size[2]):
            raise ValueError("no size, or several scans")
        chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
        parts = size[2]
        factors = [(p[1] >> 4, p[1] & 15) for p in parts] if len(parts) > 1 else [(1, 1)]
        if any(not 1 <= f <= 4 for pair in factors for f in pair):
            raise ValueError("no such sampling factor")
        blocks = tuple(
            (i, huffman[chosen[p[0]] >> 4], huffman[16 + (chosen[p[0]] & 15)])
            for i, p in enumerate(parts)
            for _ in range(factors[i][0] * factors[i][1])
        )
        k = np.searchsorted(stops, at)
        if k == len(stops) or data[stops[k] + 1] != 0xD9:
            raise ValueError("no end of image")
        end = int(stops[k])
        wide, high = (8 * max(f[i] for f in factors) for i in (0, 1))
        if 4 * (end - at) < -(-size[0] // wide) * -(-size[1] // high) * len(blocks):
            raise ValueError("fewer than two bits a block")
        images.append(Image(size[0], size[1], factors, quantisers[parts[0][2]], interval, blocks, (at, end)))
        at = end + 2
    if not images:
        raise ValueError("empty")
    return images


_lookups: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def _lookup(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """By the next 16 bits: code length (0: no such code) and symbol."""
    if table not in _lookups:
        lengths = [n for n, count in enumerate(table[:16], 1) for _ in range(count)]
        length, symbol = np.zeros(65536, np.int64), np.zeros(65536, np.int64)
        for code, n, s in _codes(list(zip(lengths, table[16:]))):
            length[code << (16 - n) : (code + 1) << (16 - n)] = n
            symbol[code << (16 - n) : (code + 1) << (16 - n)] = s
        if len(_lookups) > 64:
            _lookups.clear()
        _lookups[table] = length, symbol
    return _lookups[table]


def _dc_lanes(scan: np.ndarray, starts: np.ndarray, units: np.ndarray, tables: tuple) -> np.ndarray:
    """DC coefficients: a row for each restart interval, with the blocks of its units in order.

    ``scan`` has no markers or stuffed bytes any more; ``starts`` are the intervals' first bytes."""
    p = np.append(scan, np.zeros(8, np.uint8)).astype(np.int64)
    window = (p[:-4] << 32) | (p[1:-3] << 24) | (p[2:-2] << 16) | (p[3:-1] << 8) | p[4:]
    top = len(window) - 1
    n_parts = max(t[0] for t in tables) + 1
    out = np.zeros((len(starts), int(units.max()) * len(tables)), np.int64)
    before = np.zeros((n_parts, len(starts)), np.int64)
    at = starts.astype(np.int64) * 8
    lanes = np.arange(len(starts))
    for unit in range(int(units.max())):
        if (units <= unit).any():
            lanes = np.flatnonzero(units > unit)
        whole = len(lanes) == len(starts)
        for b, (part, dc, ac) in enumerate(tables):
            pos = at if whole else at[lanes]
            length, symbol = _lookup(dc)
            seen, skip = window[np.minimum(pos >> 3, top)], pos & 7
            head = (seen >> (24 - skip)) & 0xFFFF
            n = symbol[head]
            used = length[head] + n
            value = (seen >> (40 - skip - used)) & ((1 << n) - 1)
            value -= np.where(value < (1 << n) >> 1, (1 << n) - 1, 0)
            pos = pos + used
            if whole:
                before[part] += value
                out[:, unit * len(tables) + b] = before[part]
            else:
                before[part, lanes] += value
                out[lanes, unit * len(tables) + b] = before[part, lanes]
            length, symbol = _lookup(ac)
            k, open_ = np.ones(len(pos), np.int64), None
            while True:  # one AC symbol a turn, in the lanes whose block isn't ended
                here = pos if open_ is None else pos[open_]
                head = (window[np.minimum(here >> 3, top)] >> (24 - (here & 7))) & 0xFFFF
                s = symbol[head]
                used, forward = length[head] + (s & 15), np.where(s == 0, 64, (s >> 4) + 1)
                if not used.all():
                    raise ValueError("no such code")
                if open_ is None:
                    pos += used
                    k += forward
                    open_ = np.flatnonzero(k < 64)
                else:
                    pos[open_] += used
                    k[open_] += forward
                    open_ = open_[k[open_] < 64]
                if not len(open_):
                    break
            if whole:
                at = pos
            else:
                at[lanes] = pos
    return out


def thumbnails(data: bytes, images: list[Image]) -> list[np.ndarray]:
    """For each image its luminance, one sample for each block. The images' scans are ranges of ``data``."""
    a = np.frombuffer(data, np.uint8)
    out: list[np.ndarray | None] = [None] * len(images)
    alike = defaultdict(list)
    for i, x in enumerate(images):
        alike[x.tables].append(i)
    for tables, members in alike.items():
        scan = np.concatenate([a[slice(*images[i].scan)] for i in members])
        sizes = np.array([images[i].scan[1] - images[i].scan[0] for i in members])
        begin = np.cumsum(sizes) - sizes
        ff = np.flatnonzero(scan[:-1] == 255)
        restart = ff[(scan[ff + 1] & 0xF8) == 0xD0]
        keep = np.ones(len(scan), bool)
        keep[ff[scan[ff + 1] == 0] + 1] = False
        keep[restart] = keep[restart + 1] = False
        starts = np.union1d(begin, restart + 2)
        units, lanes = [], []
        for i in members:
            x = images[i]
            h, v = max(f[0] for f in x.factors), max(f[1] for f in x.factors)
            n = -(-x.width // (8 * h)) * -(-x.height // (8 * v))
            step = x.interval or n
            lanes.append(-(-n // step))
            units.append(np.minimum(step, n - step * np.arange(lanes[-1])))
        if sum(lanes) != len(starts):
            raise ValueError("restart markers are missing")
        shift = np.cumsum(keep) - keep
        dc = _dc_lanes(scan[keep], shift[starts], np.concatenate(units), tables)
        lane = 0
        for i, n_lanes, own in zip(members, lanes, units):
            x = images[i]
            (h, v), top = x.factors[0], (max(f[0] for f in x.factors), max(f[1] for f in x.factors))
            luma = [b for b, t in enumerate(tables) if t[0] == 0]
            rows = dc[lane : lane + n_lanes].reshape(n_lanes, -1, len(tables))[:, :, luma]
            lane += n_lanes
            flat = rows.reshape(-1, len(luma)) if (own == own[0]).all() else np.concatenate([r[:n] for r, n in zip(rows, own)])
            flat = flat[: int(own.sum())]
            across, down = -(-x.width // (8 * top[0])), -(-x.height // (8 * top[1]))
            plane = flat.reshape(down, across, v, h).transpose(0, 2, 1, 3).reshape(down * v, across * h)
            plane = plane[: -(-x.height * v // (8 * top[1])), : -(-x.width * h // (8 * top[0]))]
            out[i] = np.clip(np.floor_divide(plane * x.quantiser + 4, 8) + 128, 0, 255).astype(np.uint8)
    return out


def average_hash(thumb: np.ndarray) -> str:
    """64 bits in hex: which cells of an 8 x 8 grid are brighter than the thumbnail's mean."""
    rows, cols = (np.minimum(np.arange(8) * n // 8, n - 1) for n in thumb.shape)
    total = np.add.reduceat(np.add.reduceat(thumb.astype(np.int64), rows, axis=0), cols, axis=1)
    area = np.outer(*(np.diff(np.append(e, n)).clip(1) for e, n in zip((rows, cols), thumb.shape)))
    bits = total * thumb.size > area * int(thumb.sum(dtype=np.int64))
    return np.packbits(bits).tobytes().hex()


def _batches(values: list[bytes], size: int) -> Iterator[list[bytes]]:
    part, n = [], 0
    for x in values:
        part.append(x)
        n += len(x)
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


def read(stored: list[bytes | None]) -> list[tuple[bytes, str] | None]:
    """For each chain of images: the samples of their thumbnails, and the feature: each image's width, height and
    thumbnail hash."""
    found: list[list[Image] | None] = []
    at, good = 0, []
    for data in stored:
        try:
            images = parse(data) if data else None
        except (ValueError, LookupError, ArithmeticError, struct.error):
            images = None
        for x in images or ():
            x.scan = (x.scan[0] + at, x.scan[1] + at)
        found.append(images)
        if images:
            good.append(data)
            at += len(data)
    flat = [x for images in found for x in images or ()]
    try:
        thumbs = iter(thumbnails(b"".join(good), flat) if flat else [])
    except (ValueError, LookupError, ArithmeticError):
        if len(stored) == 1:
            return [None]
        return [x for data in stored for x in read([data])]
    out = []
    for images in found:
        if not images:
            out.append(None)
            continue
        own = [next(thumbs) for _ in images]
        feature = ",".join(f"{x.width}x{x.height}:{average_hash(t)}" for x, t in zip(images, own))
        out.append((b"".join(t.tobytes() for t in own), feature))
    return out


def _store(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        payloads = [pad(x.encode()) for x in texts.fillna("")]
        yield pd.Series([y for part in _batches(payloads, BATCH) for y in write(part)], dtype=object)


def _features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for stored in batches:
        values = [b"" if x is None else bytes(x) for x in stored]
        rows = [y or (None, None) for part in _batches(values, BATCH) for y in read(part)]
        yield pd.DataFrame(rows, columns=["payload", "feature"])


def text_as_images(text: Column) -> Column:
    """A text's UTF-8 bytes, padded, as a chain of images."""
    return F.pandas_udf(_store, "binary")(text)


def image_features(stored: Column) -> Column:
    """Of a binary column of chains of images: the thumbnails' samples (``payload``) and the ``feature``."""
    return F.pandas_udf(_features, "payload binary, feature string")(stored)
