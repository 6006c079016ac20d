"""TIFF media columns: read pages out of image files and store bytes as such files.

``pages`` walks the image directories of files in a binary column and gives one row per page. Strips and
tiles may be plain, PackBits, LZW or deflate, with or without the horizontal predictor, in either byte
order. ``payloads`` stores texts as multi-page files and reads them back through the same reader.

Defined results: a null or empty file, one without a TIFF header, or one that ends early gives one row
with page null and the reason in ``error``; the pages before a fault are kept. A page whose compression
or sample layout is not supported gives a row with its size and an ``error``. Chains of directories that
loop end at the first repeat. Repeated files give their rows each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lectern.llm.shingles import portions

# Fixed values of the format: tags, field types by size, compressions, predictors.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = 284, 317, 322, 323, 324, 325
TYPE_CODES = {1: "B", 3: "H", 4: "I"}
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
CLEAR, END, FIRST_FREE, MOST_CODES = 256, 257, 258, 4096

BLOCK = 64
PAGE_BYTES = 131_072
# How pages of a payload are stored, page by page in turn: (compression, tiled, predictor).
LAYOUTS = ((DEFLATE, False, False), (PACKBITS, False, False), (DEFLATE, True, True), (LZW, False, False), (DEFLATE, False, True), (PACKBITS, True, True))


def packbits_encode(data: bytes) -> bytes:
    """Runs of three or more equal bytes become a count and the byte; the rest are literals."""
    values = np.frombuffer(data, dtype=np.uint8)
    if not len(values):
        return b""
    edges = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    runs = np.diff(np.append(edges, len(values)))
    long = np.flatnonzero(runs >= 3)
    out, at = bytearray(), 0

    def literal(upto: int) -> None:
        for i in range(at, upto, 128):
            part = data[i : min(i + 128, upto)]
            out.append(len(part) - 1)
            out.extend(part)

    for start, n in zip(edges[long].tolist(), runs[long].tolist()):
        literal(start)
        while n >= 2:
            take = min(n, 128)
            out.append(257 - take)
            out.append(data[start])
            start, n = start + take, n - take
        at = start
    literal(len(data))
    return bytes(out)


def packbits_decode(data: bytes) -> bytes:
    out, at = [], 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out.append(data[at + 1 : at + 2 + n])
            at += 2 + n
        else:
            if n > 128:
                out.append(data[at + 1 : at + 2] * (257 - n))
            at += 2 if n > 128 else 1
    return b"".join(out)


# Bits of each code after a clear. The writer's table is one entry ahead of what the reader has filled in.
_LZW_WIDTHS = 9 + sum((np.arange(MOST_CODES) + FIRST_FREE >= step).astype(np.int64) for step in (511, 1023, 2047))
_LZW_OFFSETS = np.concatenate([[0], np.cumsum(_LZW_WIDTHS)])
_SINGLES = [bytes([i]) for i in range(256)]


def lzw_encode(data: bytes) -> bytes:
    """Most significant bit first; the table is cleared when it is nearly full."""
    codes: list[int] = [CLEAR]
    segments: list[int] = []
    table: dict[int, int] = {}
    free, begun = FIRST_FREE, 1
    look = table.get
    held = data[0] if data else -1
    for one in data[1:]:
        key = held << 8 | one
        longer = look(key)
        if longer is not None:
            held = longer
            continue
        codes.append(held)
        table[key] = free
        free += 1
        held = one
        if free == MOST_CODES - 2:
            codes.append(CLEAR)
            segments.append(len(codes) - begun)
            begun = len(codes)
            table.clear()
            free = FIRST_FREE
    if held >= 0:
        codes.append(held)
    codes.append(END)
    segments.append(len(codes) - begun)
    size = np.concatenate([[9], *[_LZW_WIDTHS[:n] for n in segments]])
    # Each code in 12 bits, of which the lowest ``size`` are kept.
    wide = np.unpackbits(np.array(codes, dtype=">u2").view(np.uint8)).reshape(-1, 16)
    return np.packbits(wide[np.arange(16) >= 16 - size[:, None]]).tobytes()


def lzw_decode(data: bytes) -> bytes:
    """Code widths depend only on the number of codes since the clear, so they are read in blocks."""
    padded = np.frombuffer(data + b"\0\0\0\0", dtype=np.uint8).astype(np.int64)
    total = len(data) * 8
    out: list[bytes] = []
    at = 0
    while at + 9 <= total:
        # All codes up to the next clear, as if none came.
        n = int(np.searchsorted(_LZW_OFFSETS[1:], total - at, side="right"))
        places, width = at + _LZW_OFFSETS[:n], _LZW_WIDTHS[:n]
        byte = places >> 3
        word = (padded[byte] << 24) | (padded[byte + 1] << 16) | (padded[byte + 2] << 8) | padded[byte + 3]
        block = ((word >> (32 - (places & 7) - width)) & ((1 << width) - 1)).tolist()
        if block[0] == CLEAR:
            at += 9
            continue
        table = [*_SINGLES, b"", b""]
        before = b""
        for i, code in enumerate(block):
            if code == CLEAR:
                at += int(_LZW_OFFSETS[i + 1])
                break
            if code == END:
                return b"".join(out)
            if code < len(table):
                entry = table[code]
            elif code == len(table) and before:
                entry = before + before[:1]
            else:
                raise ValueError("an LZW code beyond the table")
            if before:
                table.append(before + entry[:1])
            out.append(entry)
            before = entry
        else:
            break
    return b"".join(out)


def _unpack(data: bytes, compression: int) -> bytes:
    if compression == NONE:
        return data
    if compression == PACKBITS:
        return packbits_decode(data)
    if compression == LZW:
        return lzw_decode(data)
    if compression in (DEFLATE, OLD_DEFLATE):
        return zlib.decompress(data)
    raise ValueError(f"compression {compression} is not supported")


def _pack(data: bytes, compression: int) -> bytes:
    return {NONE: bytes, PACKBITS: packbits_encode, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 1)}[compression](data)


def directories(data: bytes) -> Iterator[dict[int, list[int]]]:
    """The tags of each image directory in turn, as lists of whole numbers."""
    if data[:4] not in (b"II*\0", b"MM\0*"):
        raise ValueError("no TIFF header")
    order = "<" if data[:2] == b"II" else ">"
    (at,) = struct.unpack_from(order + "I", data, 4)
    seen = set()
    while at and at not in seen:
        seen.add(at)
        (n,) = struct.unpack_from(order + "H", data, at)
        tags = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            if kind not in TYPE_CODES:
                continue
            form = f"{order}{count}{TYPE_CODES[kind]}"
            place = at + 10 + 12 * i
            if struct.calcsize(form) > 4:
                (place,) = struct.unpack_from(order + "I", data, place)
            tags[tag] = list(struct.unpack_from(form, data, place))
        yield tags
        (at,) = struct.unpack_from(order + "I", data, at + 2 + 12 * n)


def samples(data: bytes, tags: dict[int, list[int]]) -> np.ndarray:
    """The 8-bit samples of one page: rows x columns x samples a pixel."""
    one = lambda tag, other=None: tags.get(tag, [other])[0]
    width, length, per = one(WIDTH), one(LENGTH), one(SAMPLES, 1)
    if set(tags.get(BITS, [1])) != {8} or one(PLANAR, 1) != 1:
        raise ValueError("only 8-bit samples, pixel by pixel, are supported")
    if TILE_OFFSETS in tags:
        across, down, places, counts = one(TILE_WIDTH), one(TILE_LENGTH), tags[TILE_OFFSETS], tags[TILE_COUNTS]
    else:
        across, down, places, counts = width, min(one(ROWS_PER_STRIP, length), length), tags[STRIP_OFFSETS], tags[STRIP_COUNTS]
    image = np.zeros((length, width, per), dtype=np.uint8)
    columns = -(-width // across)
    for k, (place, count) in enumerate(zip(places, counts)):
        top, left = k // columns * down, k % columns * across
        rows = down if TILE_OFFSETS in tags else min(down, length - top)
        if place + count > len(data):
            raise ValueError("the file ends early")
        raw = np.frombuffer(_unpack(data[place : place + count], one(COMPRESSION, NONE)), dtype=np.uint8)
        block = raw[: rows * across * per].reshape(rows, across, per)
        if one(PREDICTOR, 1) == 2:
            block = np.cumsum(block, axis=1, dtype=np.uint8)
        elif one(PREDICTOR, 1) != 1:
            raise ValueError("the predictor is not supported")
        part = block[: length - top, : width - left]
        image[top : top + part.shape[0], left : left + part.shape[1]] = part
    return image


def write(images: list[np.ndarray], layouts=LAYOUTS, order: str = "<", tile: int = 64, strip: int = 32_768) -> bytes:
    """A file with one page per image (rows x columns, or with samples a pixel), stored by ``layouts`` in turn."""
    out = bytearray((b"II*\0" if order == "<" else b"MM\0*") + b"\0\0\0\0")
    link = 4
    for number, image in enumerate(images):
        compression, tiled, predicted = layouts[number % len(layouts)]
        pixels = image.reshape(image.shape[0], image.shape[1], -1)
        length, width, per = pixels.shape
        if tiled:
            padded = np.zeros((-(-length // tile) * tile, -(-width // tile) * tile, per), dtype=np.uint8)
            padded[:length, :width] = pixels
            blocks = [padded[y : y + tile, x : x + tile] for y in range(0, padded.shape[0], tile) for x in range(0, padded.shape[1], tile)]
        else:
            rows = max(1, strip // (width * per))
            blocks = [pixels[y : y + rows] for y in range(0, length, rows)]
        places, counts = [], []
        for block in blocks:
            if predicted:
                block = np.diff(block, axis=1, prepend=np.zeros((block.shape[0], 1, per), dtype=np.uint8))
            packed = _pack(np.ascontiguousarray(block, dtype=np.uint8).tobytes(), compression)
            places.append(len(out))
            counts.append(len(packed))
            out += packed
        fields = {WIDTH: ("I", [width]), LENGTH: ("I", [length]), BITS: ("H", [8] * per), COMPRESSION: ("H", [compression]), PHOTOMETRIC: ("H", [1]), SAMPLES: ("H", [per]), PLANAR: ("H", [1]), PREDICTOR: ("H", [2 if predicted else 1])}
        if tiled:
            fields |= {TILE_WIDTH: ("I", [tile]), TILE_LENGTH: ("I", [tile]), TILE_OFFSETS: ("I", places), TILE_COUNTS: ("I", counts)}
        else:
            fields |= {STRIP_OFFSETS: ("I", places), ROWS_PER_STRIP: ("I", [rows]), STRIP_COUNTS: ("I", counts)}
        entries = []
        for tag, (code, values) in sorted(fields.items()):
            packed = struct.pack(f"{order}{len(values)}{code}", *values)
            if len(packed) > 4:
                out += b"\0" * (len(out) % 2)
                place = len(out)
                out += packed
                packed = struct.pack(order + "I", place)
            entries.append(struct.pack(order + "HHI", tag, 3 if code == "H" else 4, len(values)) + packed.ljust(4, b"\0"))
        out += b"\0" * (len(out) % 2)
        out[link : link + 4] = struct.pack(order + "I", len(out))
        out += struct.pack(order + "H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


PAGE_SCHEMA = "page int, width int, height int, samples int, compression int, tiled boolean, predictor int, n_bytes long, sha256 string, mean double, error string"


def read_pages(data: bytes | None) -> Iterator[tuple[tuple, np.ndarray | None]]:
    """A row of ``PAGE_SCHEMA`` and the samples of each page of a file."""
    nothing = (None,) * 10
    number = -1
    try:
        for number, tags in enumerate(directories(data or b"")):
            one = lambda tag, other=None: tags.get(tag, [other])[0]  # noqa: E731, B023
            known = (number, one(WIDTH), one(LENGTH), one(SAMPLES, 1), one(COMPRESSION, NONE), TILE_OFFSETS in tags, one(PREDICTOR, 1))
            try:
                image = samples(data, tags)
            except (ValueError, KeyError, TypeError, struct.error, zlib.error) as fault:
                yield (*known, None, None, None, str(fault)), None
                continue
            raw = image.tobytes()
            yield (*known, len(raw), hashlib.sha256(raw).hexdigest(), float(image.mean()) if image.size else None, None), image
    except (ValueError, struct.error) as fault:
        yield (*nothing, str(fault)), None


def pages(files: DataFrame, column: str = "content", key: str = "path") -> DataFrame:
    """One row per page of each file in the binary ``column``: size, layout, digest and mean of its samples."""
    kind = files.schema[key].dataType.simpleString()
    names = ["page", "width", "height", "samples", "compression", "tiled", "predictor", "n_bytes", "sha256", "mean", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, data in zip(batch["key"], batch["data"]):
                found = [row for row, _ in read_pages(data)]
                out = pd.DataFrame(found, columns=names, dtype=object)
                out.insert(0, "key", [name] * len(found))
                yield out

    read = files.select(F.col(f"`{key}`").alias("key"), F.col(f"`{column}`").alias("data"))
    return read.mapInPandas(run, f"key {kind}, {PAGE_SCHEMA}").withColumnRenamed("key", key)


def store(payload: bytes) -> bytes:
    """``payload`` (a positive multiple of 64 bytes) as pages of at most ``PAGE_BYTES``, rows of up to 1024 samples.

    The first page's layout follows from the payload's checksum, so all layouts are used alike.
    """
    first = zlib.crc32(payload) % len(LAYOUTS)
    images = []
    for at in range(0, len(payload), PAGE_BYTES):
        values = np.frombuffer(payload, dtype=np.uint8, count=min(PAGE_BYTES, len(payload) - at), offset=at)
        width = next(w for w in (1024, 512, 256, 128, 64) if len(values) % w == 0)
        images.append(values.reshape(-1, width))
    return write(images, LAYOUTS[first:] + LAYOUTS[:first])


def _payload_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].tolist()
        for piece in portions([len(t or "") for t in texts]):
            out = []
            for text in texts[piece]:
                data = (text or "").encode("utf-8", "surrogatepass")
                media = store(data + b"\0" * (-len(data) % BLOCK or (0 if data else BLOCK)))
                count, total, digest, tail, shape = 0, 0, hashlib.sha256(), b"", []
                for row, image in read_pages(media):
                    if image is None:
                        raise ValueError(row[-1])
                    raw = image.tobytes()
                    digest.update(raw)
                    total += int(image.sum(dtype=np.int64))
                    count += len(raw)
                    tail = (tail + raw)[-BLOCK:]
                    shape.append(f"{row[1]}x{row[2]}:{row[4]}{'t' if row[5] else 's'}{row[6]}")
                feature = f"pages={len(shape)};mean={total / count:.6f};{','.join(shape)}"
                out.append((len(data), count, digest.hexdigest(), zlib.crc32(tail), len(media), hashlib.sha256(media).hexdigest(), feature))
            names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
            made = pd.DataFrame(out, columns=names)
            made.insert(0, "doc_id", batch["doc_id"].values[piece])
            yield made


def payloads(docs: DataFrame) -> DataFrame:
    """Each text stored as a TIFF file and read back: sizes, digests and a feature of what was read.

    Null texts count as empty; the payload is padded with zero bytes to a positive multiple of 64.
    """
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return docs.select("doc_id", "text").mapInPandas(_payload_rows, schema)
