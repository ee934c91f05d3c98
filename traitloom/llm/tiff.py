"""TIFF images: store bytes as 8-bit grey pages, and read pages of any strip or tile layout back."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import common

WIDTH = 576
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
#: Rows of a strip that encode() writes.
STRIP_ROWS = 64
#: Rows of a batch that are held encoded or decoded at once.
STEP = 128
#: Bytes of a value by its field type; fixed by the format.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 13: 4}
#: struct letters of the integer field types.
LETTERS = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 13: "I"}


def pack_bits(data: bytes) -> bytes:
    """Runs of three or more become a count and a byte; the rest goes in literal stretches."""
    out, at, literal = bytearray(), 0, bytearray()

    def flush() -> None:
        if literal:
            out.append(len(literal) - 1)
            out.extend(literal)
            literal.clear()

    while at < len(data):
        run = 1
        while run < 128 and at + run < len(data) and data[at + run] == data[at]:
            run += 1
        if run >= 3:
            flush()
            out += bytes((257 - run, data[at]))
        else:
            for b in data[at : at + run]:
                literal.append(b)
                if len(literal) == 128:
                    flush()
        at += run
    flush()
    return bytes(out)


def unpack_bits(data: bytes, size: int) -> bytes:
    out, at = bytearray(), 0
    while at < len(data) and len(out) < size:
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += n + 2
        else:
            if n > 128:
                out += data[at + 1 : at + 2] * (257 - n)
            at += 1 + (n > 128)
    return bytes(out)


def lzw_pack(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first; widths grow one code early, as the format asks."""
    codes, bits, held, out = {}, 9, 0, bytearray()
    filled = 0

    def put(code: int) -> None:
        nonlocal held, filled
        held, filled = (held << bits) | code, filled + bits
        while filled >= 8:
            filled -= 8
            out.append(held >> filled & 255)
        held &= (1 << filled) - 1

    put(256)
    codes, now = {bytes((i,)): i for i in range(256)}, b""
    free = 258
    for b in data:
        longer = now + bytes((b,))
        if longer in codes:
            now = longer
            continue
        put(codes[now])
        codes[longer] = free
        free += 1
        if free == 4094:
            put(256)
            codes, free, bits = {bytes((i,)): i for i in range(256)}, 258, 9
        elif free > (1 << bits) - 1:
            bits += 1
        now = bytes((b,))
    if now:
        put(codes[now])
        free += 1
        if free > (1 << bits) - 1 and bits < 12:
            bits += 1
    put(257)
    if filled:
        out.append(held << (8 - filled) & 255)
    return bytes(out)


def lzw_unpack(data: bytes, size: int) -> bytes:
    first = [bytes((i,)) for i in range(256)] + [b"", b""]
    words, bits, held, filled, last, out, made = list(first), 9, 0, 0, None, [], 0
    for b in data:
        held, filled = held << 8 | b, filled + 8
        if filled < bits:
            continue
        filled -= bits
        code = held >> filled
        held &= (1 << filled) - 1
        if code == 257:
            break
        if code == 256:
            words, bits, last = list(first), 9, None
            continue
        if last is None:
            word = words[code]
        else:
            if code > len(words):
                raise ValueError("LZW code out of range")
            word = words[code] if code < len(words) else last + last[:1]
            words.append(last + word[:1])
        out.append(word)
        made += len(word)
        if made >= size:
            break
        last = word
        bits = max(bits, min(12, (len(words) + 1).bit_length()))
    return b"".join(out)


PACK = {NONE: bytes, LZW: lzw_pack, DEFLATE: lambda d: zlib.compress(d, 1), OLD_DEFLATE: lambda d: zlib.compress(d, 1), PACKBITS: pack_bits}
UNPACK = {
    NONE: lambda d, n: d[:n], LZW: lzw_unpack, PACKBITS: unpack_bits,
    DEFLATE: lambda d, n: zlib.decompressobj().decompress(d, n), OLD_DEFLATE: lambda d, n: zlib.decompressobj().decompress(d, n),
}


def encode(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 2, tile: int = 0, order: str = "<") -> bytes:
    """8-bit grey pages (height, width) as one file; strips, or with tile (a multiple of 16) square tiles."""
    out, link = bytearray(struct.pack(order + "2sHI", b"II" if order == "<" else b"MM", 42, 0)), 4
    for page in pages:
        height, width = page.shape
        blocks = []
        if tile:
            padded = np.pad(page, ((0, -height % tile), (0, -width % tile)), mode="edge")
            blocks = [padded[y : y + tile, x : x + tile] for y in range(0, padded.shape[0], tile) for x in range(0, padded.shape[1], tile)]
        else:
            blocks = [page[y : y + STRIP_ROWS] for y in range(0, height, STRIP_ROWS)]
        offsets, counts = [], []
        for block in blocks:
            if predictor == 2:
                block = np.concatenate([block[:, :1], np.diff(block, axis=1)], axis=1)  # wraps at 256
            data = PACK[compression](np.ascontiguousarray(block).tobytes())
            offsets.append(len(out))
            counts.append(len(data))
            out += data
        tags = {256: width, 257: height, 258: 8, 259: compression, 262: 1, 277: 1, 317: predictor}
        tags |= {322: tile, 323: tile, 324: offsets, 325: counts} if tile else {273: offsets, 278: STRIP_ROWS, 279: counts}
        out += b"\0" * (len(out) % 2)
        places = {}
        for tag, value in tags.items():
            if isinstance(value, list) and len(value) > 1:
                places[tag] = len(out)
                out += struct.pack(f"{order}{len(value)}I", *value)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(tags))
        for tag, value in sorted(tags.items()):
            n = len(value) if isinstance(value, list) else 1
            out += struct.pack(order + "HHII", tag, 4, n, places[tag] if tag in places else value[0] if isinstance(value, list) else value)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def directories(data: bytes) -> Iterator[tuple[str, dict[int, list[int]]]]:
    """The tags with integer values of each image directory in turn, each directory once."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at and at not in seen:
        seen.add(at)
        tags = {}
        n = struct.unpack_from(order + "H", data, at)[0]
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            if kind in LETTERS:
                place = at + 10 + 12 * i
                if count * SIZES[kind] > 4:
                    place = struct.unpack_from(order + "I", data, place)[0]
                tags[tag] = list(struct.unpack_from(f"{order}{count}{LETTERS[kind]}", data, place))
        yield order, tags
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def decode(data: bytes, order: str, tags: dict[int, list[int]]) -> np.ndarray:
    """Samples of one directory, (height, width, samples a pixel), of 8 or 16 bits, interleaved or in planes."""
    one = lambda tag, other: tags.get(tag, [other])[0]
    width, height, each, planes = one(256, 0), one(257, 0), one(277, 1), one(284, 1)
    bits, compression, predictor = one(258, 1), one(259, NONE), one(317, 1)
    if bits not in (8, 16) or len(set(tags.get(258, [1]))) > 1 or compression not in UNPACK or predictor not in (1, 2):
        raise ValueError(f"bits {bits}, compression {compression}, predictor {predictor} are not read")
    kind, inside = np.dtype(order + f"u{bits // 8}"), 1 if planes == 2 else each
    tiled = 324 in tags
    block_h, block_w = (one(323, 0), one(322, 0)) if tiled else (min(one(278, height), height), width)
    offsets, counts = tags[324 if tiled else 273], tags[325 if tiled else 279]
    out = np.zeros((height, width, each), kind.newbyteorder("="))
    down, across = -(-height // max(block_h, 1)), -(-width // max(block_w, 1))
    for n, (at, size) in enumerate(zip(offsets, counts, strict=True)):
        plane, rest = divmod(n, down * across)
        y, x = rest // across * block_h, rest % across * block_w
        rows = block_h if tiled else min(block_h, height - y)
        want = rows * block_w * inside * kind.itemsize
        raw = UNPACK[compression](data[at : at + size], want)
        if len(raw) < want:
            raise ValueError("a strip or tile is too short")
        block = np.frombuffer(raw, kind, rows * block_w * inside).reshape(rows, block_w, inside).astype(kind.newbyteorder("="))
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=block.dtype)
        block = block[: height - y, : width - x]
        if planes == 2:
            out[y : y + block.shape[0], x : x + block.shape[1], plane] = block[:, :, 0]
        else:
            out[y : y + block.shape[0], x : x + block.shape[1]] = block
    return out


def feature(samples: np.ndarray) -> str:
    """Mean, deviation and the shares of 16 equal bands of the sample range, in thousandths."""
    if not samples.size:
        return ""
    top = samples.ravel() >> 8 if samples.dtype.itemsize == 2 else samples.ravel()
    counts = np.bincount(top, minlength=256)
    n, levels = counts.sum(), np.arange(256)
    mean = (counts * levels).sum() / n
    deviation = np.sqrt((counts * (levels - mean) ** 2).sum() / n)
    return f"{mean:.3f};{deviation:.3f};" + ",".join(str(x * 1000 // n) for x in counts.reshape(16, 16).sum(1))


def payload(text: str | None) -> tuple[int, bytes]:
    """UTF-8 length, and the bytes padded with 255 to a positive multiple of WIDTH."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return len(data), data + b"\xff" * ((-len(data)) % WIDTH or (0 if data else WIDTH))


def store_texts(docs: DataFrame, compression: int = DEFLATE, predictor: int = 2, tile: int = 0) -> DataFrame:
    """doc_id, n_bytes, payload_bytes and media of each row of docs (doc_id, text): its bytes as one grey page.

    Null text is an empty one; repeated rows give equal media; other columns are ignored; no shuffle.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                made = [payload(t) for t in batch.column(1).to_pylist()]
                media = [encode([np.frombuffer(p, np.uint8).reshape(-1, WIDTH)], compression, predictor, tile) for _, p in made]
                yield pa.record_batch(
                    [batch.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([len(p) for _, p in made], pa.int64()), pa.array(media, pa.binary())],
                    ["doc_id", "n_bytes", "payload_bytes", "media"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(store, f"doc_id {kind}, n_bytes long, payload_bytes long, media binary")


PAGE = (
    "page int, width int, height int, samples_per_pixel int, bits int, compression int, error string, samples binary, "
    "samples_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
)


def read_pages(media: DataFrame, keep: list[str], samples: bool = True) -> DataFrame:
    """One row a page of each file in media.media: the columns keep, and the page's size, samples, digests and features.

    samples=False leaves the sample bytes out and only their digests in (tail_crc32 is that of the last 32 bytes).
    A null or damaged file, or a page of a kind that isn't read, gives a row that says so in error; pages of a file are
    decoded one at a time.
    """
    kinds = ", ".join(f"{c} {media.schema[c].dataType.simpleString()}" for c in keep)
    names = [x.split()[0] for x in PAGE.split(", ")]
    shape = ["int32"] * 6 + ["string", "binary", "string", "int64", "int64", "string", "string"]

    def page_rows(data: bytes | None) -> Iterator[tuple]:
        if data is None:
            yield (None,) * 6 + ("no file",) + (None,) * 6
            return
        sha, n = hashlib.sha256(data).hexdigest(), -1
        try:
            for n, (order, tags) in enumerate(directories(data)):  # noqa: B007
                image = decode(data, order, tags)
                raw = image.tobytes()
                yield (
                    n, image.shape[1], image.shape[0], image.shape[2], image.dtype.itemsize * 8, tags.get(259, [NONE])[0], None,
                    raw if samples else None, hashlib.sha256(raw).hexdigest(), zlib.crc32(raw[-32:]), len(data), sha, feature(image),
                )
        except (ValueError, KeyError, IndexError, struct.error, zlib.error) as e:
            yield (n,) + (None,) * 5 + (f"{type(e).__name__}: {e}"[:200], None, None, None, len(data), sha, None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                rows, source = [], []
                for i, data in enumerate(batch.column(len(keep))):
                    for row in page_rows(data.as_py()):
                        rows.append(row)
                        source.append(i)
                kept = [batch.column(k).take(pa.array(source, pa.int32())) for k in range(len(keep))]
                made = [pa.array([r[k] for r in rows], getattr(pa, kind)()) for k, kind in enumerate(shape)]
                yield pa.record_batch([*kept, *made], [*keep, *names])

    return media.select(*keep, "media").mapInArrow(read, f"{kinds}, {PAGE}")


def op9_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the samples of a grey page: written, read back, and its features."""
    media = store_texts(common.table(spark, sf_dir, "documents"))
    pages = read_pages(media, ["doc_id", "n_bytes", "payload_bytes"], samples=False)
    return pages.selectExpr(
        "doc_id", "n_bytes", "payload_bytes", "samples_sha256 AS payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "page"
    )
