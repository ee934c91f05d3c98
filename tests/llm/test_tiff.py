import hashlib
import zlib

import numpy as np
import pytest

from traitloom.llm import tiff

from .conftest import SF


@pytest.mark.parametrize("compression", [tiff.NONE, tiff.LZW, tiff.DEFLATE, tiff.OLD_DEFLATE, tiff.PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [0, 16, 64])
@pytest.mark.parametrize("order", ["<", ">"])
def test_round_trip(compression, predictor, tile, order):
    rng = np.random.default_rng(compression)
    pages = [rng.integers(0, top, (h, w)).astype(np.uint8) for h, w, top in ((1, 1, 256), (70, 33, 3), (130, 576, 256))]
    data = tiff.encode(pages, compression, predictor, tile, order)
    found = [tiff.decode(data, o, t) for o, t in tiff.directories(data)]
    assert len(found) == 3 and all((f[:, :, 0] == p).all() for f, p in zip(found, pages, strict=True))


def test_known_streams():
    """Published examples of the two codecs."""
    assert tiff.unpack_bits(bytes.fromhex("FEAA02800 02AFDAA0380002A22F7AA".replace(" ", "")), 24) == bytes.fromhex("AAAAAA80002AAAAAAAAA80002A22AAAAAAAAAAAAAAAAAAAA")
    assert tiff.lzw_unpack(tiff.lzw_pack(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])), 9) == bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])
    assert tiff.lzw_pack(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])).hex() == "8001e0408044080c068080"
    long = np.random.default_rng(0).integers(0, 256, 60_000).astype(np.uint8).tobytes() + b"ab" * 9000
    assert tiff.lzw_unpack(tiff.lzw_pack(long), len(long)) == long and tiff.unpack_bits(tiff.pack_bits(long), len(long)) == long


def brute(doc_id, text):
    data = (text or "").encode()
    padded = data + b"\xff" * ((-len(data)) % 576 or (0 if data else 576))
    return doc_id, len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:])


def test_real(spark, real):
    rows = tiff.op9_tiff(spark, SF).collect()
    assert sorted((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == sorted(brute(r.doc_id, r.text) for r in real)
    by_text = {r.doc_id: r for r in rows}
    first = {}
    for r in real:
        other = first.setdefault(r.text, by_text[r.doc_id])
        assert tuple(other)[1:] == tuple(by_text[r.doc_id])[1:]


def test_odd_rows(spark, odd, odd_rows, empty):
    media = tiff.store_texts(odd, tile=64)
    rows = tiff.read_pages(media, ["doc_id", "n_bytes"]).collect()
    assert sorted(((r.doc_id, r.n_bytes, len(r.samples), r.samples_sha256, r.tail_crc32) for r in rows), key=str) == sorted((brute(r[0], r[1]) for r in odd_rows), key=str)
    assert tiff.read_pages(tiff.store_texts(empty), ["doc_id"]).count() == 0
    files = [(1, None), (2, b""), (3, b"II*\0\x08\0\0\0"), (4, tiff.encode([np.zeros((3, 4), np.uint8)])[:-9]), (5, tiff.encode([np.zeros((3, 4), np.uint8), np.ones((2, 2), np.uint8)]))]
    bad = tiff.read_pages(spark.createDataFrame(files, "id int, media binary"), ["id"]).collect()
    assert {r.id: r.error is None for r in bad} == {1: False, 2: False, 3: False, 4: False, 5: True} and sum(r.id == 5 for r in bad) == 2
