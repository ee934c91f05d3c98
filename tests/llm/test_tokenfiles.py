import zlib

import numpy as np
import zstandard
from tokenizers import Tokenizer

from traitloom.llm import common, tokenfiles

from .conftest import SF


def brute(rows):
    tok, start, out = Tokenizer.from_file(tokenfiles.tokenizer_path()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_real(spark, real):
    got = [tuple(r) for r in tokenfiles.op8_token_files(spark, SF).collect()]
    assert sorted(got) == brute([(r.doc_id, r.text) for r in real])


def test_many_files_and_random_access(spark, real):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    folder = common.new_folder(spark, "t")
    files = tokenfiles.write_tokens(docs, folder, tokenfiles.tokenizer_path(), file_rows=30)
    assert files.count() > 3
    want = {r[0]: r for r in brute([(r.doc_id, r.text) for r in real])}
    some = tokenfiles.read_tokens(files, wanted=[3, 77, 150]).collect()
    assert {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in some} == {want[i] for i in (3, 77, 150)}
    path = files.first().path.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[30] ^= 255
    import pyarrow.fs

    bad = path + ".bad"
    open(bad, "wb").write(data)
    reader = tokenfiles.Reader(pyarrow.fs.LocalFileSystem(), bad)
    try:
        for i in range(len(reader)):
            reader.get(i)
        raise AssertionError("damage went unseen")
    except (ValueError, zstandard.ZstdError):
        pass


def test_odd_rows(spark, odd, odd_rows, empty):
    files = tokenfiles.write_tokens(odd, common.new_folder(spark, "t"), tokenfiles.tokenizer_path())
    got = sorted((tuple(r) for r in tokenfiles.read_tokens(files).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    assert got == brute([(r[0], r[1]) for r in odd_rows])
    files = tokenfiles.write_tokens(empty, common.new_folder(spark, "t"), tokenfiles.tokenizer_path())
    assert files.count() == 0 and tokenfiles.read_tokens(files).count() == 0


def test_pieces_equal_whole_texts():
    texts = ["it's  we'll DON'T <|endoftext|> a<|startoftext|>b", "é ́x ΣΑΣ ς İ", "a b c​d\x1fe\x85f", "日本語 12345 ---!!!", ""]
    tok = Tokenizer.from_file(tokenfiles.tokenizer_path())
    got = tokenfiles.Encoder(tokenfiles.tokenizer_path())(texts)
    assert [np.frombuffer(g, np.uint16).tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_go_to_the_model_at_once(monkeypatch):
    """Pieces of Latin letters and marks never pass the whole tokenizer, which took most of the time; ids are its ids all the same, also
    of other pieces, and across both tables of the cache."""
    monkeypatch.setattr(tokenfiles, "CACHE_WORDS", 6)
    encoder = tokenfiles.Encoder(tokenfiles.tokenizer_path())
    plain = ["Thionandes of\u00e9t\u00e9 resh,### rami\u00f1&&& a. \u017e\u0142\u0151.", "THE the\nthe,. " + "qz" * 60]
    other = ["\u01c5 \u0130x \u03a3\u03a3 e\u0301t\u00e9 \u00aa\u00ba it's' don't### 1a.# \u4e2d\u6587. \u00c9T\u00c9 #,. <|endoftext|>. a_b a\t b.\u2028c", None, ""]
    want = [np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u2").tobytes() for t in plain + other]
    seen, ids = [], encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda text: (seen.append(text), ids(text))[1])
    assert encoder(plain) == want[:2] and encoder(plain) == want[:2]
    assert encoder.by_model and not any(c.isalpha() for text in seen for c in text)
    assert encoder(other + plain + other) == want[2:] + want[:2] + want[2:]
