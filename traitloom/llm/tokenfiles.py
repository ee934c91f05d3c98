"""Token files: one zstandard frame a document, each with its checksum, then a document directory and a seek table.

A file is a run of ordinary zstandard frames, so any zstandard reader decompresses it as a whole. Two skippable
frames end it: the directory (magic 0x184D2A50; bytes of an id as uint32, then doc_id of each frame as int64) and the seek table of the public
seekable format (magic 0x184D2A5E; compressed size, decompressed size and checksum of each frame as uint32, then
the number of frames, a descriptor byte and 0x8F92EAB1), with CRC-32 of the decompressed bytes as checksum.
A reader takes the table from the file's end and decompresses only the frames it wants.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

DIRECTORY, SEEK_TABLE, FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
END_ID, LEVEL = 1, 3
#: Rows of documents in a file, about; files hold ranges of doc_id.
FILE_ROWS = 8_192
#: Files at most; beyond it they grow.
MOST_FILES = 10_000
#: Entries of a worker's cache from words to ids; once full it is kept as the older of two, which only costs time.
CACHE_WORDS = 200_000
#: Texts that a task holds split into words at once.
STEP = 128


#: Texts whose ids are those of their lower-cased pieces, if the tokenizer's do not cross white space.
PROBES = ("", " ", "\n\n", "One two", " The  QUICK\nbrown Fox. ", "it's Hello, World... 12 3", "A b c A B C", "caf\u00e9 na\u00efve \u4e2d\u6587 x", "word\n. word ,")
#: A-Z to a-z, and an end of a line to a blank.
_LOWER_LINES = bytes(32 if b == 10 else common.LOWER_ASCII[b] for b in range(256))


#: Words that a tokenizer's model alone has to encode as the tokenizer does, if lower-case Latin words are to go to it at once.
WORDS = ("a", "the", "quick", "thionandes", "etaoinshrdlucmfwypvbgkqjxz", "zyxwvutsrqponmlkjihgfedcba", "qz" * 100, "\u00e9\u00e0\u00fc\u00df\u00f1\u00e7", "ci\u00f3nll\u00f3", "\u017e\u0142\u0151\u0131\u011f\u00f8\u00fe\u0101\u024f")
#: Marks that are looked up alone where they end a piece, if TAILED show that the tokenizer splits them from letters; else the first two.
TAILS, TAILED = ".,#&$*%", ("the###", "quick,&&&", "a.$%*", "\u00e9t\u00e9%%%", "one.#,*")
#: The character that stands for each byte in byte-level vocabularies: printable ones for themselves, others by turn from 256 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_CHARS = {b: 256 + n for n, b in enumerate(b for b in range(256) if b not in _PRINTED)}


def model_form(word: str) -> str | None:
    """A word of lower-case Latin letters as a byte-level model takes it; None for any other piece. Such words are their own normal form."""
    if not word.isalpha() or word != word.lower():
        return None
    if word.isascii():
        return word
    return word.encode().decode("latin-1").translate(BYTE_CHARS) if max(word) < "\u0250" else None


class Pieces(dict):
    """Ids of pieces as bytes; one that is not there is taken from the older table or encoded."""

    def __init__(self, encode: Callable[[str], bytes], tails: str, old: dict[str, bytes]):
        super().__init__()
        self.encode, self.tails, self.old = encode, tails, old

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            word = piece.rstrip(self.tails)
            # letters and the marks after them are split from each other by any tokenizer of words, so both are looked up alone
            found = self[word] + self[piece[len(word) :]] if len(word) < len(piece) and word.isalpha() else self.encode(piece)
        self[piece] = found
        return found


class Encoder:
    """encode() of a tokenizers file, one white-space-free piece at a time where the file allows for it.

    It does if it lower-cases and drops white space by itself, as PROBES tell: then normalising, splitting and merging never cross white
    space, so the ids of a text are those of its pieces in turn; pieces recur, so most come from the cache. Lower-case Latin words
    have nothing to be normalised or split, so the model gets them at once (where WORDS tell that this is so, and no added token begins
    with a letter). Texts of any other tokenizer are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.width = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.by_piece = all(self._ids(x) == [i for p in x.lower().split() for i in self._ids(p)] for x in PROBES)
        added = any(t.content.strip()[:1].isalpha() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.by_model = not added and all([t.id for t in self.tokenize(model_form(w))] == self._ids(w) for w in WORDS)
        split = lambda x: self._ids(x.rstrip(TAILS)) + self._ids(x[len(x.rstrip(TAILS)) :])
        tails = TAILS if not added and all(self._ids(x) == split(x) for x in TAILED) else TAILS[:2]
        self.cache = Pieces(self._piece, tails, {})

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _piece(self, piece: str) -> bytes:
        word = model_form(piece) if self.by_model else None
        ids = self._ids(piece) if word is None else [t.id for t in self.tokenize(word)]
        return array("H" if self.width is np.uint16 else "I", ids).tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of each text, without the end id."""
        if not self.by_piece:
            return [np.array(e.ids, self.width).tobytes() for e in self.tokenizer.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
        # other white space than blanks and ends of lines stays inside pieces
        split = ((t or "").encode("utf-8", "surrogatepass").translate(_LOWER_LINES).decode("utf-8", "surrogatepass").split(" ") for t in texts)
        out = []
        for pieces in split:
            if len(self.cache) > CACHE_WORDS:
                self.cache.old = {}
                self.cache = Pieces(self._piece, self.cache.tails, self.cache)
            out.append(b"".join(map(self.cache.__getitem__, pieces)))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def frame(ids: bytes, level: int = LEVEL) -> bytes:
    return zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress(ids)


class Writer:
    """Writes one file in order; a file appears under its name only when it is whole."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str, width: int = 2):
        self.width = width
        self.fs, self.path, self.part = fs, path, f"{path}.{os.getpid()}-{os.urandom(4).hex()}"
        self.out, self.ids, self.table = fs.open_output_stream(self.part), [], []

    def add(self, doc_id: int | None, data: bytes, size: int, crc: int) -> None:
        self.out.write(data)
        self.ids.append(-(1 << 63) if doc_id is None else doc_id)
        self.table.append((len(data), size, crc))

    def close(self) -> None:
        directory = struct.pack("<I", self.width) + np.array(self.ids, "<i8").tobytes()
        self.out.write(struct.pack("<II", DIRECTORY, len(directory)) + directory)
        table = np.array(self.table, "<u4").reshape(-1, 3).tobytes()
        self.out.write(struct.pack("<II", SEEK_TABLE, len(table) + 9) + table + struct.pack("<IBI", len(self.table), 0x80, FOOTER))
        self.out.close()
        self.fs.move(self.part, self.path)  # a second attempt replaces the file by the same bytes


class Reader:
    """Random access to one file: only the tail and the wanted frames are read."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, descriptor, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != FOOTER or descriptor != 0x80:
            raise ValueError(f"{path}: no seek table")
        begin = size - 9 - 12 * n - 8
        self.table = np.frombuffer(self.file.read_at(12 * n, begin + 8), "<u4").reshape(n, 3).astype(np.int64)
        if struct.unpack("<II", self.file.read_at(8, begin)) != (SEEK_TABLE, 12 * n + 9):
            raise ValueError(f"{path}: broken seek table")
        ids = self.file.read_at(8 * n + 12, begin - 8 * n - 12)
        if struct.unpack("<II", ids[:8]) != (DIRECTORY, 8 * n + 4):
            raise ValueError(f"{path}: broken directory")
        self.width = struct.unpack("<I", ids[8:12])[0]
        self.doc_ids = np.frombuffer(ids[12:], "<i8")
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        self.unpack = zstandard.ZstdDecompressor().decompress

    def __len__(self) -> int:
        return len(self.table)

    def get(self, i: int) -> bytes:
        """The decompressed bytes of frame i, checked."""
        data = self.unpack(self.file.read_at(int(self.table[i, 0]), int(self.starts[i])), max_output_size=int(self.table[i, 1]))
        if len(data) != self.table[i, 1] or zlib.crc32(data) != self.table[i, 2]:
            raise ValueError(f"frame {i}: checksum differs")
        return data


def file_name(n: int) -> str:
    return f"tokens-{n:06d}.zst"


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write the ids of docs (doc_id, text) to files in folder, ascending by doc_id over the files in turn.

    Returns one row a file: file_no, path, n_docs, n_tokens. Texts are tokenised and compressed where they lie;
    only frames are shuffled, by ranges of doc_id that approximate quantiles of all ids bound. Null text has only
    the end id; null doc_ids come first; equal doc_ids stay together, ordered by their bytes; an empty table writes
    no file; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([end_id], encode.width).tobytes()
        for whole in batches:
            for at in range(0, whole.num_rows, STEP):
                batch = whole.slice(at, STEP)
                ids = [x + end for x in encode(batch.column(1).to_pylist())]
                file_no = np.searchsorted(bounds, batch.column(0).fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="right")
                yield pa.record_batch(
                    [
                        batch.column(0), pa.array([frame(x) for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int32()),
                        pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(file_no, pa.int32()),
                    ],
                    ["doc_id", "frame", "size", "crc", "file_no"],
                )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, out, number, tokens = np.dtype(encoder(tokenizer).width).itemsize, None, None, 0
        fs, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for no, doc_id, data, size, crc in zip(*(batch.column(c).to_pylist() for c in ("file_no", "doc_id", "frame", "size", "crc")), strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    number, out = no, Writer(fs, f"{root}/{file_name(no)}", width)
                out.add(doc_id, data, size, crc)
                tokens += size // width
        if out is not None:
            out.close()
            row = {"file_no": [number], "path": [f"{folder}/{file_name(number)}"], "n_docs": [len(out.ids)], "n_tokens": [tokens]}
            yield pa.RecordBatch.from_pydict(row, pa.schema([("file_no", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    files = min(MOST_FILES, 1 + docs.count() // file_rows)
    bounds = docs.approxQuantile("doc_id", [i / files for i in range(1, files)], 0.1 / files) if files > 1 else []
    bounds = np.array(sorted({int(b) for b in bounds}), np.int64)
    frames = docs.mapInArrow(compress, "doc_id long, frame binary, size int, crc long, file_no int")
    placed = frames.repartitionById(len(bounds) + 1, F.col("file_no")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "crc", "frame")
    return common.stash(placed.mapInArrow(write, "file_no int, path string, n_docs long, n_tokens long"), "token-files")


def read_tokens(files: DataFrame, wanted: Iterable[int] | None = None) -> DataFrame:
    """Read files (file_no, path, n_tokens) back: one row a document, doc_id, start, n_tokens, ids, ids_crc32.

    start counts the ids of all documents before it, over all files; with wanted, only frames of those doc_ids
    are decompressed. A task reads a file, frame by frame.
    """
    chosen = None if wanted is None else set(wanted)
    before = F.sum("n_tokens").over(Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1))  # a row a file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                fs, name = pyarrow.fs.FileSystem.from_uri(path)
                file = Reader(fs, name)
                starts, kind = start + np.concatenate([[0], np.cumsum(file.table[:, 1] // file.width)]), f"<u{file.width}"
                picks = [i for i in range(len(file)) if chosen is None or int(file.doc_ids[i]) in chosen]
                for at in range(0, len(picks), 512):
                    some = picks[at : at + 512]
                    ids = [np.frombuffer(file.get(i), kind).astype("<u4") for i in some]
                    crc = [zlib.crc32(x.tobytes()) for x in ids]
                    ids_of = [None if file.doc_ids[i] == -(1 << 63) else int(file.doc_ids[i]) for i in some]
                    yield pa.record_batch(
                        [pa.array(ids_of, pa.int64()), pa.array([int(starts[i]) for i in some], pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                    )

    n = max(1, files.count())
    listed = files.select("file_no", "path", F.coalesce(before, F.lit(0)).cast("long").alias("start"))
    return listed.repartition(n, "file_no").mapInArrow(read, "doc_id long, start long, n_tokens long, ids array<int>, ids_crc32 long")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: place, number and checksum of each document's ids."""
    docs = common.table(spark, sf_dir, "documents")
    files = write_tokens(docs, common.new_folder(spark, "tokens"), tokenizer_path())
    return read_tokens(files).select("doc_id", "start", "n_tokens", "ids_crc32")
