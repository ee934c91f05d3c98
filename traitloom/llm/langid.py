"""Language ID by cross-parsing entropy against suffix automata of labelled text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Bounds of the labelled sample that the models are fitted on: documents a language, characters that are read of
#: each, characters of normalised text a language.
SAMPLE_DOCS, SAMPLE_DOC_CHARS, SAMPLE_CHARS = 256, 4_096, 49_152
#: Bytes of all languages' tables of moves together at most, in equal parts; a language of very many letters learns from fewer characters.
TABLE_BYTES = 256 << 20
#: Texts are cut into so many characters that are parsed side by side, and again from where the cut before them ended, until
#: that is where they began; the phrases are those of parsing each text in one go. What has not settled after so many rounds
#: (repeated patterns may never) is parsed block after block, equal blocks entered alike only once.
BLOCK, TURNS = 512, 6
#: Blocks that are remembered so.
REMEMBERED = 4_096
SPACE, UNSEEN = 0, 1
#: Bytes of text that are parsed side by side, about.
HELD = 2 << 20
UNDETERMINED = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """1 for each code point that is a letter."""
    return np.array([chr(i).isalpha() for i in range(0x110000)], np.uint8)


def normal(text: str) -> str:
    """Lower case, everything but letters a single space."""
    return " ".join("".join(c.lower() if c.isalpha() else " " for c in text).split())


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of codes; state 0 is the root."""
    moves, link, length = [{}], [-1], [0]
    last = 0
    for c in codes:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


class Models:
    """Per language a table of the automaton's moves in which a failing move starts the next phrase.

    An entry is (next state's row) * 4 + phrases that end with this move: none while the match goes on, one when it
    fails, and one more if the character stands nowhere in the language's text and is a phrase by itself.
    """

    def __init__(self, sample: tuple[tuple[str, str], ...]):
        self.langs = [lang for lang, _ in sample]
        texts = [self._bounded(text, TABLE_BYTES // max(1, len(sample))) for _, text in sample]
        alphabet = sorted({c for text in texts for c in text} - {" "})
        code = {c: i + 2 for i, c in enumerate(alphabet)} | {" ": SPACE}
        self.classes = _letters().astype(np.uint16)  # UNSEEN for letters, SPACE for the rest
        for c in alphabet:
            for form in {c, c.upper(), c.title()}:
                if len(form) == 1:
                    self.classes[ord(form)] = code[c]
        self.tables, self.bits, self.own = [], [], []
        for text in texts:
            letters = sorted(set(text) - {" "})  # a table is as wide as its own language's letters; others' are unseen
            mine = {c: i + 2 for i, c in enumerate(letters)} | {" ": SPACE}
            own = np.full(len(code) + 2, UNSEEN, np.uint16)
            for c, i in mine.items():
                own[code[c]] = i
            width = len(mine) + 1
            moves = automaton([mine[c] for c in f" {text} "])
            root = np.full(width, 2, np.int64)
            for c, to in moves[0].items():
                root[c] = to * width * 4 + 1
            table = np.tile(root.astype(np.int32 if len(moves) * width * 4 < 1 << 31 else np.int64), (len(moves), 1))
            table[0] -= 1  # at the root no phrase is open
            for state, row in enumerate(moves):
                for c, to in row.items():
                    table[state, c] = to * width * 4
            self.tables.append(table.ravel())
            self.own.append(own)
            self.bits.append(math.log2(len(text) + 2))

    @staticmethod
    def _bounded(text: str, most: int) -> str:
        """The beginning of text whose table, of at most two states a character, fits into so many bytes."""
        while len(text) > 1 and 8 * (len(text) + 2) * (len(set(text)) + 2) > most:
            text = text[: len(text) * 3 // 4]
        return text

    def codes(self, text: str) -> np.ndarray:
        """Codes of the normalised text with a space at either end; runs of other characters are one space."""
        found = self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        found = np.concatenate([[SPACE], found, [SPACE]]).astype(np.uint16)
        return found[np.concatenate([[True], (found[1:] != SPACE) | (found[:-1] != SPACE)])]

    @staticmethod
    def _in_turn(table: np.ndarray, lanes: np.ndarray, length: np.ndarray, state: int) -> tuple[np.ndarray, int]:
        """Phrases that end in each of a text's blocks, one after another, and the state after the last."""
        counts, known, move = np.zeros(len(lanes), np.int64), {}, table.item
        for k, n in enumerate(length):
            block = lanes[k, :n]
            key = block.tobytes(), state
            if key not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                ends = 0
                for c in block.tolist():
                    entry = move(state + c)
                    ends += entry & 3
                    state = entry >> 2
                known[key] = ends, state
            counts[k], state = known[key]
        return counts, state

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): phrases of each text when parsed against each language."""
        sizes = np.array([len(t) for t in texts])
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        lanes = np.zeros((blocks.sum(), BLOCK), np.uint16)
        length = np.full(blocks.sum(), BLOCK)
        at = 0
        for t, n in zip(texts, blocks, strict=True):
            lanes[at : at + n].reshape(-1)[: len(t)] = t
            at += n
            length[at - 1] = len(t) - (n - 1) * BLOCK
        order = np.argsort(-length, kind="stable")
        place = np.argsort(order)
        follows = np.append(owner[1:] == owner[:-1], False)[order]  # whether a block goes on in the next one
        following = place[np.minimum(order + 1, len(order) - 1)]
        steps, length = np.ascontiguousarray(lanes[order].T), length[order]
        out = np.empty((len(texts), len(self.langs)), np.int64)
        for k, table in enumerate(self.tables):
            begin, end, count = (np.zeros(len(order), np.int64) for _ in range(3))
            todo, own = np.arange(len(order)), self.own[k][steps]
            turn = 0
            while len(todo):
                turn += 1
                if turn > TURNS:
                    # blocks of a text lie one after another in lanes, and place says where they are now
                    for text in np.unique(owner[order[todo]]):
                        at = order[todo[owner[order[todo]] == text]].min()
                        blocks_of = place[at : np.searchsorted(owner, text, side="right")]
                        count[blocks_of], end[blocks_of[-1]] = self._in_turn(table, own[:, blocks_of].T, length[blocks_of], int(begin[place[at]]))
                    break
                some = own if len(todo) == len(order) else own[:, todo]
                open_at = np.searchsorted(-length[todo], -np.arange(BLOCK), side="left")  # blocks longer than the step
                state, ends = begin[todo].astype(table.dtype), np.zeros(len(todo), np.int64)
                for j, n in enumerate(open_at):
                    if not n:
                        break
                    entry = table[state[:n] + some[j, :n]]
                    ends[:n] += entry & 3
                    state[:n] = entry >> 2
                end[todo], count[todo] = state, ends
                on = todo[follows[todo]]
                on = on[begin[following[on]] != end[on]]
                begin[following[on]] = end[on]
                todo = np.sort(following[on])
            count[~follows] += end[~follows] != 0  # the last phrase, unless it ended with an unseen letter
            out[:, k] = np.bincount(owner[order], weights=count, minlength=len(texts))
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        codes = [self.codes(t) if t else np.zeros(1, np.uint16) for t in texts]
        known = np.array([bool((c != SPACE).any()) for c in codes])
        langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.langs or not known.any():
            return langs, scores
        rows = np.flatnonzero(known)
        parsed = [codes[i] for i in rows]
        cost = self.phrases(parsed) * np.array(self.bits) / np.array([len(c) for c in parsed])[:, None]
        best = cost.argmin(1)  # the first of equals: languages are sorted
        least = cost[np.arange(len(rows)), best]
        rest = cost.copy()
        rest[np.arange(len(rows)), best] = np.inf
        second = rest.min(1)
        for i, b, score in zip(rows, best, np.clip(1 - least / second, 0, 1), strict=True):
            langs[i], scores[i] = self.langs[b], float(score)
        return langs, scores


_MODELS: dict[int, Models] = {}


def models(sample: tuple[tuple[str, str], ...]) -> Models:
    """Built once in each worker."""
    key = hash(sample)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Models(sample)
    return _MODELS[key]


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame) -> tuple[tuple[str, str], ...]:
    """The models' text: (lang, normalised text), sorted by lang.

    For each lang the SAMPLE_DOCS labelled, not held out documents of least id hash; of each the first
    SAMPLE_DOC_CHARS characters, together at most SAMPLE_CHARS. The result is bounded by these and the number of languages.
    """
    learn = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    place = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    picked = learn.select("lang", "doc_id").withColumn("n", F.row_number().over(place)).where(F.col("n") <= SAMPLE_DOCS)
    ids = sorted({r["doc_id"] for r in picked.collect()})
    texts = learn.where(F.col("doc_id").isin(ids)).select("lang", "doc_id", F.substring("text", 1, SAMPLE_DOC_CHARS).alias("text"))
    rows = texts.groupBy("lang", "doc_id").agg(F.min("text").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id").collect() if ids else []
    found: dict[str, list[str]] = {}
    for r in rows:
        found.setdefault(r["lang"], []).append(normal(r["text"] or ""))
    joined = {lang: " ".join(t for t in parts if t)[:SAMPLE_CHARS].strip() for lang, parts in found.items()}
    return tuple(sorted((lang, text) for lang, text in joined.items() if text))


def identify(docs: DataFrame, sample: tuple[tuple[str, str], ...]) -> DataFrame:
    """docs with lang_pred and score, from the text alone; existing columns of these names are replaced.

    The language whose text needs the fewest bits wins: phrases of the cross-parsing times the bits of a position in
    that text, by character. score is one less best over second best. Null texts and those without a letter are
    `und` with score 0, as is every text when nothing was learned; letters that no language has are phrases of
    their own; of equal languages the first by name. Rows are handled where they lie, whole; texts may be of any length; an
    empty table gives no rows.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*[f"`{c}`" for c in keep])
    at = keep.index("text")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = models(sample)
        for whole in batches:
            read = pa.compute.fill_null(pa.compute.binary_length(whole.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            group = np.cumsum(read) // HELD  # a long text is a group of its own, nearly
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else []
            for begin, end in zip(first, [*first[1:], whole.num_rows], strict=True):
                batch = whole.slice(begin, end - begin)
                langs, scores = model.predict(batch.column(at).to_pylist())
                yield pa.record_batch([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType([*docs.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    return docs.mapInArrow(predict, schema)


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = common.table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
