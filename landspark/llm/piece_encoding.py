"""Encoding texts as the pieces of a SentencePiece model of merge type, and decoding them.

Such a model merges, again and again, the two neighbours whose union is the piece of the best score
(the leftmost of equals). The result is the one sequence of pieces in which each piece and each two
neighbours, merged anew by themselves, stay as they are; so it can be searched for. From left to right the
longest piece that begins at a place is tried first, then shorter ones that fit what stands before; where
none does, the place is marked in a bitfield, the last piece is taken back, and a shorter one is tried.
A place is marked once at most, as what leads to it is unique. One pass of an
Aho-Corasick automaton finds the longest piece at every place; whether two pieces
fit is found by merging them, once for each pair.

No piece goes on behind a space or, where the vocabulary lacks it, a line break, so a text falls into units
there, and the ids of short units are kept by each worker, in two generations of bounded size.
Characters that are no piece become the pieces of their bytes.

A null text counts as empty. An empty text has the begin and end ids alone. Texts
of any length are encoded in parts that end where a unit ends. Only id and text are read, so other
columns may have any name; repeated rows have repeated results, and an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landspark.llm.common import small_batches

#: Units whose ids a worker keeps in each of two generations, at most, and characters of the longest of them.
CACHED_UNITS, CACHED_CHARS = 200_000, 64
#: Pairs of pieces that a worker remembers, at most.
CACHED_PAIRS = 500_000
#: Characters of a text that are cut into units at once, about.
PIECE = 1 << 20
#: What stands for a space in pieces.
SPACE = "▁"
_encoders: dict = {}


class Encoder:
    """Encodes texts by the pieces of one model."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        own, n = self.library, self.library.get_piece_size()
        self.score = {own.id_to_piece(k): own.get_score(k) for k in range(n) if not (own.is_control(k) or own.is_byte(k) or own.is_unknown(k) or own.is_unused(k))}
        self.bytes = [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        characters = {c for p in self.score for c in p}
        if not all(map(own.is_byte, self.bytes)) or characters - self.score.keys() or any(SPACE in p.lstrip(SPACE) for p in self.score) or own.encode("a  ﬁ\t") != self._plain("a  ﬁ\t"):
            raise ValueError("not a merge-type model that keeps texts as they are, falls back to bytes and splits words at spaces")
        self.stops = "" if "\n" in characters else "\n"
        self.units = re.compile(f"{SPACE}*[^{SPACE}{self.stops}]+|{SPACE}+" + f"|[{self.stops}]" * bool(self.stops))
        # pieces that merging never leaves as they are can't be part of a result
        self.pieces, self.ids, self.sizes, self.shorter = [], [], [], []
        numbers: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for p in sorted(p for p in self.score if self.merged(p) == [p]):
            k = numbers[p] = len(self.pieces)
            self.pieces.append(p)
            self.ids.append(own.piece_to_id(p))
            self.sizes.append(len(p))
            # prefixes come before longer pieces in this order
            self.shorter.append(next((numbers[p[:i]] for i in range(len(p) - 1, 0, -1) if p[:i] in numbers), -1))
            self.automaton.add_word(p, (k, len(p)))
        self.automaton.make_automaton()
        # the last entries are those of a character that is no piece, -1
        self.sizes.append(1)
        self.shorter.append(-1)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _plain(self, text: str) -> list[int]:
        """The ids of a text by merging alone; slow."""
        parts = self.merged((SPACE + text).replace(" ", SPACE)) if text else []
        return [k for p in parts for k in ([self.library.piece_to_id(p)] if p in self.score else [self.bytes[b] for b in p.encode()])]

    def merged(self, text: str) -> list[str]:
        """The pieces that a short text is merged to."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                found = score.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fit(self, a: int, b: int) -> bool:
        """Whether two neighbours stay as they are."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= CACHED_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merged(self.pieces[a] + self.pieces[b]) == [self.pieces[a], self.pieces[b]]
        return known

    def search(self, text: str) -> list[int]:
        """The ids of a unit: its longest pieces from left to right, taken back from the first on that does not fit."""
        pairs, tokens, at = self.pairs, [], 0
        last = None
        for end, (token, size) in self.automaton.iter_long(text):
            if end + 1 - size != at or last is not None and not (pairs[last, token] if (last, token) in pairs else self.fit(last, token)):
                return self.backtrack(text, tokens, at)
            tokens.append(token)
            last, at = token, end + 1
        return [self.ids[k] for k in tokens] if at == len(text) else self.backtrack(text, tokens, at)

    def backtrack(self, text: str, taken: list[int], at: int) -> list[int]:
        """Goes on behind the pieces ``taken``, which end at ``at``; a character that is no piece is -1."""
        n, sizes, pairs, shorter = len(text), self.sizes, self.pairs, self.shorter
        longest = [-1] * n
        for end, (k, size) in self.automaton.iter(text):  # by end, so the last that begins at a place is the longest
            longest[end + 1 - size] = k
        failed = bytearray(n // 8 + 1)
        token, last = longest[at], taken[-1] if taken else -1
        while True:
            end = at + sizes[token]
            if not failed[end >> 3] >> (end & 7) & 1 and (last < 0 or token < 0 or (pairs[last, token] if (last, token) in pairs else self.fit(last, token))):
                taken.append(token)
                if end == n:
                    break
                at, last, token = end, token, longest[end]
            else:
                token = shorter[token]
                if token < 0:  # no piece goes on from here: take the last one back, and look for a shorter one
                    failed[at >> 3] |= 1 << (at & 7)
                    token = taken.pop()
                    at -= sizes[token]
                    last = taken[-1] if taken else -1
        ids, at = [], 0
        for token in taken:
            if token >= 0:
                ids.append(self.ids[token])
            else:
                ids += [self.bytes[b] for b in text[at].encode()]
            at += sizes[token]
        return ids

    def _learn(self, units: set[str]) -> None:
        for u in units:
            found = self.older.get(u)
            self.known[u] = np.array(self.search(u), "<u4").tobytes() if found is None else found

    def _parts(self, text: str) -> Iterator[str]:
        """Pieces of a text that end where a unit ends."""
        at = 0
        while len(text) - at > PIECE:
            cut = text.rfind(SPACE, at + 1, at + PIECE)
            while cut > at and text[cut - 1] == SPACE:
                cut -= 1
            if cut <= at:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def __call__(self, text: str) -> bytes:
        """The ids of a text, without begin and end, as little-endian unsigned 32-bit integers."""
        out = []
        for part in self._parts((SPACE + text).replace(" ", SPACE)) if text else ():
            units = self.units.findall(part)
            if len(self.known) > CACHED_UNITS:
                self.known, self.older = {}, self.known
            known = self.known
            if new := {u for u in units if u not in known}:
                long = {u for u in new if len(u) > CACHED_CHARS}
                self._learn(new - long)
                if long:
                    out += [known[u] if u in known else np.array(self.search(u), "<u4").tobytes() for u in units]
                    continue
            out += map(known.__getitem__, units)
        return b"".join(out)


def encoder(model: bytes) -> Encoder:
    """This worker's encoder."""
    if hash(model) not in _encoders:
        _encoders.clear()
        _encoders[hash(model)] = Encoder(model)
    return _encoders[hash(model)]


def encode(docs: DataFrame, model_file: str, begin: bool = True, end: bool = True, decoded: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every text, map-only; ids are packed as little-endian unsigned 32-bit integers.

    ``decoded`` adds ``decoded``, the text that the ids are decoded to, as :func:`decode` gives it.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(model_file, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())  # a vocabulary: less than a MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            own = encoder(model.value)
            first, last = (np.array([k] if wanted else [], "<u4").tobytes() for k, wanted in ((own.library.bos_id(), begin), (own.library.eos_id(), end)))
            ids = [first + own(text.as_py() or "") + last for text in rows.column(1)]
            out = {"doc_id": rows.column(0), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids": pa.array(ids, pa.binary())}
            if decoded:
                out["decoded"] = pa.array([own.library.decode(np.frombuffer(x, "<u4").tolist()) for x in ids], pa.string())
            yield pa.record_batch(list(out.values()), names=list(out))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary" + ", decoded string" * decoded)


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``, map-only; null ids give null."""
    spark = encoded.sparkSession
    with open(model_file, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        for rows in batches:
            texts = [None if x.as_py() is None else library.decode(np.frombuffer(x.as_py(), "<u4").tolist()) for x in rows.column(1)]
            yield pa.record_batch([rows.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def unpacked(encoded: DataFrame) -> DataFrame:
    """``doc_id, ids`` with ids as an array of integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids = [None if x.as_py() is None else np.frombuffer(x.as_py(), "<i4") for x in rows.column(1)]
            yield pa.record_batch([rows.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids array<int>")
