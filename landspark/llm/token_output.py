"""Token ids as Arrow files of equal-length sequences.

Documents are range-partitioned and sorted by id, encoded where they lie, and each
partition streams one Arrow IPC file to a shared folder. A file is a row of record
batches with two columns of fixed-size lists, ``input_ids`` (unsigned, 16 bits if the
vocabulary fits, else 32) and ``attention_mask`` (bits, false only behind the last id),
so that sequence ``k`` of a memory-mapped file is a slice, without a copy. The ids of a
document are the ids ``start`` to ``start + n_tokens`` of the whole output.

Null texts count as empty and have the end id alone. Documents of equal id follow each
other by text; null ids come first. An empty table gives no file and no row. Only id and
text are read, so other columns may have any name.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landspark.llm.common import materialize, small_batches

#: Words whose ids a Python worker keeps in each of two generations, at most.
CACHED_WORDS = 200_000
_tokenizers: dict = {}

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Of each byte: 1 for a-z, 2 for marks that end words, 3 for ASCII white space.
_KIND = np.array([1 if 97 <= c <= 122 else 2 if chr(c) in ".,!?;:|" else 3 if c == 32 or 9 <= c <= 13 else 0 for c in range(256)], "u1")


def spaced(text: bytes) -> bytes:
    """Sets a space before each single mark between a letter and white space."""
    bytes_ = np.frombuffer(text, "u1")
    kind = _KIND[bytes_]
    at = np.nonzero((kind[1:-1] == 2) & (kind[:-2] == 1) & (kind[2:] == 3))[0]
    return np.insert(bytes_, at + 1, 32).tobytes() if len(at) else text


class Encoder:
    """Encodes texts by a lower-casing tokenizer that drops white space, keeping the ids of words.

    Pieces between ASCII white space are encoded apart and their ids joined: the pattern
    of such a tokenizer never spans white space, and it splits a letter from a mark, so
    this equals encoding whole texts. Texts with what may be a special token or with the
    separator of pieces are encoded whole.
    """

    SEPARATOR = "\x01"

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.known, self.older = Tokenizer.from_str(spec), {}, {}
        # words of a-z alone are normal already
        self.plain = Tokenizer.from_str(json.dumps(json.loads(spec) | {"normalizer": None}))
        self.mark = self._ids(self.tokenizer, self.SEPARATOR)
        vocabulary = self.tokenizer.get_vocab()
        self.wide = max(vocabulary.values()) >= 1 << 16
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for w, k in vocabulary.items() if w.endswith("</w>")]] = True

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.asarray(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: set[bytes]) -> None:
        plain, other = [], []
        for w in words:
            if w in self.older:
                self.known[w] = self.older[w]
            else:
                (plain if w.isalpha() else other).append(w)
        if plain:  # a word of a-z is one piece to the tokenizer, and its last id ends a word
            ids = self._ids(self.plain, b" ".join(plain).decode())
            raw, cuts = ids.tobytes(), (np.nonzero(self.ends[ids])[0] * 4 + 4).tolist()
            self.known.update(zip(plain, (raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)), strict=True))
        if other:
            ids = self._ids(self.tokenizer, f" {self.SEPARATOR} ".encode().join(other).decode())
            raw, cuts = ids.tobytes(), (np.nonzero(ids == self.mark[0])[0] * 4).tolist()
            self.known.update(zip(other, (raw[a:b] for a, b in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)], strict=True)), strict=True))

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        raw = text.encode("utf-8", "replace")
        if b"<|" in raw or self.SEPARATOR.encode() in raw or len(self.mark) != 1:
            return self._ids(self.tokenizer, raw.decode()).tobytes()
        words = spaced(raw.translate(_LOWER)).split()
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        known = self.known
        if new := {w for w in words if w not in known}:
            self._learn(new)
        return b"".join([known[w] for w in words])


def encoder(spec: str) -> Encoder:
    """This worker's encoder."""
    if hash(spec) not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[hash(spec)] = Encoder(spec)
    return _tokenizers[hash(spec)]


class SequenceFile:
    """Cuts a stream of ids into sequences of equal length and writes them in batches."""

    def __init__(self, sink, length: int, batch: int, wide: bool):
        self.length, self.batch, self.held, self.n_held = length, batch, [], 0
        self.type = "<u4" if wide else "<u2"
        self.schema = pa.schema([("input_ids", pa.list_(pa.uint32() if wide else pa.uint16(), length)), ("attention_mask", pa.list_(pa.bool_(), length))])
        self.writer = pa.ipc.new_file(sink, self.schema)

    def _write(self, ids: np.ndarray, mask: np.ndarray) -> None:
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids.astype(self.type), mask)]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.n_held += len(ids) // 4
        full = self.length * self.batch
        if self.n_held >= full:
            every = np.frombuffer(b"".join(self.held), "<u4")
            for at in range(0, len(every) - full + 1, full):
                self._write(every[at : at + full], np.ones(full, bool))
            rest = every[len(every) // full * full :]
            self.held, self.n_held = [rest.tobytes()], len(rest)

    def close(self) -> None:
        if self.n_held:
            ids = np.frombuffer(b"".join(self.held), "<u4")
            padding = -len(ids) % self.length
            self._write(np.concatenate([ids, np.zeros(padding, "<u4")]), np.arange(len(ids) + padding) < len(ids))
        self.writer.close()


def read_ids(source, spans: Iterable[tuple[int, int]]) -> Iterator[int]:
    """CRC-32 of each ascending span ``start, n`` of a file's ids, batch by batch."""
    file = pa.ipc.open_file(source)
    k, first, ids = -1, 0, np.zeros(0, "<u4")
    for start, n in spans:
        crc, at = 0, start
        while at < start + n:
            while at >= first + len(ids):
                k, first = k + 1, first + len(ids)
                ids = file.get_batch(k).column("input_ids").flatten().to_numpy()
            piece = ids[at - first : start + n - first]
            crc, at = zlib.crc32(np.ascontiguousarray(piece, "<u4"), crc), at + len(piece)
        yield crc


def place(store: fs.FileSystem, own: str, final: str) -> None:
    """Renames an attempt's file to its final name; deletes it if another attempt was first."""
    try:
        if store.get_file_info(final).type == fs.FileType.NotFound:
            store.move(own, final)
    except OSError:  # a store that does not rename onto a file that came in between
        if store.get_file_info(final).type == fs.FileType.NotFound:
            raise
    if store.get_file_info(own).type != fs.FileType.NotFound:
        store.delete_file(own)


def write_tokens(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = 1, length: int = 2048, batch: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes ``path/part-*.arrow`` and returns where each document is.

    ``path`` is a folder that all executors share. Returns ``doc_id, file, file_start,
    n_tokens``, itself written beside the files. A task writes under a name of its own,
    deletes that file if it fails, and renames it at its end unless another attempt has done
    so already; all attempts write the same ids.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # a vocabulary: a few MB

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, part = None, TaskContext.get().partitionId()
        end = np.asarray([end_id], "<u4").tobytes()
        store, folder = fs.FileSystem.from_uri(path)
        own, final, at = f"{folder}/.part-{part:06d}-{uuid.uuid4().hex}", f"{folder}/part-{part:06d}.arrow", 0
        try:
            for rows in batches:
                encoded = encoder(spec.value)
                starts, sizes = [], []
                if out is None:
                    store.create_dir(folder, recursive=True)
                    sink = store.open_output_stream(own)
                    out = SequenceFile(sink, length, batch, encoded.wide or end_id >= 1 << 16)
                for text in rows.column(1):
                    ids = encoded(text.as_py() or "") + end
                    out.add(ids)
                    starts.append(at)
                    sizes.append(len(ids) // 4)
                    at += sizes[-1]
                yield pa.record_batch([rows.column(0), pa.array([part] * len(sizes), pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], names=["doc_id", "file", "file_start", "n_tokens"])
            if out is not None:
                out.close()
                sink.close()
                out = None
                place(store, own, final)
        finally:
            if out is not None:  # the task failed or was stopped
                sink.close()
                store.delete_file(own)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    # rows of one id may be many: they are parted by how their texts begin, which keeps the order of texts
    dealt = rows.repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    return materialize(dealt.mapInArrow(encode, f"doc_id {id_type}, file int, file_start long, n_tokens long"), "token-index")


def read_tokens(index: DataFrame, path: str) -> DataFrame:
    """Reads the files back: ``doc_id, start, n_tokens, ids_crc32, file, file_start``.

    One group per file; a file has one partition's documents. Only one row per file
    reaches the driver.
    """
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    firsts, at = [], 0
    for r in files:
        firsts.append((r["file"], at))
        at += r["n"]
    first = index.sparkSession.createDataFrame(firsts, "file int, first long")

    def check(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        store, folder = fs.FileSystem.from_uri(path)
        rows = rows.sort_by("file_start")
        with store.open_input_file(f"{folder}/part-{key[0].as_py():06d}.arrow") as source:
            spans = zip(rows.column("file_start").to_pylist(), rows.column("n_tokens").to_pylist(), strict=True)
            return rows.append_column("ids_crc32", pa.array(read_ids(source, spans), pa.int64()))

    id_type = index.schema["doc_id"].dataType.simpleString()
    read = index.repartition(max(1, len(files)), "file").groupBy("file").applyInArrow(check, f"doc_id {id_type}, file int, file_start long, n_tokens long, ids_crc32 long")
    return read.join(F.broadcast(first), "file").select("doc_id", (F.col("first") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32", "file", "file_start")
