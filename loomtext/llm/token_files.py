"""Token ids as flat unsigned integer files with 64-bit document offsets.

A store is a folder: per partition ``ids`` (flat unsigned integers, little-endian), ``docs`` (64-bit
document ids) and ``offsets`` (64-bit, one more than documents, counted from the partition's first
id), and a manifest table with each partition's base, the number of ids before it, and the number
of its first documents that have no id (0 stands for it in ``docs``). Files are
written with pyarrow's file systems, so a folder may be local or in a shared store; local files
are memory-mapped when read.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomtext.operators.scale import scratch_dir

# Entries of a worker's memories of encoded words and of their pieces, before one becomes the older
# one, which is looked up but not added to.
WORDS_HELD, PIECES_HELD = 300_000, 400_000

WRITE_BYTES = 4 << 20  # ids are gathered up to so many bytes, so that memory stays bounded

_ENCODERS: dict[tuple, "WordEncoder"] = {}

# Words of these characters are cut and lower-cased the same way in Python and in the library.
_SIMPLE = re.compile("[!-~À-ɏ]+").fullmatch
_PRINTED = re.compile("[!-~]+").fullmatch


class WordEncoder:
    """Encodes texts with a tokenizer of the tokenizers library, remembering words.

    White space separates pieces in these vocabularies, so a text's ids are its words' ids. Words
    are remembered as packed ids; new ones go through the library.
    """

    def __init__(self, path: str, dtype: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = dtype
        self.packing = {"<u2": "H", "<u4": "I"}[dtype]
        self.words: dict[str, bytes] = {}
        self.older_words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.cut = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        # The byte alphabet of byte-level vocabularies: printable bytes stand for themselves, the
        # others follow from U+0100 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.alphabet = {b: 256 + n for n, b in enumerate(hidden)}
        whole = self.tokenizer.to_str()
        self.spaced = '"Lowercase"' in whole and '</w>' in whole
        # Strings that the library takes as one id wherever they stand.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _library(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        packed = self.pieces.get(piece)
        if packed is None:
            packed = self.older_pieces.get(piece)
            if packed is None:
                printed = _PRINTED(piece)  # its bytes stand for themselves
                coded = piece if printed else piece.encode().decode("latin-1").translate(self.alphabet)
                ids = [t.id for t in self.tokenizer.model.tokenize(coded)]
                packed = struct.pack(f"<{len(ids)}{self.packing}", *ids)
            if len(self.pieces) >= PIECES_HELD:
                self.older_pieces, self.pieces = self.pieces, {}
            self.pieces[piece] = packed
        return packed

    def _word(self, word: str) -> bytes:
        if any([a in word for a in self.added]):
            return self._library(word)
        if word.isascii():
            if word.isalpha():  # one piece
                return self._piece(word.lower())
            plain = _PRINTED(word)
        else:
            plain = _SIMPLE(word) and unicodedata.is_normalized("NFC", word)
        if plain:
            return b"".join([self._piece(p) for p in self.cut(word.lower())])
        return self._library(word)

    def _held(self, word: str) -> bytes:
        packed = self.words.get(word)
        if packed is None:
            packed = self.older_words.get(word)
            if packed is None:
                packed = self._word(word) if word else b""
            if len(self.words) >= WORDS_HELD:
                self.older_words, self.words = self.words, {}
            self.words[word] = packed
        return packed

    def encode(self, text: str) -> bytes:
        if not self.spaced:
            return self._library(text)
        for space in "\t\n\r\f\v":
            if space in text:
                text = text.replace(space, " ")
        words = text.split(" ")
        out = list(map(self.words.get, words))
        if None in out:
            held = self._held
            out = [held(w) if packed is None else packed for w, packed in zip(words, out, strict=True)]
        return b"".join(out)


def _encoder(path: str, dtype: str) -> WordEncoder:
    if (path, dtype) not in _ENCODERS:
        _ENCODERS[path, dtype] = WordEncoder(path, dtype)
    return _ENCODERS[path, dtype]


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder)


def _mapped(fs: pafs.FileSystem, path: str) -> pa.Buffer:
    if isinstance(fs, pafs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return f.read_buffer()
    with fs.open_input_file(path) as f:
        return f.read_buffer()


MANIFEST = "part int, name string, docs long, ids long, first_doc long, unnamed long"


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    vocabulary: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
    unnamed: bool = False,
) -> str:
    """Encode every text, append ``end_id``, and write the store in ascending id order.

    Returns the store's folder (default: a new one in the shared folder of the session). Texts are
    sorted in ranges of ids; a range is one set of files. A task writes under a name of its own
    attempt and only the names that successful tasks return get into the manifest, so a task that
    runs twice leaves no trace in the store. ``vocabulary`` is the number of ids: up to 65,536
    they take 16 bits, else 32.

    Null texts count as empty and hold the end id alone. Rows without an id are left out, as the
    store is keyed by it; with ``unnamed`` they come first, ordered by a hash of their text, then
    the text, and read back with a null id. Rows that repeat an id stand side by side, ordered by their text. An
    empty table gives a store without files.
    """
    spark = docs.sparkSession
    folder = folder or f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    dtype = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    end = np.asarray([end_id], dtype=dtype).tobytes()
    width = len(end)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (fs, path) = _encoder(tokenizer, dtype), _place(folder)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        fs.create_dir(path, recursive=True)
        n_docs, n_unnamed, offsets, ids, out, doc_file = 0, 0, [0], 0, None, None
        first = None
        for batch in batches:
            if not len(batch):
                continue
            if out is None:
                out = fs.open_output_stream(f"{path}/{name}.ids")
                doc_file = fs.open_output_stream(f"{path}/{name}.docs")
                first = batch.column(0)[0].as_py()
            doc_file.write(batch.column(0).fill_null(0).to_numpy().astype("<i8").tobytes())
            n_unnamed += batch.column(0).null_count
            packed, size = [], 0
            for text in batch.column(1).to_pylist():
                packed += encoder.encode(text or ""), end
                size += len(packed[-2])
                ids += len(packed[-2]) // width + 1
                offsets.append(ids)
                if size > WRITE_BYTES:
                    out.write(b"".join(packed))
                    packed, size = [], 0
            out.write(b"".join(packed))
            n_docs += len(batch)
        if out is None:
            return
        out.close()
        doc_file.close()
        with fs.open_output_stream(f"{path}/{name}.offsets") as f:
            f.write(np.asarray(offsets, dtype="<i8").tobytes())
        rows = [[part], [name], [n_docs], [ids], [first], [n_unnamed]]
        types = [pa.int32(), pa.string(), *[pa.int64()] * 4]
        columns = [pa.array(r, type=t) for r, t in zip(rows, types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "name", "docs", "ids", "first_doc", "unnamed"])

    texts = docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )
    if unnamed:  # dealt by their texts, so that they need not fit in one range
        texts = texts.withColumn("_mark", F.when(F.col("doc_id").isNull(), F.xxhash64("text")))
        keys = ["doc_id", "_mark"]
    else:
        texts, keys = texts.filter("doc_id IS NOT NULL"), ["doc_id"]
    parts = (
        texts.repartitionByRange(*keys)
        .sortWithinPartitions(*keys, "text")
        .select("doc_id", "text")
        .mapInArrow(write, MANIFEST)
    )
    parts.write.parquet(f"{folder}/parts")
    # One row per partition from here on.
    before = Window.orderBy("first_doc", "part").rowsBetween(Window.unboundedPreceding, -1)
    bases = spark.read.schema(MANIFEST).parquet(f"{folder}/parts").withColumn(
        "base", F.coalesce(F.sum("ids").over(before), F.lit(0))
    )
    bases.withColumn("dtype", F.lit(dtype)).write.parquet(f"{folder}/manifest")
    return folder


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a store: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is over its ids as 32-bit
    little-endian integers. Each partition's files are mapped by one task, a document at a time.
    """
    manifest = f"{MANIFEST}, base long, dtype string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(_mapped(fs, f"{path}/{row['name']}.ids"), dtype=row["dtype"])
                offsets = np.frombuffer(_mapped(fs, f"{path}/{row['name']}.offsets"), dtype="<i8")
                doc_ids = np.frombuffer(_mapped(fs, f"{path}/{row['name']}.docs"), dtype="<i8")
                sums = [
                    zlib.crc32(ids[a:b].astype("<u4").tobytes())
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                columns = [
                    pa.array(doc_ids, mask=np.arange(len(doc_ids)) < (row["unnamed"] or 0)),
                    *(pa.array(c) for c in (row["base"] + offsets[:-1], np.diff(offsets), np.asarray(sums, dtype="<i8"))),
                ]
                for at in range(0, len(doc_ids), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [c[at : at + 10_000] for c in columns],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    parts = spark.read.schema(manifest).parquet(f"{folder}/manifest")
    n = max(1, parts.count())
    return parts.repartition(n, "part").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def read_document(folder: str, row: dict) -> Iterator[np.ndarray]:
    """The ids of each document of one partition (a row of the manifest), mapped, in order."""
    fs, path = _place(folder)
    ids = np.frombuffer(_mapped(fs, f"{path}/{row['name']}.ids"), dtype=row["dtype"])
    offsets = np.frombuffer(_mapped(fs, f"{path}/{row['name']}.offsets"), dtype="<i8")
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield ids[a:b]
