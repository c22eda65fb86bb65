"""Token ids in seekable zstandard files.

A file holds independent zstd frames, each with the documents of about
``FRAME_IDS`` ids, then a skippable frame with the document range of every
frame, then the seek table (the public seekable format: compressed size,
decompressed size and checksum of every frame, footer last). A reader takes the
last bytes, picks the frames whose id range it wants and decompresses only those;
every frame is held against its checksum. A document lies whole in one frame.

Encoding: the tokenizer's own pieces never span a single space or newline
between two other characters, so those segments are encoded one by one and
remembered (letters and the marks behind them apart, as the tokenizer's pattern
does for byte-level BPE); texts with other white space are encoded whole. Both give the ids
of encoding the whole text, at a fraction of the time.

Documents are range-partitioned by (doc_id, text hash) and written in that order, a
file per task, so the files in order hold ascending ids (nulls first).

Defined results: null and empty texts have only the end id; repeated rows are
written each; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
import os
import string
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, prepare, scratch, table, text_rows
from .files import open_fs, write_whole
from .workers import tidy

FRAME_IDS = 1 << 18
CACHE_BYTES = 96 << 20  # of a generation of remembered segments; an encoder keeps four at most
ENTRY_BYTES = 180       # of a segment besides its letters and ids
KNOWN_MARKS, LONG_MARKS = 1 << 13, 16  # marks that are remembered, and letters of the longest
# Behind letters these are a piece of their own (the apostrophe may belong to what follows it).
MARKS = "".join(c for c in string.punctuation if c != "'")
LATIN = "\u0250"  # letters below it are the same to Python and to the tokenizer
TASK_BYTES = 64 << 20  # of texts per task, and so per file: segments are remembered for that long
END_ID = 0
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1  # fixed by the seekable format
INDEX = 0x184D2A50
_RANGE = struct.Struct("<qqIQ")  # first id, last id, documents, ids before this frame in the file


# Byte-level vocabularies write the bytes that are no visible Latin-1 signs as U+0100 and up, in order.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}
SPACE_SIGN = chr(BYTE_SIGNS[ord(" ")])


class _Segments(dict):
    """Ids of segments, made on first use; two generations of about ``CACHE_BYTES`` are kept."""

    def __init__(self, tokenizer, before: str):
        super().__init__()
        self.tokenizer, self.tokenize, self.before = tokenizer, tokenizer.model.tokenize, before
        self.sign = SPACE_SIGN if before else ""
        self.old, self.known_marks, self.bytes = {}, {}, 0

    def __missing__(self, word: str) -> bytes | None:
        ids = self.old.get(word)
        if ids is None and word:
            core = word.rstrip(MARKS)
            plain = core.isascii()
            if core.isalpha() and (plain or max(core) < LATIN):
                # Letters, then marks: pieces of their own, so words share them.
                if core != word:
                    ids = self[core] + self.marks(word[len(core):])
                elif plain:  # ASCII letters are written as they are
                    ids = _packed([t.id for t in self.tokenize(self.sign + core)])
                else:
                    ids = self.piece(self.before + core)
            elif not word[0].isspace() and not word[-1].isspace():
                # (Next to other white space a segment is not encoded by itself.)
                ids = _packed(self.tokenizer.encode(self.before + word, add_special_tokens=False).ids)
        self.bytes += ENTRY_BYTES + len(word) + len(ids or b"")
        if self.bytes > CACHE_BYTES:  # the new generation is full: it takes the place of the old one
            self.old = dict(self)
            self.clear()
            self.bytes = 0
        self[word] = ids
        return ids

    def piece(self, text: str) -> bytes:
        """Ids of a text that the tokenizer's pattern would leave whole, from its model."""
        written = text.encode().decode("latin-1").translate(BYTE_SIGNS)
        return _packed([t.id for t in self.tokenize(written)])

    def marks(self, text: str) -> bytes:
        if len(text) > LONG_MARKS:
            return self.piece(text)
        if text not in self.known_marks:
            if len(self.known_marks) >= KNOWN_MARKS:
                self.known_marks.clear()
            self.known_marks[text] = self.piece(text)
        return self.known_marks[text]


_PACK = [struct.Struct(f"<{n}I").pack for n in range(33)]


def _packed(ids: list[int]) -> bytes:
    n = len(ids)
    return _PACK[n](*ids) if n < 33 else struct.pack(f"<{n}I", *ids)


class Encoder:
    """Whole-text ids by way of remembered segments."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.newline = _packed(self.tokenizer.encode("\n", add_special_tokens=False).ids)
        self.first, self.rest = _Segments(self.tokenizer, ""), _Segments(self.tokenizer, " ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text, as little-endian unsigned 32-bit integers."""
        first, rest = self.first.__getitem__, self.rest.__getitem__
        out = []
        for text in texts:
            parts: list[bytes | None] = []
            for line in text.split("\n"):
                words = line.split(" ")
                parts.append(self.newline)
                parts.append(first(words[0]))
                parts.extend(map(rest, words[1:]))
            if None in parts:
                out.append(_packed(self.tokenizer.encode(text, add_special_tokens=False).ids))
            else:
                out.append(b"".join(parts[1:]))
        return out


def pack(docs: list[tuple[int | None, bytes]]) -> bytes:
    """The payload of a frame: ids, null marks, lengths, then all token ids."""
    n = len(docs)
    return b"".join([
        struct.pack("<I", n), np.array([d or 0 for d, _ in docs], "<i8").tobytes(),
        np.array([d is None for d, _ in docs], "u1").tobytes(),
        np.array([len(x) // 4 for _, x in docs], "<i8").tobytes(), *[x for _, x in docs]])


def unpack(data: bytes) -> list[tuple[int | None, np.ndarray]]:
    n, = struct.unpack_from("<I", data)
    ids = np.frombuffer(data, "<i8", n, 4)
    null = np.frombuffer(data, "u1", n, 4 + 8 * n)
    ends = np.cumsum(np.frombuffer(data, "<i8", n, 4 + 9 * n))
    tokens = np.frombuffer(data, "<u4", offset=4 + 17 * n)
    starts = np.concatenate([[0], ends[:-1]]) if n else ends
    return [(None if z else int(d), tokens[a:b]) for d, z, a, b in zip(ids, null, starts, ends)]


class SeekableWriter:
    def __init__(self, out):
        self.out, self.frames, self.ranges, self.ids = out, [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, docs: list[tuple[int | None, bytes]]) -> None:
        data = pack(docs)
        frame = self.compressor.compress(data)
        known = [d for d, _ in docs if d is not None]
        low, high = (min(known), max(known)) if known else (0, -1)
        self.ranges.append(_RANGE.pack(low, high, len(docs), self.ids))
        self.frames.append(struct.pack("<III", len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.out.write(frame)
        self.ids += sum(len(x) // 4 for _, x in docs)

    def finish(self) -> None:
        index = b"".join(self.ranges)
        self.out.write(struct.pack("<II", INDEX, len(index)) + index)
        table_ = b"".join(self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table_) + 9) + table_
                       + struct.pack("<IBI", len(self.frames), 0x80, SEEKABLE))


class SeekableReader:
    def __init__(self, uri: str):
        fs, path = open_fs(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{uri}: no seek table")
        table_ = self._at(size - 9 - 12 * n, 12 * n)
        self.frames = [struct.unpack_from("<III", table_, 12 * i) for i in range(n)]
        index = self._at(size - 17 - 12 * n - _RANGE.size * n, _RANGE.size * n)
        self.ranges = [_RANGE.unpack_from(index, _RANGE.size * i) for i in range(n)]
        self.starts = np.concatenate([[0], np.cumsum([f[0] for f in self.frames])]).astype(int).tolist()
        self.decompressed = 0

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def frame(self, i: int) -> list[tuple[int | None, np.ndarray]]:
        length, size, check = self.frames[i]
        data = zstandard.ZstdDecompressor().decompress(self._at(self.starts[i], length), max_output_size=size)
        self.decompressed += 1
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {i} differs from its checksum")
        return unpack(data)

    def documents(self, wanted: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """Only the frames whose range holds a wanted id are decompressed."""
        ids = sorted(set(wanted))
        for i, (low, high, _, _) in enumerate(self.ranges):
            if any(low <= d <= high for d in ids):
                yield from ((d, x) for d, x in self.frame(i) if d in ids)

    def close(self) -> None:
        self.file.close()


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Write every document under ``folder``; one row per file: part, file, documents, ids."""
    end = np.array([end_id], "<u4").tobytes()

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, enc = TaskContext.get().partitionId(), Encoder(tokenizer)  # the task's own: it goes with the task
        name, n_docs, writers = f"{folder}/part-{part:06d}.tokens.zst", 0, []

        def fill(out) -> None:
            nonlocal n_docs
            w, held, ids = SeekableWriter(out), [], 0
            writers.append(w)
            for pdf in batches:
                for doc_id, x in zip(pdf["doc_id"], enc.encode(pdf["text"].tolist())):
                    held.append((None if doc_id is None else int(doc_id), x + end))
                    ids += len(x) // 4 + 1
                    n_docs += 1
                    if ids >= frame_ids:
                        w.add(held)
                        held, ids = [], 0
            if held:
                w.add(held)
            w.finish()

        write_whole(name, fill)
        yield pd.DataFrame({"part": [part], "file": [name], "docs": [n_docs], "ids": [writers[0].ids]})

    rows = text_rows(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit(""))) \
        .withColumn("tie", F.xxhash64("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.repartitionByRange(max(1, math.ceil(total / TASK_BYTES)), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    # Ids travel as text: pandas would turn nullable integers into floats.
    written = rows.select(F.col("doc_id").cast("string").alias("doc_id"), "text") \
        .mapInPandas(run, "part int, file string, docs long, ids long")
    files = materialise(written.filter("docs > 0"), "files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_tokens(files: DataFrame) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32."""
    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, base in zip(pdf["file"], pdf["start"]):
                reader = SeekableReader(file)
                for i, (_, _, _, before) in enumerate(reader.ranges):
                    docs = reader.frame(i)
                    n = np.array([len(x) for _, x in docs], dtype=np.int64)
                    yield pd.DataFrame({
                        "doc_id": pd.array([d for d, _ in docs], dtype="Int64"),
                        "start": int(base) + before + np.cumsum(n) - n, "n_tokens": n,
                        "ids_crc32": [zlib.crc32(x.tobytes()) for _, x in docs]})
                reader.close()

    return files.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def public_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def token_output(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encode, write, and read back every document."""
    spark = docs.sparkSession
    files = materialise(write_tokens(docs, scratch(spark, "tokens"), tokenizer or public_tokenizer()), "placed")
    return read_tokens(files.repartition(max(1, files.count())))


def op4_token_output(spark, sf_dir: str) -> DataFrame:
    return token_output(table(prepare(spark), sf_dir, "documents"))
