"""Token ids in files of fixed-width bit packing.

Texts are encoded with the tokenizers library, an end id is appended to each, and ids are written in ascending order of the
document id. Every id takes the least number of bits for the vocabulary; blocks of BLOCK ids start at a byte of their own,
whose offset is stored, so that any range of ids is unpacked with numpy from its blocks alone.

File (little-endian): magic, then eight 64-bit numbers: format, bits, ids per block, ids, documents, blocks, 0, 0; then for
each document id, whether the id is null (1 byte), and its first id; then block offsets; then packed blocks.

Null text is empty: one document of the end id only. Null document ids come first. Rows with equal ids stay separate
documents, in the order of their texts' hashes. An empty table gives no file and no rows.

Encoding: a text is cut before spaces and line feeds that follow a word, where the pre-tokenizer always cuts,
and the library's ids of each piece are kept in a bounded table; texts with other white space go to the library whole.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asterline.llm.files import contents, whole_file
from asterline.session import scratch, stored

MAGIC = b"IDPACK01"
BLOCK = 4096
FILE_IDS = 4 << 20
#: Pieces in each of the two generations whose ids a worker keeps; the older one goes when the younger is full.
KEPT_PIECES = 600_000
#: Characters of a key beyond which its ids are not kept.
KEPT_LENGTH = 256
ODD_SPACE = re.compile(r"[^\S \n]")
PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")


def per_worker(name: str, make: Callable):
    """Made once in a Python worker and kept for its later tasks."""
    home = sys.modules.setdefault("asterline_worker", types.ModuleType("asterline_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids, bits: int) -> bytes:
    """ids (numpy, unsigned 32-bit) in `bits` bits each, lowest bits first."""
    import numpy as np

    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
    return np.packbits(each.ravel(), bitorder="little").tobytes()


def unpack(data, count: int, bits: int):
    import numpy as np

    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")[: count * bits].reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = each
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


def write_file(out, doc_ids: list, starts: list[int], ids, bits: int) -> None:
    """starts: first id of each document, and the number of all ids at the end."""
    import numpy as np

    blocks = [pack(ids[i : i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    out.write(MAGIC)
    out.write(np.array([1, bits, BLOCK, len(ids), len(doc_ids), len(blocks), 0, 0], "<u8").tobytes())
    out.write(np.array([x or 0 for x in doc_ids], "<i8").tobytes())
    out.write(np.array([x is None for x in doc_ids], np.uint8).tobytes())
    out.write(np.array(starts, "<u8").tobytes())
    out.write(offsets.tobytes())
    for x in blocks:
        out.write(x)


class Packed:
    """A file's documents and random access to its ids."""

    def __init__(self, data: bytes):
        import numpy as np

        if data[:8] != MAGIC:
            raise ValueError("not a file of packed ids")
        _, self.bits, self.block, self.ids, docs, blocks, _, _ = (int(x) for x in np.frombuffer(data, "<u8", 8, 8))
        at = 72
        self.doc_ids = np.frombuffer(data, "<i8", docs, at)
        self.null = np.frombuffer(data, np.uint8, docs, at := at + 8 * docs)
        self.starts = np.frombuffer(data, "<u8", docs + 1, at := at + docs)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1, at := at + 8 * (docs + 1))
        self.data = memoryview(data)[at + 8 * (blocks + 1) :]

    def slice(self, start: int, stop: int):
        """ids[start:stop], from the blocks that hold them."""
        import numpy as np

        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        out = []
        for b in range(first, last + 1):
            count = min(self.block, self.ids - b * self.block)
            out.append(unpack(self.data[int(self.offsets[b]) : int(self.offsets[b + 1])], count, self.bits))
        return np.concatenate(out)[start - first * self.block : stop - first * self.block]


def little(ids: list[int]) -> bytes:
    """ids as little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_characters() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next character from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, more = [], 256
    for b in range(256):
        out.append(chr(b) if b in own else chr(more))
        more += b not in own
    return out


class Pieces(dict):
    """ids of pieces by key, in two generations. A missing key is looked up in the older one or learned; long ones are not kept."""

    def __init__(self, learn: Callable[[str], bytes]):
        self.learn = learn
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.learn(key)
        if len(key) <= KEPT_LENGTH:
            self[key] = ids
        return ids

    def age(self) -> None:
        """When the younger generation is full it becomes the older one."""
        if len(self) > KEPT_PIECES:
            self.older = dict(self)
            self.clear()


class Encoder:
    """ids of texts (as little-endian unsigned 32-bit bytes), with the pieces met before kept.

    A key stands for a piece: after \\r the piece itself, else a piece whose leading space is left out unless it
    begins with a line feed.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        characters = byte_characters()
        self.bytes = str.maketrans(dict(enumerate(characters)))
        self.space, self.line = characters[32], self._whole("\n")
        self.marks = {c: self._whole(c) for c in ".,;:!?"}
        self.pieces = Pieces(self._learn)

    def keys(self, text: str) -> list[str]:
        odd = any(c in text for c in "\t\r\x0b\x0c\x1c\x1d\x1e\x1f") if text.isascii() else ODD_SPACE.search(text)
        if odd:
            return ["\r" + text]
        if "  " in text or "\n" in text and (" \n" in text or "\n " in text or "\n\n" in text):
            return ["\r" + x for x in PIECES.findall(text)]
        out = text.replace("\n", " \n").split(" ")
        if out[0]:
            out[0] = "\r" + out[0]
            return out
        return out[1:]

    def _whole(self, piece: str) -> bytes:
        return little(self.library.encode(piece, add_special_tokens=False).ids)

    def _learn(self, key: str) -> bytes:
        """ids of a new piece. A piece of letters, with or without one mark after them, is one or two words to the library's
        model, which takes them by themselves; any other piece goes through the library whole."""
        tail = self.marks.get(key[-1:])
        word = key[:-1] if tail else key
        line = word[:1] == "\n"
        word = word[1:] if line else word
        if not word.isalpha():
            return self._whole(key[1:] if key[:1] == "\r" else key if key[:1] == "\n" else " " + key)
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.bytes)
        ids = little([t.id for t in self.library.model.tokenize(word if line else self.space + word)])
        return (self.line if line else b"") + ids + (tail or b"")

    def encode(self, texts: list[str]) -> list[bytes]:
        self.pieces.age()
        found = self.pieces.__getitem__
        return [b"".join(map(found, self.keys(t))) for t in texts]


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents in ascending order of their ids. Returns the manifest: file, documents, ids, start."""
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranged = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def files(batches):
        import os

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = per_worker(f"ids_{tokenizer}", lambda: Encoder(tokenizer))
        bits = width(max(encoder.library.get_vocab_size(with_added_tokens=True), end_id + 1))
        end = int(end_id).to_bytes(4, "little")
        part, made = TaskContext.get().partitionId(), []
        doc_ids, chunks, starts = [], [], [0]

        def flush():
            name = f"ids-{part:06d}-{len(made):06d}.bin"
            with whole_file(f"{folder}/{name}") as out:
                write_file(out, doc_ids, starts, np.frombuffer(b"".join(chunks), "<u4"), bits)
            made.append({"file": name, "documents": len(doc_ids), "ids": starts[-1]})
            doc_ids.clear(), chunks.clear(), starts.clear()
            starts.append(0)

        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                some = batch.slice(i, 512)
                for doc_id, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist())):
                    doc_ids.append(doc_id)
                    chunks.append(ids + end)
                    starts.append(starts[-1] + len(ids) // 4 + 1)
                    if starts[-1] >= FILE_IDS:
                        flush()
        if doc_ids:
            flush()
        yield pa.RecordBatch.from_pylist(made, schema=pa.schema(
            [("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]))

    made = stored(ranged.select("doc_id", "text").mapInArrow(files, "file string, documents long, ids long"), "ids-manifest")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; start counts the ids of all documents before."""

    def documents(batches):
        import pyarrow as pa

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                packed = Packed(content.as_py())
                ids = packed.slice(0, packed.ids).astype("<u4")
                starts = packed.starts.astype("int64")
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                yield pa.RecordBatch.from_arrays([
                    pa.array([path.rsplit("/", 1)[1]] * len(crc), pa.string()),
                    pa.array(packed.doc_ids, pa.int64(), mask=packed.null.astype(bool)),
                    pa.array(starts[:-1], pa.int64()), pa.array(starts[1:] - starts[:-1], pa.int64()), pa.array(crc, pa.int64()),
                ], names=["file", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = contents(manifest.sparkSession, folder).mapInArrow(
        documents, "file string, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    return rows.join(manifest.select("file", "start"), "file").select(
        "doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )


def packed(docs: DataFrame, tokenizer: str, end_id: int, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Write all documents and read the files back."""
    spark = docs.sparkSession
    folder = scratch(spark, "ids")
    manifest = write(docs, folder, tokenizer, end_id, ident, text)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read(manifest, folder)
