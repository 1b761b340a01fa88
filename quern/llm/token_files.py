"""Token ids in bit-packed binary files (operator 10).

File layout (little endian): header ``QTOK1``, bits per id; then blocks of
``BLOCK_IDS`` ids, each id stored in the minimum bits of the vocabulary and each
block starting on a byte; then the block offsets, the ids per block and the document
index (id, null flag, first id, number of ids) as arrays, and a footer with their
positions. A block unpacks by numpy alone, and a document is read by its blocks.

Rows are range-sorted by doc_id (nulls first; equal ids by text hash), encoded and
written by one task per range, and committed through temporary names and a manifest. The ranges
follow from the rows alone, so equal rows give equal files.

Defined results: a null text is the empty text, one end id long. Repeated rows are
stored once each, side by side. An empty table gives no file and no row.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from quern.llm.common import (SHARD_BYTES, TempFile, commit, file_rows, open_fs, prepare, qualified, ranges, read_manifest,
                              scratch_path, staged, table)
from quern.llm.wordwise import batched, ids_of_lists, runs

MAGIC = b"QTOK1\0"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 26                 # ids after which a task begins its next file
CACHE_WORDS = 500_000            # distinct words in the newer half of a worker's cache: about 100 MB a half
WORDS_AT_ONCE = 200
BLANK_MARKS = "ĠĊ"               # fixed values: how byte-level vocabularies write a blank and a line feed


# --- bit packing ------------------------------------------------------------------------
def bits_for(vocab_size: int) -> int:
    """Minimum bits that hold every id below ``vocab_size``."""
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width packing, lowest bit first; the last byte is padded with zeros."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    each = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(each, axis=1, bitorder="little")[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The ``n`` ids of a packed block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel()


class TokenWriter:
    """Writes one file; holds one block of ids and the document index."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.waiting: list[bytes] = []
        self.n_waiting = self.n_ids = 0
        self.offsets: list[int] = []
        self.counts: list[int] = []
        self.docs: list[tuple[int, bool, int, int]] = []
        out.write(MAGIC + struct.pack("<I", bits))

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """A document's ids as little-endian unsigned 32-bit integers."""
        n = len(ids) // 4
        self.docs.append((doc_id or 0, doc_id is None, self.n_ids, n))
        self.waiting.append(ids)
        self.n_ids += n
        self.n_waiting += n
        if self.n_waiting >= BLOCK_IDS:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), "<u4")
        end = len(ids) if last else len(ids) // BLOCK_IDS * BLOCK_IDS
        for i in range(0, end, BLOCK_IDS):
            block = ids[i:min(i + BLOCK_IDS, end)]
            self.offsets.append(self.out.size)
            self.counts.append(len(block))
            self.out.write(pack(block, self.bits))
        self.waiting, self.n_waiting = [ids[end:].tobytes()], len(ids) - end

    def close(self) -> None:
        self._flush(last=True)
        index = np.array([(d, s, n) for d, _, s, n in self.docs], "<i8").reshape(-1, 3).T.tobytes()
        nulls = np.array([x for _, x, _, _ in self.docs], np.uint8).tobytes()
        at = self.out.size
        self.out.write(np.array(self.offsets, "<i8").tobytes() + np.array(self.counts, "<i8").tobytes()
                       + index + nulls)
        self.out.write(struct.pack("<QQQ", at, len(self.offsets), len(self.docs)))
        self.out.close()


class TokenReader:
    """Random access to one file."""

    def __init__(self, fs, path: str):
        self.file = fs.open_input_file(path)
        size = self.file.size()
        head = self.file.read_at(len(MAGIC) + 4, 0)
        if head[:len(MAGIC)] != MAGIC:
            raise ValueError(f"{path}: not a token file")
        self.bits = struct.unpack("<I", head[len(MAGIC):])[0]
        at, blocks, docs = struct.unpack("<QQQ", self.file.read_at(24, size - 24))
        tail = self.file.read_at(size - 24 - at, at)
        self.offsets, self.counts = np.frombuffer(tail, "<i8", 2 * blocks).reshape(2, blocks)
        self.doc_ids, self.starts, self.lengths = np.frombuffer(tail, "<i8", 3 * docs, 16 * blocks).reshape(3, docs)
        self.nulls = np.frombuffer(tail, np.uint8, docs, 16 * blocks + 24 * docs)
        self._held = (-1, None)

    def block(self, i: int) -> np.ndarray:
        if self._held[0] != i:
            n = int(self.counts[i])
            data = self.file.read_at((n * self.bits + 7) // 8, int(self.offsets[i]))
            self._held = i, unpack(data, self.bits, n)
        return self._held[1]

    def document(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the file; reads its blocks only."""
        start, end = int(self.starts[i]), int(self.starts[i] + self.lengths[i])
        parts = [self.block(b)[max(0, start - b * BLOCK_IDS):end - b * BLOCK_IDS]
                 for b in range(start // BLOCK_IDS, (max(start, end - 1)) // BLOCK_IDS + 1)] if end > start else []
        return np.concatenate(parts) if parts else np.zeros(0, "<u4")

    def close(self) -> None:
        self.file.close()


# --- encoding ---------------------------------------------------------------------------
class ByteEncoder:
    """Byte-level encoding by the library, each distinct word encoded once.

    The library's word pattern never joins text across a blank that stands between
    two characters that are not white space, nor across such a line feed. So a text
    without two adjacent white-space characters is cut there, and the pieces' ids
    (kept per worker) are concatenated. Other texts, and texts that hold a special
    token's string, are encoded whole. New words go to the library many to a text, as a
    token that starts with the mark of a blank or a line feed starts the next word.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}                   # ids of " word", and of "\nword"
        self.older: dict[str, bytes] = {}                   # those learnt before, looked up in turn
        vocabulary = self.library.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t[:1] in BLANK_MARKS]] = True
        # Runs of letters with a blank before them are words of the library's pattern already.
        self.letters = Tokenizer.from_str(self.library.to_str())
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "merged_with_next"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.marks = dict(zip(".,;:", self.ids(list(".,;:"))))

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words with the blank or line feed before each, ``WORDS_AT_ONCE`` to a text."""
        letters = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        ids = dict(zip(letters, self._joined(self.letters, [" " + w for w in letters])))
        # White space at a word's end would meet the next word's.
        last = [w for w in other if not w or w[-1].isspace()]
        ids.update(zip(last, self.ids([w if w[:1] == "\n" else " " + w for w in last])))
        other = [w for w in other if w not in ids]
        ids.update(zip(other, self._joined(self.library, [w if w[:1] == "\n" else " " + w for w in other])))
        return [ids[w] for w in words]

    def _joined(self, library: Tokenizer, words: list[str]) -> Iterator[bytes]:
        texts = ["".join(words[k:k + WORDS_AT_ONCE]) for k in range(0, len(words), WORDS_AT_ONCE)]
        for k, text_ids in zip(range(0, len(words), WORDS_AT_ONCE), batched(library, texts)):
            some, ids = words[k:k + WORDS_AT_ONCE], np.array(text_ids, "<u4")
            cuts = (4 * np.flatnonzero(self.begins[ids])).tolist()
            data = ids.tobytes()
            yield from (data[i:j] for i, j in zip(cuts, [*cuts[1:], None])) if len(cuts) == len(some) else self.ids(some)

    def _look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, each with the blank or line feed before it."""
        known, older = self.known.get, self.older.get
        got = list(map(known, words))
        ids: dict[str, bytes | None] = {}
        marked = []
        for i in [i for i, g in enumerate(got) if g is None]:
            w = words[i]
            if (g := older(w)) is None and w[-1:] in self.marks and w[-2:-1].isalpha():
                # A mark after a letter is a token of its own, so the word before it is learnt once.
                marked.append(w)
                w = w[:-1]
                g = known(w) or older(w)
            ids[w] = g or ids.get(w)
        bare = [w for w, g in ids.items() if g is None]
        ids.update(zip(bare, self.ids_of_words(bare)))
        ids.update((w, ids[w[:-1]] + self.marks[w[-1]]) for w in marked)
        if len(self.known) + len(ids) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        self.known.update(ids)
        return [ids[w] if g is None else g for w, g in zip(words, got)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start, end in runs(texts):
            some = texts[start:end]
            whole = [bool(ADJACENT.search(t)) or any(s in t for s in self.special) for t in some]
            cut = pa.array([t for t, w in zip(some, whole) if not w], pa.large_string())
            rest = pc.split_pattern(pc.replace_substring(cut, "\n", " \n"), " ")
            # The first word of a text has no blank before it.
            heads = rest.offsets.to_numpy()[:-1]
            flat = rest.flatten()
            first = self.ids(flat.take(pa.array(heads)).to_pylist())
            kept = np.ones(len(flat), bool)
            kept[heads] = False
            lists = pa.LargeListArray.from_arrays(pa.array(rest.offsets.to_numpy() - np.arange(len(rest) + 1)), flat.filter(pa.array(kept)))
            texts_ids = iter([a + b for a, b in zip(first, ids_of_lists(lists, self._look_up))])
            whole_ids = iter(self.ids([t for t, w in zip(some, whole) if w]))
            out += [next(whole_ids if w else texts_ids) for w in whole]
        return out


# Two adjacent white-space characters (more kinds than the library's, which is the safe side).
ADJACENT = re.compile(r"\s\s")
_LOADED: dict[str, ByteEncoder] = {}


def load(path: str) -> ByteEncoder:
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # a task has one core
        _LOADED[path] = ByteEncoder(path)
    return _LOADED[path]


# --- jobs -------------------------------------------------------------------------------
def write_token_files(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 0,
                      shard_bytes: int = SHARD_BYTES) -> list[dict]:
    """Encode ``docs(doc_id, text)`` and write them in ascending doc_id order; the manifest's rows."""
    folder = qualified(docs.sparkSession, folder)
    library = Tokenizer.from_file(tokenizer)
    bits = bits_for(max(library.get_vocab_size(), end_id + 1))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        encoder, part = load(tokenizer), TaskContext.get().partitionId()
        writer, files = None, []

        def close():
            writer.close()
            files.append((part, len(files), writer.out.name, len(writer.docs), writer.n_ids))

        for rb in batches:
            for doc_id, ids in zip(rb.column("doc_id").to_pylist(), encoder.encode([t or "" for t in rb.column("text").to_pylist()])):
                if writer is None:
                    writer = TokenWriter(TempFile(folder), bits)
                writer.add(doc_id, ids + end)
                if writer.n_ids >= FILE_IDS:
                    close()
                    writer = None
        if writer is not None:
            close()
        cols = list(zip(*files)) or [()] * 5
        yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                              names=["part", "seq", "temp", "docs", "ids"])

    sizes = staged(docs.select(F.col("doc_id").cast("long").alias("key"), F.xxhash64("text").alias("tie"),
                               F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")), "sizes")
    shards = ranges(sizes, nulls_first=True, shard_bytes=shard_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_th")) \
        .withColumn("_shard", shards.number("doc_id", "_th")).repartitionById(shards.count, "_shard") \
        .sortWithinPartitions("_shard", F.col("doc_id").asc_nulls_first(), "_th", "text").select("doc_id", "text")
    # One row per file: as many as there are tasks, plus one for every FILE_IDS ids.
    files = rows.mapInArrow(run, "part int, seq int, temp string, docs long, ids long").collect()
    return commit(folder, [f.asDict() for f in sorted(files, key=lambda f: (f["part"], f["seq"]))], ".qtok")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every stored document; ids as packed unsigned 32-bit."""
    folder = qualified(spark, folder)
    rows, base = [], 0
    for f in read_manifest(folder):
        rows.append((f"{folder}/{f['file']}", base))
        base += f["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for path, first in zip(rb.column("path").to_pylist(), rb.column("base").to_pylist()):
                fs, local = open_fs(path)
                reader = TokenReader(fs, local)
                for k in range(0, len(reader.starts), 500):
                    these = range(k, min(k + 500, len(reader.starts)))
                    yield pa.record_batch([
                        pa.array([None if reader.nulls[i] else int(reader.doc_ids[i]) for i in these], pa.int64()),
                        pa.array(reader.starts[k:k + 500] + first), pa.array(reader.lengths[k:k + 500]),
                        pa.array([reader.document(i).tobytes() for i in these], pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"])
                reader.close()

    return file_rows(spark, rows, "path string, base long") \
        .mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the files."""
    import public_tokenizers
    prepare(spark)
    folder = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
