"""Documents as token pieces, packed into sequences by hierarchical best-fit (operator 13).

Pieces are dealt to tasks of about ``LOCAL_ITEMS`` items, and each task packs its own by
best-fit decreasing. Bins that are nearly full, free by at most ``SLACK`` of the capacity, are
emitted; the others go on as items of their fill. A tree of merges takes them, ``FAN_IN`` tasks to
one: best-fit again, emit, pass on. A task passes on at most ``CARRIED`` bins, its emptiest; its fuller
ones are emitted as they are, so a merge holds at most ``FAN_IN * CARRIED`` rows at every
input size and no piece is ever left out. Two bins of at most half a capacity never leave
a task side by side, and the emptiest bins are those that can take another task's rest.

Items carry their columns through the first round only; merges see ``(bin, fill)``, and
one join at the end gives each item its sequence and offset. Every round is a
written table, so a lost executor repeats a part of one round and bin numbers stay.

Defined results: a null text is the empty text and gives one piece, its end id. Repeated rows
are packed once each. An empty table gives no rows. Items of null or zero size take no room and
lie behind other items; negative sizes and sizes above the capacity raise ``ValueError``. Other
columns of the items are kept; ``pack_best_fit`` replaces ``sequence_id`` and ``offset``.
"""

from __future__ import annotations

import json
import os
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from quern.llm.bpe import PLAIN
from quern.llm.common import prepare, staged, table, unused
from quern.llm.wordwise import batched, ids_of_lists, runs

CAPACITY = 2048
LOCAL_ITEMS = 8192
FAN_IN = 16
CARRIED = 512
SLACK = 1 / 128
CACHE_CHUNKS = 400_000           # distinct chunks in the newer half of a Python worker's cache
DOCS_AT_ONCE = 1000
CHUNKS_AT_ONCE = 200
MARKS = "".join(c for c in string.punctuation if c != "'")     # a run of these at a word's end is a word of its own


# --- tokens -----------------------------------------------------------------------------
class ChunkEncoder:
    """Ids of whole texts by the library, each distinct run between white space encoded once.

    Where the vocabulary drops white space and marks word ends, a text is lower-cased, cut at
    white space and looked up, a block's distinct runs at a time. Unknown runs are parted into words
    by the vocabulary's own pattern and go to its merges many to a text; as many word ends as a
    run has words close its ids. Texts with characters outside the plain range or with a
    special token's string, and all texts of other vocabularies, are encoded whole.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        end = spec["model"].get("end_of_word_suffix")
        a, b, both, upper = self.ids(["abc", "de", "abc de", "ABC"])
        layers = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_chunk = bool(end) and layers == ["Split", "ByteLevel"] and both == a + b and upper == a
        if self.by_chunk:
            vocabulary = self.library.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for t, i in vocabulary.items() if t.endswith(end)]] = True
            self.word = regex.compile(next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                                           if p["type"] == "Split"))
            # For words that are lower-cased, composed and parted by blanks already.
            self.words_only = Tokenizer.from_str(self.library.to_str())
            self.words_only.normalizer = normalizers.Sequence([])
            self.words_only.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def ids_of_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of runs without white space, ``CHUNKS_AT_ONCE`` to a text."""
        out: list[bytes] = []
        spaced, counts = [], []
        for c in chunks:
            if c.isalpha():
                spaced.append(c)
                counts.append(1)
            elif (stem := c.rstrip(MARKS)).isalpha():
                spaced.append(f"{stem} {c[len(stem):]}")
                counts.append(2)
            else:
                words = self.word.findall(c)
                spaced.append(" ".join(words))
                counts.append(len(words))
        texts = [" ".join(spaced[k:k + CHUNKS_AT_ONCE]) for k in range(0, len(spaced), CHUNKS_AT_ONCE)]
        for k, text_ids in zip(range(0, len(chunks), CHUNKS_AT_ONCE), batched(self.words_only, texts)):
            ids = np.array(text_ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            last = np.cumsum(counts[k:k + CHUNKS_AT_ONCE]) - 1
            if len(ends) == last[-1] + 1:
                cuts, data = (4 * ends[last]).tolist(), ids.tobytes()
                out += [data[i:j] for i, j in zip([0, *cuts], cuts)]
            else:
                out += self.ids(chunks[k:k + CHUNKS_AT_ONCE])
        return out

    def look_up(self, chunks: list[str]) -> list[bytes]:
        """Ids of a block's distinct runs."""
        known, older = self.known.get, self.older.get
        got = [b"" if not c else known(c) for c in chunks]
        new = []
        for i in [i for i, g in enumerate(got) if g is None]:
            if (g := older(chunks[i])) is None:
                new.append(i)
            else:
                got[i] = self.known[chunks[i]] = g
        if new:
            for i, g in zip(new, self.ids_of_chunks([chunks[i] for i in new])):
                got[i] = g
                if len(g) <= 256:
                    self.known[chunks[i]] = g
            if len(self.known) > CACHE_CHUNKS:
                self.older, self.known = self.known, {}
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for start, end in runs(texts):
            some = texts[start:end]
            plain = [self.by_chunk and not PLAIN.search(t) and not any(s in t for s in self.special) for t in some]
            whole = iter(self.ids([t for t, p in zip(some, plain) if not p]))
            chunks = pc.utf8_split_whitespace(pa.array([t.lower() for t, p in zip(some, plain) if p], pa.large_string()))
            parts = iter(ids_of_lists(chunks, self.look_up))
            out += [next(parts if p else whole) for p in plain]
        return out


_LOADED: dict[str, ChunkEncoder] = {}


def load(path: str) -> ChunkEncoder:
    """The encoder of a file, kept per Python worker."""
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # a task has one core
        _LOADED[path] = ChunkEncoder(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``(doc_id, piece, start, ids)`` of ``docs(doc_id, text)``: ids with the end id, cut only beyond ``capacity``.

    ``ids`` are little-endian unsigned 32-bit integers.
    """
    end, width = np.array([end_id], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        for rb in batches:
            for k in range(0, rb.num_rows, DOCS_AT_ONCE):
                of, piece, ids = [], [], []
                texts = [t or "" for t in rb.column("text").slice(k, DOCS_AT_ONCE).to_pylist()]
                for i, doc in enumerate(encoder.encode(texts)):
                    doc += end
                    for p in range(0, len(doc), width):
                        of.append(k + i)
                        piece.append(p // width)
                        ids.append(doc[p:p + width])
                yield pa.record_batch([rb.column("doc_id").take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                                       pa.array(np.array(piece, np.int64) * capacity), pa.array(ids, pa.binary())],
                                      names=["doc_id", "piece", "start", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, ids binary")


# --- packing ----------------------------------------------------------------------------
def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin.

    Open bins are listed by their free space, and a bit mask tells which lists hold one, so
    the tightest bin for an item is the lowest bit from its size on. Equal sizes go in order.
    """
    order = np.argsort(-sizes, kind="stable")
    of, at = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fill = 0, []
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        if not 0 <= s <= capacity:
            raise ValueError(f"an item of size {s} does not fit a bin of {capacity}")
        if s == 0 and fill:                                 # no room needed: behind the last bin's items
            of[i], at[i] = len(fill) - 1, fill[-1]
            continue
        fits = mask >> s
        if fits:
            free = s + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                mask ^= 1 << free
        else:
            free, b = capacity, len(fill)
            fill.append(0)
        of[i], at[i] = b, fill[b]
        fill[b] += s
        if free > s:
            by_free[free - s].append(b)
            mask |= 1 << (free - s)
    return of, at, np.array(fill, np.int64)


def passed_on(fill: np.ndarray, capacity: int, slack: float, carried: int) -> np.ndarray:
    """Which bins go on as items: the emptiest ``carried`` of those free by more than ``slack``."""
    on = np.zeros(len(fill), bool)
    emptiest = np.argsort(fill, kind="stable")[:carried]
    on[emptiest] = capacity - fill[emptiest] > slack * capacity
    return on


def _first_of(bins: np.ndarray, n: int) -> np.ndarray:
    """True at one item of every bin."""
    first = np.zeros(len(bins), bool)
    seen = np.full(n, -1, np.int64)
    seen[bins[::-1]] = np.arange(len(bins))[::-1]
    first[seen[seen >= 0]] = True
    return first


def _local_round(items: DataFrame, size_col: str, capacity: int, slack: float, carried: int, parts: int, new: dict) -> DataFrame:
    """Every item with its bin and offset; at one item of each bin that goes on, the bin's fill (else 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held = [rb for rb in batches if rb.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        sizes = rows.column(new["size"]).to_numpy()
        of, at, fill = best_fit(sizes, capacity)
        goes = _first_of(of, len(fill)) & passed_on(fill, capacity, slack, carried)[of]
        out = rows.drop_columns([new["size"]])
        for name, values in ((new["bin"], of + (TaskContext.get().partitionId() << 32)), (new["at"], at)):
            out = out.append_column(name, pa.array(values, pa.int64()))
        yield from out.append_column(new["fill"], pa.array(np.where(goes, fill[of], 0), pa.int64())).to_batches(2000)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    # Rows are dealt by their number in the written table, so equal rows and hot ids spread evenly.
    dealt = items.withColumn(new["size"], F.coalesce(F.col(f"`{size_col}`").cast("long"), F.lit(0))) \
        .withColumn(new["part"], F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")) \
        .repartitionById(parts, new["part"]).drop(new["part"])
    return dealt.mapInArrow(run, f"{kept}, `{new['bin']}` long, `{new['at']}` long, `{new['fill']}` long")


def _merge_round(bins: DataFrame, capacity: int, slack: float, carried: int, width: int, last: bool) -> DataFrame:
    """``(bin, into, shift, fill)``: each bin's place; at one row of every bin that goes on, its fill (else 0).

    ``width`` tasks of the first round, told by the upper half of a bin's number, share a
    merge. A merged bin has the number of its largest member.
    """
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("bin", ignore_index=True)
        of, at, fill = best_fit(pdf["fill"].to_numpy(), capacity)
        names = np.zeros(len(fill), np.int64)
        opens = at == 0                                  # fills are at least 1, so one member starts a bin
        names[of[opens]] = pdf["bin"].to_numpy()[opens]
        goes = opens & passed_on(fill, capacity, slack, carried)[of] & (not last)
        return pd.DataFrame({"bin": pdf["bin"], "into": names[of], "shift": at, "fill": np.where(goes, fill[of], 0)})

    return bins.withColumn("task", F.floor(F.shiftright("bin", 32) / F.lit(width))).groupBy("task") \
        .applyInPandas(lambda pdf: run(pdf[["bin", "fill"]]), "bin long, into long, shift long, fill long")


def pack_best_fit(items: DataFrame, size_col: str, capacity: int = CAPACITY, slack: float = SLACK, carried: int = CARRIED,
                  fan_in: int = FAN_IN, local_items: int = LOCAL_ITEMS) -> DataFrame:
    """``items`` with ``sequence_id`` (any numbers) and ``offset``: gapless places in bins of ``capacity``."""
    items = items.drop("sequence_id", "offset")
    new = {}
    for n in ("size", "part", "bin", "at", "fill"):
        new[n] = unused(items, f"_{n}")
    held = staged(items, "pack-items")
    parts = max(1, -(-held.count() // local_items))
    placed = staged(_local_round(held, size_col, capacity, slack, carried, parts, new), "pack-local")
    bins = placed.where(F.col(new["fill"]) > 0).select(F.col(new["bin"]).alias("bin"), F.col(new["fill"]).alias("fill"))
    rounds, width = [], 1
    top = placed.agg(F.max(F.shiftright(new["bin"], 32))).first()[0] or 0
    while width <= top:
        width *= fan_in
        merged = staged(_merge_round(bins, capacity, slack, carried, width, last=width > top), "pack-merge")
        rounds.append(merged)
        bins = merged.where("fill > 0").select(F.col("into").alias("bin"), "fill")
    if not rounds:
        return placed.withColumnsRenamed({new["bin"]: "sequence_id", new["at"]: "offset"}).drop(new["fill"])
    # Places of merged bins in their last bin, from the last round down.
    moves = rounds[-1].select("bin", "into", "shift")
    for merged in rounds[-2::-1]:
        upper = moves.select(F.col("bin").alias("into"), F.col("into").alias("top"), F.col("shift").alias("more"))
        moves = merged.join(upper, "into", "left").select(
            "bin", F.coalesce("top", "into").alias("into"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
    moves = moves.select(F.col("bin").alias(new["bin"]), F.col("into").alias("sequence_id"), F.col("shift").alias(new["size"]))
    return placed.join(moves, new["bin"], "left") \
        .withColumn("sequence_id", F.coalesce("sequence_id", new["bin"])) \
        .withColumn("offset", F.col(new["at"]) + F.coalesce(new["size"], F.lit(0))) \
        .select(*[F.col(f"`{c}`") for c in items.columns], "sequence_id", "offset")


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's length, checksum, sequence and offset."""
    import public_tokenizers
    prepare(spark)
    pieces = token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack_best_fit(pieces.select("doc_id", "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                                       F.crc32("ids").alias("ids_crc32")), "length")
