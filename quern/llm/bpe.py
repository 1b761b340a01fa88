"""BPE encoding and decoding from merge ranks (operator 3).

A word is a doubly linked list of symbols. A priority queue holds the merge rank of
every adjacent pair; the lowest rank (then the leftmost) is merged next, and entries
whose symbols have changed since are skipped. Decoding concatenates vocabulary
strings. Results equal those of the ``tokenizers`` library for the word-level
vocabulary files (lower case, white space dropped, ``</w>`` word ends).

Defined results: a null text is the empty text and has no ids. Repeated rows give
repeated result rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm.common import prepare, table, unused

# Beyond these characters, case, composition and letter classes follow the library's own tables.
PLAIN = regex.compile(r"[^\x00-\x1b\x20-\u024f]")
WHITE = regex.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

# Words kept ready per Python worker; frequent words come back at once after a reset.
CACHE_WORDS = 400_000


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(256 + hidden.index(b)) if b in hidden else chr(b) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        parts = spec["pre_tokenizer"]["pretokenizers"]
        self.word = regex.compile(next(p["pattern"]["Regex"] for p in parts if p["type"] == "Split"))
        self.library = Tokenizer.from_file(path)
        self.bytes = byte_chars()
        self.strings: dict[int, str] = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge adjacent symbols by rank until no pair has one."""
        n = len(symbols)
        if n < 2:
            return symbols
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks, sym = self.ranks, list(symbols)
        queue = []
        for i in range(n - 1):
            if (hit := ranks.get((sym[i], sym[i + 1]))) is not None:
                queue.append((hit[0], i, sym[i], sym[i + 1], hit[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, new = heapq.heappop(queue)
            j = after[i]
            if sym[i] != left or j >= n or sym[j] != right:
                continue                                    # stale: one of the two was merged away
            sym[i], sym[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (hit := ranks.get((new, sym[k]))) is not None:
                    heapq.heappush(queue, (hit[0], i, new, sym[k], hit[1]))
            if (p := before[i]) >= 0 and (hit := ranks.get((sym[p], new))) is not None:
                heapq.heappush(queue, (hit[0], p, sym[p], new, hit[1]))
        return [s for s in sym if s >= 0]

    def encode_word(self, word: str) -> bytes:
        """Ids of one pre-token as little-endian unsigned 32-bit integers."""
        if (out := self.words.get(word)) is None:
            out = self.encode_symbols([self.bytes[b] for b in word.encode()])
            if len(self.words) >= CACHE_WORDS:
                self.words.clear()
            if len(word) <= 64:
                self.words[word] = out
        return out

    def encode_symbols(self, chars: list[str]) -> bytes:
        chars[-1] += self.suffix
        return np.array(self.merge([self.vocab[c] for c in chars if c in self.vocab]), "<u4").tobytes()

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a piece of normalised text without white space."""
        if (out := self.chunks.get(chunk)) is None:
            if PLAIN.search(chunk):
                out = b"".join(self.encode_symbols(list(w))
                               for w, _ in self.library.pre_tokenizer.pre_tokenize_str(chunk))
            else:
                out = b"".join(map(self.encode_word, self.word.findall(chunk)))
            if len(self.chunks) >= CACHE_WORDS:
                self.chunks.clear()
            if len(chunk) <= 64:
                self.chunks[chunk] = out
        return out

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.cut is not None and "<|" in text:
            return b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self.plain(p)
                            for p in self.cut.split(text))
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        if PLAIN.search(text):
            chunks = filter(None, WHITE.split(self.library.normalizer.normalize_str(text)))
        else:                                               # composed already, one case rule per character
            chunks = text.lower().split()
        return b"".join(map(self.encode_chunk, chunks))

    def decode(self, ids: bytes) -> str:
        """Vocabulary strings, a blank between two, as the library's decode without a decoder."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The encoder of a file, kept per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, plus ``ids`` (little-endian unsigned 32-bit) and ``decoded``."""
    return _mapped(docs, tokenizer, text_col,
                   {"ids": pa.binary(), "decoded": pa.string()}, "ids binary, decoded string",
                   lambda ids, text: (ids, text))


def token_digests(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, plus token count and digests of ids and decoded text."""
    return _mapped(docs, tokenizer, text_col,
                   {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()},
                   "n_tokens long, ids_sha256 string, decoded_sha256 string",
                   lambda ids, text: (len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                                      hashlib.sha256(text.encode()).hexdigest()))


def _mapped(docs, tokenizer, text_col, types, ddl, result) -> DataFrame:
    keep = [c for c in docs.columns if c != text_col and c not in types]
    text = unused(docs, "_text")

    def run(batches):
        bpe = load(tokenizer)
        for rb in batches:
            rows = []
            for t in rb.column(text):
                ids = bpe.encode(t.as_py())
                rows.append(result(ids, bpe.decode(ids)))
            cols = list(zip(*rows)) if rows else [()] * len(types)
            yield pa.record_batch([rb.column(c) for c in keep]
                                  + [pa.array(v, t) for v, t in zip(cols, types.values())],
                                  names=[*keep, *types])

    kept = docs.select(*[F.col(f"`{c}`") for c in keep]).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [ddl])
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).alias(text)).mapInArrow(run, schema)


def op3_bpe_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count, id digest and decoded digest of every document."""
    import public_tokenizers
    prepare(spark)
    return token_digests(table(spark, sf_dir, "documents").select("doc_id", "text"),
                         public_tokenizers.path("word_bpe_49k.json"))
