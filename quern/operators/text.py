"""Text jobs (SET-1, TXT-1..3, JOIN-6): word count, distinct words, inverted index,
tag lookup. Whole texts are processed; every split keeps empty tokens (trap T10).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.columns import tag_tokens, words
from quern.session import scratch_path


def _explode_split(c):
    """``explode`` of a ``split``: ``split`` of a non-null string is never empty,
    so ``explode_outer`` gives the same rows and spares the planner's inferred
    ``size(split(...)) > 0`` filter, which would split every text twice."""
    return F.explode_outer(c)


def line_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word occurrence: lines by ``\\n``, words by one space.

    The reference's ``flatten`` of generators (UDF-5) is ``explode`` here.
    """
    d = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")) \
            .filter(F.col("text").isNotNull())
    lines = d.select("doc_id", _explode_split(F.split("text", "\n", -1)).alias("line"))
    return lines.select("doc_id", _explode_split(words("line")).alias("word"))


def distinct_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """SET-1: the distinct words of all document lines (partial distinct per task)."""
    return line_words(docs, id_col, text_col).select("word").distinct()


def word_count(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """TXT-1 / TXT-2: occurrences per word; the combiner is Spark's partial aggregate."""
    return line_words(docs, id_col, text_col).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct ``(word, doc_id)`` in order, from one exchange of the postings and one sort of each range.

    Equal postings are in one range, side by side once it is sorted, so the window that keeps the first of
    them holds one posting, and its sort is also the result's. Ranges are not merged to the advisory size: each stays
    small enough to be sorted in memory.
    """
    d = docs.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("doc_id"), F.array_distinct(words(F.col(text_col))).alias("ws"))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = d.select(_explode_split("ws").alias("word"), "doc_id").repartitionByRange(ranges, "word", "doc_id")
    same = Window.partitionBy("word", "doc_id").orderBy("word")
    return ranged.withColumn("_no", F.row_number().over(same)).where("_no = 1").drop("_no")


def inverted_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """TXT-3: word → sorted document ids, a word counted once per document.

    Splits the whole text on one space only (a newline stays inside a token, as
    in the reference). The posting list is returned as rows ``(word, doc_id)``
    in list order — ``doc_id`` is the string id, so order is text order, as
    ``sorted`` on the reference's string ids. Rows instead of one array per word:
    a frequent word's list grows with the corpus and must not be built in one
    task; the ranges are cut on (word, doc_id), which splits a hot
    word's postings over many tasks.
    """
    return _postings(docs, id_col, text_col).orderBy("word", "doc_id")


def inverted_index_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          block_ids: int = 10_000) -> DataFrame:
    """TXT-3: ``(word, block_no, doc_ids)``: a word's posting list as blocks of ``block_ids`` ids.

    The blocks of a word, one after another, are its sorted list of distinct ids (text order). Postings move once: each
    sorted range packs its own into blocks and writes them to the shared folder. A word that ends in its range is
    complete then. Those that go on in the next range, at most one for each range, get their places from the counts
    of the ranges before, and their blocks are cut anew. No task ever holds more of a word than one block.
    """
    packed = _postings(docs, id_col, text_col).mapInArrow(_packer(block_ids), "word string, block_no long, doc_ids array<string>") \
        .withColumn("_range", F.spark_partition_id())
    path = scratch_path(docs.sparkSession, "postings")
    packed.write.parquet(path)
    held = docs.sparkSession.read.schema(packed.schema).parquet(path)
    first = held.groupBy("_range").agg(F.min("word").alias("word")).select("word").distinct()
    counts = held.join(F.broadcast(first), "word").groupBy("word", "_range").agg(F.sum(F.size("doc_ids")).alias("_n"))
    of_word = Window.partitionBy("word")
    before = F.sum("_n").over(of_word.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select("word", "_range", F.coalesce(before, F.lit(0)).alias("_shift"), F.count("*").over(of_word).alias("_ranges")) \
        .where("_ranges > 1").drop("_ranges")
    whole = held.join(F.broadcast(shifts.select("word").distinct()), "word", "left_anti").select("word", "block_no", "doc_ids")
    # A piece has one block's length at most, so it lies in one or two blocks.
    place = F.col("block_no") * block_ids + F.col("_shift")
    head = (F.lit(block_ids) - place % block_ids).cast("int")
    pieces = held.join(F.broadcast(shifts), ["word", "_range"]).select("word", F.explode(F.array(
        F.struct(F.floor(place / block_ids).alias("block_no"), place.alias("at"), F.slice("doc_ids", F.lit(1), head).alias("ids")),
        F.struct((F.floor(place / block_ids) + 1).alias("block_no"), (place + head).alias("at"),
                 F.slice("doc_ids", head + 1, F.lit(block_ids)).alias("ids")))).alias("p")).where(F.size("p.ids") > 0)
    cut = pieces.groupBy("word", F.col("p.block_no").alias("block_no")) \
        .agg(F.array_sort(F.collect_list(F.struct("p.at", "p.ids"))).alias("l")) \
        .select("word", "block_no", F.flatten("l.ids").alias("doc_ids"))
    return whole.unionByName(cut)


def _packer(block_ids: int):
    """Sorted ``(word, doc_id)`` of a range as blocks ``(word, block_no, doc_ids)``, numbered inside the range."""
    def run(batches):
        held, at = None, 0                # the open block of the last word, and its place in the word's list
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = (rows if held is None else pa.concat_tables([held, rows])).combine_chunks()
            n = rows.num_rows
            if not n:
                continue
            word = rows.column("word").combine_chunks()
            new = np.flatnonzero(pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)) + 1
            starts = np.concatenate([[0], new])
            place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
            place[:new[0] if len(new) else n] += at
            cuts = np.flatnonzero(place % block_ids == 0)
            yield from blocks(rows, place, cuts)
            held, at = rows.slice(cuts[-1]), int(place[cuts[-1]])
        if held is not None:
            yield from blocks(held, np.array([at]), np.array([0, held.num_rows]))

    def blocks(rows, place, cuts):
        """The closed blocks: from each cut to the next."""
        if len(cuts) > 1:
            rows = rows.slice(0, cuts[-1]).combine_chunks()
            ids = rows.column("doc_id").combine_chunks()
            first = pa.array(cuts[:-1])
            yield pa.RecordBatch.from_arrays(
                [rows.column("word").combine_chunks().take(first), pa.array(place[cuts[:-1]] // block_ids, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), ids)], names=["word", "block_no", "doc_ids"])
    return run


def first_listed_match(items: DataFrame, tags_col: str, vocab: DataFrame,
                       name_col: str = "name", ordinal_col: str = "ordinal",
                       default: str | None = "No", out: str = "language") -> DataFrame:
    """JOIN-6: per item, the first vocabulary entry (by ``ordinal``) whose
    lower-case ``<name>`` occurs among the item's tags, else ``default``.

    One plan at every size: each distinct tag string is exploded and equi-joined with
    the vocabulary, one aggregate keeps its first hit, and the items look their tag
    string up. Spark broadcasts the vocabulary or the hits where they are small.
    ``default=None`` drops items without a match (FIL-7).
    """
    v = (vocab.select(F.lower(F.col(name_col)).alias("_tag"),
                      F.struct(F.col(ordinal_col).alias("o"), F.col(name_col).alias("n")).alias("_e"))
         .groupBy("_tag").agg(F.min("_e").alias("_e")))
    tags = items.select(F.col(tags_col).alias("_tags")).distinct()
    hits = tags.select("_tags", F.explode(tag_tokens("_tags")).alias("_tag")).join(v, "_tag") \
        .groupBy("_tags").agg(F.min("_e")["n"].alias(out))
    res = items.join(hits, items[tags_col] == hits["_tags"], "left").drop("_tags")
    if default is None:
        return res.filter(F.col(out).isNotNull())
    return res.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
