"""Operators on small tables with nulls, ties, repeated rows, long texts, extra columns, and on empty ones."""

import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quern.llm import ann, bpe, merkle, mixing, pii, quality, simhash, token_files, toxicity, warc
from quern.llm.common import crc32_of_id, scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies int, _th long"


def docs_of(spark, texts, ids=None, sources=None):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, "en", s, len(t or ""), 1, 2) for i, t, s in zip(ids, texts, sources or ["a"] * len(texts))]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd_docs(spark):
    r = random.Random(4)
    texts = [None, "", "one", "long " * 30_000, "x" * 50_000, "mail me@site.org now", "mail me@site.org now"] + \
        [" ".join(r.choice(["ab", "cd", "ef.", "gh\n"]) for _ in range(40)) for _ in range(30)]
    ids = [0, 1, 2, 3, 4, 5, 5, None, *range(8, 37)]
    return docs_of(spark, texts, ids, [None if i % 5 == 0 else f"s{i % 3}" for i in range(len(texts))]).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(37)] + [(None, 1, 1), (3, None, None)],
                                 "doc_id long, quality int, toxic int")


def test_quality_and_toxicity_on_odd_rows(odd_docs, labels):
    for scored in (quality.quality_scores(odd_docs, labels),
                   quality.add_scores(odd_docs.select("doc_id", "text"),
                                      toxicity.fit_toxicity(odd_docs, labels, crc32_of_id("doc_id") % 3 != 1))):
        rows = scored.collect()
        assert len(rows) == 37 and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if r.doc_id == 5}) == 1
    assert quality.keep_good(odd_docs, labels, 0.0).columns == odd_docs.columns


def test_toxicity_counts_all_rows(odd_docs):
    rows = odd_docs.select("text").collect()
    held, n = toxicity._counts_of(odd_docs)
    want, m = toxicity.feature_counts([toxicity.features(r.text) for r in rows])
    assert n == m == 37 and (held == want).all()


def test_toxicity_counts_of_confirmed_rows_in_both_forms(spark, odd_docs):
    # a repeated id, one without a text row, and many ids for a small bitmap
    ids = spark.createDataFrame([(5,), (5,), (8,), (20,), (9_999,)] + [(i,) for i in range(50_000, 50_600)], "doc_id long")
    rows = [r.text for r in odd_docs.select("doc_id", "text").collect() if r.doc_id in (5, 8, 20)]
    want = toxicity.feature_counts([toxicity.features(t) for t in rows])
    for small in (True, False):
        (held, n), (_, every) = toxicity.group_counts(odd_docs, ids, small)
        assert (n, every) == (len(rows), 37) and (held == want[0]).all()
    got = toxicity.rows_with_ids(odd_docs, ids, bits=128)
    assert sorted(r.doc_id for r in got.collect()) == [5, 5, 8, 20] and got.columns == odd_docs.columns


def test_empty_tables(spark, odd_docs, labels):
    none = odd_docs.where("false")
    assert quality.quality_scores(none, labels.where("false")).count() == 0
    assert toxicity.fit_toxicity(none, labels.where("false"), F.lit(True)).scores([None]).tolist() == pytest.approx([0], abs=1e-9)
    assert bpe.token_digests(none, _word()).count() == 0
    assert mixing.mix_documents(none).count() == 0 and pii.replace_pii(none).count() == 0
    assert simhash.near_components(none).count() == 0 and merkle.edited_fingerprints(none).count() == 0
    folder = scratch_path(spark, "t")
    assert token_files.write_token_files(none, _byte(), folder) == []
    assert token_files.read_token_files(spark, folder).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(pages, folder + "w")
    assert warc.read_warc(spark, folder + "w").count() == 0
    vectors = spark.createDataFrame([(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0])],
                                    "vec_id long, embedding array<double>")
    assert ann.nearest(vectors, vectors).count() == 0


def test_documents_without_usable_labels_are_kept(odd_docs, labels):
    want = Counter(map(tuple, odd_docs.collect()))
    for unusable in (labels.where("false"), labels.where("doc_id is null"), labels.withColumn("quality", F.lit(None).cast("int"))):
        assert Counter(map(tuple, quality.keep_good(odd_docs, unusable).collect())) == want


def _word():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe_digests(odd_docs):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(_word())
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.token_digests(odd_docs, _word()).collect())
    want = Counter()
    for r in odd_docs.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want[r.doc_id, len(ids), hashlib.sha256(raw).hexdigest(),
             hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want


def test_token_files(spark, odd_docs, monkeypatch):
    from tokenizers import Tokenizer
    monkeypatch.setattr(token_files, "FILE_IDS", 500)
    lib, folder = Tokenizer.from_file(_byte()), scratch_path(spark, "tok")
    token_files.write_token_files(odd_docs, _byte(), folder)
    rows = token_files.read_token_files(spark, folder).collect()
    want = Counter()
    for r in odd_docs.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[r.doc_id, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in rows) == want
    rows.sort(key=lambda r: r.start)
    order = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order)
    assert [r.start for r in rows] == [sum(x.n_tokens for x in rows[:i]) for i in range(len(rows))]


@pytest.mark.parametrize("bound", [0, 1000])
def test_warc(spark, bound):
    data = [(1, "http://a", "same"), (2, "http://b", "same"), (2, "http://b", "same"), (3, None, None), (4, "u", ""),
            (None, "http://n", "same"), (5, "http://c", "é" * 50_000)]
    pages = spark.createDataFrame([(*r, 1) for r in data], "page_id long, url string, html string, digest int")
    folder = scratch_path(spark, "warc")
    files = warc.write_warc(pages, folder, roll_bytes=300, max_broadcast_rows=bound)
    assert len(files) > 1
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_warc(spark, folder).collect())
    assert got == Counter({(1, 4, "response", None): 1, (2, 4, "revisit", 1): 2, (3, 0, "response", None): 1,
                           (4, 0, "revisit", 3): 1, (None, 4, "revisit", 1): 1, (5, 100_000, "response", None): 1})


def test_mixing_targets_and_bounds(spark, odd_docs):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 0), (None, 500)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 20 and got["c"] == 0 and sum(got.values()) == pytest.approx(1510 * 1.5)
    keys = mixing.document_keys(odd_docs)
    rows = mixing.with_copies(keys, keys).collect()
    assert len(rows) == 37 and all(0 <= r.copies <= 2 for r in rows)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, mixing.with_copies(keys, keys).collect()))
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 4).alias("source"),
                                    (F.col("id") % 700 + 1).alias("size"))
    for r in mixing.with_copies(many, many).groupBy("source", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("n")).collect():
        assert r.n == pytest.approx(r.target, rel=0.01)
    mixed = mixing.mix_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == sum(r.copies for r in rows)


def test_pii_surrogates(spark):
    texts = ["Mr John Smith, +1 (337) 555-7349", "mrs@x.org; Mrs Smith (337) 555-7349", "card 4111111111111111", None, "",
             "card 4111 1111 1111 1111", "plain text, 12345", 'token = "9f14a7029c8514dfe98aba92898d323168e199da"']
    out = pii.replace_pii(docs_of(spark, texts), "k", "n")
    rows = {r.doc_id: r for r in out.collect()}
    assert out.columns == [*docs_of(spark, texts).columns, "n"]
    for secret in ("Smith", "555-7349", "mrs@x.org", "411111", "9f14a7"):
        assert not any(secret in (r.text or "") for r in rows.values())
    surname = rows[0].text.split(",")[0].split()[-1]
    assert f"Mrs {surname}" in rows[1].text and rows[0].text.startswith("Mr ")
    assert rows[0].text[-8:] == rows[1].text[-8:]                                     # one phone, two forms
    assert rows[2].text.replace("card ", "") == rows[5].text.replace("card ", "").replace(" ", "")
    assert rows[3].text is None and rows[4].text == "" and rows[6].text == texts[6] and rows[6].n == 0
    digits = [int(c) for c in rows[2].text[5:]][::-1]
    assert (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


def test_pii_secret_on_the_next_line_keeps_its_name(spark):
    texts = ["a key:\nUnderstanding the plan", "token =\n \n9f14a7029c8514dfe98aba92 end", "secret\n= abcdefghijklmnop"]
    out = [r.text for r in pii.replace_pii(docs_of(spark, texts), "k").orderBy("doc_id").collect()]
    for text, got, start, end in zip(texts, out, ("a key:\n", "token =\n \n", "secret\n= "), (" the plan", " end", "")):
        assert got.startswith(start) and got.endswith(end) and len(got) == len(text) and got != text


def test_pii_names_in_other_forms(spark):
    texts = ["so John F. Kennedy said", "so Dr J. Smith said", "so Mr van Dyke said", "so JOHN SMITH said", "so John\nSmith said",
             "so Mr. 王伟 said", "so Dr Ludwig van Beethoven said", "so MR SMITH said", "so John Smith said", "so john smith said"]
    hidden = ["Kennedy", "Smith", "Dyke", "SMITH", "Smith", "王", "Beethoven", "SMITH", "Smith", None]
    rows = pii.replace_pii(docs_of(spark, texts), "k", "n").orderBy("doc_id").collect()
    for text, name, r in zip(texts, hidden, rows):
        assert r.n == (1 if name else 0) and (name is None or name not in r.text), (text, r.text)
        assert r.text.startswith("so ") and r.text.endswith(" said")
    assert " van " in rows[2].text and " van " in rows[6].text and "." in rows[0].text
    surname = rows[8].text.split()[2]
    assert surname in rows[4].text and surname.upper() in rows[3].text and surname.upper() in rows[7].text


def test_pii_collisions_are_resolved(spark, monkeypatch):
    few = lambda key, k, c, h, attempt: F.substring(h, 1, 1)  # noqa: E731  16 surrogates only
    monkeypatch.setattr(pii, "surrogate", few)
    texts = [f"a{i}@x.org" for i in range(8)] * 2
    out = [r.text for r in pii.replace_pii(docs_of(spark, texts), "k").collect()]
    assert len(set(out)) == 8 and out[:8] == out[8:]


def test_simhash_components(spark, odd_docs):
    r = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    base = [r.choice(words) for _ in range(600)]
    texts = [" ".join(base)] * 3 + [" ".join(base[:k] + ["zz"] + base[k + 1:]) for k in range(0, 600, 40)] + \
        [" ".join(r.choice(words) for _ in range(80)) for _ in range(40)]
    docs = odd_docs.select("doc_id", "text").unionByName(docs_of(spark, texts, range(100, 100 + len(texts))).select("doc_id", "text"))
    rows = docs.collect()
    fp = [simhash.fingerprint(t.text, 3) & (2**64 - 1) for t in rows]
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 3 and comp[i] != comp[j]:
                comp = [comp[j] if c == comp[i] else c for c in comp]
    least = {c: min((r.doc_id for r, x in zip(rows, comp) if x == c and r.doc_id is not None), default=None) for c in set(comp)}
    got = Counter((r.doc_id, r.component_id) for r in simhash.near_components(docs).collect())
    assert got == Counter((r.doc_id, least[c]) for r, c in zip(rows, comp))
    kept = simhash.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == simhash.near_components(odd_docs).select(F.coalesce("component_id", "fp")).distinct().count()


def test_merkle(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = merkle.edited_fingerprints(odd_docs.select("doc_id", "text")).collect()
    ids = sorted((-1 if r.doc_id is None else r.doc_id) for r in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in got) == ids
    by = {r.doc_id: r.text or "" for r in rows}
    out = {r.doc_id: r for r in got}
    for a, b in [(1, 2), (2, 3), (3, 4), (4, 5), (5, 8), (36, None), (None, 0)]:
        n = len(by[a])
        edited = by[a][:n - n // 4] + by[b][:n // 4]
        if (a, b) != (4, 5) and a != 5:                                     # id 5 is there twice
            assert out[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert len({r.fingerprint for r in got if r.doc_id == 5}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert out[0].fingerprint == out[1].fingerprint and out[0].near_next == 1.0
    same = spark.createDataFrame([("a\nb\n\nc\n" * 9, "a\nb\n\nc\n" * 8 + "a\nB\n\nc\n")], "x string, y string")
    cmp = same.select(merkle.fingerprint(merkle.leaves(F.col("x"))).alias("x"), merkle.fingerprint(merkle.leaves(F.col("y"))).alias("y"))
    assert len(cmp.select(merkle.differing_sections("x", "y").alias("d")).first().d) == 1


@pytest.mark.parametrize("blocks_a_job", [1, 16])
def test_nearest_is_exact_on_small_tables(spark, monkeypatch, blocks_a_job):
    monkeypatch.setattr(ann, "BLOCKS_A_JOB", blocks_a_job)
    r = random.Random(3)
    data = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(300)] + [(300 + i, [1.0] * 6) for i in range(60)] + \
        [(7, [0.5] * 6), (400, None), (401, [0.0] * 6), (402, [1.0, 2.0]), (None, [1.0] * 6)]
    vectors = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    queries = vectors.where("vec_id % 50 = 0")
    got = ann.nearest(vectors, queries, block=3).collect()
    rows = [(i, v) for i, v in data if i is not None and v and len(v) == 6 and any(v)]
    for q, v in rows:
        if q % 50 == 0:
            want = sorted((sum((a - b) ** 2 for a, b in zip(v, w)) ** 0.5, i) for i, w in rows if i != q)[:10]
            mine = sorted((x.rank, x.vec_id, x.score) for x in got if x.query_id == q)
            assert [i for _, i, _ in mine] == [i for _, i in want]
            assert [s for _, _, s in mine] == pytest.approx([d for d, _ in want])


def test_query_blocks_are_cut_without_an_exact_quantile(spark, monkeypatch):
    errors, sizes = [], []
    frame, block = type(spark.range(1)), ann._block
    exact = frame.approxQuantile
    monkeypatch.setattr(frame, "approxQuantile", lambda self, c, p, e: errors.append((len(p) + 1, e)) or exact(self, c, p, e))
    monkeypatch.setattr(ann, "_block", lambda rows, part, *a: sizes.append(part.count()) or block(rows, part, *a))
    r = random.Random(8)
    vectors = spark.createDataFrame([(i * i, [r.gauss(0, 1) for _ in range(4)]) for i in range(200)], "vec_id long, embedding array<double>")
    assert ann.nearest(vectors, vectors, k=1, block=50).count() == 200
    assert len(errors) == 1 and all(0 < e <= 0.1 / blocks for blocks, e in errors)
    assert sum(sizes) == 200 and max(sizes) <= 56


def test_clashing_columns_keep_their_values(odd_docs, labels):
    docs = odd_docs
    for name in ("_id", "_h", "_m", "_attempts", "_th0", "_score", "_text", "text_hash", "fp", "size"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    want = {c for c in docs.columns if c != "text"}
    rows = {(r.doc_id, r._th, r._id, r._h, r._m, r._attempts, r._th0, r._score, r._text, r.fp, r.size) for r in docs.collect()}
    for out in (quality.keep_good(docs, labels, 0.0), simhash.drop_near_copies(docs), pii.replace_pii(docs),
                mixing.mix_documents(docs), bpe.token_digests(docs, _word())):
        assert want <= set(out.columns)
        got = out.collect()
        assert got and {(r.doc_id, r._th, r._id, r._h, r._m, r._attempts, r._th0, r._score, r._text, r.fp, r.size) for r in got} <= rows


def test_pipeline_runs_its_stages(spark, odd_docs, labels, tmp_path):
    odd_docs.drop("copies", "_th").write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pii_private_block_filled_by_the_data(spark):
    """More distinct addresses of one block than it has surrogates: all stay distinct."""
    from quern.llm.pii import replace_pii
    rows = [(i, " ".join(f"host 192.168.{i}.{j} up" for j in range(256))) for i in range(256)]
    out = replace_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    found = [m for r in out.collect() for m in r.text.split() if m[0].isdigit()]
    assert len(found) == 65536 and len(set(found)) == 65536
    assert all(m.startswith(("192.168.", "10.")) for m in found)
