"""Rows of the pipeline against plain Python, every query's columns, and the SQL oracles of this subpackage."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF_SMALL
from quern.llm import toxicity
from quern.llm.mixing import OP4_SQL
from quern.llm.pii import replace_pii
from quern.llm.quality import THRESHOLD, quality_scores
from quern.llm.registry import ORACLE_SQL, QUERIES
from test_oracle import TABLES, _digest

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


# --- SQL oracles ------------------------------------------------------------------------------
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF_SMALL).toPandas(), con.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and _digest(got) == _digest(want)


# --- result columns ---------------------------------------------------------------------------
CONTRACT = {
    "op1_quality_fm": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op2_warc_roundtrip": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string",
                           "refers_to": "bigint"},
    "op3_bpe_tokens": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op5_toxicity_nnpu": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op7_ann_forest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op8_simhash_near_dedup": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op9_merkle_fingerprints": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "near_edited": "double",
                                "near_next": "double"},
    "op10_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op11_polar_whitening": {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                             "explained": "double", "identity_error": "double"},
    "op12_merkle_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string",
                             "folded_root": "string", "verified": "boolean"},
    "op13_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
                              "sequence_id": "bigint", "offset": "bigint"},
}


@pytest.fixture(scope="module")
def results(spark):
    held = {}

    def of(name):
        if name not in held:
            df = QUERIES[name](spark, SF_SMALL)
            held[name] = dict(df.dtypes), df.collect()
        return held[name]
    return of


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_result_columns(results, name):
    types, rows = results(name)
    assert rows and CONTRACT[name].items() <= types.items()


@pytest.mark.parametrize("name,of,rest", [("op1_quality_fm", 4, 2), ("op5_toxicity_nnpu", 3, 1)])
def test_held_out_rows_and_threshold(results, documents, name, of, rest):
    rows = results(name)[1]
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in documents.select("doc_id").collect())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % of == rest)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_records_of_pages(spark, results):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    import base64
    for r in results("op2_warc_roundtrip")[1]:
        body = pages[r.page_id]
        assert r.payload_bytes == len(body) and r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        least = first[body]
        assert (r.record_type, r.refers_to) == (("response", None) if least == r.page_id else ("revisit", least))


def test_nearest_are_those_of_brute_force(spark, results):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=np.float64)
    got = defaultdict(list)
    for r in sorted(results("op7_ann_forest")[1], key=lambda r: (r.query_id, r.rank)):
        got[r.query_id].append(r.vec_id)
        d = np.sqrt(((x[ids == r.vec_id][0] - x[ids == r.query_id][0]) ** 2).sum())
        assert r.score == pytest.approx(d, rel=1e-12)
    assert set(got) == {i for i in ids if i % 100 == 0}
    hits = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        best = [i for _, i in sorted(zip(d.tolist(), ids.tolist())) if i != q][:10]
        hits += len(set(best) & set(found)) / len(best)
    assert hits / len(got) >= 0.9


def test_edited_texts_and_equal_fingerprints(documents, results):
    docs = [(r.doc_id, r.text or "") for r in documents.orderBy("doc_id").collect()]
    rows = {r.doc_id: r for r in results("op9_merkle_fingerprints")[1]}
    by_text = defaultdict(set)
    for (i, t), (_, after) in zip(docs, docs[1:] + docs[:1]):
        n = len(t) // 4
        edited = t[:len(t) - n] + after[:n]
        r = rows[i]
        by_text[t].add(r.fingerprint)
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (edited == t)
        if edited == t and t:
            assert r.near_edited == 1
    assert all(len(f) == 1 for f in by_text.values())


# --- nnPU risk --------------------------------------------------------------------------------
def test_classifier_descends_the_clipped_risk():
    """Risk of the fitted classifier by the formula is below that of the prior alone, and never negative in its clipped part."""
    r = np.random.default_rng(0)
    vile, clean = ["you vile scum %d" % i for i in r.integers(0, 50, 120)], ["a calm text about %d" % i for i in r.integers(0, 50, 500)]
    p = [toxicity.features(t) for t in vile[:60]]
    u = [toxicity.features(t) for t in clean + vile[60:]]
    prior = 0.1

    def risk(model):
        g = lambda rows: model.margins(rows)
        loss = lambda m: 1 / (1 + np.exp(np.clip(m, -30, 30)))  # noqa: E731 - sigmoid loss l(g) = sigmoid(-g)
        negative = loss(-g(u)).mean() - prior * loss(-g(p)).mean()
        return prior * loss(g(p)).mean() + max(0.0, negative)
    fitted, flat = toxicity.PuClassifier(), toxicity.PuClassifier(bias=float(np.log(prior / (1 - prior))))
    fitted.fit(p, u, prior)
    assert 0 <= risk(fitted) < 0.5 * risk(flat)
    assert (fitted.scores(vile) > 0.7).mean() > 0.9 and (fitted.scores(clean) < 0.3).mean() > 0.95


# --- pipeline ---------------------------------------------------------------------------------
def _fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _one_per_component(rows):
    """Ids that stay: the smallest of each class of fingerprints linked at 3 bits or fewer."""
    prints = {i: _fingerprint(t) for i, t in rows}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(prints)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {find(i) for i in ids}


def test_pipeline_rows_equal_plain_python(spark, documents, tmp_path):
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    stages, kept = dict(corpus_pipeline.STAGES), {}
    docs = documents
    for k, (name, _) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{k}"
        stages[name](spark, docs, SF_SMALL).write.parquet(path)
        docs = kept[name] = spark.read.parquet(path)
    quality, dedup, pii, mixed, tokens = (kept[n].collect() for n, _ in corpus_pipeline.STAGES)
    # 1: exactly the rows whose score reaches the threshold, untouched.
    scores = {r.doc_id: r.score for r in quality_scores(documents, labels).collect()}
    source = {r.doc_id: r for r in documents.collect()}
    assert {r.doc_id for r in quality} == {i for i, s in scores.items() if s >= THRESHOLD} and quality
    assert all(source[r.doc_id] == r for r in quality)
    # 8: one row of each component of the first stage's rows.
    assert sorted(r.doc_id for r in dedup) == sorted(_one_per_component([(r.doc_id, r.text) for r in quality]))
    assert len(dedup) < len(quality) and all(source[r.doc_id] == r for r in dedup)
    # 6: the same rows; texts are the operator's, other columns stay, and mail addresses are no longer theirs.
    own = {r.doc_id: r.text for r in replace_pii(kept["simhash near-dedup"]).collect()}
    assert {r.doc_id: r.text for r in pii} == own and len(pii) == len(dedup)
    mail = re.compile(r"[\w.+-]+@[\w-]+\.[\w.]+")
    for r in pii:
        before = source[r.doc_id]
        assert (r.source, r.lang) == (before.source, before.lang)
        assert not set(mail.findall(r.text or "")) & set(mail.findall(before.text or ""))
    # 4: each row as often as the SQL of the mix takes it.
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/2/*.parquet')")
    taken = con.sql(OP4_SQL).df()
    want = Counter({int(i): int(t // s) for i, s, t in zip(taken.doc_id, taken["size"], taken.taken) if s})
    # (texts without words take part by their copies, which the SQL's words do not show)
    assert Counter(r.doc_id for r in mixed if WORD.search(r.text or "")) == +want
    assert {r.text for r in mixed} <= set(own.values())
    # 3: the library's ids of every repeat.
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lib.no_truncation()
    lib.no_padding()
    expected = Counter()
    for r in mixed:
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        expected[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in tokens) == expected
    # run() does these stages in this order.
    run = corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert Counter(map(tuple, run)) == expected


def test_toxicity_with_documents_but_no_labels(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(documents, labels, F.lit(True))
    assert max(model.scores(["any text", "", None])) < 1e-6
