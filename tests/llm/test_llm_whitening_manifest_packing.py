"""Operators 11 to 13 against plain Python and numpy, on odd rows and on empty tables."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from conftest import SF_SMALL
from quern.llm import manifest, packing, whitening
from quern.llm.common import table

WORDS = public_tokenizers.path("word_bpe_49k.json")


# --- 11: whitening ------------------------------------------------------------------------
def _whitened(spark, rows, components=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, deviation string, `_x` int")
    fit = whitening.distinct_integers(df, "embedding")
    model = whitening.fit_whitening(fit)
    return model, whitening.identity_error(fit, model, components), \
        whitening.add_whitened(df, model, "embedding", components)


def _rows(vectors):
    return [(i, v, "mine", 7) for i, v in enumerate(vectors)]


def test_whitening_equals_numpy(spark):
    r = np.random.default_rng(1)
    vectors = (r.normal(size=(200, 6)) @ r.normal(size=(6, 6))).tolist()
    vectors += vectors[:50] + [None, [], [1.0, float("nan")], [float("inf")] * 6, [1.0, None, 0.0], [0.5, 0.25]]
    model, error, out = _whitened(spark, _rows(vectors))
    good = [v for v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * c)) for c in v] + [0] * (6 - len(v)) for v in good])
    u = np.unique(x, axis=0)
    mean = u.sum(0) / len(u)
    cov = (u - mean).T @ (u - mean) / len(u)
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1], axes[:, ::-1]
    assert model.n == len(u) == 202 and model.sums == u.sum(0).tolist()
    assert np.allclose(model.covariance, cov, rtol=1e-12) and np.allclose(model.values, e, rtol=1e-9)
    assert error < 1e-9
    rows = out.collect()
    assert len(rows) == len(good) and out.columns == ["vec_id", "embedding", "_x", "deviation", "whitened"]
    where = {i: k for k, i in enumerate(i for i, v in enumerate(vectors) if any(v is g for g in good))}
    assert set(where) == {r.vec_id for r in rows}
    w = ((x - mean) @ axes[:, :4]) / np.sqrt(e[:4])
    got = np.array([r.whitened for r in sorted(rows, key=lambda r: r.vec_id)])
    sign = np.sign((got * w).sum(axis=0))
    assert np.allclose(got * sign, w, atol=1e-8)
    for row in rows:
        assert row.deviation == sum(int(v) ** 2 for v in model.n * x[where[row.vec_id]] - u.sum(0))


def test_whitening_stays_exact_for_huge_entries(spark):
    vectors = [[1e15, 2.0], [-1e15, 3.0], [4e14, -5.0], [1.5, 2.5]]
    model, error, out = _whitened(spark, _rows(vectors), 2)
    u = [[int(np.floor(256 * c)) for c in v] for v in vectors]
    s = [sum(c) for c in zip(*u)]
    assert model.sums == s
    t = [[4 * c - k for c, k in zip(v, s)] for v in u]
    assert model.covariance[0, 1] == sum(a * b for a, b in t) / 4 ** 3
    assert sorted(int(r.deviation) for r in out.collect()) == sorted(a * a + b * b for a, b in t)


def test_whitening_without_variance_and_without_rows(spark):
    _, error, out = _whitened(spark, _rows([[1.0, 2.0]] * 3))
    assert error is None and [(r.whitened, int(r.deviation)) for r in out.collect()] == [([None, None], 0)] * 3
    model, error, out = _whitened(spark, _rows([[1.0, 2.0, 3.0], [2.0, 2.0, 3.0], [4.0, 2.0, 3.0]]))
    assert error < 1e-12 and all(r.whitened[0] is not None and r.whitened[1:] == [None, None] for r in out.collect())
    for rows in ([], _rows([None, [float("nan")]])):
        model, error, out = _whitened(spark, rows)
        assert (model.n, error, out.count()) == (0, None, 0)
    assert [r.whitened for r in _whitened(spark, _rows([[], []]))[2].collect()] == [[], []]


def test_whitening_query(spark):
    rows = whitening.op11_polar_whitening(spark, SF_SMALL).collect()
    table_rows = table(spark, SF_SMALL, "embeddings").collect()
    assert len(rows) == 4 * len(table_rows) and {r.component for r in rows} == {1, 2, 3, 4}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-4
    shares = [next(r.explained for r in rows if r.component == c) for c in (1, 2, 3, 4)]
    assert shares == sorted(shares, reverse=True) and 0 < sum(shares) <= 1


# --- 12: manifest ---------------------------------------------------------------------------
def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _tree(hashes, arity):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i:i + arity]) for i in range(0, len(levels[-1]), arity)])
    proofs = []
    for i in range(len(hashes)):
        proof = []
        for level in levels[:-1]:
            first = i // arity * arity
            proof.append(("".join(level[first:i]), "".join(level[i + 1:first + arity])))
            i //= arity
        proofs.append(proof)
    return levels[-1][0], proofs


def _manifest(rows, arity):
    """Expected (doc_id, leaf, subroot, root, steps) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, _h(*map(_field, r)), r[0]))
    out, subs = [], []
    for source in sorted(groups, key=lambda s: (s is not None, (s or "").encode())):
        leaves = sorted(groups[source], key=lambda x: x[:3])
        sub, proofs = _tree([x[2] for x in leaves], arity)
        out += [(x[3], x[2], sub, len(subs), p) for x, p in zip(leaves, proofs)]
        subs.append(sub)
    root, tops = _tree(subs, arity)
    return [(d, leaf, sub, root, p + tops[k]) for d, leaf, sub, k, p in out]


@pytest.mark.parametrize("arity", [2, 3, 4])
def test_manifest_equals_plain_python(spark, arity):
    r = random.Random(arity)
    rows = [(i if i % 11 else None, r.choice(["a", "a", "a", "é", None, "ab", f"s{i % 5}"]), None if i % 7 == 0 else "en",
             i * 3, r.choice([None, "", "x\ny", "é" * 9, f"text {i}\n"])) for i in range(150)]
    rows += [rows[5]] * 40 + [(900, "only", "de", 1, "long " * 40_000)]
    df = spark.createDataFrame([(*x, "extra", 1) for x in rows],
                               "doc_id long, source string, lang string, n_chars long, text string, root string, tree int")
    got = manifest.dataset_manifest(df, keep=("doc_id", "root", "tree"), arity=arity).collect()
    key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
    found = [(g.doc_id, g.leaf, g.subroot, g.root, [(s.left, s.right) for s in g.steps]) for g in got]
    assert sorted(found, key=key) == sorted(_manifest(rows, arity), key=key)
    assert {g.tree for g in got} == {1}


def test_manifest_of_one_row_one_source_and_none(spark):
    ddl = "doc_id long, source string, lang string, n_chars long, text string"
    one = manifest.dataset_manifest(spark.createDataFrame([(1, None, None, None, None)], ddl)).collect()
    assert [(r.leaf, r.steps) for r in one] == [(_h(_field(1), "-", "-", "-", "-"), [])] and one[0].leaf == one[0].root == one[0].subroot
    rows = [(i, "s", "en", 2, f"t{i}") for i in range(5)]
    got = manifest.dataset_manifest(spark.createDataFrame(rows, ddl)).collect()
    assert sorted((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.steps]) for r in got) == sorted(_manifest(rows, 3))
    assert manifest.dataset_manifest(spark.createDataFrame([], ddl)).count() == 0


def test_manifest_query_finds_what_was_tampered_with(spark):
    docs = {r.doc_id: r for r in table(spark, SF_SMALL, "documents").collect()}
    rows = manifest.op12_merkle_manifest(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        changed = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (docs[r.doc_id].text or "")
        assert r.verified == (not changed) == (r.folded_root == r.root)


# --- 13: packing ----------------------------------------------------------------------------
def _check_places(rows, capacity):
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset, r.length)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
        assert ends[r.sequence_id] <= capacity
    return len(ends)


def test_best_fit_takes_the_tightest_bin():
    of, at, fill = packing.best_fit(np.array([3, 6, 4, 7, 0, 10]), 10)
    assert fill.tolist() == [10, 10, 10] and at[5] == 0 and fill[of[4]] == at[4]
    assert of[0] == of[3] and of[1] == of[2]                 # 7 + 3 and 6 + 4, not 6 + 3
    r = np.random.default_rng(3)
    sizes = r.integers(1, 101, 3000)
    of, at, fill = packing.best_fit(sizes, 100)
    assert (np.bincount(of, sizes) == fill).all() and fill.max() <= 100 and len(fill) <= 1.02 * -(-sizes.sum() // 100)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([11]), 10)


@pytest.mark.parametrize("local,fan_in,carried", [(50, 3, 20), (40, 2, 1), (10_000, 4, 8)])
def test_merges_keep_every_item_in_place(spark, local, fan_in, carried):
    r = random.Random(5)
    sizes = [r.choice([1, 2, 30, 55, 60, 99, 100]) for _ in range(1000)] + [7] * 500 + [None, 0]
    df = spark.createDataFrame([(i % 400, s, "mine") for i, s in enumerate(sizes)], "id long, length long, `_bin` string")
    out = packing.pack_best_fit(df, "length", 100, local_items=local, fan_in=fan_in, carried=carried)
    rows = out.na.fill(0, ["length"]).collect()
    assert out.columns == ["id", "length", "_bin", "sequence_id", "offset"]
    assert sorted((x.id, x.length) for x in rows) == sorted((i % 400, s or 0) for i, s in enumerate(sizes))
    bins = _check_places([x for x in rows if x.length], 100)
    assert bins <= (1.02 if carried > 1 else 1.1) * packing.best_fit(np.array([s or 0 for s in sizes]), 100)[2].size


def test_underfull_bins_of_all_tasks_meet(spark):
    # Each task sees one item only, so all the work is the merges'.
    df = spark.range(64).selectExpr("id", "CAST(if(id % 2 = 0, 60, 40) AS BIGINT) AS length")
    rows = packing.pack_best_fit(df, "length", 100, local_items=1, fan_in=4, carried=4).collect()
    assert len(rows) == 64 and _check_places(rows, 100) <= 40


def _pieces(texts, capacity=2048):
    lib = Tokenizer.from_file(WORDS)
    lib.no_truncation()
    lib.no_padding()
    out = []
    for i, t in texts:
        ids = lib.encode(t or "", add_special_tokens=False).ids + [0]
        out += [(i, k // capacity, k, np.array(ids[k:k + capacity], "<u4").tobytes()) for k in range(0, len(ids), capacity)]
    return out


def test_token_pieces_equal_the_library(spark):
    r = random.Random(2)
    odd = ["", None, "A b  c\tD\r\n", "don't STOP, it's 3.14!", "naïve Straße café é", "王伟 text ﬁne", "x" * 9000,
           "İstanbul ǅ", "<|endoftext|> tail", "a<|b", "\x1c\x1dmid\x85dle", "word " * 12_000, "emoji 👍🏽 ok"]
    texts = list(enumerate(odd)) + [(5, "same words"), (5, "same words"), (None, "no id")] + \
        [(100 + i, " ".join(r.choice(["Alpha", "beta,", "gamma's", "(delta)", "42nd"]) for _ in range(r.randrange(60)))) for i in range(50)]
    df = spark.createDataFrame([(i, t, 3) for i, t in texts], "doc_id long, text string, piece int")
    for capacity in (2048, 7):
        got = [(x.doc_id, x.piece, x.start, bytes(x.ids)) for x in packing.token_pieces(df, WORDS, capacity).collect()]
        key = lambda x: (x[0] is not None, x[0] or 0, *x[1:])
        assert sorted(got, key=key) == sorted(_pieces(texts, capacity), key=key)


def test_cache_generations_keep_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 3)
    encoder = packing.ChunkEncoder(WORDS)
    texts = ["one two three four", "five one six", "two seven eight nine one", "three"] * 3
    for t in texts:
        assert encoder.encode([t]) == encoder.ids([t])


def test_byte_level_vocabularies_are_encoded_whole():
    encoder = packing.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not encoder.by_chunk and encoder.encode(["a b  c"]) == encoder.ids(["a b  c"])


def test_packing_query(spark):
    rows = packing.op13_best_fit_packing(spark, SF_SMALL).collect()
    docs = [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()]
    want = [(i, p, s, len(ids) // 4, zlib.crc32(ids)) for i, p, s, ids in _pieces(docs)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    assert _check_places(rows, 2048) <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


def test_packing_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    pieces = packing.token_pieces(none, WORDS)
    assert packing.pack_best_fit(pieces.selectExpr("doc_id", "CAST(1 AS BIGINT) AS length"), "length").count() == 0
