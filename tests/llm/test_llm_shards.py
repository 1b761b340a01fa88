"""Files of equal rows are equal: ranges follow from the rows, not from the session or the input files."""

import hashlib
import os
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quern.llm import token_files, warc
from quern.llm.common import Ranges, ranges, scratch_path, staged


def _files(folder):
    folder = folder.removeprefix("file:")
    return {f: hashlib.sha256(open(f"{folder}/{f}", "rb").read()).hexdigest() for f in sorted(os.listdir(folder)) if f.startswith("part-")}


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(1)
    texts = [" ".join(r.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(r.randrange(80))) for _ in range(600)]
    return [(i if i % 50 else None, f"http://a/{i}", None if i % 31 == 0 else t) for i, t in enumerate(texts)] + \
        [(7, "http://hot", f"hot {k}") for k in range(300)] + [(9, "http://same", "same")] * 40


@pytest.mark.parametrize("kind", ["warc", "tokens"])
def test_settings_and_input_files_do_not_show_in_the_output(spark, rows, kind):
    found = []
    for parts, shuffles in ((1, "4"), (5, "9"), (3, "2")):
        shuffled = rows[:]
        random.Random(parts).shuffle(shuffled)
        df = staged(spark.createDataFrame(shuffled, "page_id long, url string, html string").repartition(parts), "in")
        folder, before = scratch_path(spark, kind), spark.conf.get("spark.sql.shuffle.partitions")
        try:
            spark.conf.set("spark.sql.shuffle.partitions", shuffles)
            if kind == "warc":
                warc.write_warc(df, folder, shard_bytes=8000)
            else:
                token_files.write_token_files(df.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")),
                                              public_tokenizers.path("byte_bpe_50k.json"), folder, shard_bytes=8000)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        found.append(_files(folder))
    assert found[0] == found[1] == found[2] and len(found[0]) >= 5


def test_ranges_keep_order_and_split_a_hot_key(spark):
    r = np.random.default_rng(2)
    keys, ties = r.integers(-50, 50, 4000), r.integers(-2 ** 63, 2 ** 63 - 1, 4000)
    keys[:1500] = 13                                         # one key holds a third of all rows
    df = spark.createDataFrame([(int(k), int(t), 100) for k, t in zip(keys, ties)] + [(None, 5, 100)] * 3, "key long, tie long, bytes long")
    for nulls_first in (True, False):
        cut = ranges(df, nulls_first, 20_000)
        got = df.withColumn("shard", cut.number("key", "tie")).collect()
        some = sorted((x for x in got if x.key is not None), key=lambda x: (x.key, x.tie))
        assert [x.shard for x in some] == sorted(x.shard for x in some)
        assert {x.shard for x in got if x.key is None} == {0 if nulls_first else cut.count - 1}
        assert max(np.bincount([x.shard for x in got])) < 1000 and 0 <= min(x.shard for x in got) <= max(x.shard for x in got) < cut.count
    assert Ranges([], True).place(np.array([3, 1]), np.array([0, 0])).tolist() == [0, 0]
    assert ranges(df.where("false"), True).count == 2
