"""The pipeline over the smallest tables against plain versions of its stages."""

import numpy as np
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from cofi.llm import bpe, mixing, quality
from cofi.llm.queries import RANK_FILE, public_tokenizers
from cofi.session import materialize
from tests.llm.test_quality import plain
from tests.llm.test_simhash import plain_components, plain_fp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "step")
        out.append(docs)
    return out


def test_each_stage_on_what_its_predecessor_kept(spark, steps):
    raw = pq.read_table(f"{SF}/documents.parquet").to_pandas()
    good, one, masked, mixed, tokens = (x.toPandas() for x in steps)
    assert all(list(x.columns) == list(raw.columns) for x in (good, one, masked, mixed))
    assert not set(raw[[plain(t)[-1] for t in raw.text]].doc_id) & set(good.doc_id) and len(good) > 0.5 * len(raw)
    of = plain_components({r.doc_id: plain_fp(r.text) for r in good.itertuples()}, 2)
    assert sorted(one.doc_id) == sorted(set(of.values())) and len(one) < len(good)
    assert sorted(masked.doc_id) == sorted(one.doc_id)
    both = one.merge(masked, on="doc_id")
    changed = both[both.text_x != both.text_y]
    assert 0 < len(changed) < len(one) / 2 and not changed.text_y.str.contains(r"@mail\d").any()
    want = mixing.selection(steps[2]).select("doc_id").toPandas()
    assert sorted(want.doc_id) == sorted(mixed.doc_id) and set(mixed.text) <= set(masked.text)
    c = bpe.codec(RANK_FILE, public_tokenizers.PATTERN)
    texts = dict(zip(mixed.doc_id, mixed.text))
    assert len(tokens) == len(mixed)
    assert all(c.decode(np.frombuffer(r.ids, "<u4")).decode() == texts[r.doc_id] for r in tokens.itertuples())


def test_run_is_the_stages(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[-1].collect()))


def test_clean_documents_stay(spark):
    """Of labelled documents: nearly all good ones stay in the quality stage, most bad ones go."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    x = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").toPandas()
    assert x[x.quality == 1].kept.mean() > 0.99
    assert x[x.quality == 0].kept.mean() < 0.35
