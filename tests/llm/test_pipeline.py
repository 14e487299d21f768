"""The pipeline's stages against plain versions, one after the other."""

import collections

import brute
import corpus_pipeline
import numpy as np
import xxhash

from pyspark.sql import functions as F

from lendmart.llm import bpe, mixing

SF = "/root/testdata/sf0.001"


def test_stages(spark, docs, texts, tokenizer):
    now, ids = docs, set(texts)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, now, SF)
        got = [r.doc_id for r in out.select("doc_id").collect()]
        if name != names[-1]:
            assert out.columns == docs.columns
        if name == "quality rules":
            ids = {d for d in ids if not brute.rules(texts[d])[5]}
        elif name == "exact dedup":
            ids = set({brute.lower(texts[d]): d for d in sorted(ids)}.values())
        elif name == "SimHash near-dedup":
            prints = [(d, brute.simhash(texts[d], xxhash.xxh64_intdigest)) for d in sorted(ids)]
            ids = set(brute.components(prints))
        if name in names[:3]:
            assert sorted(got) == sorted(ids)
        else:
            assert set(got) == ids and len(got) >= len(ids)
        now = out
        if name == "mixing sources":
            # One partition after the other, the rows stand in the mixture's order.
            place = {(r.doc_id, r.epoch): r.position for r in mixing.mix(docs.where(F.col("doc_id").isin(list(ids)))).select("doc_id", "mix.*").collect()}
            epoch, order = collections.Counter(), []
            for d in got:
                order.append((place[d, epoch[d]], d))
                epoch[d] += 1
            assert order == sorted(order)
    own = bpe.Codec(open(tokenizer).read())
    for r in now.collect():
        assert r.token_ids == np.frombuffer(own.encode(texts[r.doc_id]), "<u4").tolist() and r.n_tokens == len(r.token_ids)
    assert source and corpus_pipeline.run(spark, SF).count() == len(got)


def test_stages_on_odd_rows(spark, clashing, nothing):
    for name, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, clashing, SF).columns == clashing.columns
        assert step(spark, nothing, SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, clashing, SF).count() == clashing.count()
