import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from tuneforge.llm import bpe, queries, toxicity
from tuneforge.llm.common import table, written

from ..conftest import SF_SMALL
from .test_dedup_shard_mix import norm, targets_brute
from .test_near_dup import classes_brute


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SF_SMALL, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF_SMALL), f"test-{name}"))
    return [d.collect() for d in out]


def test_columns(steps):
    assert all(s[0].__fields__ == steps[0][0].__fields__ for s in steps[:-1])


def test_toxicity_stage(spark, steps):
    model = queries.toxicity_model(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    slots = toxicity._Slots(model.bits)
    want = {r.doc_id for r in steps[0] if model.margin(toxicity.terms_of(r.text, slots)) < 0}
    assert {r.doc_id for r in steps[1]} == want


def test_dedup_stages(steps):
    first = {}
    for r in sorted(steps[1], key=lambda r: r.doc_id):
        first.setdefault(norm(r.text), r.doc_id)
    assert sorted(r.doc_id for r in steps[2]) == sorted(first.values())
    classes = classes_brute([(r.doc_id, r.text) for r in sorted(steps[2], key=lambda r: r.doc_id)])
    assert sorted(r.doc_id for r in steps[3]) == sorted(set(classes.values()))


def test_mix_stage(steps):
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in steps[3]}
    source = {r.doc_id: r.source for r in steps[3]}
    total, got, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, n in size.items():
        total[source[i]] += n
        largest[source[i]] = max(largest[source[i]], n)
    plays = Counter(r.doc_id for r in steps[4])
    for i, n in plays.items():
        assert n <= 2
        got[source[i]] += n * size[i]
    for s, t in targets_brute(total).items():  # whole documents: the last one may pass the target
        assert t - 1 <= got[s] <= t + largest[s]


def test_token_stage(steps):
    enc = tiktoken.Encoding("x", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    want = sorted((r.doc_id, np.array(enc.encode_ordinary(r.text or ""), "<u4").tobytes(), hashlib.sha256((r.text or "").encode()).hexdigest())
                  for r in steps[4])
    assert sorted((r.doc_id, bytes(r.ids), r.decoded_sha256) for r in steps[5]) == want


def test_hard_rows(spark, steps):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "some words here", None, "s", 3),
            (3, "word " * 40_000, "en", None, None), (4, "some  words here", "en", "s", 1)]
    for given in (rows, []):
        at = spark.createDataFrame(given, docs.schema)
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            at = written(stage(spark, at, SF_SMALL), f"test-{name}")
            assert k == 4 or at.columns == docs.columns
        assert (at.count() > 0) == bool(given)
