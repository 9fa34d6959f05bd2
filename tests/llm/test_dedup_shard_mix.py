import hashlib
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tuneforge.llm import exact_dedup, mixture, queries, sharding

from ..conftest import SF_SMALL

ROWS = [(5, "a  b", "s1"), (3, "a b", "s1"), (9, "a\tb", None), (4, None, "s2"), (7, "", "s2"), (None, "a b", "s1"),
        (8, " a b", "s3"), (8, " a b", "s3"), (None, "only null id", "s1"), (11, "é" * 5000, "s2"), (12, " ", None)]


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_classes_brute_force(spark, docs_of):
    groups = defaultdict(list)
    for i, t, _ in ROWS:
        groups[norm(t)].append(i)
    want = sorted(str((i, min((x for x in g if x is not None), default=None), len(g)))
                  for k, g in groups.items() for i in g)
    for digest in (exact_dedup.sha256_hex, lambda c: F.substring(exact_dedup.sha256_hex(c), 1, 1),
                   lambda c: F.lit("same")):  # colliding digests change nothing
        got = exact_dedup.exact_classes(docs_of(ROWS), digest=digest).collect()
        assert sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in got) == want


def test_exact_dedup_rows(spark, docs_of):
    kept = exact_dedup.exact_dedup(docs_of(ROWS)).collect()
    assert sorted(norm(r.text) for r in kept) == sorted({norm(t) for _, t, _ in ROWS})
    assert {r.doc_id for r in kept} == {3, 4, 8, 11, 12, None}
    assert exact_dedup.exact_dedup(docs_of([])).count() == 0


def test_sharding(spark, docs_of):
    rows = ROWS + [(100 + i, f"text {i} " * (1 + i % 7), "s") for i in range(400)]
    out = sharding.shard_documents(docs_of(rows), 7).collect()
    assert len(out) == len(rows)
    by_text, slots, load = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in out:
        by_text[r.group_key].add(r.shard)
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    rest = sorted(load.values())[:-1]  # one shard holds the one large text
    assert rest[-1] - rest[0] < 0.05 * rest[-1]
    want = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    assert sorted((r.size, r.text_crc32) for r in out) == want
    assert sharding.shard_documents(docs_of([]), 7).count() == 0


def targets_brute(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, pool, out = 1.5 * sum(sizes.values()), set(names), {}
    while pool:
        w = sum(weight[s] for s in pool)
        full = {s for s in pool if left * weight[s] / w >= 2 * sizes[s]}
        if not full:
            return out | {s: left * weight[s] / w for s in pool}
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        pool -= full
    return out


def test_mix_targets_and_taken(spark, docs_of):
    rows = ROWS + [(100 + i, "w " * (i % 90), f"s{i % 4}") for i in range(300)]
    docs, pieces = mixture.mix(docs_of(rows), block_words=16)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = targets_brute(sizes)
    got = docs.collect()
    assert len(got) == len(rows)
    taken = defaultdict(int)
    for r in got:
        s = None if r.source_key == "~" else r.source_key[1:]
        assert abs(r.target - want[s]) < 1e-6 and r.source_size == sizes[s]
        assert r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = mixture.mix(docs_of(rows).repartition(5), block_words=16)[0].collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    # every slot plays one block of its source, and early slots already mix by weight
    p = pieces.groupBy("slot").agg(F.countDistinct("source_key").alias("n"), F.sum("words").alias("w")).collect()
    assert all(r.n == 1 and r.w <= 16 for r in p)
    assert mixture.mix(docs_of([]))[0].count() == 0


def test_registered(spark):
    for name in ("op4_mixture", "op6_exact_dedup", "op7_sharding"):
        assert queries.QUERIES[name](spark, SF_SMALL).count() == 200
