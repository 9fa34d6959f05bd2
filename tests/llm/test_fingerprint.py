import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tuneforge.llm import fingerprint as fp
from tuneforge.llm import queries

from ..conftest import SF_SMALL


def sketch_of(text, k=fp.K):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x]
    grams = {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return sorted({hashlib.md5(g.encode()).hexdigest()[:16] for g in grams})[:k]


def alike(a, b, k=fp.K):
    u = sorted(set(a) | set(b))[:k]
    return len([x for x in u if x in a and x in b]) / len(u) if u else 1.0


def expected(rows):
    """One row of each id, ascending (null lowest), as the successor."""
    ids = sorted({i for i, _ in rows}, key=lambda i: (i is not None, i))
    out = []
    for i, t in rows:
        t = t or ""
        after = ids[(ids.index(i) + 1) % len(ids)]
        tail = max(len(x or "") // 4 for j, x in rows if j == i)
        start, nxt = min(((x or "")[:tail], bytes.fromhex("".join(sketch_of(x))), x or "") for j, x in rows if j == after)[::2]
        edited = t[:len(t) - len(t) // 4] + start[:len(t) // 4]
        a, b = sketch_of(t), sketch_of(edited)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), alike(a, b), alike(a, sketch_of(nxt))))
    return out


def result(df):
    return [(r[0], r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()]


def text(rng, n):
    return "".join(rng.choice("abcdefgé😀") * rng.randint(1, 4) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(n))


def test_brute_force(spark, docs_of):
    rng = random.Random(3)
    rows = [(i * 7 - 20, text(rng, rng.choice([0, 1, 3, 5, 6, 40, 300, 900]))) for i in range(60)]
    rows += [(400, None), (401, ""), (402, " \t "), (403, "one"), (404, "long " * 30_000), (None, "no id at all here"), (None, "z")]
    rows += [rows[3], rows[3], (rows[5][0], "another text of that id " * 9)]
    docs = docs_of([(i, t, "s") for i, t in rows]).withColumns({c: F.lit(1) for c in ("own", "next", "edited", "_tf_text", "k")})
    assert sorted(map(repr, result(fp.fingerprint_edits(docs.repartition(5))))) == sorted(map(repr, expected(rows)))


def test_one_document_and_none(spark, docs_of):
    (r,) = result(fp.fingerprint_edits(docs_of([(1, "a b c d e f g h", "s")])))
    assert r == expected([(1, "a b c d e f g h")])[0]
    assert fp.fingerprint_edits(docs_of([])).collect() == []


def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert sorted(map(repr, result(queries.op11_fingerprints(spark, SF_SMALL)))) == sorted(map(repr, expected(rows)))


def test_estimates_merge(spark):
    """Parts of a set, some repeated, merge into the sketch of the whole; estimates are near the truth."""
    words = [f"w{i}" for i in range(6000)]
    whole, half = " ".join(words), " ".join(words[:3000])
    parts = [("a", " ".join(words[i:i + 104])) for i in range(0, 6000, 100)] * 3 + [("b", None), (None, half)]
    rows = spark.createDataFrame(parts, "g string, t string").select("g", fp.sketch(F.col("t")).alias("s"))
    for fan in (fp.FAN, 4):
        old, fp.FAN = fp.FAN, fan
        try:
            got = {r.g: r.s for r in fp.merge_groups(rows, ["g"], "s").collect()}
        finally:
            fp.FAN = old
        assert got == {"a": sketch_of(whole), "b": [], None: sketch_of(half)}
    both = spark.createDataFrame([(whole, half)], "w string, h string").select(fp.sketch(F.col("w")).alias("w"), fp.sketch(F.col("h")).alias("h"))
    w, h = F.col("w"), F.col("h")
    r = both.select(fp.resemblance(w, h).alias("r"), fp.containment(h, w).alias("hw"), fp.containment(w, h).alias("wh"),
                    fp.distinct_shingles(w).alias("n"), fp.to_string(w).alias("s"), fp.from_string(fp.to_string(w)).alias("back"), "w").first()
    assert r.r == pytest.approx(0.5, abs=0.15) and r.wh == pytest.approx(0.5, abs=0.2) and r.hw > 0.75
    assert r.n == pytest.approx(5996, rel=0.3) and r.back == r.w


def test_native(spark):
    """No Python on the main path, and texts are dealt by one exchange that both joins read."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = fp.fingerprint_edits(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not re.search("Python|Arrow|Pandas", plan)
    final = plan.split("Initial Plan")[0]
    assert final.count("ReusedExchange") == 1
