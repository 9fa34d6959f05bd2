"""Property tests: the exact cut equals a global row_number over the seeded hash, for random
group sizes, ratios, seeds and both k rules; and the sheet stop rule equals a row loop."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tuneforge.functions.keys import shuffle_hash
from tuneforge.operators import sheets, split

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(sizes=st.lists(st.integers(min_value=0, max_value=60), min_size=1, max_size=4),
       ratio=st.sampled_from([0.0, 0.1, 0.3, 0.5, 0.7, 0.8, 0.9, 1.0]),
       seed=st.integers(min_value=0, max_value=10_000),
       mode=st.sampled_from(["floor_train", "ceil_valid"]))
def test_exact_split_matches_python(spark, sizes, ratio, seed, mode):
    rows = [(f"g{g}", f"k{g}_{i}") for g, n in enumerate(sizes) for i in range(n)]
    if not rows:
        return
    df = spark.createDataFrame(rows, "source string, row_key string")
    got = {(r.source, r.row_key): r.split for r in split.exact_split(df, "row_key", ratio, seed, ["source"], mode).collect()}
    hashes = {(r.source, r.row_key): r.h for r in df.select("*", shuffle_hash("row_key", seed, "split").alias("h")).collect()}
    for g, n in enumerate(sizes):
        if n == 0:
            continue
        keys = sorted((hashes[(f"g{g}", f"k{g}_{i}")], f"k{g}_{i}") for i in range(n))
        k = math.floor(n * ratio) if mode == "floor_train" else n - math.ceil((1 - ratio) * n)
        for pos, (_h, key) in enumerate(keys):
            assert got[(f"g{g}", key)] == ("train" if pos < k else "valid")


def _first_blank_reference(cells, header_row, in_col, out_col):
    """The row loop: from header_row + 1, stop at the first row with neither key cell."""
    out, row = [], header_row + 1
    while True:
        a, b = cells.get((row, in_col)), cells.get((row, out_col))
        if a is None and b is None:
            return out
        out.append((row, a or "", b or ""))
        row += 1


@settings(**SETTINGS)
@given(present=st.lists(st.tuples(st.booleans(), st.booleans(), st.booleans()), min_size=0, max_size=25))
def test_first_blank_matches_row_loop(spark, present):
    cells = {(5, 1): "No", (5, 2): "question", (5, 3): "answer"}
    for i, (has_no, has_in, has_out) in enumerate(present):
        r = 6 + i
        if has_no:
            cells[(r, 1)] = str(i)
        if has_in:
            cells[(r, 2)] = f"q{i}"
        if has_out:
            cells[(r, 3)] = f"a{i}"
    df = spark.createDataFrame([("f", "s", r, c, v) for (r, c), v in cells.items()],
                               "file string, sheet string, row int, col int, value string")
    ok, _ = sheets.drop_unmapped_sheets(df, sheets.resolve_columns(df, 5, "qa"), "qa")
    got = sorted((r.row, r.input, r.output) for r in sheets.sheet_records(df, ok, 5, "qa").collect())
    assert got == _first_blank_reference(cells, 5, 2, 3)


@settings(**SETTINGS)
@given(sizes=st.lists(st.integers(min_value=1, max_value=50), min_size=1, max_size=3),
       k=st.integers(min_value=0, max_value=60), seed=st.integers(min_value=0, max_value=10_000))
def test_sample_exact_matches_python(spark, sizes, k, seed):
    rows = [(f"g{g}", f"k{g}_{i}") for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "source string, row_key string")
    got = {(r.source, r.row_key) for r in split.sample_exact(df, "row_key", k, seed, "s", by=["source"]).collect()}
    hashes = {(r.source, r.row_key): r.h for r in df.select("*", shuffle_hash("row_key", seed, "s").alias("h")).collect()}
    want = set()
    for g, n in enumerate(sizes):
        keys = sorted((hashes[(f"g{g}", f"k{g}_{i}")], f"k{g}_{i}") for i in range(n))
        want |= {(f"g{g}", key) for _h, key in keys[:k]}
    assert got == want
