"""Sources (JSON lines, dialogues, workbooks) and sinks, on hand-made files in a temp folder."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tuneforge.functions.json_valid import json_valid
from tuneforge.operators import sheets
from tuneforge.sinks import writers as W
from tuneforge.sources import cells as C
from tuneforge.sources import jsonl

VALID = ['123', 'NaN', '"a"', 'null', 'true', '[1,2]', '{"a":1,"a":2}', '{"a":NaN}', ' {"a": 1} ', '-Infinity']
INVALID = ['{"a":1} x', "{'a':1}", '{a:1}', '[1', '{"a":1', '{"a":01}', '"a\tb"', '', '{"a":1}{"b":2}', 'nul']


def _py_valid(s):
    try:
        json.loads(s)
        return True
    except ValueError:
        return False


def test_json_validity_equals_python(spark):
    df = spark.createDataFrame([(s,) for s in VALID + INVALID], "s string")
    got = {r.s: r.v for r in df.select("s", json_valid("s").alias("v")).collect()}
    assert all(got[s] == _py_valid(s) for s in VALID + INVALID)
    assert all(got[s] for s in VALID) and not any(got[s] for s in INVALID)


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_read_jsonl_records_rejects_and_keys(spark, tmp_dir):
    p = os.path.join(tmp_dir, "qa.jsonl")
    _write(p, ['{"input": "質問", "output": "答え"}', "", "   ", '{"text": "本文"}', "{bad", '{"input": 5}',
               '{"other": 1}', '{"input": "a", "output": "b"}', '{"input": "a", "output": "b"}'])
    rec, rej = jsonl.read_jsonl(spark, p)
    from tuneforge.operators.records import dispatch_kind

    kept, dropped = dispatch_kind(rec)
    rows = {(r.input, r.output, r.text, r.kind) for r in kept.collect()}
    assert ("質問", "答え", None, "qa") in rows and (None, None, "本文", "text") in rows
    assert ("5", None, None, "qa") in rows  # non-string values keep their JSON text
    assert dropped.count() == 1  # {"other": 1}
    assert rej.agg(F.sum("n_lines")).first()[0] == 1
    keys = [r.row_key for r in rec.collect()]
    assert len(keys) == len(set(keys)) == 6


def test_line_keys_independent_of_partitioning(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dup.jsonl")
    _write(p, ['{"text": "x"}'] * 500 + ['{"text": "y"}'] * 3)
    a = sorted(r.row_key for r in jsonl.line_keys(jsonl.read_lines(spark, p)).collect())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        b = sorted(r.row_key for r in jsonl.line_keys(jsonl.read_lines(spark, p)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert a == b and len(set(a)) == 503


def test_line_keys_after_a_shuffle(spark):
    df = spark.range(6000).select(F.concat(F.lit("f"), F.col("id") % 2).alias("file"), F.concat(F.lit("line "), F.col("id") % 700).alias("line"),
                                  F.col("id").alias("extra")).repartition(16, "extra")
    out = jsonl.line_keys(df)
    r = out.agg(F.count("*").alias("n"), F.countDistinct("row_key").alias("k"), F.countDistinct("extra").alias("e")).first()
    assert (r.n, r.k, r.e) == (6000, 6000, 6000) and out.columns == ["file", "line", "extra", "row_key"]


def test_equal_lines_of_two_files_have_two_keys(spark, tmp_dir):
    for sub in ("a", "b"):
        os.makedirs(os.path.join(tmp_dir, sub))
        _write(os.path.join(tmp_dir, sub, "x.jsonl"), ['{"text": "same"}'] * 2)
    rec, _ = jsonl.read_jsonl(spark, [os.path.join(tmp_dir, s, "x.jsonl") for s in ("a", "b")], source="c")
    assert len({r.row_key for r in rec.collect()}) == 4


def test_read_split_jsonl_and_dialogues(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "train.jsonl"), ['{"input": "a", "output": "b"}'] * 3)
    _write(os.path.join(tmp_dir, "valid.jsonl"), ['{"text": "t"}'])
    s = jsonl.read_split_jsonl(spark, tmp_dir)
    assert {(r.split, r["count"]) for r in s.groupBy("split").count().collect()} == {("train", 3), ("validation", 1)}
    dpath = os.path.join(tmp_dir, "topic1.json")
    with open(dpath, "w", encoding="utf-8") as f:
        json.dump([{"utterances": [{"turn_num": 1, "utterance": "u1"}, {"turn_num": 2, "utterance": "u2"}]},
                   {"utterances": [{"turn_num": 1, "utterance": "v1"}]}], f, ensure_ascii=False)
    u = jsonl.read_dialogues(spark, dpath).collect()
    assert sorted((r.dlg_idx, r.pos, r.turn_num, r.utterance) for r in u) == [(0, 0, 1, "u1"), (0, 1, 2, "u2"), (1, 0, 1, "v1")]


NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
RNS = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def _xlsx(path):
    """A two-sheet workbook with shared, rich, inline, formula, number and boolean cells."""
    shared = ["No", "Answer A", "Model Answer", "q1"]
    sst = "".join(f"<si><t>{s}</t></si>" for s in shared) + "<si><r><t>Ques</t></r><r><t>tion</t></r></si>"
    cells = [  # (ref, xml) ; header row 5: No | Question | Answer A | Model Answer
        ("A5", '<c r="A5" t="s"><v>0</v></c>'), ("B5", '<c r="B5" t="s"><v>4</v></c>'),
        ("C5", '<c r="C5" t="s"><v>1</v></c>'), ("D5", '<c r="D5" t="s"><v>2</v></c>'),
        ("A6", '<c r="A6"><v>1</v></c>'), ("B6", '<c r="B6" t="s"><v>3</v></c>'),
        ("C6", '<c r="C6"><v>0.5</v></c>'), ("D6", '<c r="D6" t="str"><f>A1</f><v>a1</v></c>'),
        ("E6", '<c r="E6" t="b"><v>1</v></c>'),
        ("B7", '<c r="B7" t="inlineStr"><is><t>q2</t></is></c>'),
        ("D8", '<c r="D8" t="inlineStr"><is><t>a3</t></is></c>'),
        ("A9", '<c r="A9"><v>4</v></c>'),
        ("B10", '<c r="B10" t="inlineStr"><is><t>q5</t></is></c>'),
    ]
    rows = {}
    for ref, xml in cells:
        rows.setdefault(int(ref[1:]), []).append(xml)
    sheet = "".join(f'<row r="{r}">{"".join(x)}</row>' for r, x in sorted(rows.items()))
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {NS} {RNS}><sheets><sheet name="QA" sheetId="1" r:id="rId1"/>'
                                      f'<sheet name="Notes" sheetId="2" r:id="rId2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
                   '<Relationship Id="rId2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>{sst}</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{sheet}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {NS}><sheetData><row r="5"><c r="A5" t="inlineStr">'
                                               f'<is><t>Name</t></is></c></row></sheetData></worksheet>')


def _sheet_xlsx(path, sheet, sst=""):
    _xlsx(path)
    parts = {}
    with zipfile.ZipFile(path) as z:
        parts = {n: z.read(n) for n in z.namelist()}
    parts["xl/worksheets/sheet1.xml"] = f"<worksheet {NS}><sheetData>{sheet}".encode()
    if sst:
        parts["xl/sharedStrings.xml"] = f"<sst {NS}>{sst}</sst>".encode()
    with zipfile.ZipFile(path, "w") as z:
        for n, data in parts.items():
            z.writestr(n, data)


def test_workbook_text_references_and_numbers(spark, tmp_dir):
    _sheet_xlsx(os.path.join(tmp_dir, "b.xlsx"),
                '<row><c t="s"><v>0</v></c><c><v>1.1000000000000001</v></c><c r="E1"><v>1E-3</v></c><c><v>7</v></c></row>'
                '<row><c t="inlineStr"><is><t>x</t><rPh sb="0" eb="1"><t>READ</t></rPh></is></c></row></sheetData></worksheet>',
                '<si><t>東京</t><rPh sb="0" eb="2"><t>トウキョウ</t></rPh></si>')
    _sheet_xlsx(os.path.join(tmp_dir, "broken.xlsx"), '<row><c><v>1</v></c></row><row><c><v>2')
    _sheet_xlsx(os.path.join(tmp_dir, "index.xlsx"), '<row><c><v>1</v></c><c t="s"><v>99</v></c></row></sheetData></worksheet>')
    os.makedirs(os.path.join(tmp_dir, "below"))
    _xlsx(os.path.join(tmp_dir, "below", "deep.xlsx"))
    got = {(os.path.basename(r.file), r.row, r.col): r.value for r in C.read_cells(spark, tmp_dir).where("sheet = 'QA'").collect()}
    assert got == {("b.xlsx", 1, 1): "東京", ("b.xlsx", 1, 2): "1.1", ("b.xlsx", 1, 5): "0.001", ("b.xlsx", 1, 6): "7", ("b.xlsx", 2, 1): "x"}
    assert {os.path.basename(r.file) for r in C.workbook_rejects(spark, tmp_dir).collect()} == {"broken.xlsx", "index.xlsx"}
    assert C.read_cells(spark, tmp_dir, recursive=True).where("file like '%deep.xlsx'").count() > 0


def test_csv_sheets(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "s.csv"), "w", encoding="utf-8") as f:
        f.write('No,Question,Answer,Answer\n1,"q, ""1""\nmore",a1,other\n2,,a2,\n')
    cells = C.cells_from_csv_sheets(spark, tmp_dir)
    table = sheets.read_sheet_table(cells, ["Question", "Answer"], header_row=1)
    got = sorted((r.row, r.Question, r.Answer) for r in table.collect())
    assert got == [(2, 'q, "1"\nmore', "a1"), (3, None, "a2")]


def test_csv_sheets_split_and_whole(spark, tmp_dir):
    """Files over many blocks and files with quoted line breaks give what Python's csv module gives."""
    import csv
    import random

    rng = random.Random(2)
    files = {"plain": [[rng.choice(["", "a", "b c", " lead", "trail ", 'say "x"', "ü,y", "null", "#c", "\\n"]) for _ in range(rng.randint(1, 6))] for _ in range(400)],
             "long": [["h1", "h2"], ["x" * 200_000, "y"], ["z", "w" * 150_000]],
             "breaks": [["a", "line\nbreak", "c"], ["", "\n\n", 'q"\n']] * 20, "one": [["only"]]}
    for name, rows in files.items():
        with open(os.path.join(tmp_dir, f"{name}.csv"), "w", encoding="utf-8", newline="") as f:
            f.write("\ufeff" if name == "plain" else "")
            csv.writer(f, lineterminator="\n").writerows(rows)
    with open(os.path.join(tmp_dir, "bytes.csv"), "wb") as f:
        f.write(b"a,\xff\xfe\n\nlast,1\n")
    open(os.path.join(tmp_dir, "empty.csv"), "w").close()
    want = {(n, r, c): v for n, rows in files.items() for r, row in enumerate(rows, 1) for c, v in enumerate(row, 1) if v}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        got = {(os.path.basename(r.file)[:-4], r.row, r.col): r.value for r in C.cells_from_csv_sheets(spark, tmp_dir).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    odd = {k: got.pop(k) for k in list(got) if k[0] == "bytes"}
    assert got == want
    assert odd[("bytes", 3, 1)] == "last" and odd[("bytes", 1, 1)] == "a" and ("bytes", 2, 1) not in odd


def test_line_numbers_over_blocks(spark, tmp_dir):
    """True line numbers of valid and invalid lines, blank ones counted, whatever the blocks and the way to look them up."""
    from tuneforge.sources import lines as L

    want = {}
    for name, n in (("a", 900), ("b", 1), ("c", 77)):
        rows = [("", " ", '{"text": "same"}', "{bad", '{"text": "long ' + "x" * 300 + '"}')[(i * 7 + i // 5) % 5] for i in range(n)]
        _write(os.path.join(tmp_dir, f"{name}.jsonl"), rows)
        want |= {(f"{name}.jsonl", i): r.strip() for i, r in enumerate(rows, 1) if r.strip()}
    bound = L.BROADCAST_BLOCKS
    for size, blocks in (("134217728", bound), ("700", bound), ("700", 0)):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        L.BROADCAST_BLOCKS = blocks
        try:
            rec, bad = jsonl.read_jsonl(spark, tmp_dir)
            got = {(os.path.basename(r.file), r.line_no): r.line for r in rec.select("file", "line_no", "line").union(bad.select("file", "line_no", "line")).collect()}
            assert got == want
            assert {r.line for r in bad.collect()} == {"{bad"}
            assert rec.select("row_key").distinct().count() == rec.count()
        finally:
            L.BROADCAST_BLOCKS = bound
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_split_rejects(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "train.jsonl"), ['{"input": "a"}', "", "{x", "y}"])
    _write(os.path.join(tmp_dir, "valid.jsonl"), ['{"text": "t"}'])
    kept, bad = jsonl.read_split_jsonl(spark, tmp_dir, with_rejects=True)
    assert {r.split for r in kept.collect()} == {"train", "validation"}
    assert [(r.split, r.line_no, r.line) for r in bad.orderBy("line_no").collect()] == [("train", 3, "{x"), ("train", 4, "y}")]


def test_workbook_parts_apart(spark, tmp_dir):
    """Sheets are parsed apart; a bad checksum, a missing string or a missing part rejects the file whole."""
    _xlsx(os.path.join(tmp_dir, "good.xlsx"))
    with open(os.path.join(tmp_dir, "good.xlsx"), "rb") as f:
        data = f.read()
    at = data.index(b"<t>q2</t>")
    with open(os.path.join(tmp_dir, "flipped.xlsx"), "wb") as f:
        f.write(data[:at] + b"<t>qX</t>" + data[at + 9:])
    with zipfile.ZipFile(os.path.join(tmp_dir, "good.xlsx")) as z, zipfile.ZipFile(os.path.join(tmp_dir, "nostrings.xlsx"), "w") as out:
        for n in z.namelist():
            if "shared" not in n:
                out.writestr(n, z.read(n), zipfile.ZIP_DEFLATED)
    with zipfile.ZipFile(os.path.join(tmp_dir, "good.xlsx")) as z, zipfile.ZipFile(os.path.join(tmp_dir, "packed.xlsx"), "w") as out:
        for n in z.namelist():
            out.writestr(n, z.read(n), zipfile.ZIP_DEFLATED)
    with open(os.path.join(tmp_dir, "empty.xlsx"), "wb") as f:
        f.write(b"P")
    cells, rejects = C.read_workbooks(spark, tmp_dir)
    by = {}
    for r in cells.collect():
        by.setdefault(os.path.basename(r.file), set()).add((r.sheet, r.sheet_pos, r.row, r.col, r.value))
    assert set(by) == {"good.xlsx", "packed.xlsx"} and by["good.xlsx"] == by["packed.xlsx"] and len(by["good.xlsx"]) == 14
    assert {os.path.basename(r.file): r.reason for r in rejects.collect()} == {
        "flipped.xlsx": "unreadable workbook: BadZipFile", "nostrings.xlsx": "unreadable workbook: IndexError", "empty.xlsx": "unreadable workbook: BadZipFile"}


def test_read_workbook_first_blank_stop(spark, tmp_dir):
    _xlsx(os.path.join(tmp_dir, "book.xlsx"))
    with open(os.path.join(tmp_dir, "old.xls"), "wb") as f:
        f.write(b"\xd0\xcf\x11\xe0 legacy")
    cells = C.read_cells(spark, tmp_dir)
    got = {(r.sheet, r.row, r.col): r.value for r in cells.collect()}
    assert got[("QA", 5, 2)] == "Question" and got[("QA", 6, 4)] == "a1" and got[("QA", 6, 5)] == "TRUE"
    assert got[("QA", 6, 3)] == "0.5" and got[("Notes", 5, 1)] == "Name"
    mapping = sheets.resolve_columns(cells, 5, "qa")
    m = {r.sheet: (r.input_col, r.output_col) for r in mapping.collect()}
    assert m["QA"] == (2, 4)  # Model Answer (right-most) wins over Answer A
    ok, rejects = sheets.drop_unmapped_sheets(cells, mapping, "qa")
    assert [r.sheet for r in rejects.collect()] == ["Notes"]
    recs = sorted((r.row, r.input, r.output) for r in sheets.sheet_records(cells, ok, 5, "qa").collect())
    assert recs == [(6, "q1", "a1"), (7, "q2", ""), (8, "", "a3")]  # row 9 has neither: row 10 is lost
    bad = {os.path.basename(r.file): r.reason for r in C.workbook_rejects(spark, tmp_dir).collect()}
    assert "old.xls" in bad and "book.xlsx" not in bad


def test_write_jsonl_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("質問", "答え", None), (None, None, "本文")], "input string, output string, text string")
    out = os.path.join(tmp_dir, "out")
    W.write_jsonl(df, out)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ['{"input":"質問","output":"答え"}', '{"text":"本文"}']


def test_write_splits_ordered(spark, tmp_dir):
    df = spark.createDataFrame([(f"k{i}", "train" if i % 3 else "valid", f"{(i * 7919) % 101:03d}") for i in range(40)],
                               "row_key string, split string, order_key string")
    root = os.path.join(tmp_dir, "splits")
    W.write_splits(df, root, ["row_key"], n_files=1)
    assert sorted(n for n in os.listdir(root) if not n.startswith(".")) == ["_SUCCESS", "split=train", "split=valid"]
    train_dir = os.path.join(root, "split=train")
    parts = sorted(n for n in os.listdir(train_dir) if n.startswith("part-"))
    lines = [json.loads(x)["row_key"] for n in parts for x in open(os.path.join(train_dir, n), encoding="utf-8")]
    want = [r.row_key for r in df.where("split = 'train'").orderBy("order_key").collect()]
    assert lines == want


def test_append_results_and_runs(spark, tmp_dir):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "q", "a")], "timestamp string, input_text string, generated_text string")
    log = os.path.join(tmp_dir, "log")
    W.append_results(df, log)
    W.append_results(df, log)
    assert spark.read.option("header", True).csv(log).count() == 2
    base = os.path.join(tmp_dir, "runs")
    W.write_run(df, base, "r1")
    with pytest.raises(Exception):
        W.write_run(df, base, "r1")


def test_build_if_absent_and_latest_snapshot(spark, tmp_dir):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    p = W.dataset_path(tmp_dir, "20240105", 42, 0.9)
    assert p.endswith("train_pct=90") and W.dataset_path("r", "d", 1, 0.804).endswith("train_pct=80.4")
    assert p.endswith("makedate=20240105/seed=42/train_pct=90")
    os.makedirs(p)  # a crashed build leaves an empty folder: it must be rebuilt
    assert W.build_if_absent(spark, p, build).count() == 3
    assert W.build_if_absent(spark, p, build).count() == 3
    assert len(calls) == 1
    for name in ["makedate=20240301", "makedate=2024031", "makedate=latest", "checkpoint-10"]:
        os.makedirs(os.path.join(tmp_dir, name))
    assert W.latest_snapshot(spark, tmp_dir).endswith("makedate=20240301")
    with pytest.raises(FileNotFoundError):
        W.latest_snapshot(spark, os.path.join(tmp_dir, "makedate=20240301"))


def test_read_public_qa_concatenates_splits(spark, tmp_dir):
    from tuneforge.operators.records import concat

    a, b = os.path.join(tmp_dir, "train"), os.path.join(tmp_dir, "validation")
    spark.createDataFrame([("i", "c", "o")], "instruction string, input string, output string").write.parquet(a)
    spark.createDataFrame([("j", None, "p")], "instruction string, input string, output string").write.parquet(b)
    qa = jsonl.read_public_qa(spark, {"train": a, "validation": b})
    assert sorted((r.orig_split, r.instruction) for r in qa.collect()) == [("train", "i"), ("validation", "j")]
    assert concat(qa, qa).count() == 4


def test_missing_jsonl_inputs_are_skipped(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.jsonl")
    _write(p, ['{"text": "x"}'])
    with pytest.warns(UserWarning, match="missing input"):
        rec, _ = jsonl.read_jsonl(spark, [p, os.path.join(tmp_dir, "nope.jsonl")])
    assert rec.count() == 1
    with pytest.raises(FileNotFoundError), pytest.warns(UserWarning, match="missing input"):
        jsonl.read_jsonl(spark, [os.path.join(tmp_dir, "nope.jsonl")])


def test_numbered_runs(spark, tmp_dir):
    df = spark.range(2)
    base = os.path.join(tmp_dir, "runs")
    first = W.next_run_path(spark, base)
    df.write.parquet(first)
    second = W.next_run_path(spark, base)
    assert first.endswith("run_id=1") and second.endswith("run_id=2")
