"""Ingestion helpers and file formats."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from quillmart.sources import files, formats, sinks


def test_table_name_and_sanitize():
    assert files.table_name("A-b c.csv") == "a_b_c_csv"
    assert files.sanitize("  C__NationKey ") == "c_nationkey"
    assert files.sanitize("c-Name!!") == "c_name"


def test_drop_sensitive_after_sanitize(spark):
    df = spark.createDataFrame([(1, "x", "4111", 123)], ["User ID", "Name", "Credit Card Number", "CVV"])
    assert files.drop_sensitive(files.sanitize_columns(df)).columns == ["user_id", "name"]


def test_choose_delimiter():
    assert formats.choose_delimiter("a,b,c") == ","
    assert formats.choose_delimiter("a\tb") == "\t"
    assert formats.choose_delimiter("a;b;c") == ";"
    assert formats.choose_delimiter("single") == ","


def test_csv_round_trip_with_quotes(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    df = spark.createDataFrame([("1", 'Acme, "Best" Inc'), ("2", "plain")], "id string, name string")
    for sep in [",", "\t", ";"]:
        p = f"{d}/f{ord(sep)}.csv"
        formats.write_delimited(df, p, sep)
        back = formats.read_csv_fallback(spark, p)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_json_columns_and_html(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    df = spark.range(0, 25).select(F.col("id"), (F.col("id") * 2).cast("string").alias("v"),
                                   F.when(F.col("id") % 5 == 0, F.lit("a&b<c>")).alias("w"),
                                   (F.col("id") / 10).cast("int").alias("chunk"))
    formats.column_docs(df, "chunk", "id", ["v", "w"]).write.text(f"{d}/j")
    back = formats.read_json_columns(spark, f"{d}/j", ["v", "w"])
    assert sorted((int(r.unnamed_0), r.v, r.w) for r in back.collect()) == \
        sorted((r.id, r.v, r.w) for r in df.collect())
    formats.html_pages(df, "chunk", ["id", "v", "w"]).write.text(f"{d}/h")
    h = formats.read_html_tables(spark, f"{d}/h")
    assert sorted((int(r.id), r.v, r.w) for r in h.collect()) == sorted((r.id, r.v, r.w) for r in df.collect())


def test_audit_upsert_keeps_greatest(spark):
    a = spark.createDataFrame([("raw", "t1", 5), ("raw", "t2", 9)], "schema_name string, table_name string, "
                              "last_ingested_at int")
    b = spark.createDataFrame([("raw", "t1", 7), ("raw", "t2", 3), ("raw", "t3", 1)], a.schema)
    got = sorted(map(tuple, sinks.audit_upsert(a, b).collect()))
    assert got == [("raw", "t1", 7), ("raw", "t2", 9), ("raw", "t3", 1)]


def written(text, name):
    path = f"{tempfile.mkdtemp(dir='/tmp')}/{name}"
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


@pytest.fixture
def tiny_splits(spark):
    """Every file in splits of a few bytes, so that records cross them."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(df, *columns):
    return sorted(map(tuple, (df.select(*columns) if columns else df).collect()), key=str)


PAGES = ["<html><body>\n<table border=1>\n<tr>\n<th>id</th><th>v</th></tr>\n<tr><td>1</td>\n<td> a&amp;b\n</td></tr></table></body>\n</html>",
         "<HTML><TABLE><TR><TH>v</TH><TH>w</TH></TR><TR><TD></TD><TD>9</TD></TR></TABLE></HTML>", "<html>no table</Html >",
         "<html><p>1 > 0</p><table><tr><th>id<th>w<tr><td><b>2</b>nd<td><i>x</i> y</table><table><tr><td>other</td></tr></table>"]


@pytest.mark.parametrize("size", [10 ** 6, 150, 37, 5])
def test_html_pages_of_any_case_and_form(spark, tiny_splits, size):
    path = written("\n".join(PAGES), "p.html")
    tiny_splits(size)
    assert rows_of(files.read_source(spark, path), "id", "v", "w") == sorted(
        [("1", "a&b", None), (None, None, "9"), ("2nd", None, "x y")], key=str)
    assert [r["reason"] for r in formats.bad_html(spark, path).collect()] == ["no table"]


def test_html_of_a_data_frame(spark):
    import pandas as pd
    frame = pd.DataFrame({"id": [1, 2], "name": ["a<b", None], "two words": ["x", "y &amp; z"]})
    got = files.read_source(spark, written(frame.to_html(), "f.html"))
    assert got.columns == ["Unnamed: 0", "id", "name", "two words"]
    assert rows_of(got) == [("0", "1", "a<b", "x"), ("1", "2", "None", "y &amp; z")]
    many = pd.concat([frame, frame], axis=1, keys=["l", "r"])
    got = files.read_source(spark, written(many.to_html(), "m.html"))
    assert got.columns == ["Unnamed: 0", "l_id", "l_name", "l_two words", "r_id", "r_name", "r_two words"] and got.count() == 2


def cells(page):
    parser = formats.TableParser()
    parser.feed(page)
    return parser.table()


def test_table_parser_spans_nesting_and_open_tags():
    assert cells("<table><tr><th>a<th>b<th>c<tr><td rowspan=2>1<td colspan=2>2<tr><td>3<td>4</table>") == (
        ["a", "b", "c"], [["1", "2", "2"], ["1", "3", "4"]])
    assert cells("<table><thead><tr><td>a</td></tr></thead><tbody><tr><th>r</th></tr></tbody><tfoot><tr><td>t</td></tr></tfoot></table>") == (
        ["a"], [["r"], ["t"]])
    assert cells("<table><tr><th>a</th></tr><tr><td>x<table><tr><td>in</td><td>ner</td></tr></table>y<script>no</script></td></tr></table>") == (
        ["a"], [["x in nery"]])
    assert cells("<table><tr><th>a</th></tr><tr><th>all</th></tr><tr><td>1<br>2</td></tr></table>") == (["a_all"], [["1 2"]])
    assert cells("<table><tr><td>no header</td></tr></table>") == ([], [["no header"]])
    assert cells("<table></table>") == ([], []) and cells("nothing") == ([], [])
    assert cells("<table><tr><th>a<th>b<tr><td rowspan=3>1<td>2<tr><td>3</table>") == (["a", "b"], [["1", "2"], ["1", "3"]])


@pytest.mark.parametrize("size", [10 ** 6, 100, 7])
def test_csv_fields_with_line_breaks_across_splits(spark, tiny_splits, size):
    import csv
    import io
    import random
    rng = random.Random(size)
    rows = [[str(i), "".join(rng.choice('ab",\n\r ') for _ in range(rng.randrange(12))), rng.choice(["x", "", "y\nz"])] for i in range(60)]
    text = io.StringIO()
    out = csv.writer(text, lineterminator="\n")
    out.writerows([["id", 'te,"xt', "z\nk"], *rows])
    path = written(text.getvalue(), "a.csv")
    tiny_splits(size)
    got = files.read_source(spark, path)
    assert got.columns == ["id", 'te,"xt', "z\nk"]
    assert rows_of(got) == sorted([(a, b or None, c or None) for a, b, c in rows], key=str)
    assert formats.bad_csv(spark, path).count() == 0


def test_csv_headers_and_bad_records(spark):
    path = tempfile.mkdtemp(dir="/tmp")
    for name, text in {"1": '"a,b"\tc\tc\n1\t"line one\nline two"\t3\n\n2\n', "2": 'c;d\r\n5;6\r\n7;8;9\r\n"x"y;1\r\n;\r\n',
                       "3": "", "4": 'c\n"never closed\nend'}.items():
        with open(f"{path}/{name}.csv", "w", newline="") as f:
            f.write(text)
    got = formats.read_csv_fallback(spark, path)
    assert got.columns == ["a,b", "c", "c.1", "d"]
    assert rows_of(got) == sorted([("1", "line one\nline two", "3", None), ("2", None, None, None), (None, "5", None, "6"), (None,) * 4], key=str)
    bad = sorted((r["file"][-5:], r["reason"], r["record"]) for r in formats.bad_csv(spark, path).collect())
    assert [(f, t) for f, _, t in bad] == [("2.csv", '"x"y;1'), ("2.csv", "7;8;9"), ("4.csv", '"never closed\nend')]
    assert formats.choose_delimiter('"a,b"\tc') == "\t" and formats.choose_delimiter('"a;b"') == ","


@pytest.mark.parametrize("size", [10 ** 6, 60, 9])
def test_json_column_documents_of_any_layout(spark, tiny_splits, size):
    import json
    import pandas as pd
    frame = pd.DataFrame({"a": ['q"uo\\te\\', "ü\n{[,:]}", None], "b b": [1, 2.5, None], "c": [True, None, {"x": ["y", 1]}]}, dtype=object)
    plain, pretty = frame.to_json(), json.dumps(json.loads(frame.to_json()), indent=4, ensure_ascii=False)
    expected = [("0", 'q"uo\\te\\', "1", "true"), ("1", "ü\n{[,:]}", "2.5", None), ("2", None, None, '{"x":["y",1]}')]
    tiny_splits(size)
    for text, times in ((plain, 1), (pretty, 1), (plain + "\n" + pretty, 2)):
        got = files.read_source(spark, written(text, "d.json"))
        assert got.columns == ["unnamed_0", "a", "b b", "c"] and rows_of(got) == sorted(expected * times, key=str)


def test_json_column_documents_with_faults(spark):
    for text, reason, n in [('{"a": {"0": 1, "1": 2}} {"a": {"0": ', "the document has no end", 2), ('{"a": {"0": 1, "1" 2}}', "unexpected 2 at index:", 1),
                            ('{"a": {}, "b": {"0": nope}}', None, 0), ('{"a": {"0": "x"}, "b": 3}', "unexpected 3 at rows", 1)]:
        path = written(text, "d.json")
        assert files.read_source(spark, path).where("a IS NOT NULL").count() == n
        bad = formats.bad_json(spark, path).collect()
        assert len(bad) == 1 and (reason is None or bad[0]["reason"] == reason)


def test_json_column_documents_give_whole_rows_where_they_are_read(spark):
    """The text is understood once, and no cell of a document of usual size is shuffled."""
    path = tempfile.mkdtemp(dir="/tmp")
    for name, text in {"1": '{"a": {"1": "x", "0": null}, "b": {"0": 2, "2": true}}\n{"b": {}, "a": {}}', "2": '{"a": {"1": "y"}, "a": {"1": "z", "3": ""}}\n'}.items():
        with open(f"{path}/{name}.json", "w") as f:
            f.write(text)
    got = formats.read_json_columns(spark, path)
    assert got.columns == ["unnamed_0", "a", "b"]
    assert rows_of(got) == sorted([("1", "x", None), ("0", None, "2"), ("2", None, "true"), ("1", "z", None), ("3", "", None)], key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Exchange", "Sort", "MapInArrow", "Aggregate") if x in plan]


def test_json_column_document_larger_than_a_task_holds(spark, tiny_splits):
    n, long = 3000, "x, \"" * 1000
    import json
    document = {"a": {str(i): f"{i}{long}" for i in range(n)}, "b": {str(i): i for i in range(0, n, 2)}, "c": {}}
    assert len(json.dumps(document)) > formats.HELD
    tiny_splits(1 << 20)
    got = files.read_source(spark, written(json.dumps(document) + '{"b": {"0": "other"}}', "d.json"))
    assert got.columns == ["unnamed_0", "a", "b", "c"]
    short = got.withColumn("a", F.concat(F.regexp_extract("a", "^[0-9]+", 0), F.lit(" "), F.length("a").cast("string")))
    assert rows_of(short) == sorted([(str(i), f"{i} {len(long) + len(str(i))}", str(i) if i % 2 == 0 else None, None) for i in range(n)]
                                    + [("0", None, "other", None)], key=str)


def stream(text, per_piece, held, monkeypatch):
    """Rows (document, index, values), names and reasons of a text that is cut at its commas."""
    monkeypatch.setattr(formats, "HELD", held)
    reader, cut = formats.CellStream("f", len(text.encode())), text.split(",")
    cut = cut[:-1] if not cut[-1] else cut  # as Spark cuts it
    blocks = [b for k in range(0, len(cut), per_piece) for b in reader.piece(",".join(cut[k:k + per_piece]))] + list(reader.end())
    rows, names, reasons = {}, set(), [b[-1] for b in blocks if b[-1] is not None]
    for _, doc, _, cols, idx, vals, _ in (b for b in blocks if b[-1] is None):
        names.update(cols)
        for k, i in enumerate(idx):
            row = rows.setdefault((doc, i), {})
            row.update({c: v[k] for c, v in zip(cols, vals) if v[k] is not None})
    return rows, names, reasons


@pytest.mark.parametrize("held", [0, 20, 10 ** 6])
@pytest.mark.parametrize("per_piece", [1, 3, 1000])
def test_cell_stream(monkeypatch, per_piece, held):
    import functools
    read = functools.partial(stream, per_piece=per_piece, held=held, monkeypatch=monkeypatch)
    text = '{"a": {"0": "x,\\"y\\u00fc", "1" : 1.50, "2":-2e5 , "3": true}, "b": {"3": {"k": ["v,", 1]}, "2": NaN, "0": null}} {} {"c": {}}\n'
    rows = {(0, "0"): {"a": 'x,"yü'}, (0, "1"): {"a": "1.50"}, (0, "2"): {"a": "-2e5", "b": "NaN"}, (0, "3"): {"a": "true", "b": '{"k":["v,",1]}'}}
    assert read(text) == (rows, {"a", "b", "c"}, [])
    assert read(text.strip() + ",") == (rows, {"a", "b", "c"}, ["unexpected , at document"])
    assert read('{"a": {"0": "x", "1": "y,z') == ({(0, "0"): {"a": "x"}, (0, "1"): {"a": "y,z"}}, {"a"}, ["the document has no end"])
    assert read('{"a": {"0": "x", "1": "y\\"') == ({(0, "0"): {"a": "x"}}, {"a"}, ["the document has no end"])
    assert read('{"a": {"0": "x", "1": 1 2}}') == ({(0, "0"): {"a": "x"}, (0, "1"): {"a": "1"}}, {"a"}, ["unexpected 2 at after value"])
    found, _, reasons = read('{"a": {"0": "x", "1": "\\q"}}')
    assert found == {(0, "0"): {"a": "x"}} and len(reasons) == 1


def test_json_lines_with_faults(spark):
    path = written('{"a": 1}\n{"a": \n{"a": 3}\n', "l.json")
    assert rows_of(files.read_source(spark, path)) == [("1",), ("3",)]
    assert [r["record"] for r in formats.bad_json(spark, path).collect()] == ['{"a": ']


def test_quarantine_of_a_folder(spark):
    folder = tempfile.mkdtemp(dir="/tmp")
    spark.range(5).write.parquet(f"{folder}/good.parquet")
    spark.range(0).write.parquet(f"{folder}/empty.parquet")
    os.mkdir(f"{folder}/torn.parquet")
    for name, text in {"torn.parquet/x.parquet": "no parquet", "c.csv": "a,b\n1,2\n1,2,3\n", "j.json": '{"a": 1}\n{"a"\n', "none.csv": "",
                       "h.html": "<html><table><tr><th>a</th></tr><tr><td>1</td></tr></table></html><html></html>", "x.pkl": "?"}.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)
    names = ["good.parquet", "empty.parquet", "torn.parquet", "c.csv", "j.json", "none.csv", "h.html", "x.pkl"]
    got = files.quarantine_report(spark, {n: f"{folder}/{n}" for n in names}).collect()
    assert {r["source"]: (r["good"], r["bad"], r["skipped"]) for r in got} == {
        "good.parquet": (5, 0, None), "empty.parquet": (0, 0, "empty"), "torn.parquet": (0, 0, "unreadable"), "c.csv": (1, 1, None),
        "j.json": (1, 1, None), "none.csv": (0, 0, "empty"), "h.html": (1, 1, None), "x.pkl": (0, 0, "pickled Python objects are not loaded")}


def test_json_forms(spark):
    assert formats.json_form('{"a": {"0": 1}}') == "columns" and formats.json_form(' {"a": {}}') == "columns"
    assert formats.json_form('{"a": 1}') == "lines" and formats.json_form("[{") == "array"
    d = tempfile.mkdtemp(dir="/tmp")
    for name, text in {"c": '{"a": {"0": "x", "1": null}, "b": {"0": "1", "1": "2"}}', "l": '{"a": "x", "b": 1}\n{"a": null, "b": 2}',
                       "r": '[{"a": "x", "b": 1},\n {"a": null, "b": 2}]'}.items():
        with open(f"{d}/{name}.json", "w") as f:
            f.write(text)
        got = files.read_source(spark, f"{d}/{name}.json").select("a", "b").collect()
        assert sorted(map(tuple, got), key=str) == sorted([("x", "1"), (None, "2")], key=str)


def test_unsupported_kind_is_an_error(spark):
    import pytest
    with pytest.raises(ValueError):
        files.read_source(spark, "/tmp/x.pkl")


def test_overwrite_keeps_the_old_table_when_a_write_fails(spark):
    import pytest
    path = tempfile.mkdtemp(dir="/tmp") + "/t"
    sinks.overwrite(spark.range(5), path)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception):
        sinks.overwrite(broken, path)
    assert spark.read.parquet(path).count() == 5
    sinks.overwrite(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    sinks.load_fact(spark.range(2, 4), path, "append")
    assert spark.read.parquet(path).count() == 4
