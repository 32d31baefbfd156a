import json

import pytest
from pyspark.sql import functions as F

from corpusflow.functions import text as T
from corpusflow.sources import files


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "notes.txt").write_text("first line\nsecond line")
    (tmp_path / "sub" / "GUIDE.MD").write_text("# Title\ntext")
    (tmp_path / "sub" / "homes.csv").write_text("city,rooms\nOslo, 3\n\"a, b\",\n")
    (tmp_path / "errors.csv").write_text("code,meaning\nE1,bad gateway\n")
    (tmp_path / "items.json").write_text(json.dumps([{"a": 1, "b": "x"}, {"a": 2, "c": [1, 2]}]))
    (tmp_path / "broken.json").write_text("{ not json")
    (tmp_path / "image.png").write_bytes(b"\x89PNG")
    return str(tmp_path)


def test_directory_reads_every_known_type(spark, folder):
    rows = {(r.file_name, r.location): r for r in files.read_directory(spark, folder).collect()}
    assert {k: v.file_type for k, v in rows.items()} == {
        ("notes.txt", "Full Document"): "Text", ("GUIDE.MD", "Full Document"): "Markdown",
        ("homes.csv", "Row 0"): "CSV", ("homes.csv", "Row 1"): "CSV", ("errors.csv", "Row 0"): "CSV",
        ("items.json", "Record #1"): "JSON", ("items.json", "Record #2"): "JSON"}
    assert rows["notes.txt", "Full Document"].text == "first line\nsecond line"
    assert rows["homes.csv", "Row 0"].text == "city: Oslo\nrooms: 3"
    assert rows["homes.csv", "Row 1"].text == "city: a, b\nrooms: "
    assert rows["errors.csv", "Row 0"].text == "code: E1\nmeaning: bad gateway"
    assert json.loads(rows["items.json", "Record #2"].text) == {"a": 2, "c": [1, 2]}
    assert rows["items.json", "Record #1"].metadata["source"] == "items.json"


def test_chunks_inherit_provenance(spark, folder):
    rows = files.load_chunks(spark, folder, size=12, overlap=0).where("file_name = 'notes.txt'").collect()
    assert [(r.chunk_no, r.chunk, r.location) for r in sorted(rows, key=lambda r: r.chunk_no)] == [
        (0, "first line", "Full Document"), (1, "second line", "Full Document")]


def test_row_numbers_run_through_split_files(spark, tmp_path):
    lines = ["n,word"] + [f"{i},word{i}" for i in range(3000)]
    (tmp_path / "big.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "more.csv").write_text("n,word\n7,seven\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        rows = files.read_csv(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    big = {r.location: r.text for r in rows if r.file_name == "big.csv"}
    assert big == {f"Row {i}": f"n: {i}\nword: word{i}" for i in range(3000)}
    assert [r.location for r in rows if r.file_name == "more.csv"] == ["Row 0"]


def test_rejects_go_to_quarantine(spark, folder, tmp_path):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "x.csv").write_text("a,b\n1,2\n1,2,3,4\n")
    assert [r.record for r in files.quarantined_csv(spark, str(bad), ["a", "b"]).collect()] == ["1,2,3,4"]
    good = files.read_csv(spark, str(bad), columns=["a", "b"]).collect()
    assert [r.text for r in good] == ["a: 1\nb: 2"]
    assert [r.file_name for r in files.quarantined_json(spark, folder).collect()] == ["broken.json"]


def test_missing_path_is_empty_and_empty_corpus_is_an_error(spark, tmp_path):
    nothing = files.read_directory(spark, str(tmp_path / "absent"))
    assert nothing.count() == 0
    with pytest.raises(ValueError):
        files.require_rows(nothing, "absent")


def test_reader_registry_takes_other_formats(spark, folder):
    only = files.read_directory(spark, folder, {".txt": files.read_text})
    assert [r.file_name for r in only.collect()] == ["notes.txt"]


def test_page_and_unknown_locations(spark):
    df = spark.createDataFrame([("a/x.PDF", 0, "t"), ("b.csv", None, "t"), ("c.bin", 1, "t"), ("d.md", 4, "t")],
                               "path string, ordinal int, text string")
    out = {(r.file_name, r.file_type, r.location) for r in files.normalise(df).collect()}
    assert out == {("x.PDF", "PDF", "Page 1"), ("b.csv", "CSV", "Row N/A"), ("d.md", "Markdown", "Full Document")}


def test_html_text(spark):
    html = "<html><style>p{}</style><script>a<b</script><h1>T</h1><!-- x --><p>a &amp; b&nbsp;&lt;c&gt;<br>d</p>"
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(T.html_text("html")).first()[0] == "T a & b <c> d"
    assert df.select(T.html_headed_text("html")).first()[0].split("\n")[0:2] == ["", "# T"] or \
        df.select(T.html_headed_text("html")).first()[0].startswith("# T")


def test_text_helpers(spark):
    df = spark.createDataFrame([("  Ab\ncd, éF 12!  Next?\nLast",)], "t string")
    row = df.select(T.tokens("t").alias("a"), T.word_count("t").alias("b"), T.sentences("t").alias("c"),
                    T.preview("t", 5).alias("d"), F.length("t").alias("e")).first()
    assert row.a == ["ab", "cd", "éf", "12", "next", "last"] and row.b == 6
    assert row.c == ["  Ab\ncd, éF 12!", "Next?", "Last"] and row.d == "Ab cd"


def test_csv_with_line_breaks_and_names_that_need_escapes(spark, tmp_path):
    (tmp_path / "a b+c%[1].csv").write_text('x,y\n"a\nb",4\nplain,5\n')
    rows = files.read_directory(spark, str(tmp_path)).collect()
    assert {(r.text, r.location) for r in rows} == {("x: a\nb\ny: 4", "Row 0"), ("x: plain\ny: 5", "Row 1")}
    assert {r.file_name for r in rows} == {"a b+c%[1].csv"}
    assert all(r.metadata["path"].endswith("/a b+c%[1].csv") for r in rows)


def test_character_references_of_the_standard(spark):
    page = "<p>It&#8217;s caf&eacute; &mdash; 5&#x20AC; &amp;lt; a&nbsp;b</p>"
    df = spark.createDataFrame([(page,), (None,), ("",)], "html string")
    assert [r.t for r in df.select(T.html_text("html").alias("t")).collect()] == [
        "It\u2019s caf\u00e9 \u2014 5\u20ac &lt; a b", None, ""]


@pytest.fixture
def small_splits(spark):
    """Files are cut into blocks of a few bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


TRICKY_CSV = ('id,text\n' + ''.join(f'{i},"line one of {i}\n\nsaid ""yes, {i}""\r\nend"\r\n' if i % 3 else f'{i}, plain {i} \n\n' for i in range(20))
              + '777,"' + 'long\n' * 40 + '"\n')


@pytest.mark.parametrize("size", [60, 1 << 20])
def test_csv_blocks_of_any_size_give_the_same_records(spark, tmp_path, small_splits, size):
    import csv
    import io
    (tmp_path / "a.csv").write_bytes(TRICKY_CSV.encode())
    (tmp_path / "b.csv").write_bytes(b"x,x,\n1,2,3\n")
    want = [r for r in csv.reader(io.StringIO(TRICKY_CSV, newline="")) if r][1:]
    small_splits(size)
    rows = files.read_csv(spark, str(tmp_path))
    got = {(r.file_name, r.location): r.text for r in rows.collect()}
    assert got == {**{("a.csv", f"Row {i}"): f"id: {a.strip(' ')}\ntext: {b.strip(' ')}" for i, (a, b) in enumerate(want)},
                   ("b.csv", "Row 0"): "x: 1\nx1: 2\n_c2: 3"}
    if size == 60:
        assert spark.read.text(str(tmp_path / "a.csv")).rdd.getNumPartitions() > 10


ELEMENTS = [{"k": i, "t": 'a, "b" \\\\ [x] {y}' + "," * (i % 5), "n": [[i], {"z": [1, 2]}]} if i % 4 else ("s,\\\"" * 3, 1.5, None, True, "é")[i % 5] for i in range(16)]


@pytest.mark.parametrize("size", [60, 1 << 20])
def test_json_blocks_of_any_size_give_the_same_elements(spark, tmp_path, small_splits, size):
    (tmp_path / "flat.json").write_text(json.dumps(ELEMENTS))
    (tmp_path / "pretty.json").write_text(json.dumps(ELEMENTS, indent=2) + "\n")
    (tmp_path / "object.json").write_text("\ufeff" + json.dumps({f"k,{i}": v for i, v in enumerate(ELEMENTS)}, indent=1))
    (tmp_path / "none.json").write_text(" [ ] \n")
    small_splits(size)
    got = {}
    for r in files.read_json(spark, str(tmp_path)).collect():
        got.setdefault(r.file_name, {})[int(r.location.removeprefix("Record #"))] = r.text
    assert set(got) == {"flat.json", "pretty.json", "object.json"}
    for texts in got.values():
        values = [texts[i + 1] if isinstance(v, str) or texts[i + 1] is None else json.loads(texts[i + 1]) for i, v in enumerate(ELEMENTS)]
        assert values == ELEMENTS and len(texts) == len(ELEMENTS)
    assert files.quarantined_json(spark, str(tmp_path)).collect() == []


def test_quarantine_lists_every_reject_with_a_reason(spark, tmp_path):
    import gzip
    (tmp_path / "ok.csv").write_text("a,b\n1,2\n")
    (tmp_path / "odd.csv").write_bytes(b'a,b\n1\n1,2,3\n\xff,2\n1,2\n1,"open\n')
    (tmp_path / "cut.json").write_text('[{"a": 1}, {"b": ')
    (tmp_path / "bare.json").write_text("17")
    (tmp_path / "lines.json").write_text('{"a": 1, "b": 2}\n{"a": 3, "b": 4}\n')
    (tmp_path / "some.json").write_text('[1, nope, 3]')
    (tmp_path / "latin 1%.txt").write_bytes("caf\u00e9".encode("latin-1"))
    (tmp_path / "blank.txt").write_text("")
    (tmp_path / "x.png").write_bytes(b"\x89")
    got = sorted((r.file_name, r.reason, r.record) for r in files.quarantine(spark, str(tmp_path)).collect())
    assert [(f, why) for f, why, _ in got] == [
        ("bare.json", "no JSON array or object"), ("cut.json", "no JSON array or object"), ("latin 1%.txt", "not UTF-8"), ("lines.json", "no JSON array or object"),
        ("odd.csv", "does not fit the header"), ("odd.csv", "does not fit the header"), ("odd.csv", "not UTF-8"), ("odd.csv", "open quote"),
        ("some.json", "no JSON value")]
    assert gzip and sorted((r.file_name, r.text) for r in files.read_directory(spark, str(tmp_path)).collect() if r.file_name != "blank.txt") == [
        ("odd.csv", "a: 1\nb: 2"), ("ok.csv", "a: 1\nb: 2"), ("some.json", "1"), ("some.json", "3")]
    assert files.quarantine(spark, str(tmp_path / "absent")).collect() == []
