"""Readers: listings, links, delimited text, JSON records, landed files."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata import schemas as S
from strata.sources.delimited import parse_delimited, read_delimited
from strata.sources.json_records import explode_records, parse_json_records, read_json_records
from strata.sources.landed import read_landed
from strata.sources.listing import extract_links, parse_listing

LISTING = """<!doctype html><title>Index of /pub/series/pr</title><h2>Index of /pub/series/pr</h2><pre>
<a href="../">up</a>
3/14/2026  6:05 AM      48213 <A HREF="/pub/series/pr/pr.measure">pr.measure</A>
11/2/2025 12:45 PM    1900071 <A HREF="/pub/series/pr/pr.data.1.AllData">pr.data.1.AllData</A>
 7/9/2024 11:59 PM         37 <a href="pr.footnote">pr.footnote</a>
 7/9/2024 11:59 PM        900 <A HREF="/pub/series/pr/notes.txt">notes.txt</A>
</pre>"""
BASE = "https://files.example.org/pub/series/pr/"


def test_extract_links_keeps_prefix_only(spark):
    pages = spark.createDataFrame([(1, LISTING)], "page_id long, html string")
    names = [r.file_name for r in extract_links(pages, "html", "pr.", keep=["page_id"]).collect()]
    assert names == ["pr.measure", "pr.data.1.AllData", "pr.footnote"]


def test_extract_links_ignores_commented_links(spark):
    html = '<a href="/x/pr.a">a</a><!-- <a href="/x/pr.hidden">h</a> --><a href="/x/other">o</a>'
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.file_name for r in extract_links(pages, "html", "pr.").collect()] == ["pr.a"]


def test_extract_links_skips_script_and_style(spark):
    html = ('<script>var s = \'<a href="/d/pr.fake">x</a>\';</script><STYLE>a[href="/d/pr.css"]{}</STYLE>'
            '<a href="/d/pr.real">r</a>')
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.file_name for r in extract_links(pages, "html", "pr.").collect()] == ["pr.real"]


def test_extract_links_quoting_and_entities(spark):
    html = (
        "<a class=x href='/d/pr.one'>1</a> <A HREF=/d/pr.two>2</A> <a href=\"/d/pr.a&amp;b\">3</a>"
        '<a href="">empty</a><abbr href="/d/pr.no">no</abbr>'
    )
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    assert [r.file_name for r in extract_links(pages, "html", "pr.").collect()] == ["pr.one", "pr.two", "pr.a&b"]


def test_parse_listing_fields(spark):
    pages = spark.createDataFrame([(1, LISTING)], "page_id long, html string")
    rows = parse_listing(pages, "html", BASE, "pr.").collect()
    assert [r.file_name for r in rows] == ["pr.measure", "pr.data.1.AllData", "pr.footnote"]
    first = rows[0]
    assert first.file_size == 48213
    assert first.source_url == "https://files.example.org/pub/series/pr/pr.measure"
    # Listing times carry no zone; the session zone is UTC.
    assert first.source_modified_time == datetime(2026, 3, 14, 6, 5)
    assert rows[2].source_url == "https://files.example.org/pub/series/pr/pr.footnote"
    assert rows[2].source_modified_time == datetime(2024, 7, 9, 23, 59)


def test_parse_listing_impossible_date_is_null(spark):
    html = ' 2/30/2026  8:30 AM   5 <A HREF="/p/pr.x">pr.x</A>'
    pages = spark.createDataFrame([(html,)], "html string")
    row = parse_listing(pages, "html", "https://h.org/p/").first()
    assert row.file_name == "pr.x" and row.source_modified_time is None


def test_read_delimited_binds_by_position(spark, tmp_path):
    # Padded header skipped, short row -> trailing NULL, extra field dropped, blanks kept, empty -> NULL.
    p = tmp_path / "pr.data"
    p.write_text(
        "series_id        \tyear\tperiod\tvalue\tfootnote_codes\n"
        "PRS1   \t2020\tQ01\t  1.5\t\n"
        "PRS2\t2021\tQ02\n"
        "\n"
        "PRS3\t2022\tQ03\t2.0\tF\textra\n"
    )
    rows = read_delimited(spark, str(p), S.OBSERVATIONS_RAW).collect()
    assert [r.series_id for r in rows] == ["PRS1   ", "PRS2", "PRS3"]
    assert rows[0].value == "  1.5" and rows[0].footnote_codes is None
    assert rows[1].value is None and rows[1].footnote_codes is None
    assert rows[2].footnote_codes == "F"


def test_parse_delimited_column(spark):
    schema = StructType([StructField(n, StringType()) for n in ("a", "b", "c")])
    df = spark.createDataFrame([("x \t y",), ("only",)], "line string")
    rows = parse_delimited(df, "line", schema).collect()
    assert (rows[0].a, rows[0].b, rows[0].c) == ("x ", " y", None)
    assert (rows[1].a, rows[1].b) == ("only", None)


def _doc(records, **extra):
    return json.dumps({"columns": ["Nation ID", "Nation", "Year", "Population"], "data": records, **extra}, indent=2)


def test_read_json_records_explodes_and_sanitises(spark, tmp_path):
    p = tmp_path / "population.json"
    p.write_text(_doc([
        {"Nation ID": "01000US", "Nation": "United States", "Year": 2019, "Population": 328239523.0},
        {"Nation ID": "01000US", "Nation": "United States", "Year": 2018, "Population": 327167439.0},
    ]))
    df = read_json_records(spark, str(p), S.POPULATION_DOCUMENT)
    assert df.columns == ["nation_id", "nation", "year", "population"]
    assert sorted(r.year for r in df.collect()) == [2018, 2019]


def test_missing_data_array_yields_no_rows(spark, tmp_path):
    # Explode (not outer) drops a document without records.
    p = tmp_path / "empty.json"
    p.write_text(json.dumps({"columns": ["Nation"]}))
    assert read_json_records(spark, str(p), S.POPULATION_DOCUMENT).count() == 0
    assert read_json_records(spark, str(p), S.POPULATION_DOCUMENT, outer=True).count() == 1


def test_parse_json_records_from_column(spark):
    docs = spark.createDataFrame([(7, _doc([{"Nation ID": "x", "Nation": "N", "Year": 2020, "Population": 1.0}]))],
                                 "doc_id long, js string")
    rows = parse_json_records(docs, "js", S.POPULATION_DOCUMENT, keep=["doc_id"]).collect()
    assert [(r.doc_id, r.nation, r.year) for r in rows] == [(7, "N", 2020)]


def test_explode_records_outer(spark):
    df = spark.createDataFrame([(1, [(1, "a")]), (2, None)], "id long, data array<struct<k:long,v:string>>")
    assert explode_records(df, "data", keep=["id"]).count() == 1
    assert explode_records(df, "data", outer=True, keep=["id"]).count() == 2


def test_read_landed_metadata_and_hash(spark, tmp_path):
    (tmp_path / "pr.a").write_bytes(b"hello")
    (tmp_path / "pr.b").write_bytes(b"")
    df = read_landed(spark, str(tmp_path), "pr.*", with_hash=True)
    got = {r.file_name: (r.length, r.content_sha256) for r in df.collect()}
    assert got["pr.a"][0] == 5
    assert got["pr.a"][1] == "2cf24dba5fb0a30e26e83b2ac5b9e29e1b161e5c1fa7425e73043362938b9824"
    # Spark's file scan skips zero-byte files; the listing has them.
    assert got["pr.b"] == (0, "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855")
    assert read_landed(spark, str(tmp_path)).filter(F.col("file_name") == "pr.a").count() == 1


def test_join_url_shapes(spark):
    from strata.functions.columns import join_url

    cases = [
        ("https://h.org/pub/pr/", "/x/pr.a", "https://h.org/x/pr.a"),
        ("https://h.org/pub/pr/", "pr.a", "https://h.org/pub/pr/pr.a"),
        ("https://h.org/pub/index.html", "pr.a", "https://h.org/pub/pr.a"),
        ("https://h.org", "pr.a", "https://h.org/pr.a"),
        ("https://h.org/pub/", "http://other.org/pr.a", "http://other.org/pr.a"),
    ]
    df = spark.createDataFrame([(b, h) for b, h, _ in cases], "base string, href string")
    got = [r.u for r in df.select(join_url(F.col("base"), "href").alias("u")).collect()]
    assert got == [want for _, _, want in cases]


def test_listing_time_case_insensitive(spark):
    html = ' 8/6/2026 8:30 pm   7 <a href="/p/PR.x">PR.x</a>'
    row = parse_listing(spark.createDataFrame([(html,)], "html string"), "html", "https://h.org/p/").first()
    assert row.file_name == "PR.x" and row.source_modified_time == datetime(2026, 8, 6, 20, 30)


def test_read_delimited_quoting_switch(spark, tmp_path):
    p = tmp_path / "q.tsv"
    p.write_text('a\tb\n"x\ty"\tz\n')
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    csv = read_delimited(spark, str(p), schema).first()
    plain = read_delimited(spark, str(p), schema, quoting=False).first()
    assert (csv.a, csv.b) == ("x\ty", "z")  # quoted field keeps its tab
    assert (plain.a, plain.b) == ('"x', 'y"')  # quotes are text; the tab splits


def test_join_url_equals_urljoin(spark):
    from urllib.parse import urljoin

    from strata.functions.columns import join_url

    bases = ["https://x.org/a/b/c", "https://x.org/a/b/", "https://x.org", "https://x.org/p?q=1#f", "http://h:80/a"]
    links = ["pr.a", "/z/pr.a", "//host/x", "../x", "./x", "../../../x", "mailto:a@b", "https://y.org/../k", "?q=2", "#f", "", "a/./b/../c",
             "..", ".", "a//b", "/a//b/../c", "x?y=/../z", "d/", "ftp://z/q", "../", "a/..", "x#../y"]
    rows = spark.createDataFrame([(b, h) for b in bases for h in links], "b string, h string")
    got = {(r.b, r.h): r.u for r in rows.select("b", "h", join_url(F.col("b"), "h").alias("u")).collect()}
    want = {(b, h): urljoin(b, h) for b in bases for h in links}
    # urljoin drops an empty fragment or query mark; compare without them
    wrong = {k: (got[k], want[k]) for k in want if got[k].rstrip("#?") != want[k].rstrip("#?")}
    assert not wrong


def test_extract_links_equals_an_html_parser(spark):
    from html.parser import HTMLParser

    class Anchors(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            own = [v for k, v in attrs if k == "href"]
            if tag == "a" and own and own[0]:
                self.found.append(own[0])

    pages = [
        '<a data-href="pr.wrong" href="pr.right">x</a>', '<a title="a > b" href="pr.gt">x</a>', '<a href="pr&#46;n&#x41;">x</a>',
        "<a href='q\"uote' id=1>x</a><A HREF = pr.bare class=b>y</A>", '<a\n  href="two\nlines">', '<area href="no"><a href><a name="n">',
        '<a href="one" href="two">', '<a x="href=no" y=\'href="no"\' href="yes">', '<a href="&lt;&amp;gt;&quot;&#128512;">', '<ahref="no">', '<a href="">',
    ]
    frame = spark.createDataFrame(list(enumerate(pages)), "i long, html string")
    got = {}
    for r in extract_links(frame, "html", keep=["i"]).collect():
        if r.href:
            got.setdefault(r.i, []).append(r.href)
    for i, page in enumerate(pages):
        parser = Anchors()
        parser.feed(page)
        assert got.get(i, []) == parser.found, page


def test_listing_size_beyond_a_long_is_null(spark):
    html = f' 2/3/2026  8:30 AM   {"9" * 20} <A HREF="/p/pr.x">pr.x</A>'
    row = parse_listing(spark.createDataFrame([(html,)], "html string"), "html", "https://h.org/p/").first()
    assert row.file_name == "pr.x" and row.file_size is None


@pytest.mark.parametrize(
    "entry",
    [
        "8/6/2026  8:30 AM   7 <a href='/pub/pr.x'>pr.x</a>",
        "8/6/2026 8:30 am 7 <A class=\"f\" HREF='/pub/pr.x' title='a > b'>pr.x</A>",
        "<td>8/6/2026\n 8:30 AM</td> on 8/6/2026 8:30 AM 7 <a\nhref=/pub/pr.x>pr.x",
        '8/6/2026 8:30 AM 7 <a data-href="/no" href="/pub/pr&#46;x">pr.x</a>',
    ],
)
def test_listing_entries_of_many_shapes(spark, entry):
    row = parse_listing(spark.createDataFrame([(entry,)], "html string"), "html", "https://h.org/p/").collect()
    assert [(r.file_name, r.source_url, r.file_size, str(r.source_modified_time)) for r in row] == [
        ("pr.x", "https://h.org/pub/pr.x", 7, "2026-08-06 08:30:00")
    ]


@pytest.mark.parametrize(
    "entry",
    ['<a href="/pub/pr.x">pr.x</a>', '8/6/2026 8:30 AM &lt;dir&gt; <a href="/pub/pr.x">pr.x</a>', '8/6/2026 8:30 7 <a href="/x">pr.x</a>',
     '8/6/2026 8:30 AM 7 <a name="x">pr.x</a>', '8/6/2026 8:30 AM 7 <a href="/pub/pr.x">readme</a>', '8/6/2026 8:30 AM 7 <br><a href="/x">pr.x</a>'],
)
def test_what_is_no_listing_entry(spark, entry):
    assert parse_listing(spark.createDataFrame([(entry,)], "html string"), "html", "https://h.org/p/").count() == 0


# --------------------------------------------------------- folders and ranges
@pytest.fixture()
def tree(tmp_path):
    files = {"a.txt": b"one", "empty.txt": b"", "_hidden": b"x", ".dot": b"x", "sub/a.txt": b"other", "sub/deep/c d.csv": b"1,2", "sub/deep/zero": b""}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return tmp_path


def test_list_files_sees_empty_files_and_sub_folders(spark, tree):
    from strata.sources.files import list_files

    rows = {r.relative_path: r for r in list_files(spark, str(tree)).collect()}
    assert {k: r.length for k, r in rows.items()} == {"a.txt": 3, "empty.txt": 0, "sub/a.txt": 5, "sub/deep/c d.csv": 3, "sub/deep/zero": 0}
    seen = {r.path: r.modificationTime for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tree)).collect()}
    assert {r.file_path: r.modification_time for r in rows.values() if r.length} == seen
    assert {r.relative_path for r in list_files(spark, f"file://{tree}/", "*.txt").collect()} == {"a.txt", "empty.txt", "sub/a.txt"}
    assert {r.file_name for r in list_files(spark, str(tree), recursive=False).collect()} == {"a.txt", "empty.txt"}
    assert list_files(spark, str(tree / "missing")).count() == 0


def test_read_landed_holds_empty_files(spark, tree):
    import hashlib

    rows = {r.relative_path: r for r in read_landed(spark, str(tree), with_hash=True).collect()}
    assert {k: r.content_sha256 for k, r in rows.items()} == {
        k: hashlib.sha256((tree / k).read_bytes()).hexdigest() for k in ("a.txt", "empty.txt", "sub/a.txt", "sub/deep/c d.csv", "sub/deep/zero")
    }
    assert read_landed(spark, str(tree)).columns == ["file_path", "relative_path", "file_name", "length", "modification_time"]


def test_an_empty_landed_file_is_a_success(spark, tree):
    from datetime import datetime

    from strata.plans.manifest import landing_records

    todo = spark.createDataFrame([("empty.txt", 0, "NEW"), ("gone.txt", 0, "NEW")], "file_name string, file_size long, action string")
    got = landing_records(todo, read_landed(spark, str(tree)), now=datetime(2026, 9, 1)).collect()
    assert {r.file_name: (r.status, r.file_size) for r in got} == {"empty.txt": ("SUCCESS", 0), "gone.txt": ("FAILED", 0)}


def test_digests_by_range(spark, tmp_path):
    import hashlib

    from strata.sources.files import changed_ranges, list_files, range_digests, tree_digests

    data = bytes(range(256)) * 41  # 10,496 bytes: ranges of 1000, the last one short
    (tmp_path / "big").write_bytes(data)
    (tmp_path / "same").write_bytes(data)
    (tmp_path / "empty").write_bytes(b"")
    first = range_digests(list_files(spark, str(tmp_path)), 1000).cache()
    big = sorted((r.range_no, r.range_length, r.range_sha256) for r in first.collect() if r.file_path.endswith("/big"))
    parts = [data[i : i + 1000] for i in range(0, len(data), 1000)]
    assert big == [(i, len(p), hashlib.sha256(p).hexdigest()) for i, p in enumerate(parts)]
    trees = {r.file_path.rsplit("/", 1)[1]: (r.length, r.tree_sha256) for r in tree_digests(list_files(spark, str(tmp_path)), 1000).collect()}
    joined = "".join(h for _, _, h in big)
    assert trees["big"] == trees["same"] == (len(data), hashlib.sha256(joined.encode()).hexdigest())
    assert trees["empty"] == (0, hashlib.sha256(hashlib.sha256(b"").hexdigest().encode()).hexdigest())
    (tmp_path / "big").write_bytes(data[:2500] + b"?" + data[2501:] + b"more" * 200)
    (tmp_path / "empty").unlink()
    second = range_digests(list_files(spark, str(tmp_path)), 1000)
    found = changed_ranges(second, first).collect()
    odd = {(r.file_path.rsplit("/", 1)[1], r.range_no): r.action for r in found if r.action != "UNCHANGED"}
    assert odd == {("big", 2): "CHANGED", ("big", 10): "CHANGED", ("big", 11): "NEW", ("empty", 0): "REMOVED"}
    assert len(found) == 12 + 11 + 1


# ------------------------------------------------- what readers leave out
@pytest.mark.parametrize("quoting", [True, False])
def test_extra_fields_are_counted_by_the_gate(spark, tmp_path, quoting):
    from strata.operators.quality import quality_gate, quality_report
    from strata.sources.delimited import NO_EXTRA_FIELDS, parse_delimited

    schema = StructType([StructField(n, StringType()) for n in ("a", "b")])
    lines = ["1\t2", "3", "4\t5\t6", "7\t8\t", "9\t10\t\t11", "12\t13\t14\t15"]
    (tmp_path / "x").write_text("h1\th2\n" + "\n".join(lines) + "\n")
    read = read_delimited(spark, str(tmp_path / "x"), schema, quoting=quoting, extra_col="extra_fields")
    parsed = parse_delimited(spark.createDataFrame([(x,) for x in lines], "line string"), "line", schema, quoting=quoting, extra_col="extra_fields")
    for df in (read, parsed):
        assert [tuple(r) for r in quality_report(df, NO_EXTRA_FIELDS).collect()] == [("no_extra_fields", 6, 2)]
        kept, dropped = quality_gate(df, NO_EXTRA_FIELDS)
        assert sorted(r.a for r in kept.collect()) == ["1", "3", "7", "9"] and sorted(r.extra_fields for r in dropped.collect()) == ["14", "6"]
    assert read_delimited(spark, str(tmp_path / "x"), schema, quoting=quoting).columns == ["a", "b"]


def test_unreadable_documents_are_named(spark, tmp_path):
    from strata.sources.json_records import unreadable_documents

    texts = {"good": '{"data": [{"x": 1}]}', "broken": '{"data": [{"x": 1}', "none": '{"other": 1}', "empty": '{"data": []}', "null": '{"data": null}'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    schema = StructType.fromDDL("data array<struct<x: long>>")
    got = {r.file_path.rsplit("/", 1)[1]: r.reason for r in unreadable_documents(spark, str(tmp_path), schema).collect()}
    assert got == {"broken": "malformed", "none": "no records", "empty": "no records", "null": "no records"}
    assert read_json_records(spark, str(tmp_path), schema).count() == 1
