import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ordermill.llm import html_text, queries
from ordermill.llm.html_text import to_text

CASES = [
    (None, ""),
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<p>one<p>two", "one\n\ntwo"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("a<b>b</b> c\n  d", "ab c d"),
    ("a<br>b<br/><br>c", "a\nb\n\nc"),
    ("<head><title>t</title></head><body>x", "x"),
    ("<title>t</title><p>x", "x"),
    ("<script>if (a<b) { '</p>' }</script>x<style>p{}</style>", "x"),
    ("<!-- <p>no</p> -->yes<!--> <b>", "yes"),
    ("<p hidden>no<p>yes", "yes"),
    ("<div style='color:red; DISPLAY : none'>no</div><div style='display:block'>yes</div>", "yes"),
    ("<span aria-hidden=true>no</span>yes", "yes"),
    ("<p>a<div hidden><p>b</p></div>c", "a\n\nc"),
    ("<ul><li>a<li>b</ul>", "- a\n- b"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "- a\n  - b\n- c"),
    ("<ol start=3><li>a<li value=7>b<li>c</ol>", "3. a\n7. b\n8. c"),
    ("<ol><li><p>a</p><p>b</p></ol>", "1. a\n\n   b"),
    ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    ("<blockquote>q<br>r</blockquote>x", "  q\n  r\n\nx"),
    ("<pre>  a\n    b</pre>", "  a\n    b"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
    ("<table><caption>cap</caption><tbody><tr><th>h<th>i</tr></tbody></table>end", "cap\nh  i\n\nend"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table><tr><td colspan=2>a<td>b<tr><td>1<td>2<td>3</table>", "a     b\n1  2  3"),
    ("<table><tr><td>x<table><tr><td>y<td>z</table></table>", "x\n\ny  z"),
    ("<h1>H</h1>text<h2>I</h2>", "H\n\ntext\n\nI"),
    ("<a href='x'>l</a>, <img alt='pic'> <img>.", "l, pic ."),
    ("<select><option>a<option>b</select>x<textarea>y</textarea>", "a x y"),
    ("</p>a</div></b>", "a"),
    ("a < b and c > d", "a < b and c > d"),
    ("<p title='a > b'>x", "x"),
    ("<div", ""),
    ("é&nbsp;漢&#x1F600;&bogus;", "é\xa0漢\U0001f600&bogus;"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_rendering(html, text):
    assert to_text(html) == text


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert to_text(deep) == "x"
    assert to_text("<b>" * 3000 + "y") == "y"
    long = to_text("<p>word</p>" * 50_000)
    assert long.count("word") == 50_000
    for broken in ("<" * 20_000, '<a "' * 20_000, '<a b="' * 20_000, "<!--" * 20_000, "</x" * 20_000, "<script>" * 20_000):
        to_text(broken + "p>z")  # ends soon
    assert to_text("<" * 20_000 + "p>z").endswith("z")


def test_elements_are_the_same_at_any_depth():
    for n in (0, 150, 1000, 30_000):
        deep = "<div>" * n
        assert to_text(deep + "<script>no()</script><style>p{}</style><p hidden>no<b>no</b></p>x<ul><li>a<li>b</ul>") == "x\n\n- a\n- b"
        assert to_text(deep + "<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>") == "a     bbb\ncccc  d"
        assert to_text("<div hidden>" + deep + "no" + "</div>" * n + "no</div>yes") == "yes"
    lists = to_text("<ul><li>x" * 20_000).split("\n")
    assert len(lists) == 20_000 and all(x.endswith("- x") for x in lists) and len(lists[-1]) < 500
    tables = to_text("<table><tr><td>y<td>z" * 5_000)
    assert tables.count("y") == tables.count("z") == 5_000


@pytest.mark.parametrize("html, text", [
    ("<table><tr><td colspan=" + "9" * 5_000 + ">a<td>b<tr><td>cc<td>d</table>", "a      b\ncc  d"),
    ("<table><tr><td colspan=" + "0" * 5_000 + "2>a<td>b<tr><td>1<td>2<td>3</table>", "a     b\n1  2  3"),
    ("<table><tr>" + "<td colspan=1000>x" * 3_000 + "</table>", "  ".join("x" * 3_000)),
    ("a&#" + "9" * 5_000 + ";b&#x" + "F" * 5_000 + ";c", "a\ufffdb\ufffdc"),
    ("&#" + "0" * 5_000 + "65;&#x" + "0" * 5_000 + "42&#" + "0" * 5_000 + "38;lt;", "AB&lt;"),
    ("<p title='&#" + "7" * 5_000 + ";'>x", "x"),
    ("<ol><li value=" + "3" * 5_000 + ">a</ol>", "1. a"),
    ("<select size=" + "8" * 5_000 + "><option>a<option>b</select>", "a\nb"),
])
def test_numbers_of_any_length_end_no_query(html, text):
    assert to_text(html) == text


@pytest.mark.parametrize("html, text", [
    # Form fields show what they hold.
    ("<select><option disabled>pick<option>a<option selected>b<option>c</select>", "b"),
    ("<select><optgroup label=g disabled><option>a</optgroup><optgroup label=h><option label=L>b</select>", "L"),
    ("<select multiple><optgroup label=g><option>a</optgroup><option>b</select>", "g\na\nb"),
    ("x<textarea>one &amp;\ntwo</textarea>y", "x one &\ntwo y"),
    ("<input value=v> <input type=hidden value=no><input type=password value=no><input placeholder=p><input type=submit value=Go>", "v p Go"),
    ("<select hidden><option>no</select><button>yes</button>", "yes"),
    # Mathematics, without its annotations.
    ("<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2 tex</annotation></semantics></math>!", "x=2!"),
    # Visibility can be given back, display cannot.
    ("<div style='visibility:hidden'>no<b style='visibility: visible'>yes<i style='visibility:collapse'>no</i></b>no</div>", "yes"),
    ("<div style='display:none'><b style='visibility:visible;display:block'>no</b></div>yes", "yes"),
    ("<ul style='visibility:hidden'><li>no<li style='visibility:visible'>yes</ul>", "- yes"),
    ("<table style='visibility:hidden'><tr><td>no<td style='visibility:visible'>yes</table><img style='visibility:hidden' alt=no>", "  yes"),
    ("<p style='backface-visibility:hidden'>yes", "yes"),
    # Closed details show their summary only.
    ("<details>no<summary>s</summary><p>no</details><details open>a<summary>t</summary></details>", "s\na\nt"),
    ("<ruby>漢<rp>(</rp><rt>kan</rt><rp>)</rp></ruby>", "漢kan"),
])
def test_what_a_browser_shows_is_shown(html, text):
    assert to_text(html) == text


@pytest.mark.parametrize("html, text", [
    ("<dialog>no</dialog><dialog open>yes</dialog>", "yes"),
    ("a<svg><title>no</title><defs><text>no</text></defs>no<path d='M0'/><text>b <tspan>c</tspan></text><text>d</text></svg>e", "a b c d e"),
    ("<svg/>a<svg><g/><p>b", "a\n\nb"),
])
def test_open_dialogs_and_text_of_drawings_are_shown(html, text):
    assert to_text(html) == text


def test_pages_of_a_table(spark):
    df = spark.createDataFrame([(1, "<p>a", "t"), (1, "<p>a", "t"), (2, None, "t"), (3, "", "t")], "page_id long, html string, text string")
    assert sorted(map(tuple, html_text.extract(df).collect())) == [(1, "a"), (1, "a"), (2, ""), (3, "")]
    assert html_text.extract(df.where("false")).count() == 0


def test_stages_keep_the_columns_and_shrink_the_corpus(spark):
    folder = "/root/testdata/sf0.001"
    docs = queries.read(spark, folder, "documents")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert sorted(out.columns) == sorted(columns), name
        assert 0 < out.count() <= rows, name
        docs, rows = corpus_pipeline.held(out, "stage"), out.count()
    packed = corpus_pipeline.run(spark, folder)
    assert packed.select("doc_id").distinct().count() == rows


def test_stages_take_odd_rows(spark):
    """Null and empty texts, repeated rows, a very long repetitive text, no rows, and columns whose names the
    stages might use themselves: each stage's rows are known."""
    folder = "/root/testdata/sf0.001"
    docs = queries.read(spark, folder, "documents")
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (9_000_001, "", "en", None, 0), (9_000_001, "", "en", None, 0), (9_000_002, "a b " * 30_000, "en", "src0", 7)],
        docs.schema,
    )
    names = ["_lines", "_host", "_hits", "_covered", "_short", "_gone", "stays", "id", "class_id", "seed", "rank", "n_dropped"]
    clashing = odd.select("*", *[F.lit(k).alias(name) for k, name in enumerate(names)])
    # Quality rules reject texts without twenty words and repetitive ones; no other stage drops odd rows.
    kept = {"quality rules": 0, "line dedup": 4, "n-gram Jaccard join": 4, "benchmark decontamination": 4}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for part in (odd, clashing):
            out = stage(spark, part, folder)
            assert out.columns == part.columns and out.count() == kept[name], name
            texts = sorted(r["text"] or "" for r in out.collect())
            assert texts == ([] if not kept[name] else ["", "", "", "a b " * 30_000]), name
        assert stage(spark, odd.where("false"), folder).count() == 0, name
    name, stage = corpus_pipeline.STAGES[-1]
    for part in (odd, clashing):
        pieces = stage(spark, part, folder).collect()
        assert sorted((r["doc_id"] or 0, r["piece"], r["length"]) for r in pieces)[:3] == [(0, 0, 1), (9_000_001, 0, 1), (9_000_001, 0, 1)]
        assert sum(r["length"] for r in pieces) == 3 + 60_001
    assert stage(spark, odd.where("false"), folder).count() == 0


def test_line_dedup_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(queries.OP6).fetchall()}
    got = {r["doc_id"]: (r["source"], r["text"], r["n_dropped"]) for r in queries.op6_line_dedup(spark, folder).collect()}
    assert got == want and sum(r[2] for r in want.values()) > 0


def test_line_dedup_judges_small_hosts_and_rare_lines(spark, tmp_path):
    """A line on 7 of 300 pages goes, one on 4 stays; on a host of 12 pages one on 5 goes."""
    rows = [(i, f"own {i}" + "\nshared by seven" * (i < 7) + "\nshared by four" * (i < 4), "large") for i in range(300)]
    rows += [(1000 + i, f"own {i}" + "\nmenu" * (i < 5) + "\nshared by four" * (i < 4), "small") for i in range(12)]
    rows += [(2000 + i, "tiny\nmenu", "tiny") for i in range(4)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = {r[0]: r[1:] for r in con.execute(queries.OP6).fetchall()}
    found = {r["doc_id"]: (r["source"], r["text"], r["n_dropped"]) for r in queries.op6_line_dedup(spark, folder).collect()}
    assert found == want
    assert found[2][1:] == ("own 2\nshared by four", 1) and found[6][1:] == ("own 6", 1) and found[7][2] == 0
    assert found[1001][1:] == ("own 1\nshared by four", 1) and found[2000] == ("tiny", "tiny\nmenu", 0)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    staged = {r["doc_id"]: r["text"] for r in corpus_pipeline.lines(spark, docs, folder).collect()}
    assert staged == {doc_id: r[1] for doc_id, r in found.items()}
