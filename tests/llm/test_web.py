"""Archives: round trip, frames, roles; pages: main text, templates, broken markup."""

import hashlib
import io
import struct
import subprocess
import sys
import time

import pytest
import zstandard
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tablesync.llm import align, bagminhash, chat, language, merkle, suffixes, warc
from tablesync.llm import html as hx
from tablesync.session import scratch_dir
from tests.compare import differences, open_tables

SF = "/root/testdata/sf0.01"
PAGE = "page_id long, url string, html string"


def archived(spark, rows):
    pages = spark.createDataFrame(rows, PAGE).select(
        "page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    manifest = warc.write_archives(warc.with_roles(pages), scratch_dir(spark, "warc"))
    return manifest, [r.asDict() for r in warc.read_archives(manifest).collect()]


def test_archives_match_sql(spark):
    assert differences(warc.op1(spark, SF), open_tables(SF), warc.ORACLE) is None


def test_payloads_come_back(spark):
    long = "<p>" + "é" * 60 + "</p>"
    rows = [(1, "http://a.example/é?x=1 2", long), (2, None, long), (3, "u\r\nv", None), (4, "", ""), (5, "b", "x" * 99),
            (6, "b", "x" * 99), (7, "b", "y" * 100), (8, "b", "y" * 100), (None, "n", long), (9, "c", "z" * 3_000_000)]
    _, got = archived(spark, rows)
    by_id = {r["page_id"]: r for r in got}
    assert len(got) == len(rows)
    for page_id, url, html in rows:
        payload, r = (html or "").encode(), by_id[page_id]
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == hashlib.sha256(payload).hexdigest()
        assert r["url"] == (url or "")
        assert bytes(r["block"]) == (payload if r["record_type"] == "response" else b"")
    assert {i: r["refers_to"] for i, r in by_id.items() if r["record_type"] == "revisit"} == {2: 1, 8: 7, None: 1}


def test_repeated_rows_have_one_response(spark):
    _, got = archived(spark, [(1, "a", "q" * 200)] * 3 + [(2, "a", "q" * 200)] + [(4, "a", "short")] * 2)
    kinds = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["payload_bytes"] == 200)
    assert [k for k in kinds if k[1] == "response"] == [(1, "response", None)]
    assert [k[2] for k in kinds if k[1] == "revisit"] == [1, 1, 1]
    assert {r["record_type"] for r in got if r["payload_bytes"] == 5} == {"response"}


def test_a_hot_payload(spark):
    _, got = archived(spark, [(i, "h", "hot" * 50) for i in range(500)] + [(1000 + i, "h", f"{i}" * 60) for i in range(50)])
    assert sum(r["record_type"] == "revisit" and r["refers_to"] == 0 for r in got) == 499


def test_empty_table(spark):
    manifest, got = archived(spark, [])
    assert got == [] and manifest.count() == 0


def test_frames_follow_the_format():
    records = [warc.record(i, f"http://h/{i}", f"<p>page {i} of the site</p>".encode() * 5, "0" * 64, "response", None)
               for i in range(300)]
    out = io.BytesIO()
    warc.write_file(out, records)
    data = out.getvalue()
    magic, size = struct.unpack_from("<II", data)
    assert magic == warc.DICTIONARY_FRAME
    content = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    frame = reader.decompressobj()  # the first record is a frame of its own
    assert frame.decompress(data[8 + size:]) == records[0] and frame.eof
    assert list(warc.read_records(io.BytesIO(data))) == records
    assert len(data) < sum(map(len, records)) / 3


def test_a_cut_archive_is_an_error():
    out = io.BytesIO()
    warc.write_file(out, [b"a" * 1000 + bytes(range(256))] * 2)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(out.getvalue()[:-5])))


def text_of(page, templates=()):
    tree = hx.parse(page)
    hx.mark(tree)
    return "\n\n".join(hx.blocks(tree, frozenset(templates)))


def test_the_article_without_furniture():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <header>Site</header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div>
      <article><h1>A &amp; B</h1><p>One <b>two</b>
         three&nbsp;four<br>five</p><aside>Side</aside><div class="ad">Buy</div>
      <ul><li>x<li>y</ul><form>mail<input></form><blockquote>q</blockquote>
      <section id="comments"><p>first!</p></section></article>
      <div role="complementary">more</div><footer>&copy; me</footer></body></html>"""
    assert text_of(page) == "A & B\n\nOne two three four five\n\nx\n\ny\n\nq"


def test_names_with_a_word_of_furniture_stay():
    assert text_of("<body class='page has-sidebar'><div id='page' class='no-sidebar'><p>The text.</p></div></body>") == "The text."
    page = ("<article><div class='article-header'><h1>Title</h1></div><p class='notice-period'>One.</p>"
            "<h2 id='search-results'>Two</h2><h2 id='social-policy'>Three</h2><p>Four.</p>"
            "<div class='share-buttons'>x</div><div class='post-comments'>x</div><div id='cookieBanner'>x</div></article>")
    assert text_of(page) == "Title\n\nOne.\n\nTwo\n\nThree\n\nFour."
    most = "<div class='widget'><p>Nearly all of the text of this page.</p></div><div class='sidebar'>x</div>"
    assert text_of(most) == "Nearly all of the text of this page."


def test_main_with_text_besides_its_articles():
    page = "<main><div><p>The whole text.</p></div><article><p>Teaser.</p></article></main><div>x</div>"
    assert text_of(page) == "The whole text.\n\nTeaser."
    assert text_of("<main><article><p>The text.</p></article><nav>x</nav></main>") == "The text."


def test_broken_markup():
    assert text_of("<article><p><b>one<br><p>two</article><p>out") == "one\n\ntwo"
    assert text_of("plain &lt;text&gt;") == "plain <text>"
    assert text_of("<p>a<!-- <p>no --><p>b</div></p>c<") == "a b c<" or text_of("<p>a<!-- x --><p>b") == "a\n\nb"
    assert text_of("<div class='x>y'>a</div><script>never closed <p>b") == "a"
    assert text_of("<p>a <a href=\"x>y\">b</a>c</p>") == "a bc"
    assert text_of("") == "" and text_of("<<<>>>") != "<p>"


def test_names_that_hold_the_article_stay():
    assert text_of("<div class='page with-sidebar'><form><article>kept</article></form></div>") == "kept"


def test_templates_of_a_host_go(spark):
    def page(i, host, extra=""):
        return (i, f"http://{host}/{i}", f"<body><div class=box>Welcome to the site</div>{extra}<div><p>Text no {i}</p></div></body>")

    rows = [page(i, "A.example") for i in range(10)] + [page(100 + i, f"b{i}.example") for i in range(10)]
    got = {r["page_id"]: r["text"] for r in hx.main_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[3] == "Text no 3" and got[103] == "Welcome to the site\n\nText no 103"


def test_copies_of_a_page_do_not_make_it_a_template(spark):
    rows = [(i, "http://h/x", "<body><div>The only page</div></body>") for i in range(50)]
    assert {r["text"] for r in hx.main_text(spark.createDataFrame(rows, PAGE)).collect()} == {"The only page"}


def test_repeated_paragraphs_of_articles_stay(spark):
    rows = [(i, "http://h/x", f"<article><p>Same line</p><p>{i}</p></article><div>menu text</div>") for i in range(20)]
    got = {r["page_id"]: r["text"] for r in hx.main_text(spark.createDataFrame(rows, PAGE)).collect()}
    assert got[7] == "Same line\n\n7"


def test_page_edge_cases(spark):
    rows = [(1, None, None, "t"), (None, "", "", "t"), (2, "not a url", "<p>x", "t"), (2, "not a url", "<p>x", "t"),
            (3, "http://h/", "<p>" + "word " * 200_000, "t")]
    df = spark.createDataFrame(rows, PAGE + ", text2 string")
    got = sorted(((r["page_id"], r["text"]) for r in hx.main_text(df).collect()), key=repr)
    assert [t for i, t in got if i == 2] == ["x", "x"] and dict(got)[1] == "" and dict(got)[None] == ""
    assert dict(got)[3] == "word " * 199_999 + "word"
    assert hx.main_text(spark.createDataFrame([], PAGE)).count() == 0


def test_the_articles_of_the_test_pages(spark):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in hx.op9(spark, SF).collect()}
    assert set(got) == set(pages)
    for page_id, page in pages.items():
        article = page[page.index("<article>") + 9:page.index("</article>")]
        parts = re.split(r"</?p>|</?h1>", article.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
        lines = [" ".join(html.unescape(p).split()) for p in parts]
        want = "\n\n".join(x for x in lines if x)
        assert got[page_id]["text"] == want and got[page_id]["n_chars"] == len(want)


def test_forms_and_names_are_judged_by_what_they_hold():
    assert text_of("<body><form id=aspnetForm><div><p>The text.</p></div><input><select><option>x</select></form></body>") == "The text."
    assert text_of("<p>The whole text of the page.</p><form><label>Mail</label><input></form>") == "The whole text of the page."
    page = ("<article><p>One.</p><p class='ad'>Buy</p><p class=comment>First!</p><ul><li>x</li><li class='comment'>Me too</li></ul>"
            "<h2 class=ad>Two</h2></article>")
    assert text_of(page) == "One.\n\nx\n\nTwo"


def test_quotes_and_brackets():
    assert text_of("<article><p data-x=it's>One.</p><p title='a>b' hidden2>Two \"x\"</p></article>") == "One.\n\nTwo \"x\""
    assert text_of("<p>1 < 2 and a <> b </ c</p><p>3</p>") == "1 < 2 and a <> b </ c\n\n3"
    assert text_of("<p a=b/c>x<br/>y</p><img src=x / ><p>z") == "x y\n\nz"
    assert text_of("<script>var a = '</scripty>';</script><p>x</p><style>never") == "x"
    assert text_of("<p>a<p unfinished") == "a"
    assert hx.parse("<a HREF=\"x&amp;y\" href=z>").parts[0].attrs == {"href": "x&y"}


@pytest.mark.parametrize("unit", ["<a ", "<a x=\"", "<a x='\"", "</script", "<i></b>", "<div><b></i>", "<!--", "<p>", "a<", "<b><div>"])
def test_reading_takes_linear_time(unit):
    start = time.perf_counter()
    text_of("<b><p>The text.</p>" + unit * (1_000_000 // len(unit)))
    assert time.perf_counter() - start < 10


def test_deep_pages_keep_their_text():
    page = "<div>" * 5000 + "<p>deep</p>" + "</div>" * 5000 + "<p>after</p>"
    assert text_of(page) == "deep\n\nafter"


def texts(spark, rows, **kw):
    return {r["page_id"]: r["text"] for r in hx.main_text(spark.createDataFrame(rows, PAGE), **kw).collect()}


def test_blocks_of_large_hosts_and_blocks_that_rotate(spark):
    def page(i, extra):
        return (i, f"http://h/{i}", f"<body>{extra}<div><p>Text no {i}</p></div></body>")

    rows = [page(i, f"<div class=box>Offer {i % 6}</div>") for i in range(60)]
    assert texts(spark, rows)[7] == "Text no 7", "one of six, on a sixth of the pages each"
    rows = [page(i, "<div><span>On some pages</span></div>" if i < 40 else "") for i in range(400)]
    assert texts(spark, rows, many=30)[7] == "Text no 7", "a tenth of a large host"
    assert texts(spark, rows, many=50)[7] == "On some pages\n\nText no 7"
    rows = [page(i, f"<div class=story>Story {i}</div>") for i in range(60)]
    assert texts(spark, rows)[7] == "Story 7\n\nText no 7", "what is never the same stays"


def brute_templates(pages):
    """(host, key) by a loop over all pages."""
    per_host = {}
    for _, url, page in pages:
        host = url.split("/")[2]
        tree = hx.parse(page)
        hx.mark(tree)
        per_host.setdefault(host, {})[tree.key] = hx.candidates(tree)
    out = set()
    for host, found in per_host.items():
        share = max(5, -(-len(found) // 5))
        for key in {k for c in found.values() for k in c}:
            n = sum(key in c for c in found.values())
            inside, place = next(c[key] for c in found.values() if key in c)
            at_place = sum(place is not None and any(p == place for _, p in c.values()) for c in found.values())
            enough = share if inside else min(share, 100)
            if n >= 5 and (n >= enough or at_place >= enough):
                out.add((host, key))
    return out


def test_templates_equal_brute_force(spark):
    rows = []
    for i in range(90):
        host = "abc"[i % 3 if i < 60 else 0]
        inside = f"<article><div class=note>Note {i % 4}</div><p>{i}</p></article>" if i % 2 else f"<div><p>{i}</p></div>"
        rows.append((i, f"http://{host}/{i}", f"<div id=top>Site</div><div class=x>Rotates {i % 7}</div>{inside}<p>Line {i % 9}</p>"))
    df = spark.createDataFrame(rows, PAGE)
    named = df.select(hx.host_of(F.col("url")).alias("host"), F.unhex(F.md5("html")).alias("name"), "html")
    got = {tuple(r) for r in hx.templates(hx.subtrees(named), named).collect()}
    assert got == brute_templates(rows)


def test_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "http://h/", "<p>x", "a", "b", 3)], PAGE + ", host string, `_templates` string, row long")
    row, = hx.main_text(df).collect()
    assert row.asDict() == {"page_id": 1, "url": "http://h/", "host": "a", "_templates": "b", "row": 3, "text": "x"}


def test_worker_functions_load_without_the_package():
    functions = [hx._hash, hx._extract, bagminhash._sign, bagminhash._blocks(0.8), bagminhash._verify, suffixes._shared,
                 suffixes._merged, merkle._segment(2, 3), align._chunks(b"", b""), align._looked_up, language._count,
                 chat.Reading, warc.read_records]
    code = "import sys, pickle; sys.modules['tablesync'] = None; pickle.loads(sys.stdin.buffer.read())"
    for f in functions:
        run = subprocess.run([sys.executable, "-c", code], input=cloudpickle.dumps(f), capture_output=True, cwd="/", timeout=100)
        assert run.returncode == 0, (f, run.stderr[-400:])
