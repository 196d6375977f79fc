import base64
import glob
import hashlib

import pyarrow as pa
import pytest

from textforge.llm import main_text, queries, warc

SCHEMA = "page_id long, url string, html string, digest string, file string, host string, row long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "f", "h", 1) for r in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    low = {}
    for i, _, h in rows:
        if i is not None:
            low[h or ""] = min(low.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        first = low.get(h or "")
        revisit = first is not None and i != first
        out.append((i, len((h or "").encode()), digest(h), "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


WARC_ROWS = [(1, "http://a/b", "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>"), (2, None, None), (3, "http://x\r\nWARC-Type: q", ""), (4, "u", "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>"),
             (None, "n", "same"), (9, "n", "same"), (8, "n", "same"), (8, "n", "same"), (None, "only", "alone"), (7, "", "漢" * 200_000), (6, "t", "tail\r\n\r\n"), (5, "s", "\n")]


@pytest.mark.parametrize("small", [0, 1000])
def test_archives_round_trip(spark, tmp_path, small, monkeypatch):
    monkeypatch.setattr(warc, "SMALL", small)
    monkeypatch.setattr(warc.with_revisits, "__defaults__", (0, small))
    path = f"file://{tmp_path}/w{small}"
    warc.write_warc(frame(spark, WARC_ROWS).repartition(3), path, records_per_file=3)
    index = spark.read.parquet(f"{path}/index")
    got = warc.read_records(index).collect()
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == expected(WARC_ROWS)
    html = {i: h or "" for i, _, h in WARC_ROWS}
    assert all(bytes(r.payload).decode() == html[r.page_id] for r in got if r.payload is not None and r.page_id is not None)
    assert {r.url for r in got if r.page_id == 3} == {"http://x%0D%0AWARC-Type: q"} and [r.url for r in got if r.page_id == 2] == [None]
    some = warc.read_records(index.where("page_id = 7"))
    assert [bytes(r.payload).decode() for r in some.collect()] == ["漢" * 200_000]
    assert sum(open(f, "rb").read().count(b"WARC-Record-ID") for f in glob.glob(f"{tmp_path}/w{small}/archive/part-*")) == len(WARC_ROWS)


def test_queries_equal_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    got = queries.op5(spark, sf).collect()
    assert sorted(str(tuple(r)) for r in got) == expected(rows)
    texts = {r.page_id: r for r in queries.op7(spark, sf).collect()}
    assert len(texts) == len(rows)
    for i, u, h in rows:
        article = h.split("<article>")[1].split("</article>")[0]
        from html import unescape
        import re
        want = [" ".join(unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article)]
        assert texts[i].text == "\n".join(x for x in want if x) and texts[i].n_chars == len(texts[i].text) and texts[i].url == u


def test_empty_tables(spark, tmp_path):
    warc.write_warc(frame(spark, []), f"file://{tmp_path}/e")
    assert warc.read_records(spark.read.parquet(f"file://{tmp_path}/e/index")).collect() == []
    assert main_text.main_texts(frame(spark, [])).collect() == []


def test_markup_decides(spark):
    page = """<html><head><title>T</title></head><body class="has-sidebar"><header>Site</header><nav>a</nav><div class='cookie-notice'>We use cookies</div><main>
    <h1>A &amp; B&nbsp;c</h1><p>One <b>bold</b>er <i>x</i>\n  y<br>Two</p><script>if (a < b) "</p>"</script><aside>side</aside><form><p>Mail</p></form>
    <!-- <p>no</p> --><div class="comments"><p>nice</p></div><p>1 < 2 &lt;b&gt;</p><div class="ad"><div>buy</div>now</div><ul><li>i1<li>i2</ul></main><footer>f</footer>"""
    rows = [(1, "http://h/1", page), (2, "u", None), (3, None, ""), (4, "http://h/4", "<article></article><p>out</p>"), (4, "http://h/4", "plain text"),
            (5, "http://h/5", "<article><p>a<div class=ad>b</p></div>c"), (6, "http://h/6", "<p>" + "long word " * 20_000 + "</p>"), (7, "http://h/7", "<a href=\"x'>broken <p>t")]
    got = sorted(((r.page_id, r.text) for r in main_text.main_texts(frame(spark, rows)).collect()), key=str)
    want = [(1, "A & B c\nOne bolder x y\nTwo\n1 < 2 <b>\ni1\ni2"), (2, ""), (3, ""), (4, ""), (4, "plain text"), (5, "a\nc"), (6, ("long word " * 20_000).strip())]
    assert [g for g in got if g[0] != 7] == sorted(want, key=str)


def test_host_repeats_are_removed_from_open_pages(spark):
    menu = "<div>Home News Sport Weather Travel Contact us today about our offers</div>"
    foot = "<div>All rights reserved by the example company of this town and county</div>"
    rows = [(k, f"https://site.example/{k}", f"<body>{menu}<div>Story number {k} tells words w{k} x{k}</div>{foot}") for k in range(6)]
    rows += [(10, "https://other.example/1", f"<body>{menu}<div>Alone</div>")]
    rows += [(20 + k, "https://copy.example/1", "<body><div>One and the same page stays whole although it was fetched more than once</div>") for k in range(3)]
    got = {r.page_id: r.text for r in main_text.main_texts(frame(spark, rows)).collect()}
    for k in range(6):
        assert got[k] == f"Story number {k} tells words w{k} x{k}"
    assert got[10].startswith("Home News") and got[10].endswith("\nAlone")
    assert all(got[20 + k].startswith("One and the same page") for k in range(3))


def test_articles_take_part_in_their_host(spark):
    menu = "<div>Home News Sport Weather Travel Contact us today about our offers</div>"
    story = "<h2>A short heading</h2><p>The bridge over the river was closed on Monday after a barge struck it</p>"
    notice = "Please switch off your blocker so that we can go on writing"
    rows = [(1, "https://s.example/1", f"<body>{menu}<article>{story}</article><div>Beside it</div>")]
    rows += [(k, f"https://s.example/{k}", f"<body>{menu}<div>{story}</div><div>{notice}</div><div>Number {k}</div>") for k in (2, 3)]
    rows += [(4, "https://s.example/4", f"<body><nav>{menu}</nav><aside>{notice}</aside><article>Other</article>"), (7, "https://s.example/7", f"<article>{notice}</article>")]
    rows += [(k, f"https://t.example/{k}", f"<body>{story}<div>Number {k}</div>") for k in (5, 6)]
    got = {r.page_id: r.text for r in main_text.main_texts(frame(spark, rows)).collect()}
    told = "A short heading\nThe bridge over the river was closed on Monday after a barge struck it"
    assert got[1] == told and got[4] == "Other" and got[7] == notice
    assert all(got[k] == f"{told}\nNumber {k}" for k in (2, 3))
    assert all(got[k] == f"Number {k}" for k in (5, 6))


def test_every_page_takes_part_in_its_host(spark):
    def page(k, shared):
        return f"<body><nav>Home News Sport Weather Travel Contact us {'today' if shared else k} about our offers</nav><article><p>Story w{k} x{k} y{k}</p></article></body>"

    rows = [(k, f"https://a.example/{k}", page(k, True)) for k in range(4)] + [(9, "https://a.example/9", page(0, True)), (5, "https://a.example/5", page(5, False)),
                                                                              (6, "https://b.example/6", page(6, True)), (7, "https://b.example/7", None)]
    got = {r.page_id: r for r in main_text.main_texts(frame(spark, rows)).collect()}
    assert all(got[k].text == f"Story w{k} x{k} y{k}" for k in (0, 1, 2, 3, 5, 6)) and got[9].text == got[0].text
    # The menu's 11 tokens and the article's first one hold five runs of eight that other pages hold, too; a page's copy is no other page.
    assert {k: r.n_repeated for k, r in got.items()} == {0: 5, 1: 5, 2: 5, 3: 5, 9: 5, 5: 0, 6: 0, 7: 0}


def test_groups_of_suffixes_reach_over_batches():
    rows = {"head": [1, 1, 1, 2, 3, 3, 3, 3], "page": [5, 5, 6, 5, 7, 7, 7, 8], "is_open": [False, False, True, False, True, True, False, False],
            "article": [True, False, False, True, True, False, False, False], "dropped": [False, False, False, False, False, False, False, True]}
    want = [(5, False, 1, True), (6, True, 1, True), (7, False, 3, False), (7, True, 3, False), (8, False, 3, False)]
    for size in (1, 2, 3, 8):
        made = [tuple(r.values()) for b in main_text._repeats(pa.table(rows).to_batches(max_chunksize=size)) for r in b.to_pylist()]
        assert sorted(made) == sorted(want)
