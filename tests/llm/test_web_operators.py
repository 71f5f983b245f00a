"""Archives and page text."""

import hashlib
import math
import random
import time
from html.parser import HTMLParser

import zstandard

from caselattice.llm import common, html_extract, warc


def test_archives_come_back(spark, tmp_path):
    rnd = random.Random(2)
    big = ["".join(rnd.choice("abcdef \r\n") for _ in range(1200)) for _ in range(5)]
    texts = [None, "", "short", "short", "x" * 999, "x" * 999, "x" * 1000, "x" * 1000, "x" * 1000] + [rnd.choice(big) for _ in range(40)] + ["é" * 600_000]
    pages = spark.createDataFrame([(i, f"http://h/{i}\r\nX: 1", bytearray((t or "").encode())) for i, t in enumerate(texts)] + [(None, None, bytearray(b"q"))], "page_id long, url string, payload binary")
    planned = warc.plan_revisits(pages, "page_id", "payload")
    records = planned.selectExpr("page_id AS record_id", "record_type", "refers_to", "url AS uri", "payload", "payload_bytes", "payload_digest")
    folder = f"file://{tmp_path}/w"
    index = warc.write_bundles(records.repartition(3), folder, bundle_bytes=3000, frame_bytes=2500)
    rows = {r.record_id: r for r in warc.read_bundles(spark, folder, index).collect()}
    assert len(rows) == len(texts) + 1
    last = {}
    for i, t in enumerate(texts):
        last[(t or "").encode()] = i
    for i, t in enumerate(texts):
        data, r = (t or "").encode(), rows[str(i)]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        other = len(data) >= 1000 and last[data] != i
        assert (r.record_type, r.refers_to) == (("revisit", str(last[data])) if other else ("response", None))
        assert other and r.payload is None or bytes(r.payload) == data and r.intact
    some = index.where("record_id IN ('3', '8', '20', '49')")
    fetched = {r.record_id: r for r in warc.fetch(folder, some).collect()}
    assert {k: (v.payload, v.payload_digest) for k, v in fetched.items()} == {k: (rows[k].payload, rows[k].payload_digest) for k in ("3", "8", "20", "49")}
    # a bundle is a plain stream of frames, too
    name = index.first().bundle
    with open(f"{tmp_path}/w/{name}", "rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read().startswith(b"WARC/1.1\r\n")
    empty = warc.write_bundles(records.limit(0), f"file://{tmp_path}/e")
    assert warc.read_bundles(spark, f"file://{tmp_path}/e", empty).count() == 0


def kept(page):
    blocks = html_extract.parse_page(page)
    return " ".join(t for (_, t), k in zip(blocks, html_extract.kept_blocks([g for g, _ in blocks])) if k)


def test_page_structure():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar"><header>H</header><nav><a href=x>n</a></nav>
    <div class="cookie-notice">c</div><article><h1>Head&amp;line</h1><p>one <b>two</b>three<br>four&nbsp;five<p>six<script>var t="</p>";</script>
    <div class="ad">buy</div><form><p>f</p></form><ul><li>a<li>b</ul><section id="comments"><p>reader</p></section></article><aside>s</aside><footer>&copy;</footer></body></html>"""
    assert kept(page) == "Head&line one twothree four five six a b"
    assert [t for _, t in html_extract.parse_page(page)] == ["H", "n", "c", "Head&line", "one twothree four five", "six", "buy", "f", "a", "b", "reader", "s", "©"]
    for odd in (None, "", "<", "<p", "a < b > c", "<p>x<!-- never closed", "<script>", "</p></p>x", '<a href="', "<div class='x>y", "plain", "&lt;b&gt; &#65;&bogus;"):
        html_extract.parse_page(odd)
    assert kept("&lt;b&gt; &#65;") == "<b> A" and kept("a < b > c") == "a < b > c" and kept("<div class='x>y") == "y"


def test_names_and_values_of_attributes():
    assert kept('<article style="overflow:hidden"><p>body</p></article>') == "body"
    assert kept('<article><p data-src="/img/hidden.png">a <a href="/x?id=menu">this link</a> <i data-class="ad" class="x">b</i></p></article>') == "a this link b"
    assert kept('<article>x<section class="post-search-engines">s</section><div class="related-work">w</div><p class="share-price">1</p></article>') == "x s w 1"
    assert kept('<article>x<div class="related-posts">r</div><div class="ad-slot-2">a</div><ul id="share_buttons"><li>s</ul></article>') == "x"
    assert kept('<div class="site-header">h</div><p hidden>n</p><p>y</p><div aria-hidden="true">z</div>') == "y"
    assert kept("<main><h1>Headline</h1><p>teaser</p><article>text</article></main>") == "Headline text"
    assert kept("<article><p don't>it's here</p> foo<span class=ad>x</span>bar</article>") == "it's here foobar"


def test_broken_pages_take_time_in_proportion():
    pages = ["<a " * 330_000, '<a href="' * 110_000, "<div>" * 8000 + "</p>" * 8000 + "</span>" * 8000, "<b>" + "<div>" * 8000 + "</b>" * 8000, "<i>" * 8000 + "<h1></h1>" * 8000, "<a href='><b \"" * 60_000, "<script>" + "</script " * 60_000, "<!--" * 200_000, "<" * 1_000_000, "&" * 1_000_000]
    for page in pages:
        began = time.process_time()
        html_extract.parse_page(page)
        assert time.process_time() - began < 1.5, page[:20]


class Reader(HTMLParser):
    """An independent reading of well-formed pages: (what holds the block, text)."""

    def __init__(self, source):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks = [], []
        self.feed(source)

    def handle_starttag(self, tag, attrs):
        self.open.append((tag, dict(attrs).get("class")))

    def handle_endtag(self, tag):
        self.open.pop()

    def handle_data(self, data):
        if data.split():
            chrome = any(tag in ("nav", "footer", "aside") or name in ("ad", "comments") for tag, name in self.open)
            zone = "chrome" if chrome else "article" if ("article", None) in self.open else "plain"
            self.blocks.append((zone, data.split()))


def brute_texts(pages, run, min_pages, share, least):
    """The whole extraction for one host by sets of windows: pages are (id, html)."""
    read = {h: Reader(h).blocks for _, h in pages}

    def keeps(blocks):
        zone = "article" if any(z == "article" for z, _ in blocks) else "plain"
        return [z == zone for z, _ in blocks]

    def text_of(blocks):
        return " ".join(w for (_, ws), k in zip(blocks, keeps(blocks)) if k for w in ws)

    on = {}
    for blocks in read.values():
        words = [w.lower() for _, ws in blocks for w in ws]
        for i in range(len(words) - run + 1):
            on.setdefault(tuple(words[i : i + run]), set()).add(text_of(blocks) or str(blocks))
    n = len({text_of(b) or str(b) for b in read.values()})
    out = {}
    for key, h in pages:
        blocks = read[h]
        words = [(w, z, k) for (z, ws), k in zip(blocks, keeps(blocks)) for w in ws]
        gone = [False] * len(words)
        for i in range(len(words) - run + 1):
            spread = len(on[tuple(w.lower() for w, _, _ in words[i : i + run])])
            for j in range(i, i + run):
                gone[j] |= spread >= (max(least, math.ceil(share * n)) if words[j][1] == "article" else min_pages)
        mine = [g for g, (_, _, k) in zip(gone, words) if k]
        copy = all(mine) or 2 * sum(mine) > len(mine) and any(z == "article" for z, _ in blocks)
        out[key] = (" ".join(w for (w, _, k), g in zip(words, gone) if k and (copy or not g)), len(words), sum(gone), sum(not g and not k for g, (_, _, k) in zip(gone, words)))
    return out


def test_extraction_equals_brute_force(spark):
    rnd = random.Random(53)
    words = [f"w{i}" for i in range(40)] + ["Wort", "the", "&amp;"]
    pieces = [" ".join(rnd.choice(words) for _ in range(rnd.choice([2, 3, 5, 9, 14]))) for _ in range(14)]

    def block():
        return rnd.choice(pieces) if rnd.random() < 0.5 else " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 25)))

    def page():
        frame = ["<nav>{}</nav>", "<div>{}</div>", '<div class="ad">{}</div>', "<p>{}</p>", "<footer>{}</footer>", '<div class="comments">{}</div>']
        body = [rnd.choice(frame).format(block()) for _ in range(rnd.randrange(1, 6))]
        if rnd.random() < 0.4:
            body.insert(rnd.randrange(len(body) + 1), "<article>" + "".join(rnd.choice(frame).format(block()) for _ in range(rnd.randrange(1, 5))) + "</article>")
        return "<html><body>" + "".join(body) + "</body></html>"

    hosts = {f"h{k}.example": [page() for _ in range(n)] for k, n in enumerate((60, 25, 8, 1))}
    hosts["h0.example"] += hosts["h0.example"][:20] + [hosts["h0.example"][3]] * 15
    rows = [(1000 * k + i, f"https://{host}/{i}", h) for k, (host, pages) in enumerate(hosts.items()) for i, h in enumerate(pages)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    expected = {}
    for host in hosts:
        expected |= brute_texts([(i, h) for i, u, h in rows if f"//{host}/" in u], 5, 3, 0.3, 4)
    for group_bytes in (2 << 20, 1500):
        got = html_extract.extract(frame, run_tokens=5, article_share=0.3, article_pages=4, group_bytes=group_bytes).collect()
        assert {r.page_id: (r.text, r.n_tokens, r.n_repeated, r.n_marked) for r in got} == expected and all(r.n_chars == len(r.text) for r in got)
    whole = {i: " ".join(w for _, ws in Reader(h).blocks for w in ws) for i, _, h in rows}
    assert sum(0 < r[2] and r[0] != whole[i] for i, r in expected.items()) > 20


def test_hosts_boilerplate_goes_and_articles_stay(spark):
    rnd = random.Random(4)
    sentence = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    chrome, quote = sentence(20), sentence(30)
    bodies = [sentence(60) + (" " + quote if i % 4 == 0 else "") for i in range(24)]
    plain = [f"<div>{chrome}</div><div>{b}</div>" for b in bodies]
    article = [f"<nav>{chrome}</nav><article><p>{b}</p></article>" for b in bodies]
    rows = [(i, f"https://Plain.example/{i}", h) for i, h in enumerate(plain)] + [(100 + i, f"https://art.example/{i}", h) for i, h in enumerate(article)]
    rows += [(200 + i, "https://copies.example/", f"<article>{bodies[0]}</article>") for i in range(9)] + [(300, None, None), (301, "x", ""), (302, "https://one.example/", f"<p>{chrome}</p>")]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == len(rows)
    for i, b in enumerate(bodies):
        assert got[i].text == (b if i % 4 else b.removesuffix(" " + quote))
        assert got[100 + i].text == b and got[100 + i].n_chars == len(b)
    assert all(got[200 + i].text == bodies[0] for i in range(9))
    assert got[300].text == got[301].text == "" and got[302].text == chrome
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_a_large_host_is_counted_as_a_whole(spark):
    """Three pages that repeat a notice meet in no group, or not all in one; the host's size does not matter."""
    rnd = random.Random(8)
    sentence = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    bodies = [sentence(60) for _ in range(120)]
    rare, notice, twice = sentence(20), sentence(15), sentence(12)
    pages = [f"<div>{b}</div>" + f"<div>{rare}</div>" * (i % 40 == 0) + f"<div>{twice}</div>" * (i in (1, 90)) for i, b in enumerate(bodies)]
    articles = [f"<article><p>{b}</p>" + f"<p>{notice}</p>" * (i % 4 > 0) + "</article>" for i, b in enumerate(bodies)]
    rows = [(i, f"https://big.example/{i}", h) for i, h in enumerate(pages)] + [(1000 + i, f"https://art.example/{i}", h) for i, h in enumerate(articles)] + [(2000 + i, "https://big.example/", pages[7]) for i in range(5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    whole, parted = ({r.page_id: r.text for r in html_extract.extract(frame, group_bytes=b).collect()} for b in (4 << 20, 2500))
    assert whole == parted and len(parted) == len(rows)
    for i, b in enumerate(bodies):
        assert parted[i] == (f"{b} {twice}" if i in (1, 90) else b) and parted[1000 + i] == b
    assert all(parted[2000 + i] == bodies[7] for i in range(5))


def test_repeated_windows_equal_brute_force():
    import numpy as np

    rnd = random.Random(6)
    pages = [[rnd.randrange(3) for _ in range(rnd.randrange(40))] for _ in range(12)]
    tokens = np.array([t for p in pages for t in p])
    page = np.repeat(np.arange(12), [len(p) for p in pages])
    spread, fits = html_extract.repeated_windows(tokens, page, np.arange(12), 5)
    at = 0
    for p in pages:
        for i in range(len(p)):
            assert fits[at] == (i + 5 <= len(p))
            if fits[at]:
                assert spread[at] == sum(any(q[j : j + 5] == p[i : i + 5] for j in range(len(q) - 4)) for q in pages)
            at += 1


def test_shared_folder_is_the_sessions(spark):
    assert common.shared_dir(spark).removeprefix("file:").lstrip("/") == spark.conf.get("spark.checkpoint.dir").removeprefix("file:").lstrip("/")
    table = common.stash(spark.range(5).toDF("id"), "some")
    before = common.release(spark, last=1)
    assert before == 1 and table.count() == 5
    assert common.release(spark) == 0
