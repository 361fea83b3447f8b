"""WARC round trip, URL filter against brute force, main text of hand-made pages."""

import hashlib
import random
import re

import pytest
import zstandard

from aerolith.llm import op2_warc, op3_urlfilter, op4_extract

PAGES = "page_id long, url string, html string, bundle string, payload string"


@pytest.fixture(scope="module")
def pages(spark):
    big, other = "<p>" + "ä word " * 300, "<p>" + "x" * 2000
    rows = [(1, "http://a.org/1", big), (2, None, big), (3, "http://b.com/", "short"), (4, "x", "short"), (5, "http://c/\r\nX: y", None),
            (6, "http://d/", other), (7, "http://d/", big), (None, "http://n/", big), (7, "http://d/2", big), (8, "", "")]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES).repartition(3), rows


def expected(rows):
    payload = [(h or "").encode() for _, _, h in rows]
    out = []
    for (i, _, _), p in zip(rows, payload, strict=True):
        same = [j for (j, _, _), q in zip(rows, payload, strict=True) if q == p and j is not None]
        revisit = len(p) >= 1000 and sum(q == p for q in payload) > 1 and i != max(same)
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


def test_archive_round_trip(spark, pages, tmp_dir):
    df, rows = pages
    manifest = op2_warc.write_archive(df, tmp_dir, frame_bytes=3000, bundle_bytes=1).cache()
    read = op2_warc.read_archive(manifest).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read], key=str) == expected(rows)
    by_id = {i: h for i, _, h in rows}
    assert all(bytes(r.payload).decode() == (by_id[r.page_id] or "") for r in read if r.record_type == "response")
    frames = manifest.collect()
    assert len({f.bundle for f in frames}) > 1 and max(f.frame for f in frames) >= 0
    for f in frames:  # the footer agrees with the manifest, and any reader can read a bundle from front to back
        assert op2_warc.seek_table(f.bundle)[f.frame] == (f.frame_offset, f.frame_bytes, f.raw_bytes)
        fs, path = op2_warc.filesystem(f.bundle)
        data = fs.open_input_file(path).read()
        raw = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert raw.startswith(b"WARC/1.1\r\n")


def test_lookup_reads_one_record(spark, pages, tmp_dir):
    manifest = op2_warc.write_archive(pages[0], tmp_dir, frame_bytes=3000)
    got = op2_warc.lookup(manifest, spark.createDataFrame([(3,), (99,)], "page_id long")).collect()
    assert [(r.page_id, bytes(r.payload)) for r in got] == [(3, b"short")]


def test_empty_archive(spark, tmp_dir):
    manifest = op2_warc.write_archive(spark.createDataFrame([], PAGES), tmp_dir)
    assert op2_warc.read_archive(manifest).count() == 0


URLS = [None, "", "nothing", "http://", "HTTP://A.Example.ORG/es/x?q#f", "http://example.org/en/12", "http://example.org/en/2", "https://org",
        "https://ÄB.org/", "http://x.com/fr/", "http://x.com/de/a", "http://xcom/de/a", "http://com/de/", "http://a.net/p/?utm_source=1&b=2&a=1#z",
        "http://www.a.net/p?a=1&b=2", "http://a.net/p?a=1", "http://u:p@h.net:80/x//", "http://q.net?x=/de/", "http://q.net#/de/",
        "redirect?u=http://w.org/", "http://w.org/a\nb"]


def brute(url, listed, rules=op3_urlfilter.RULES):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url) if url else None
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "block" if url in listed else "allow"


def test_url_rules_and_list(spark):
    listed = {"http://a.net/p/?utm_source=1&b=2&a=1#z", "http://www.a.net/p?a=1&b=2", "http://u:p@h.net:80/x//"}
    df = spark.createDataFrame([(i, u, "c", "c") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, canon string")
    urls = spark.createDataFrame([("http://a.net/p?b=2&a=1",), ("ftp://u:p@h.net:80/x",), (None,), ("no",)], "url string")
    want = [(i, *brute(u, listed)) for i, u in enumerate(URLS * 2)]
    for size in (1 << 20, 0):  # the filter broadcast, and joined through a shuffle
        got = op3_urlfilter.filter_urls(df, urls, broadcast_bytes=size).orderBy("page_id").collect()
        assert [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in got] == want
    nothing = op3_urlfilter.filter_urls(df, urls.where("false")).collect()
    assert len(nothing) == len(want) and not any(r.listed for r in nothing)
    assert op3_urlfilter.filter_urls(df.where("false"), urls).count() == 0


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) as canon")
    n = op3_urlfilter.blocks_for(3000)
    bloom = op3_urlfilter.build_filter(keys, n)
    from pyspark.sql import functions as F

    asked = spark.range(6000).selectExpr("id", "concat('k', id) as canon")
    key = F.col("canon")
    hit = [F.col(f"__w{i}").bitwiseAND(op3_urlfilter._bits(key, i)) == op3_urlfilter._bits(key, i) for i in range(4)]
    got = asked.join(bloom, op3_urlfilter._block(key, n) == F.col("__block")).where(hit[0] & hit[1] & hit[2] & hit[3])
    passed = {r.id for r in got.select("id").collect()}
    assert set(range(3000)) <= passed and len(passed) < 3000 + 150


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{a:b}</style></head><body class="has-sidebar">
<header><h1>Site</h1><a href=/>Home</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav>
<div id="cookie-banner">We use cookies, many of them, for all that you may think of.</div><!-- <p>no</p> -->
%s<h1>Title &amp; more</h1><p>First <b>bold</b>ly &lt;x&gt;  &nbsp; one.<div class="ad-slot"><p>Buy!</p></div>
<p>Sec&#111;nd<br>line<script>var t = "</p><p>no";</script>.</p><form>Name <input> <button>Go</button></form><ul><li>i<li>j</ul>Of.%s
<aside><p>Side text that is rather long, longer than the article itself, so that only its place tells it apart.</p></aside>
<section class="comments"><h3>Comments</h3><p>A reader writes at length about things that are not in the article at all.</p></section>
<footer>&copy; all</footer></body></html>"""
TEXT = "Title & more\nFirst boldly <x> one.\nSecond line.\ni\nj\nOf."


@pytest.mark.parametrize("around", [("<article>", "</article>"), ("<main><article>", "</article></main>"), ('<div class="content">', "</div>")])
def test_main_text(around):
    assert op4_extract.extract(PAGE % around) == TEXT


def test_main_text_of_odd_pages():
    cases = {None: "", "": "", "plain &amp text": "plain & text", "<nav>x</nav>": "", "<p>a<p>b": "a\nb", "<p>cut off <b": "cut off",
             "<article><p>one</p>": "one", "<p>1 < 2 &am": "1 < 2 &am", "<script>x": "", "<article></article>": "", '<p title="a>b">t</p>': "t",
             "<p a='>t</p>": "t", "<!-- open": ""}
    assert {k: op4_extract.extract(k) for k in cases} == cases


def test_main_text_of_pages_with_links_only():
    link = "<a href=/>Click here</a>"
    for page in (link, f"<html><body><div>{link}</div></body></html>", f"<article>{link}</article>", f"<div>{link}</div><main>{link}</main>",
                 f"<ul><li>{link}<li>{link}</ul>"):
        assert op4_extract.extract(page) == ""
    assert op4_extract.extract(f"<article>{link}</article><div><p>Some prose.</p></div>") == "Some prose."
    rng = random.Random(3)
    parts = [link, "<div>", "</div>", "<article>", "</article>", "<p>", "<section>", "</section>", "<nav>", "</nav>", "<br>"]
    for _ in range(500):  # no page without prose fails
        assert op4_extract.extract("".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))) == ""


def test_main_text_without_containers_by_line_blocks():
    links = "<div>" + "".join(f"<div><a href=/{i}>entry {i}</a></div>" for i in range(30)) + "</div>"
    body = "<div>" + "".join(f"<p>Paragraph {i} has some words of prose in it.</p>" for i in range(8)) + "</div>"
    assert op4_extract.extract(links + body + links) == "\n".join(f"Paragraph {i} has some words of prose in it." for i in range(8))


def test_main_text_of_a_table(spark):
    long = "<article>" + "<p>word &eacute;</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, "u", long, "x", 5), (1, "u", long, "x", 5), (2, None, None, None, None)],
                               "page_id long, url string, html string, text string, n_chars long")
    got = sorted((r.page_id, r.text, r.n_chars) for r in op4_extract.main_text(df).collect())
    want = "\n".join(["word é"] * 20_000)
    assert got == [(1, want, len(want)), (1, want, len(want)), (2, "", 0)]
    assert op4_extract.main_text(df.where("false")).columns == ["page_id", "url", "text", "n_chars"]
    assert op4_extract.main_text(df.where("false")).count() == 0


SAY = "A paragraph with enough words in it to make the sum of a window rise above the threshold of a surge."


def test_names_count_for_containers_only():
    inside = ('<h2 id="search-trees">Search trees</h2><h2 id="related-work">Related work</h2><p class="legal">By law.</p><p>See <span class="form">this form</span>.</p>'
              '<div id="search-results-of-trees"><p>Found.</p></div><ul class="menu-of-the-day"><li>Soup</ul>')
    want = "Search trees\nRelated work\nBy law.\nSee this form.\nFound.\nSoup"
    assert op4_extract.extract(f"<article><p>{SAY}</p>{inside}</article>") == f"{SAY}\n{want}"
    for other in ('<div class="cookie-banner">%s</div>', '<section id="post-comments">%s</section>', '<div class="site-footer">%s</div>', '<article class="comment">%s</article>',
                  '<div role="navigation">%s</div>', '<div class="ad_slot_2">%s</div>', '<div class="newsletterSignup">%s</div>', "<div hidden>%s</div>"):
        page = f"<body><article><p>{SAY}</p></article>{other % f'<p>{SAY} {SAY}</p>'}</body>"
        assert op4_extract.extract(page) == SAY, other


def test_sibling_articles_and_headings_stay():
    two = f"<article><h2>One</h2><p>{SAY}</p></article><div><p>Between, short.</p></div><article><h2>Two</h2><p>{SAY}</p><section><p>End.</p></section></article>"
    assert op4_extract.extract(f"<body>{two}</body>") == f"One\n{SAY}\nTwo\n{SAY}\nEnd."
    assert op4_extract.extract(f"<body><p>Home</p><h1>Title</h1><div><p>{SAY}</p><p>Short.</p></div><p>Line</p></body>") == f"Title\n{SAY}\nShort."
    parts = f"<div><p>{SAY}</p></div><div><p>Short.</p></div><div><p>{SAY}</p></div><div><p>After.</p></div>"
    assert op4_extract.extract(f"<body><div><p>Before.</p></div>{parts}</body>") == f"{SAY}\nShort.\n{SAY}"


def test_surges_decide():
    """Text lengths over windows choose: without them other text would be kept."""
    teaser = "<article><p>Teaser.</p></article>"
    assert op4_extract.extract(f"{teaser}<div><p>{SAY}</p></div>") == SAY  # the element with a name has no surge
    assert op4_extract.extract(f"{teaser}<article><p>{SAY}</p></article>") == SAY
    assert op4_extract.extract(teaser + "<div><p>Note.</p></div>") == "Teaser."  # nothing surges
    short = "<p>Twenty-nine letters of prose.</p>"
    assert op4_extract.extract(f"<div>{short}</div><div>{short * 3}</div><div>{short}</div>") == "\n".join(["Twenty-nine letters of prose."] * 3)


def test_stretches_against_a_plain_count():
    rng = random.Random(8)
    for _ in range(300):
        lines = op4_extract.Lines()
        for _ in range(rng.randint(1, 40)):
            text = "" if rng.random() < 0.5 else "x" * rng.randint(1, 60)
            lines.add(text, rng.randint(0, len(text)), 0, 0, False)
        prose = [len(t) - k for t, k in zip(lines.text, lines.link, strict=True)]
        w = op4_extract.WINDOW
        sums = [sum(prose[max(0, i - w + 1) : i + 1]) for i in range(len(prose))]
        there = [any(lines.text[max(0, i - w + 1) : i + 1]) for i in range(len(prose))]
        want, start = [], None
        for i, t in enumerate([*there, False]):
            if t and start is None:
                start = i
            if not t and start is not None:
                want.append((start, i, sum(prose[start:i]), max(sums[start:i])))
                start = None
        assert [s[:4] for s in op4_extract.stretches(lines)] == want


def test_odd_markup_takes_time_in_proportion():
    import time

    n = 20_000
    for page, text in (("<i>" * n + SAY, SAY), ("<p><i>a" * n, "\n".join(["a"] * n)), ('<a href="' * n, ""), ("<b x='" * n + SAY, ""), (f"<p title=don't>{SAY}</p>", SAY),
                       (f'<p title="a>b" class=\'c"d\'>{SAY}</p>', SAY), (f'<p title="open>{SAY}</p><p>{SAY}</p>', f"{SAY}\n{SAY}")):
        start = time.time()
        assert op4_extract.extract(page) == text, page[:20]
        assert time.time() - start < 5
