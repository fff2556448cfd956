"""HTML, WARC, URL rules, fingerprints and the pipeline."""

import os

from pyspark.sql import functions as F

import corpus_pipeline
from opinion_spark.llm import fingerprint, html, urls, warc
from opinion_spark.llm.common import scratch
from tests.llm import helpers as H

PAGE_SCHEMA = "page_id long, url string, html string"
SAME = "<div><p>" + "a" * 200 + "</p></div>"
PAGES = [(H.BIG, "http://A.com/x", "<p>hello, world</p>"), (None, None, None), (1, "nope", ""), (2, "http://www.Example.com/en/q?x", SAME),
         (3, "http://b.net/es/%41 \n", SAME), (3, "http://b.net/es/", SAME), (5, "://", "&lt;b <a href='x"), (6, "http://com/", "<" * 500 + "<p class=\"x" * 300)]


def pages(spark):
    out = spark.createDataFrame(PAGES, PAGE_SCHEMA)
    for name in ("file", "offset", "rest", "n_chars"):
        out = out.withColumn(name, F.lit("clash"))
    return out


def test_article_without_the_rest():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav><div id="cookie-notice">We use cookies</div>
    <div class="layout"><article><h2>Head &amp; line</h2><p><b>First, <a href=x>linked</a>&nbsp;text<br>next   line<p>Second &lt;tag&gt; &eacute;
    <div class="ad">Buy</div><!-- <p>no</p> --><ul><li>one<li>two</ul><form><p>Mail?</p></form><p>Last</article>
    <aside><p>Elsewhere, and more, of that</p></aside><section class="comments"><p>Nice, very nice, I like it a lot</p></section></div>
    <script>var t="</p><p>x</p>";</script><footer>&copy; us</footer></body></html>"""
    assert html.main_text(page) == "Head & line\n\nFirst, linked text next line\n\nSecond <tag> \u00e9\n\none\n\ntwo\n\nLast"


def test_container_by_score_without_an_article_element():
    para = "<p>" + "words, and more words, " * 12 + "end.</p>"
    page = f"<body><div><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></div><div><div class=x>{para}{para}</div><p>{'short siblings count, if long enough ' * 4}</p></div></body>"
    got = html.main_text(page).split("\n\n")
    assert len(got) == 3 and "one two" not in got[0]


def test_names_drop_only_weak_containers():
    long = "the prices fell, then rose, and nobody knew why that was so in the end, " * 3
    page = f"""<body><div class="ad">{long}</div><article><header><h1>Own title</h1><p>By X</p></header>
    <p id="share-prices">Share prices <span class="social">and social</span> life <math><mi>x</mi></math> <noscript>plain</noscript> <svg><text>no</text></svg>end</p>
    <h2 id="search-algorithms">Search</h2><section id="discussion"><h3>Discussion</h3><p>{long}</p></section><h2 id="related-work">Related</h2>
    <ul class="share"><li><a href=1>Tweet</a><li><a href=2>Mail</a></ul><div class="promo"><p>Buy now</p></div><div id="comments"><p>{long}</p></div>
    <p>{long}<object>fallback</object></p><ol><li><a href=3>Reference one</a><li><a href=4>Reference two</a></ol></article>
    <div class="sidebar"><p>{long}</p></div></body>"""
    want = ["Own title", "Share prices and social life x plain end", "Search", "Discussion", long.strip(), "Related", long + "fallback", "Reference one", "Reference two"]
    assert html.main_text(page).split("\n\n") == want
    bare = f"<body><h1>T</h1><p>{long}</p><section id='discussion'><p>{long}</p></section><div class=sidebar><p>{long}</p></div></body>"
    assert html.main_text(bare).split("\n\n") == ["T", long.strip(), long.strip()]


def test_unclosed_elements_do_not_swallow_the_page():
    for name in ("math", "noscript", "object", "svg", "select", "video"):
        page = f"<body><div><p>first, of all, a paragraph</p><div><{name}></div><p>second, and last, paragraph</p></div></body>"
        assert html.main_text(page) == "first, of all, a paragraph\n\nsecond, and last, paragraph", name


LONG_P = "<p>" + "word, and more of it. " * 20 + "</p>"
LONG = " ".join(["word, and more of it."] * 20)


def test_quotes_open_values_only():
    page = '<article><p>Start <a href="x"">the linked words</a> and "quoted text" here, it goes on.</p><p data-x=Bob\'s>It\'s fine, all of it.</p><p title = \'a > b\' x="c > d">End</p><p a="b>never closed</p></article>'
    assert html.main_text(page) == 'Start the linked words and "quoted text" here, it goes on.\n\nIt\'s fine, all of it.\n\nEnd\n\nnever closed'


def test_forms_around_the_page_stay():
    wrapped = f'<body><form action=x><div class="nav"><a href=y>menu</a></div><div class="post"><h1>Title</h1>{LONG_P}</div><input name=q><label>Search</label><button>go</button></form></body>'
    assert html.main_text(wrapped) == f"Title\n\n{LONG}"
    inside = f'<article>{LONG_P}<form><p>Sign up for our letter.</p><input><fieldset><legend>Your name</legend></fieldset></form></article>'
    assert html.main_text(inside) == LONG


def test_headers_keep_the_title():
    assert html.main_text(f'<div class="post"><header><h1>Title</h1><p>by someone, in May</p></header>{LONG_P}</div>') == f"Title\n\n{LONG}"
    site = f'<div class="content"><header class="site-header"><h1>The Daily</h1></header>{LONG_P}</div>'
    assert html.main_text(site) == LONG


def test_adverts_notices_and_comments_go_whatever_their_length():
    extra = "".join(f'<div class="{c}">{"buy it now, " * 30}</div>' for c in ("advert", "ad", "newsletter-box", "cookie notice", "comments"))
    extra += "".join(f'<p class="{c}">{"buy it now, " * 30}</p>' for c in ("advert", "notice", "comment", "big promo"))
    stays = '<h2 id="search-algorithms">Search</h2><section id="discussion"><p>Talk</p></section><p id="share-prices">Prices</p><p class="ad-hoc">Rules</p><p>a <span class="notice">b</span></p>'
    assert html.main_text(f"<article>{LONG_P}{extra}{stays}</article>") == "\n\n".join([LONG, "Search", "Talk", "Prices", "Rules", "a b"])


def test_broken_pages_end():
    for page in ("<p>a", "<p", "<!-- x", "<script>x", "<p title='a>b</p>", "<" * 3000, "</p></div>text", "<a href=" + "'\"" * 2000):
        html.main_text(page)
    assert html.main_text(None) == html.main_text("") == html.main_text("<nav>x</nav>") == ""


def test_extract_rows(spark):
    got = {(r.page_id, r.url): r for r in html.extract(pages(spark), ["page_id", "url"]).collect()}
    assert len(got) == len(PAGES) and got[H.BIG, "http://A.com/x"].text == "hello, world"
    assert got[None, None].text == "" and all(r.n_chars == len(r.text) for r in got.values())
    assert html.extract(pages(spark).limit(0), ["page_id"]).count() == 0


def test_warc_round_trip(spark):
    folder = scratch(spark, "warc")
    index = warc.write_warc(warc.classify(pages(spark)), folder)
    got = warc.read_warc(index, folder).collect()
    want = []
    for i, url, text in PAGES:
        first = 2 if text == SAME and i != 2 else None
        want.append((i, url, len((text or "").encode()), H.sha(text or ""), "revisit" if first else "response", first))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    some = warc.read_warc(index.where("page_id = 3"), folder, gap=0).collect()
    assert {r.page_id for r in some} == {3} and len(some) == 2
    empty = warc.write_warc(warc.classify(pages(spark).limit(0)), folder)
    assert warc.read_warc(empty, folder).count() == 0


def test_warc_file_is_readable_on_its_own(spark):
    import gzip

    folder = scratch(spark, "warc")
    warc.write_warc(warc.classify(pages(spark).coalesce(1)), folder)
    (name,) = os.listdir(folder.removeprefix("file:"))
    data = gzip.open(os.path.join(folder.removeprefix("file:"), name)).read()
    assert data.count(b"WARC/1.1\r\n") == len(PAGES) and data.startswith(b"WARC/1.1\r\nWARC-Type: ") and data.endswith(b"\r\n\r\n")
    heads = [dict(x.split(": ", 1) for x in part.split("\r\n\r\n")[0].split("\r\n") if ": " in x) for part in data.decode().split("WARC/1.1\r\n")[1:]]
    names = [h["WARC-Record-ID"] for h in heads]
    assert all(n.startswith("<urn:uuid:") for n in names) and all(h["WARC-Refers-To"] in names for h in heads if h["WARC-Type"] == "revisit")
    assert sum("WARC-Target-URI" in h for h in heads) == sum(u is not None for _, u, _ in PAGES)
    rows = {(i, t) for i, _, t in PAGES if i is not None}
    assert len(set(names)) >= len(rows)


def brute_rule(host, path, rules):
    fits = [(len(r), r, v) for r, v in rules if (host == (h := r.split("/")[0]) or host.endswith("." + h)) and path.startswith(r[len(h):])]
    return max(fits)[1:] if fits else (None, "allow")


def test_urls_against_every_rule(spark):
    rules = urls.RULES + [(f"site{i}.org/p{i % 7}", "block") for i in range(500)] + [("org/", "allow"), ("a.b.example.com/", "block")]
    data = [(i, f"https://{s}site{i % 600}.org/p{i % 5}x/{i}?q#f") for i, s in enumerate(["", "www.", "WWW.M.", "x"] * 300)]
    data += [(9000 + i, u) for i, u in enumerate(["http://example.com/en/", "http://www.example.com/en/a", "http://wwwexample.com/en/", "http://a.net/es", "http://a.net/es/",
                                                  "HTTP://NET/fr/x", "http://x.com", "http://x.com?/", "http://h://net/es/", "http://a.b.example.com/en/", None, "", "x", "://", "http://.com/"])]
    df = spark.createDataFrame(data, "page_id long, url string")
    got = urls.judge_urls(df, spark.createDataFrame(rules, "rule string, verdict string")).collect()
    assert len(got) == len(data)
    for r in got:
        rest = r.url.split("://", 1)[1] if r.url and "://" in r.url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut].lower(), rest[cut:].split("#")[0].split("?")[0]
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == brute_rule(host, path, rules)
    none = urls.judge_urls(df, spark.createDataFrame([], "rule string, verdict string"))
    assert {r.verdict for r in none.collect()} == {"allow"} and urls.judge_urls(df.limit(0), spark.createDataFrame(rules, "rule string, verdict string")).count() == 0


def test_urls_among_clashing_columns(spark):
    """Columns named like the results are replaced, also if one of them is the URL; others stay, whatever their names."""
    rules = spark.createDataFrame([("b.com/", "block")], "rule string, verdict string")
    page = spark.createDataFrame([(1, "http://a.b.com/x", "old", "kept", 7)], "page_id long, rule string, host string, bloom_block string, w0 int")
    out = urls.judge_urls(page, rules, url="rule")
    assert out.columns == ["page_id", "bloom_block", "w0", "host", "path", "rule", "verdict"]
    assert tuple(out.first()) == (1, "kept", 7, "a.b.com", "/x", "b.com/", "block")


def test_bloom_has_no_false_negatives_and_few_hits(spark):
    listed = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("k"))
    f = urls.bloom(listed, "k", 64)
    assert urls.possible(listed, "k", f, 64).count() == 2000
    others = spark.range(20000).select(F.concat(F.lit("z"), "id").alias("k"))
    assert urls.possible(others, "k", f, 64).count() < 1000


def test_fingerprints_against_plain_python(spark):
    long = [" ".join(f"t{(i * j) % 509}" for j in range(1, 400)) for i in range(1, 30)]
    data = [(i * 3, t, "", "", 0) for i, t in enumerate(long)] + [(200, long[0], "", "", 0), (201, long[0], "", "", 0), (202, None, "", "", 0), (203, "a b \u00e9\U0001f600", "", "", 0)]
    for n in (1, 3, 50):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        got = {r.doc_id: r for r in fingerprint.fingerprints(H.docs(spark, data)).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        texts = [r[1] or "" for r in data]
        assert len(got) == len(data)
        for k, row in enumerate(data):
            nxt = texts[(k + 1) % len(data)]
            r = got[row[0]]
            assert (r.n_chars, r.edited_sha256) == (len(texts[k]), H.sha(H.edited(texts[k], nxt)))
            a, b = H.shingles(texts[k], False), H.shingles(nxt, False)
            true = len(a & b) / max(1, min(len(a), len(b)))
            assert 0 <= r.near_edited <= 1 and (abs(r.near_next - true) < 0.25 or not a or not b)
        assert got[0].fingerprint == got[200].fingerprint == got[201].fingerprint != got[3].fingerprint
        assert got[200].near_next == 1.0 and got[202].fingerprint == ""


def test_fingerprint_awkward_rows_and_merge(spark):
    got = fingerprint.fingerprints(H.docs(spark)).collect()
    assert len(got) == len(H.DOCS) and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    assert fingerprint.fingerprints(H.docs(spark).limit(0)).count() == 0
    one = fingerprint.fingerprints(H.docs(spark, H.DOCS[:1])).first()
    assert one.near_next == 1.0 and one.doc_id == H.BIG
    t = spark.createDataFrame([("a b c d e f g h", "u v w x y z 1 2 3")], "p string, q string")
    t = t.withColumn("r", F.concat_ws(" ", "p", "q"))
    for c in ("p", "q", "r"):
        t = fingerprint.add_sketch(t, c, "s" + c)
    assert t.select(fingerprint.containment(F.col("sp"), fingerprint.merge(F.col("sp"), F.col("sq")))).first()[0] in (0.0, 1.0)


def test_pipeline_ends_in_tokens(spark):
    docs = H.docs(spark)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert sorted(r.decoded for r in got) == sorted(r[1] or "" for r in H.DOCS)
    assert all(len(r.ids) == r.n_tokens for r in got)


def test_pipeline_stages(spark, tmp_path):
    H.docs(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(H.BIG, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    kept = [r.doc_id for r in corpus_pipeline.distinct_documents(spark, docs, str(tmp_path)).collect()]
    # the row without an id is a copy of document 4, so it goes like any other copy
    assert sorted(x for x in kept if x is not None) == [2, 3, 4, 5, 7, 8, 9] and kept.count(None) == 0
    assert [r.doc_id for r in corpus_pipeline.languages(spark, docs, str(tmp_path)).where("doc_id in (2, 3, 7)").collect()] == []
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
