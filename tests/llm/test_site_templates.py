from __future__ import annotations

from shoplane.llm import site_templates as st

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>A</a></ul></nav><div class="layout has-sidebar"><aside>side</aside>
<article><h1>Title &amp; more</h1><p><b>First   para<br>goes on&nbsp;here.<p>Second <i>one</i>.</p><pre>code</pre>
<div class="share-buttons">Share</div></article></div><section id="comments"><article class="comment">nice</article></section>
<div class=cookie-notice>We use cookies</div><form>mail <input></form><footer>&copy;</footer></body></html>"""
TEXT = "Title & more\nFirst para goes on here.\nSecond one.\ncode"


def test_article_without_surroundings():
    assert st.main_text(PAGE) == TEXT


def test_odd_html():
    assert st.main_text(None) == st.main_text("") == ""
    assert st.main_text("just text") == "just text"
    assert st.main_text("<p>a<p>b") == "a\nb"
    assert st.main_text("<article><p>cut off in a ta<b") == "cut off in a ta"
    assert st.main_text("<p>1 < 2 &lt;3</p><!-- no --><p>x<!-- open") == "1 < 2 <3\nx"
    assert st.main_text("<article><p>a</b></i></div>b</article>") == "ab"
    assert st.main_text("<script>never closed <p>x") == ""
    assert st.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    long = "word " * 200_000
    assert st.main_text(f"<article><p>{long}</p></article>") == long.strip()


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, subtrees string")


def site(k):
    # no main element and no telling names: only repetition tells the template
    return f"<html><body><div class=x1><p>Welcome to our site, enjoy</p></div><div class=x2><p>Story {k} begins</p><p>and ends {k}</p></div></body></html>"


def test_template_of_a_host_goes(spark):
    rows = [(k, "http://a.example/%d" % k, site(k), "x", "y", "z") for k in range(8)]
    rows += [(100, "http://b.example/1", site(1), None, None, None), (None, None, None, None, None, None), (101, None, site(2), "", "", "")]
    got = {(r["page_id"], r["url"]): r["text"] for r in st.extract(pages(spark, rows)).collect()}
    assert got[(3, "http://a.example/3")] == "Story 3 begins\nand ends 3"
    assert got[(100, "http://b.example/1")].startswith("Welcome")       # too few pages to tell
    assert got[(None, None)] == "" and len(got) == 11


def test_copies_of_one_page_are_no_template(spark):
    rows = [(k, "http://a.example/same", site(0), None, None, None) for k in range(9)]
    got = [r["text"] for r in st.extract(pages(spark, rows)).collect()]
    assert got == ["Welcome to our site, enjoy\nStory 0 begins\nand ends 0"] * 9


def test_paragraphs_of_articles_stay_though_they_recur(spark):
    html = "<html><body><article><p>Licence line that recurs</p><p>own text %d</p></article></body></html>"
    rows = [(k, "http://a.example/%d" % k, html % k, None, None, None) for k in range(9)]
    assert all(r["text"].startswith("Licence line that recurs\nown") for r in st.extract(pages(spark, rows)).collect())


def test_shuffled_templates_and_empty_table(spark, monkeypatch):
    rows = [(k, "http://a.example/%d" % k, site(k), None, None, None) for k in range(8)]
    monkeypatch.setattr(st, "BROADCAST_ROWS", 0)
    assert all(r["text"].startswith("Story") for r in st.extract(pages(spark, rows)).collect())
    assert st.extract(pages(spark, [])).collect() == []


def test_host(spark):
    urls = ["http://A.example:80/x", "https://u@b.example?q", "//c.example", "nothing", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(st.host(df["u"])).collect()] == ["a.example", "b.example", "c.example", "", ""]


def test_blocks_of_a_section_go(spark):
    # five sections of six pages: a section's own sidebar, without a telling name, is on a fifth of the host's pages
    page = "<html><body><div class=x1><p>Read more about topic %d here</p></div><div class=x2><p>Story %d of %d, told at length</p></div></body></html>"
    rows = [(10 * s + k, f"http://a.example/topic{s}/{k}", page % (s, k, s), None, None, None) for s in range(5) for k in range(6)]
    got = {r["page_id"]: r["text"] for r in st.extract(pages(spark, rows)).collect()}
    assert got == {10 * s + k: f"Story {k} of {s}, told at length" for s in range(5) for k in range(6)}


def test_blocks_from_a_pool_go_by_their_count(spark):
    # one section only, and each of five variants on a fifth of the pages; a heading as frequent stays
    page = "<html><body><div class=x1>Buy our product %d</div><div class=x2><h2>Chapter %d</h2><p>Story %d, told at length</p></div></body></html>"
    rows = [(k, f"http://a.example/{k}", page % (k % 5, k % 5, k), None, None, None) for k in range(5 * st.MANY_PAGES)]
    got = {r["page_id"]: r["text"] for r in st.extract(pages(spark, rows)).collect()}
    assert got == {k: f"Chapter {k % 5}\nStory {k}, told at length" for k in range(len(rows))}
    few = {r["page_id"]: r["text"] for r in st.extract(pages(spark, rows[:5 * st.MANY_PAGES - 5])).collect()}
    assert few[7].startswith("Buy our product 2\n")


def test_sections(spark):
    urls = ["http://a.example/en/1?x=/y/", "http://a.example/en/", "http://a.example/en", "http://a.example/?q=/b/c", "nothing/x/", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(st.section(df["u"])).collect()] == ["en", "en", "", "", "", ""]


def test_no_task_gathers_the_subtrees_of_a_host(spark, monkeypatch):
    rows = [(k, "http://a.example/x/%d" % k, site(k), None, None, None) for k in range(8)]
    for limit in (st.BROADCAST_ROWS, 0):
        monkeypatch.setattr(st, "BROADCAST_ROWS", limit)
        seen = []
        monkeypatch.setattr(st, "stage", lambda df, name: seen.append(df._jdf.queryExecution().toString()) or df)
        templates = st.site_templates(pages(spark, rows))
        plans = "".join(seen) + templates._jdf.queryExecution().toString()
        assert "collect_list" not in plans and "collect_set" not in plans and "Window" not in plans
        assert templates.count() == 4          # the div and its paragraph, of the host and of its section


def test_near_copies_keep_their_text(spark):
    # four bodies that differ in a date and an advert only; in the second site the date stands among the paragraphs
    text = "A long story that is told here and goes on for a while. " * 5
    whole = "<html><body><div class=x0>Visit our other sites</div><p>2024-01-0%d</p><div class=x1><h2>Title</h2><p>" + text + "</p></div></body></html>"
    parts = "<html><body><div class=x1><p>2024-01-0%d</p><h2>Title</h2><p>" + text + "</p><p>The end.</p></div></body></html>"
    rows = [(k, f"http://a.example/{k}", whole % k, None, None, None) for k in range(4)]
    rows += [(10 + k, f"http://b.example/{k}", parts % k, None, None, None) for k in range(4)]
    got = {r["page_id"]: r["text"] for r in st.extract(pages(spark, rows)).collect()}
    assert got == {k: f"2024-01-0{k % 10}\nTitle\n{text.strip()}" + ("\nThe end." if k >= 10 else "") for k in (0, 1, 2, 3, 10, 11, 12, 13)}


def test_comments_end_as_in_browsers():
    assert st.main_text("<p>a<!-->b</p><p>c</p>") == "ab\nc"
    assert st.main_text("<p>a<!--->b</p>") == "ab"
    assert st.main_text("<p>a<!-- x --!>b</p><p>c</p>") == "ab\nc"
    assert st.main_text("<p>a<!---->b<!-- > -- -->c</p>") == "abc"


BODY = "<h1>Title</h1><p>" + "The story goes on and on. " * 20 + "</p>"
WHOLE = "Title\n" + " ".join(["The story goes on and on."] * 20)


def test_named_boxes_inside_and_outside_of_the_article():
    for name in sorted(st.DROPPED_NAMES):
        box = f'<div class="{name}">Some other words</div>'
        assert st.main_text(f"<body>{box}<article>{BODY}</article></body>") == WHOLE, name
        assert st.main_text(f"<body><article>{BODY}{box}</article></body>") == WHOLE, name
        assert st.main_text(f'<body><article>{BODY}<p id="page-{name}">Some other words</p></article></body>') == WHOLE, name


def test_named_parts_of_the_article_stay():
    for name in sorted(st.TITLE_NAMES):      # the title's own box
        assert st.main_text(f'<article><div class="article-{name}"><h1>Title</h1></div>{BODY.split("</h1>")[1]}</article>') == WHOLE
    for name in sorted(st.PART_NAMES):       # a layout element with most of the text
        assert st.main_text(f'<article><div class="{name}-layout">{BODY}</div></article>') == WHOLE
    assert st.main_text(f'<article class="related">{BODY}</article>') == WHOLE


def test_counts_against_plain_python(spark):
    """Template keys equal those of a plain count of page bodies per host and per section."""
    import random
    rng = random.Random(5)
    rows = []
    for k in range(240):
        h, s = rng.choice(["a", "a", "a", "b", "c"]), rng.choice(["x", "y", "z", ""])
        parts = [f"<div class=k{j}><p>Block {j} of {h if j % 2 else s}</p></div>" for j in range(8) if rng.random() < 0.1 * (j + 1)]
        html = f"<body>{''.join(parts)}<div class=t><h2>Chapter {k % 3}</h2><p>Story {k if rng.random() < 0.9 else 0}</p></div></body>"
        rows.append((k, f"http://{h}.example/{s}/{k}" if s else f"http://{h}.example/{k}", html, None, None, None))
    bodies, found = {}, {}
    for _, url, html, *_ in rows:
        h, _, rest = url.removeprefix("http://").partition("/")
        body, subtrees = st.template_candidates(html)
        for scope in [(h,)] + ([(h, rest.split("/")[0])] if "/" in rest else []):
            bodies.setdefault(scope, set()).add(body)
            for t, outer in subtrees.items():
                n = found.setdefault((scope, t), {})
                n[body] = n.get(body, False) or (outer and len(scope) == 1)
    hashes = {tuple(r["p"]): r["x"] for r in spark.createDataFrame([(list(s),) for s in bodies], "p array<string>").selectExpr(
        "p", "if(size(p) = 1, xxhash64(p[0]), xxhash64(p[0], p[1])) AS x").collect()}
    want = set()
    for (scope, t), n in found.items():
        if len(n) >= st.MIN_PAGES and len(n) >= st.MIN_SHARE * len(bodies[scope]):
            want.add(hashes[scope] ^ t)
        elif sum(n.values()) >= 20:
            want.add(~(hashes[scope] ^ t))
    got = {r["key"] for r in st.site_templates(pages(spark, rows), many_pages=20).collect()}
    assert got == want and len(want) > 10 and any(len(s) == 2 for s in bodies)
