"""Main text of pages, by rules and by subtrees that recur on a host."""

from collections import Counter

import pytest

from lakeproof.llm.pages import extract_pages, host_of, parse, segments, subtree_hashes
from lakeproof.llm.support import table
from tests.llm.fixtures import prose


def text_of(source):
    return " ".join(segments(parse(source))[0])


@pytest.mark.parametrize("source, expected", [
    ("", ""),
    ("plain text &amp; more <", "plain text & more <"),
    ("<p>a<table><tr><td>1<td>2<tr><td>3</table><pre> x\n y</pre>", "a 1 2 3 x y"),
    ("<article><h1>T</h1><p><b>o</b>ne<br>two<p>three</article><footer>f</footer>", "T one two three"),
    ("<body><header>Top</header><nav><ul><li>m</nav><div id=content><p>Body &eacute;&#33; &nbsp; x</p></div></body>", "Body é! x"),
    ("<main><h1>H</h1><article><header><h2>h</h2></header><p>a</p><aside>q</aside></article></main><p>out", "H h a"),
    ("<article><p>a</p><form>f<input value='>'></form><div class='ad box'>b</div><section id=comments><p>c</p></section></article>", "a"),
    ("<article class=story>s</article><article class='comment'>c</article>", "s"),
    ("<script>var t='</p><p>no';</script><style>p{}</style><p>yes<!-- <p>no --></p><noscript>n</noscript>", "yes"),
    ('<a href="x>y" title=\'<p>\'>link</a> tail', "link tail"),
    ("<div role=navigation>n</div><div class='leads'>kept</div><div class='cookie-notice'>c</div>", "kept"),
    ("<p>cut &am", "cut &am"), ("<p>cut<a hre", "cut"), ("<p>un<b>closed <i>x</p><p>next", "unclosed x next"),
    ("<article></article><p>only here</p>", "only here"),
])
def test_rules(source, expected):
    assert text_of(source) == expected


def test_hosts():
    assert host_of("https://user@WWW.Example.com:80/a?b") == "example.com" and host_of("//x.y/z") == "x.y"
    assert host_of(None) == "" and host_of("no host") == ""


def test_deep_and_long_pages():
    assert text_of("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert len(text_of("<p>" + "word " * 200_000)) == 5 * 200_000 - 1


def pages(spark, rows):
    schema = "page_id bigint, url string, html string, host string, template int, segments string"
    return spark.createDataFrame([(*r, "h", 1, "s") for r in rows], schema)


def result(frame):
    return sorted((str(r["page_id"]), r["text"], r["n_chars"]) for r in frame.collect())


def test_what_recurs_on_a_host_goes(spark):
    box = "<div class=x7><p>Buy our <b>things</b> today</p></div>"
    line = "<div class=x9>Part of the series</div>"
    rows = [(k, f"http://a.example/{k}", f"<body>{box}<div><p>Story {k}</p><p>The end.</p></div><section>tail {k % 2}</section></body>") for k in range(10)]
    rows += [(100, "http://b.example/", f"<body>{box}<p>Single</p></body>")]
    rows += [(200 + k, "http://c.example/", f"<body>{box}</body>") for k in range(6)]
    rows += [(300 + k, f"http://d.example/{k}", f"<article><p>The end.</p><p>Text {k}</p>{line}</article>") for k in range(8)]
    rows += [(400, None, None), (401, "x", ""), (None, "http://a.example/z", "<p>Extra</p>"), (402, "http://e.example/", box), (402, "http://e.example/", box)]
    # the last paragraph is on nearly all pages of its host, each section on less than half of them
    expected = [(str(k), f"Story {k} tail {k % 2}") for k in range(10)]
    expected += [("100", "Buy our things today Single")] + [(str(200 + k), "Buy our things today") for k in range(6)]
    expected += [(str(300 + k), f"The end. Text {k}") for k in range(8)]
    expected += [("400", ""), ("401", ""), ("None", "Extra"), ("402", "Buy our things today"), ("402", "Buy our things today")]
    found = result(extract_pages(pages(spark, rows).repartition(4)))
    assert found == sorted((i, t, len(t)) for i, t in expected)


def test_a_block_on_a_tenth_of_a_large_host_goes(spark):
    box = "<div class=x7><p>Read on in our <b>series</b></p></div><ul><li>one</li><li>two</li></ul>"
    line = "<p>The end.</p>"
    rows = [
        (k, f"http://a.example/{k}", f"<body>{box if k % 10 == 0 else ''}<div><p>Story {k}</p>{line}</div><article><p>Text {k}</p>"
         f"{line if k % 10 else ''}</article></body>" if k % 2 else f"<body>{box if k % 10 == 0 else ''}<p>Story {k}</p></body>")
        for k in range(1000)
    ]
    expected = [(str(k), (f"Text {k} The end." if k % 10 else f"Text {k}") if k % 2 else f"Story {k}") for k in range(1000)]
    assert result(extract_pages(pages(spark, rows))) == sorted((i, t, len(t)) for i, t in expected)


def test_a_story_that_recurs_stays(spark):
    story, box = prose(60, 1), f"<div class=x7><p>{prose(12, 2)}</p></div>"
    own = [f"<h1>Title {k}</h1>{box}<div class=text><p>{prose(20, 10 + k)}</p><p>{prose(30, 50 + k)}</p></div>" for k in range(60)]
    shared = [f"<h1>Title {k}</h1>{box}<div class=text>{{}}</div><p>viewed {k} times</p>" for k in range(6)]
    alone = [(k, f"http://b.example/{k}", shared[k].format(f"<p>{story}</p>")) for k in range(6)]
    assert {r["text"] for r in extract_pages(pages(spark, alone)).collect()} == {f"Title {k} {prose(12, 2)} {story} viewed {k} times" for k in range(6)}
    for written in (f"<p>{story}</p>", "".join(f"<p>{' '.join(story.split()[n:n + 12])}</p>" for n in range(0, 60, 12))):
        rows = [(k, f"http://a.example/{k}", s.format(written)) for k, s in enumerate(shared + own)]
        found = {r["page_id"]: r["text"] for r in extract_pages(pages(spark, rows)).collect()}
        assert all(found[k] == f"Title {k} {story} viewed {k} times" for k in range(6))
        assert all(found[6 + k] == f"Title {k} {prose(20, 10 + k)} {prose(30, 50 + k)}" for k in range(60))


def plain(rows):
    """Templates counted and cut with lists and loops, element by element."""
    parsed = [(host_of(url), parse(html or "")) for _, url, html in rows]
    sizes = Counter(host for host, _ in parsed)
    on = Counter((host, h) for host, page in parsed for h in subtree_hashes(page))
    results = []
    for (page_id, _, _), (host, page) in zip(rows, parsed):
        texts, blocks = segments(page)
        wide, few = set(), set()
        for h, first, end in blocks:
            many = on[host, h]
            if many >= 5 and many >= 0.5 * sizes[host]:
                wide |= set(range(first, end))
            elif many >= 6 and h % 2 == 0:
                few |= set(range(first, end))
        gone = set()
        for cut in (wide, few):
            long = {k: len(t.split()) for k, t in enumerate(texts) if len(t.split()) >= 8 and k not in gone}
            story = 2 * sum(n for k, n in long.items() if k in cut) > sum(long.values())
            gone |= cut - set(long if story else ())
        kept = [t for k, t in enumerate(texts) if k not in gone] or texts
        results.append((str(page_id), " ".join(kept), len(" ".join(kept))))
    return sorted(results)


def test_templates_equal_a_plain_version(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url", "html").collect()]
    assert result(extract_pages(pages(spark, rows))) == plain(rows)


def test_a_deep_page_with_many_runs_is_small():
    """One place for each element, not one for each element around each run."""
    source = "".join(f"<div id=d{k}>" for k in range(500)) + "".join(f"<p>word {k}</p>" for k in range(20_000))
    texts, blocks = segments(parse(source))
    assert len(texts) == 20_000 and len(blocks) == 20_500 and blocks[0][1:] == (0, 20_000)


def test_nothing_in_nothing_out(spark):
    assert extract_pages(pages(spark, [])).collect() == []
