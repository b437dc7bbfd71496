"""The operators on pages: main text and url verdicts."""

import collections
import html
import random
import re
import time

import numpy as np
import pytest

from salescope.llm import html_extract, queries, url_filter

SF = "/root/testdata/sf0.001"


def test_main_text_of_given_pages(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in queries.op1_html_extraction(spark, SF).collect()}
    assert got.keys() == pages.keys()
    for k, p in pages.items():
        inner = p["html"].split("<article>", 1)[1].split("</article>", 1)[0]
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner))).split())
        assert (got[k]["text"], got[k]["n_chars"], got[k]["url"]) == (text, len(text), p["url"])


@pytest.mark.parametrize("page, text", [
    ("<body><nav>a</nav><article><h1>T &amp; U</h1><p>x<br>y <b>bo</b>ld<p>z</article><footer>f", "T & U x y bold z"),
    ("<main><div class='cookie-notice'>c<div>d</div></div><p title='>'>x\n\t y</p><form>q</form><aside>s</aside></main>", "x y"),
    ("<article>a<script>var t='</p>'</script><style>p{}</style><!-- <p>no</p> -->b<section id=comments><p>c</p></section></article>", "ab"),
    ("<article>a &lt;b&gt; 1 < 2 &#233;</article>", "a <b> 1 < 2 é"),
])
def test_markup(page, text):
    assert html_extract.main_text(page) == text


def test_host_repetition_decides_where_markup_does_not(spark):
    note = "please accept all of our many terms before you read on here"
    rows = [(i, f"http://A.example.com/{i}", f"<body><div>{note}</div><div>page {i} says " + " ".join(f"v{i}x{j}" for j in range(30)) + "</div><nav>n</nav>") for i in range(5)]
    rows += [(9, "http://other.org/1", f"<body><p>{note}</p></body>"), (10, None, None), (11, "no scheme", ""), (12, "http://a.example.com/12", f"<article>{note}</article>"),
             (13, "http://a.example.com/0", rows[0][2]), (None, "http://a.example.com/x", "<nav>only</nav>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'c' AS host", "1 AS run", "2 AS content")
    got = {r["page_id"]: r["text"] for r in html_extract.extract_main_text(pages).collect()}
    for i in range(5):
        assert got[i] == f"page {i} says " + " ".join(f"v{i}x{j}" for j in range(30))
    assert got[9] == note and got[10] == got[11] == got[None] == "" and got[12] == note and got[13] == got[0]
    assert html_extract.extract_main_text(pages.limit(0)).count() == 0


def test_rules(spark):
    rows = [(1, "https://WWW.Example.com/en/x?q"), (2, "http://example.com/en/a#b"), (3, "http://a.com/"), (4, "http://a.com"), (5, "http://x.net/es/1"),
            (6, "http://xnet/es/1"), (7, None), (8, "a/b"), (9, "http://blog.example.com/fr/"), (10, "http://é.net/fr/?a://b")]
    pages = spark.createDataFrame([(k, u, None) for k, u in rows], "page_id long, url string, html string").selectExpr("*", "1 AS verdict", "2 AS by_rule")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.filter_urls(pages).collect()}
    assert got[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[2] == ("example.com", "/en/a", "example.com/en/", "block")
    assert got[3][2:] == ("com/", "allow") and got[4] == ("a.com", "", None, "allow")
    assert got[5][2:] == ("net/es/", "block") and got[6][2] is None and got[7] == got[8] == ("", "", None, "allow")
    assert got[9][2:] == ("com/", "allow") and got[10] == ("é.net", "/fr/", "net/fr/", "block")
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_scores_follow_links(spark):
    link = lambda *hosts: " ".join(f'<a href="http://{h}/">x</a>' for h in hosts)
    rows = [(1, "http://bad.net/es/", ""), (2, "http://friend.org/", link("bad.net", "bad.net")), (3, "http://good.com/", link("liked.org")),
            (4, "http://liked.org/", link("bad.net", "good.com")), (5, "http://alone.org/", link("alone.org"))]
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    # liked.org and good.com link to each other: its trust is 0.20, its distrust 0.23
    assert got == {1: "block", 2: got[2], 3: "allow", 4: "block", 5: "allow"}
    links = url_filter.host_links(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {(r["src"], r["dst"], r["n"]) for r in links.collect()} == {
        ("friend.org", "bad.net", 1), ("good.com", "liked.org", 1), ("liked.org", "bad.net", 1), ("liked.org", "good.com", 1)}
    seeds = spark.createDataFrame([("bad.net", 0.0, 1.0), ("friend.org", 0.0, 0.0), ("good.com", 1.0, 0.0), ("liked.org", 0.0, 0.0)], "host string, allowed double, blocked double")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.host_scores(seeds, links).collect()}
    hosts = ["bad.net", "friend.org", "good.com", "liked.org"]
    out = {"friend.org": ["bad.net"], "good.com": ["liked.org"], "liked.org": ["bad.net", "good.com"]}
    trust, distrust = dict.fromkeys(hosts, 0.0), dict.fromkeys(hosts, 0.0)
    into = {h: [s for s in out if h in out[s]] for h in hosts}
    for _ in range(url_filter.STEPS + 1):      # the first gives the seeds, where the operator starts
        trust = {h: 0.15 * (h == "good.com") + 0.85 * sum(trust[s] / len(out[s]) for s in into[h]) for h in hosts}
        distrust = {h: 0.15 * (h == "bad.net") + 0.85 * sum(distrust[d] / len(into[d]) for d in out.get(h, [])) for h in hosts}
    for h in hosts:
        assert got[h][0] == pytest.approx(trust[h], abs=1e-3) and got[h][1] == pytest.approx(distrust[h], abs=1e-3)


@pytest.mark.parametrize("part", ["<a ", "<a \"", "<a '>", "<title>", "<!--", "<article>", "<p><li>", "<div class=has-ad><article>", "&amp", "<main><div class=ad>", "<b"])
def test_a_malformed_page_takes_linear_time(part):
    seconds = []
    for size in (1 << 18, 1 << 20):
        page = part * (size // len(part))
        begin = time.perf_counter()
        html_extract.blocks_of(page)
        seconds.append(time.perf_counter() - begin)
    assert seconds[1] < max(12 * seconds[0], 0.5)


@pytest.mark.parametrize("page, text", [
    ("<article>Story</article><article class='comment'>no</article>", "Story"),
    ("<article>Story</article><section class='related-posts'><article>teaser</article></section>", "Story"),
    ("<article>own <article>a comment</article>more</article>", "own more"),
    ("<article>We have <math>x</math> here <svg><text>s</text></svg></article>", "We have x here s"),
    ("<article>a <noscript>b <p>the rest", "a b the rest"),
    ("<article><div class='legal'>The terms are these.</div></article>", "The terms are these."),
    ("<article>story<div class='legal'>terms</div></article>", "story"),
    ("<form id='aspnetForm'><div class='page has-sidebar'><article>only</article></div></form>", "only"),
    ("<main><article>a</article></main><article>b</article>", "a b"),
    ("<article class='post has-comments'>kept</article>", "kept"),
    ("<title>never closed <article>a <b title='x>y'>b</b> <i title=\"unclosed>c</article>", "a b c"),
    ("<article>1 < 2 <> 3 </ 4 <5></article>", "1 < 2 <> 3 </ 4 <5>"),
])
def test_what_is_text(page, text):
    assert html_extract.main_text(page) == text


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def extracted(spark, rows):
    pages = spark.createDataFrame([(i, f"http://{h}/{i}", p) for i, (h, p) in enumerate(rows)], "page_id long, url string, html string")
    return [r["text"] for r in sorted(html_extract.extract_main_text(pages).collect(), key=lambda r: r["page_id"])]


def test_notice_inside_articles_goes_and_copies_stay(spark):
    notice = words("notice", 120)
    own = [words(f"own{i}x", 25) for i in range(5)]
    copy, edited = words("copy", 80), [words("copy", 80).replace("copy17 ", f"edit{i} ") for i in range(6)]
    passage = words("passage", 60)
    rows = [("a", f"<article><p>{notice}</p><p>{x}</p></article>") for x in own]                      # a notice of the whole host
    rows += [("b", f"<nav>{i}</nav><article><p>{copy}</p></article>") for i in range(6)]              # exact copies
    rows += [("c", f"<article><p>{x}</p></article>") for x in edited]                                 # near copies
    rows += [("d", f"<article><p>{words(f'd{i}x', 30)}</p>" + (f"<p>{passage}</p>" if i < 4 else "") + "</article>") for i in range(10)]    # some quote a passage
    rows += [("e", f"<article><p>{notice}</p></article>")]                                            # another host
    got = extracted(spark, rows)
    assert got[:5] == own and got[5:11] == [copy] * 6 and got[11:17] == edited and got[-1] == notice
    assert got[17:27] == [words(f"d{i}x", 30) + (f" {passage}" if i < 4 else "") for i in range(10)]


def test_host_text_without_articles(spark):
    notice = words("notice", 120)
    rows = [("a", f"<div>Home | About</div><div>{notice} {words(f'own{i}x', 25)}</div><div>All rights reserved 2020</div>") for i in range(5)]
    rows += [("b", f"<div>{words('shared', 40)}</div><div>{words(f'b{i}x', 9 if i < 2 else 12)}</div>") for i in range(2)] * 2       # two contents, copied
    rows += [("c", f"<div>{words('pair', 40) if i < 2 else words(f'c{i}x', 40)}</div>") for i in range(6)]                           # two of five contents alike
    got = extracted(spark, rows)
    assert got[:5] == [words(f"own{i}x", 25) for i in range(5)]
    assert got[5:9] == [words(f"b{i}x", 9) for i in range(2)] * 2
    assert got[9:] == [words("pair", 40)] * 2 + [words(f"c{i}x", 40) for i in range(2, 6)]


@pytest.mark.parametrize("seed", range(3))
def test_host_runs_against_brute_force(spark, seed):
    """Which words of undecided blocks stay, by comparing every run of every two contents."""
    rng = random.Random(seed)
    k = html_extract.MIN_RUN
    parts = [words(f"s{seed}p{j}x", rng.randint(3, 20)) for j in range(6)]
    pages = []
    for i in range(12):
        bits = [rng.choice(parts) if rng.random() < 0.6 else words(f"u{seed}q{i}r{j}x", rng.randint(1, 15)) for j in range(rng.randint(1, 5))]
        pages.append([" ".join(bits[j:j + 2]) for j in range(0, len(bits), 2)])
    contents = sorted({tuple(p) for p in pages})
    streams = [" ".join(c).split(" ") for c in contents]
    runs = collections.Counter(r for s in streams for r in {tuple(s[i:i + k]) for i in range(len(s) - k + 1)})
    blocks = collections.Counter(b for c in contents for b in set(c))
    for r, n in blocks.items():                                       # a block as long as a run is one
        if len(r.split(" ")) == k:
            runs[tuple(r.split(" "))] = max(n, runs[tuple(r.split(" "))])
    want = []
    for p in pages:
        s = " ".join(p).split(" ")
        told = lambda n: n >= 3 or n > len(contents) / 2 and n > 1
        mark = np.zeros(len(s) + k, bool)
        for i in range(len(s) - k + 1):
            mark[i:i + k] |= told(runs[tuple(s[i:i + k])])
        at, out = 0, []
        for b in p:
            n = len(b.split(" "))
            if not (blocks[b] >= 3 and blocks[b] > len(contents) / 2):
                m = html_extract._whole_runs(mark[at:at + n])
                out.append(" ".join(x for x, y in zip(b.split(" "), m) if not y))
            at += n
        want.append(" ".join(x for x in out if x))
    assert extracted(spark, [("h", "".join(f"<div>{b}</div>" for b in p)) for p in pages]) == want
