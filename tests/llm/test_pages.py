"""Main text of pages against plain programs and pages whose article is known."""

import html
import math
import random
import re
from collections import Counter, defaultdict

import pytest

from arrearium.llm import site_style
from arrearium.llm.site_style import Page, main_text
from arrearium.llm.queries import QUERIES
from tests.llm.data import prose

FOLDER = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, host string, low int, text string, node long"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", 1, "t", 2) for r in rows], PAGES)


def plain_article(page):
    """The article of a page of the given tables: its blocks lie between h1 and p marks."""
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    said = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "br" in b else "", b)).split()) for b in blocks]
    return "\n\n".join(x for x in said if x)


def test_whole_table(spark):
    want = Counter()
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        text = plain_article(r.html)
        want[r.page_id, r.url, text, len(text)] += 1
    assert Counter(tuple(r) for r in QUERIES["op11_style"](spark, FOLDER).collect()) == want


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain words", "plain words"),
        ("<p>a<p>b", "a\n\nb"),
        ("<p>a <b>b<br>c</b>\n d&nbsp;e</p>", "a b c d e"),
        ("<div>a<script>if (x < 1) { '</p>' }</script>b<style>p{}</style>c</div>", "abc"),
        ("<p>1 < 2 &lt; 3 &amp;amp; &eacute;&#233;&#xe9; &nosuch; &am</p>", "1 < 2 < 3 &amp; ééé &nosuch; &am"),
        ("<!-- <p>no</p> --><p>yes</p><!-- cut off", "yes"),
        ("<a title='x > y' href=z>link</a> tail", "link tail"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a\n\nb\n\nc\n\nd"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
        ("<nav>menu</nav><header>top</header><p>text</p><aside>side</aside><form>mail</form><footer>end</footer>", "text"),
        ("<main><header><h1>Title</h1></header><p>text</p><section id='comments'><p>first!</p></section></main>", "Title\n\ntext"),
        ("<body class='has-sidebar'><div class='pageHeader'><h1>T</h1></div><div class='site-header'>S</div><p>text</p>", "T\n\ntext"),
        ("<div class='cookie-notice'>ok?</div><div role='banner'>b</div><div hidden>h</div><p style='display: none'>n</p><p>text</p>", "text"),
        ("<article><h1>T</h1><p>text</p></article><div>outside</div><article class='comment'>me</article>", "T\n\ntext"),
        ("<form><main><p>text</p></main></form>", "text"),
        ("<div class='ads'><article><p>text</p></article></div>", "text"),
        ("<p>cut off <b", "cut off"),
        ("<p>" + "word " * 100_000 + "</p>", " ".join(["word"] * 100_000)),
        ("<div>" * 50_000 + "deep", "deep"),
        ("<svg><text>no</text></svg><button>no</button><textarea><p>no</textarea><select><option>a</select><p>yes</p>", "yes"),
        ("<P CLASS=x>Upper</P>\x00<unknown-tag>kept</unknown-tag>", "Upper\n\n\x00kept"),
    ],
)
def test_pages_and_their_articles(page, text):
    assert main_text(page, set()) == text


def plain_importance(texts):
    """{node: (pages, presentations, importance)} of one host from its distinct pages, by comparing whole lists."""
    shown, said, seen = defaultdict(list), defaultdict(list), set()
    for text in texts:
        page = Page(text)
        nodes = site_style.nodes_of(page)
        words = [" ".join(p.split()) for p in page.pieces if p and p.strip()]
        if tuple(words) in seen:
            continue
        seen.add(tuple(words))
        style, content = defaultdict(list), defaultdict(list)
        for i in range(1, len(nodes)):
            if page.tags[i] in site_style.INLINE or page.tags[i] in site_style.NOT_TEXT:
                continue
            below = [nodes[j] for j in range(i + 1, len(nodes)) if page.parents[j] == i and page.tags[j] not in site_style.INLINE]
            style[nodes[i]].append(tuple(n for k, n in enumerate(below) if k == 0 or below[k - 1] != n))
            part = page.pieces[page.first[i] : page.last[i]]
            content[nodes[i]].append(tuple(" ".join(p.split()) for p in part if p and p.strip()))
        for n in style:
            shown[n].append(tuple(style[n]))
            said[n].append(tuple(content[n]))

    def entropy(x):
        m = len(x)
        return 1.0 if m == 1 else -sum(c / m * math.log(c / m, m) for c in Counter(x).values())

    weight = {n: 0.9 ** len(set(x)) for n, x in shown.items()}
    return {n: (len(x), len(set(x)), (1 - weight[n]) * entropy(x) + weight[n] * entropy(said[n])) for n, x in shown.items()}


def site(seed, n):
    """Pages of one template, whose notice has no telling name, and the articles."""
    r, out = random.Random(seed), []
    for i in range(n):
        blocks = [prose(1000 * seed + 10 * i + k, r.randint(5, 30)) for k in range(r.randint(1, 4))]
        body = "".join(f"<p>{b}</p>" for b in blocks)
        link = f"<ul class='x1'><li>{prose(i % 3, 2)}</li></ul>" if i % 4 else ""
        page = f"<body><div class='q7'>We value you. Read on.</div>{link}<div class='story' id='s{i}'>{body}</div><div class='z3'>All rights.</div></body>"
        out.append((page, "\n\n".join(blocks)))
    return out


def test_importance_of_nodes(spark):
    found = [p for p, _ in site(4, 30)]
    rows = [(i, "https://www.one.example/a", p) for i, p in enumerate([*found, *found[:7]])]
    got = site_style.style_tree(pages(spark, rows).repartition(5)).collect()
    want = plain_importance(found)
    assert {r.node: (r.pages, r.presentations, round(r.importance, 9)) for r in got} == {n: (a, b, round(c, 9)) for n, (a, b, c) in want.items()}
    assert {r.host for r in got} == {"one.example"}


def test_template_of_a_host_goes_and_copies_stay(spark):
    many, few = site(1, 40), site(2, 3)
    rows = [(i, "https://www.many.example:80/x?y", p) for i, (p, _) in enumerate(many)]
    rows += [(100 + i, "http://few.example/", p) for i, (p, _) in enumerate(few)]
    # One article on many pages of a host, whole and with one word changed, is no template.
    same = "<body><article><h1>Title</h1><p>{}</p><p>" + prose(77, 50) + "</p></article></body>"
    rows += [(200 + i, "http://copies.example/", same.format("equal")) for i in range(30)]
    rows += [(300 + i, "http://copies.example/", same.format(f"near {i}")) for i in range(30)]
    rows += [(400, None, "<p>no host</p>"), (401, "//", ""), (402, "http://many.example/", None), (403, "not a url", many[0][0]), (None, None, None), (0, "https://www.many.example:80/x?y", many[0][0])]
    got = site_style.extracted(pages(spark, rows).repartition(7)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    links = {i: prose(i % 3, 2) for i in range(40) if i % 4}
    for i, (_, text) in enumerate(many):
        assert by_id[i] in (text, f"{links.get(i)}\n\n{text}")
    assert by_id[100].startswith("We value you.") and by_id[100].endswith("All rights.")
    assert by_id[200] == f"Title\n\nequal\n\n{prose(77, 50)}" and by_id[305] == f"Title\n\nnear 5\n\n{prose(77, 50)}"
    assert (by_id[400], by_id[401], by_id[402], by_id[None]) == ("no host", "", "", "")
    assert site_style.extracted(pages(spark, [])).count() == 0


def test_broken_pages_do_not_stop_the_job(spark):
    r = random.Random(6)
    marks = ["<p>", "</p>", "<div class='a", "'>", "<table>", "<td>", "</tr>", "<!--", "-->", "&amp", "<script>", "</script>", "x ", "<", "</", "<a b=\"", "\"", "<li>", "</ul>", "<article>", "</article>", "<br/>", "</html>", "\x00"]
    rows = [(i, f"http://h{i % 3}.example/", "".join(r.choice(marks) for _ in range(r.randint(0, 60)))) for i in range(400)]
    got = site_style.extracted(pages(spark, rows)).collect()
    assert len(got) == 400 and all("<script>" not in x.text for x in got)
