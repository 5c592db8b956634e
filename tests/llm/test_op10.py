import json
import random
import time

from pyspark.sql import functions as F

from vitalair.llm import wrapper as wr
from vitalair.llm.q10_extraction import main_texts, wrappers

SHELL = "<html><head><title>t</title></head><body><div class='nav'><a>Home</a></div><div id=top>Site of ours</div><div id=c>{}</div><div class='footer'>(c)</div></body></html>"
NONE = wr.NONE


def _page(i):
    return SHELL.format(f"<h1>Title {i}</h1><p>First  text {i} of\nthe page &amp; more.</p><div class=ads>Buy</div><p>Second <b>text</b> {i * 7}.</p>")


def test_template_goes_and_content_stays(spark):
    rows = [(i, f"http://a.org/{i}", _page(i)) for i in range(30)] + [(30, None, None), (31, "http://a.org/x", ""), (32, "http://b.org/", _page(32)), (3, "http://a.org/3", _page(3))]
    df = spark.createDataFrame([(*r, "h", 1, "w") for r in rows], "page_id long, url string, html string, host string, h long, wrapper string")
    got = sorted(map(tuple, main_texts(df).collect()), key=repr)
    text = lambda i: f"Title {i}\nFirst text {i} of the page & more.\nSecond text {i * 7}."
    # a host with one page has no constant nodes, but its noise goes and the region with nearly all text is still the content
    want = [(i, u, "" if not h else text(i)) for i, u, h in rows]
    assert [(a, b, c) for a, b, c, _ in got] == sorted(want, key=repr)
    assert all(n == len(t) for *_, t, n in got)
    assert main_texts(df.limit(0)).count() == 0


def test_very_deep_and_broken_pages():
    deep = "<div>" * 50_000 + "<p>core</p>"
    assert wr.extract(deep, NONE) == "core"
    assert wr.extract("<article>" + "<b>" * 20_000 + "x", NONE) == "x"
    wrapper = wr.loaded(wr.induce([deep, "<p>other words</p>", "</div></p><p", "plain"]))
    assert wrapper[0] >= 3 and wr.extract("plain text only", wrapper) == "plain text only" and wr.extract("plain text only", NONE) == "plain text only"
    assert wr.extract("<article>a &lt;b&gt; <!-- no --> c<script>if (a<b) x()</script></article>", NONE) == "a <b> c"
    long = " ".join(f"w{i}" for i in range(200_000))
    assert wr.extract(f"<main><p>{long}</p></main>", NONE) == long


HALF = (
    "<html><body><div class=q1>Our site name</div><section><div class=k7><span>Follow us</span> daily now</div>{}<div class=z>Written by staff</div></section>"
    "<table><tr><td>All about us here</td></tr></table></body></html>"
)
FIXED = ["Our site name", "Follow us daily now", "Written by staff", "All about us here", "Read more on page two"]


def invented(i, tag):
    rng = random.Random(i)
    own = [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(999)}" for _ in range(9)) for _ in range(3)]
    inner = "".join(f"<p>{t}</p>" for t in own) + "<p>Read more on page two</p>"
    return HALF.format(f"<{tag}>{inner}</{tag}>"), own


def test_half_of_each_page_is_template_without_telling_names(spark):
    for tag in ("div", "article"):
        pages = [invented(i, tag) for i in range(6)]
        rows = [(i, f"https://x.net/{i}", p) for i, (p, _) in enumerate(pages)] + [(6, "https://one.net/", pages[0][0])] + [(7, "https://x.net/7", HALF.format(""))]
        df = spark.createDataFrame(rows, "page_id long, url string, html string")
        for most in (10**6, 0):  # wrappers sent to all tasks, and joined by host in parts
            got = {r.page_id: r.text for r in main_texts(df, to_broadcast=most).collect()}
            assert [got[i] for i in range(6)] == ["\n".join(own) for _, own in pages]
            assert got[7] == ""
            assert FIXED[4] in got[6] and (tag == "article" or FIXED[0] in got[6])  # one page tells nothing of its host


def test_copies_tell_nothing():
    rng = random.Random(3)
    words = [f"w{rng.randrange(9999)}" for _ in range(90)]
    page = lambda ws: "<article>" + "".join(f"<p>{' '.join(ws[i : i + 30])}</p>" for i in (0, 30, 60)) + "</article>"
    near = []
    for k in range(8):
        ws = list(words)
        ws[rng.randrange(90)] = f"other{k}"
        near.append(page(ws))
    wrapper = wr.loaded(wr.induce(near))
    assert wrapper[0] == 1 and wr.extract(near[3], wrapper).count("\n") == 2


def test_blocks_beside_most_of_the_text_stay():
    page = "<body><div><h1>Title</h1><div><b>Lead</b></div><p>Lead text</p></div><div><p>" + "long " * 90 + "</p></div></body>"
    assert wr.extract(page, NONE).startswith("Title\nLead\nLead text\nlong")


def brute_match(a, b):
    """Simple tree matching by the textbook's table."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1]):
        for j, y in enumerate(b[1]):
            m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + brute_match(x, y))
    return 1 + m[-1][-1]


def test_tree_matching_against_the_table():
    rng = random.Random(5)

    def tree(depth):
        keys = rng.sample("abcdef", rng.randint(0, 6)) if depth else []
        return [(k, tree(depth - 1)) for k in keys]

    def slots(key, below):
        s = wr.Slot(key)
        s.children = {k: slots(k, b) for k, b in below}
        return s

    for _ in range(300):
        a, b = ("r", tree(3)), ("r", tree(3))
        pairs = []
        assert wr.match(slots(*a), slots(*b), pairs) == brute_match(a, b) == len(pairs)
        assert all(x.key == y.key for x, y in pairs)


def test_very_many_siblings():
    rows = [f"<div id=a{i}>t{i}</div>" for i in range(20_000)]
    pages = ["".join(rows), "".join(rows) + "<p>q w e</p>", "".join(f"<div id=a{i}>u{i}</div>" for i in reversed(range(20_000))), "".join(f"<h2>t{i}</h2><p>x{i}</p>" for i in range(20_000))]
    began = time.time()
    wrapper = wr.loaded(wr.induce(pages))
    assert all(wr.extract(p, wrapper) for p in pages) and time.time() - began < 30


def parts_of(i, n=3):
    rng = random.Random(1000 + i)
    return [" ".join(f"{rng.choice('abcdefgh')}{rng.randrange(9999)}" for _ in range(9)) for _ in range(n)]


def rare_pages():
    """A host of 90 pages: a notice that eight of them have in a slot of their own, and an article that was published five times with other words here and there in a block named after it."""
    out = []
    for i in range(90):
        own = parts_of(i)
        notice = "<div class=k31>Offered to you by the society of friends</div>" if i % 12 == 5 else ""
        body = "<p>" + "</p><p>".join(own) + "</p>"
        if i >= 85:
            own = [t if k else f"{t} again{i}" for k, t in enumerate(parts_of(85))]
            body = "<div id=post-85><p>" + "</p><p>".join(own) + "</p></div>"
        out.append((f"<div class=q>Our name</div><article>{notice}{body}</article>", own))
    return out


def test_constant_texts_are_counted_over_all_pages(spark):
    """A text of eight pages in ninety is template; copies of an article are not, though they are alike in a slot of their own."""
    pages = rare_pages()
    df = spark.createDataFrame([(i, f"https://x.net/{i}", h) for i, (h, _) in enumerate(pages)], "page_id long, url string, html string")
    for most in (10**6, 0):
        got = {r.page_id: r.text for r in main_texts(df, to_broadcast=most).collect()}
        assert got == {i: "\n".join(own) for i, (_, own) in enumerate(pages)}


def test_counts_over_spark_are_those_of_pages_at_hand(spark):
    """Without copies the wrappers are those that all pages of a host, taken one by one, give; also where pages have slots in another order."""
    hosts = {"x.net": [invented(i, "div")[0] for i in range(20)], "y.net": [h for h, _ in rare_pages()[:85]]}
    ends = [f"<div id=a{k}>fixed {k}</div>" for k in range(4)]
    hosts["z.net"] = ["".join([*(ends if i % 9 else ends[::-1]), f"<p>{parts_of(i)[0]}</p>"]) for i in range(30)]
    rows = [(i, f"http://{h}/{i}", p) for h, pages in hosts.items() for i, p in enumerate(pages)]
    got = {(r.url.split("/")[2], r.page_id): r.text for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for h, pages in hosts.items():
        wrapper = wr.loaded(wr.induce(pages))
        assert [got[h, i] for i in range(len(pages))] == [wr.extract(p, wrapper) for p in pages]


def test_siblings_stand_in_the_order_of_the_pages():
    root = wr.path(None, "r")
    own = {k: wr.path(root, k) for k in "abc"}
    rows = [(root, 0, "r", 0, 9), (own["c"], root, "c", 0, 5), (own["a"], root, "a", 0, 4), (own["b"], root, "b", own["a"], 4), (own["c"], root, "c", own["b"], 2)]
    n, top = wr.loaded(wr.frame(rows, {p: [1] for p in own.values()}))
    assert n == 0 and list(top.children) == ["a", "b", "c"]


def test_pages_among_very_many_copies_are_found(spark):
    """Of 60 pages 57 are copies of one: their paragraphs stay, and the name that all have goes, as four are no copies of each other."""
    pages = []
    for i in range(60):
        own = parts_of(i if i in (3, 17, 29) else 0)
        own[i % 3] += f" edited{i}"
        pages.append((f"<div class=q>Our name</div><div><p>{'</p><p>'.join(own)}</p></div>", own))
    df = spark.createDataFrame([(i, f"https://x.net/{i}", h) for i, (h, _) in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in main_texts(df).collect()}
    assert got == {i: "\n".join(own) for i, (_, own) in enumerate(pages)}
    known = wrappers(df.where("page_id not in (3, 17)").withColumn("host", F.lit("x.net"))).collect()
    assert [json.loads(r.wrapper) for r in known] == [{"n": 2, "w": []}]  # two that are no copies of each other tell nothing
