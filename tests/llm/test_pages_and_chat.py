"""Operators on pages and conversations, and the pipeline, against brute force."""

import collections
import hashlib
import html
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spanweave.llm import chat, pages, registry, urls
from spanweave.llm.common import table
from spanweave.llm.registry import TOKENIZER

# --- 5


def plain_article(page):
    """The article's blocks of the driver's page generator, by patterns."""
    inner = re.search(r"<article>(.*)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_main_text_of_the_tables(spark, sf):
    rows = table(spark, sf, "pages")
    expected = {r.page_id: plain_article(r.html) for r in rows.collect()}
    found = {r.page_id: r for r in pages.main_text(rows).withColumn("n_chars", F.length("text")).collect()}
    assert {i: r.text for i, r in found.items()} == expected
    assert all(r.n_chars == len(r.text) for r in found.values())


RICH = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t = "</p><p>no</p>";</script></head><body class="has-sidebar">
<header><h2>Site &amp; name</h2><nav><ul><li>Home<li>About</ul></nav></header><div class="cookie-notice">We use cookies</div>
<main><article class="post"><header><h1>Head &lt;line&gt;</h1></header><p>First  &amp;amp;\n<b>bold</b><br>part<p>Second &eacute;&#233; &am
<div class="ad">Buy</div><form>Mail <input> <button>Go</button></form><aside>See also</aside><ul><li>one<li>two</ul>
<table><tr><td>a<td>b</table><blockquote>quote</blockquote><!-- no --><p hidden-x>Last</p><div class="share-box">Share</div></article>
<section id="comments"><article class="comment"><p>Nice!</p></article></section></main><footer><p>&copy; us</p></footer></body></html>"""


def test_main_text_of_rich_markup(spark):
    df = spark.createDataFrame([(1, "http://a/x", RICH)], "page_id long, url string, html string")
    assert pages.main_text(df).first().text == "Head <line>\nFirst &amp; bold part\nSecond éé &am\none\ntwo\na\nb\nquote\nLast"


PROSE = """<body><nav>Home</nav><article><h1>T</h1><p>a <button>x</button> b</p><p>c <math><mi>y</mi></math> d <svg><title>no</title></svg>e</p>
<p class="alert">f</p><section class="search"><p>g</p></section><p>h <span class="related">i</span> j</p><noscript><p>k</p></noscript><menu><li>l<li>m</menu>
<p>n <select><option>no</select>o <script>no()</script>p</p><div class="comments"><p>no</p></div><div>q<table><tr><td>r</table>s</div></article><p class="ad">no</p></body>"""


def test_what_is_marked_inside_an_article_goes_and_no_block_is_split(spark):
    df = spark.createDataFrame([(1, "http://a/x", PROSE)], "page_id long, url string, html string")
    assert pages.main_text(df).first().text == "T\na b\nc y d e\nh i j\nn o p\nq\nr\ns"


#: Pages without an article element: what wraps the text, of which {} is the place.
WRAPPERS = [
    '<div class="layout has-sidebar">{}</div>', '<div class="with-header">{}</div>', '<div class="post share-enabled">{}</div>', '<main><div class="has-sidebar">{}</div></main>', '<body class="no-sidebar">{}</body>',
    '<div id="page" class="sidebar-right"><main>{}</main></div>', '<div class="post comments-open">{}</div>', '<div class="related">{}</div>', '<div class="header-fixed">{}</div>', "<section>{}</section>", '<td class="header">{}</td>', "<div>{}</div>",
    '<div class="promo-layout">{}</div>', '<div role="search-result">{}</div>', '<article class="post alert">{}</article>',
]
#: What stands beside the text, inside the wrapper and outside, and is none of it.
ASIDE = [
    "<nav><ul><li>Home<li>About us</ul></nav>", '<div class="menu"><a href="/">Home and all the rest of it</a></div>', '<p class="advert">Buy now</p>', '<p class="cookie-notice">We use cookies</p>', '<ul><li class="related">See this</ul>',
    '<section class="newsletter"><p>Join us</p></section>', "<menu><li>One<li>Two</menu>", "<button>Press</button>", "<noscript>Turn it on</noscript>", '<div class="left-sidebar">Left</div>', '<div id="comments"><div>' + "So true! " * 40 + "</div></div>",
    '<div class="comment-list">' + "<article><p>Nice, nice, nice.</p></article>" * 20 + "</div>", "<form>Mail <input></form>", "<script>var x</script><style>p{}</style>", '<div class="social-share">Share</div>', "<footer>Us</footer>", '<h3 class="related">More</h3>',
]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_forms_of_pages(wrapper):
    """Wrappers do not take the text with them, and what is marked goes wherever it stands."""
    text = ["A headline of some length", "The first of the paragraphs, which goes on for a while.", "one point", "another point", "The end of it all, said at length."]
    blocks = [f"<h2>{text[0]}</h2>", f"<p>{text[1]}</p>", f"<ul><li>{text[2]}<li>{text[3]}</ul>", f"<p>{text[4]}</p>"]
    for aside in ASIDE:
        for at in (0, 2, 4):
            page = wrapper.format("".join([*blocks[:at], aside, *blocks[at:]]))
            lines, kinds = pages.lines_of(page)
            assert [x for x, kind in zip(lines, kinds, strict=True) if kind != pages.NOISE] == text, page
        lines, kinds = pages.lines_of(aside + wrapper.format("".join(blocks)) + aside)
        assert [x for x, kind in zip(lines, kinds, strict=True) if kind != pages.NOISE] == text, aside


def test_differencing_decides_on_every_form_of_page(spark):
    """Pages of a host differ in their text alone; what is shared is marked nowhere, and goes."""
    rows, expected = [], {}
    for form, wrapper in enumerate(w for w in WRAPPERS if "<article" not in w):
        for i in range(4):
            own = [f"Text {i} of form {form}, the first part.", f"Text {i} of form {form}, the second part."]
            page_id = form * 10 + i
            expected[page_id] = "\n".join(own)
            rows.append((page_id, f"http://h{form}/a/{i}", f"<div>Site</div><div>Home</div>{wrapper.format(''.join(f'<p>{x}</p>' for x in own))}<div>All rights</div>"))
    found = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == expected


def plain_difference(rows):
    """Texts by differencing alone: each page loses a longest common subsequence with its nearest neighbour."""
    hosts, out = collections.defaultdict(list), {}
    for page_id, url, body in rows:
        host, _, path = url.split("://", 1)[1].partition("/")
        hosts[host].append(("/" + path, page_id, [x for x in re.split(r"<[^>]*>", body) if x]))
    for group in hosts.values():
        group.sort()
        for k, (path, page_id, lines) in enumerate(group):
            near = [g for g in (group[k - 1] if k else None, group[k + 1] if k + 1 < len(group) else None) if g]
            shared = lambda g: next((i for i, (x, y) in enumerate(zip(g[0], path, strict=False)) if x != y), min(len(g[0]), len(path)))  # noqa: B023, E731
            other = max(near, key=shared)[2] if near else []
            best = [[0] * (len(other) + 1) for _ in range(len(lines) + 1)]
            for i, x in enumerate(lines):
                for j, y in enumerate(other):
                    best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
            out[page_id] = len(lines) - best[-1][-1], set(lines) - set(other), lines
    return out


def test_differencing_alone_decides_where_markup_says_nothing(spark):
    """Pages of bare divs: what is left of each is as long as brute force says, holds all it has alone, in order."""
    rng = random.Random(9)
    rows = []
    for i in range(120):
        host = rng.randrange(6)
        template = [f"menu {host} {k}" for k in range(4)]
        own = [f"text {i} {k}" for k in range(rng.randint(1, 4))] + [rng.choice(["again", "and again"]) for _ in range(rng.randint(0, 3))]
        lines = [*template[:2], *own, *(template[2:] if rng.random() < 0.9 else [])]
        rows.append((i, f"http://h{host}/{rng.choice('abc')}/{i:03}", "".join(f"<div>{x}</div>" for x in lines)))
    expected = plain_difference(rows)
    found = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    for r in found:
        n, alone, lines = expected[r.page_id]
        kept = r.text.split("\n") if r.text else []
        rest = iter(lines)
        assert len(kept) == n and alone <= set(kept) and all(x in rest for x in kept)


def test_template_lines_go_from_pages_without_an_article(spark):
    page = lambda body: f"<body><div>Welcome</div><div>Menu</div>{body}<div>All rights</div></body>"
    rows = [(1, "http://h/a/1", page("<p>one</p><p>same</p>")), (2, "http://h/a/2", page("<p>two</p>")), (3, "http://other/a", page("<p>one</p>")), (4, "http://h/a/2", page("<p>two</p>"))]
    found = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1] == "one\nsame" and found[2] == "two"
    assert found[3] == "Welcome\nMenu\none\nAll rights"  # nothing to compare with


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        b = [rng.choice("abcd") for _ in range(rng.randint(0, 14))]
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        for block in (2, 1024):
            found = [a[i] for i in sorted(pages.aligned(a, b, block))]
            rest = iter(b)
            assert len(found) == best[-1][-1] and all(x in rest for x in found)


def test_main_text_edges(spark):
    rows = [(1, None, None), (2, "no scheme", ""), (3, "http://h/p", "<p>x"), (3, "http://h/p", "<p>x"), (None, "http://h/q", "plain < text & more"), (5, "http://h/r", "<p>" + "word " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("lines", "grp", "path", "kinds", "host", "text")})
    found = pages.main_text(df).collect()
    assert len(found) == len(rows) and pages.main_text(df.limit(0)).count() == 0
    by_id = {r.page_id: r.text for r in found}
    assert by_id[1] == by_id[2] == "" and by_id[3] == "x" and by_id[None] == "plain < text & more" and len(by_id[5]) == 249_999


def test_main_text_spreads_a_hot_host(spark, monkeypatch):
    monkeypatch.setattr(pages, "SHARE", 4)
    rows = [(i, f"http://{'hot' if i % 3 else 'h' + str(i)}/p/{i}", f"<div>Menu</div><p>text {i}</p>") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert all(found[i] == (f"text {i}" if i % 3 else f"Menu\ntext {i}") for i in range(60))


def test_neighbours_are_those_of_the_whole_host(spark, monkeypatch):
    """Pages of a section share a line with their nearest page alone, wherever the host is cut."""
    rng = random.Random(5)
    rows = [(i, f"http://big/{i // 2:05}/{i % 2}", f"<div>Section {i // 2}</div><div>text {i}</div>") for i in range(1200)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "page_id long, url string, html string").repartition(3)
    for share in (4096, 7):  # whole, and cut inside sections
        monkeypatch.setattr(pages, "SHARE", share)
        found = {r.page_id: r.text for r in pages.main_text(df).collect()}
        assert found == {i: f"text {i}" for i in range(1200)}


def test_all_copies_of_a_page_lose_the_template(spark, monkeypatch):
    """A run of equal pages is compared with the pages around it, also where groups are cut in it."""
    page = lambda body: f"<div>Menu</div><div>{body}</div>"
    rows = [(0, "http://h/a", page("first")), *((i, "http://h/b", page("copy")) for i in range(1, 100)), (100, "http://h/c", page("last"))]
    rows += [(200 + i, f"http://only/{i}", page("alone")) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    expected = {i: "copy" for i in range(1, 100)} | {0: "first", 100: "last"} | {200 + i: "Menu\nalone" for i in range(20)}
    for share in (4096, 6):
        monkeypatch.setattr(pages, "SHARE", share)
        assert {r.page_id: r.text for r in pages.main_text(df).collect()} == expected


# --- 2


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else None
    if rest is None:
        return "", "", None, None
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, said in urls.RULES:
        of, begins = rule.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + begins) and (best is None or len(rule) > len(best[0])):
            best = rule, said
    return host, path, *(best or (None, None))


URLS = ["http://A.Example.NET/en/x?q", "https://net/", "http://net", "http://xnet/", "http://example.com/de/1#f", "http://EXAMPLE.com/den", "ftp://b.org/fr/", "http://org/fr", "no url", None, "", "http://É.org/fr/a", "http://a.net?x/en/", "//x.net/", "a://b://c.net/"]


def test_url_rules(spark, sf):
    rows = [(i, u, "<p>") for i, u in enumerate(URLS)] + [(100 + r.page_id, r.url, r.html) for r in table(spark, sf, "pages").collect()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = urls.judge(df).collect()
    assert len(found) == len(rows)
    of = {i: plain_verdict(u) for i, u, _ in rows}
    for r in found:
        host, path, rule, said = of[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block") and said in (None, r.verdict)


def test_link_propagation(spark):
    """Host scores equal a power iteration on dense matrices."""
    links = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 3), ("d", "bad", 1), ("e", "d", 1), ("bad", "a", 1)]
    seeds = [("trust", "a", 1.0), ("trust", "b", 0.5), ("distrust", "bad", 1.0)]
    names = sorted({x for e in links for x in e[:2]})
    step = {"trust": np.zeros((len(names),) * 2), "distrust": np.zeros((len(names),) * 2)}
    for s, t, n in links:
        step["trust"][names.index(t), names.index(s)] += n
        step["distrust"][names.index(s), names.index(t)] += n
    expected = {}
    for kind, m in step.items():
        m = m / np.where(m.sum(0) > 0, m.sum(0), 1)
        x = np.array([sum(v for k, h, v in seeds if (k, h) == (kind, n)) for n in names]) * (1 - urls.DAMPING)
        front = x
        for _ in range(urls.ROUNDS):
            front = urls.DAMPING * m @ front
            x = x + front
        expected |= {(kind, n): v for n, v in zip(names, x, strict=True) if v}
    got = urls.propagate(spark.createDataFrame(links, "src string, dst string, n long"), spark.createDataFrame(seeds, "kind string, host string, mass double"))
    found = {(r.kind, r.host): r.mass for r in got.collect()}
    assert found.keys() == expected.keys() and all(abs(found[k] - expected[k]) < 1e-9 for k in found)


def test_hosts_that_link_to_blocked_ones_are_blocked(spark):
    rows = [(i, f"http://spam{i}.net/", "<p>") for i in range(3)]
    rows += [(10, "http://farm.org/x", '<a href="http://spam0.net/a">x</a> <a href=//SPAM1.net>y</a>'), (11, "http://fine.org/x", '<a href="/local">z</a>'), (12, "http://good.example.net/en/", '<a href="http://fine.org/q">ok</a>')]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "salt", "score", "kind")})
    found = {r.page_id: (r.verdict, r.score) for r in urls.judge(df, threshold=0.3).collect()}
    assert found[10][0] == "block" and found[11][0] == found[12][0] == "allow" and found[11][1] > 0
    assert urls.judge(df.limit(0)).count() == 0
    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    cursor = db.execute(urls.verdict_sql())
    columns = [c[0] for c in cursor.description]
    assert collections.Counter(map(tuple, urls.judge(df).select(*columns).collect())) == collections.Counter(cursor.fetchall())


# --- 7


def read_whole(parts, tokenizer):
    return {r.conv_id: r for r in chat.read_back(parts, tokenizer).collect()}


def test_chat_round_trip(spark):
    tricky = ["\\", "\\\\### User:", "### Assistant:### Assistant:", "</turn></turn>", "<|endoftext|>", "\\### Assistant: </turn> ok", "#### User:", "", None, "é\n\x00", "x" * 100_000]
    roles = ["user", "assistant", "system", "tool </turn>", None, "assistant"]
    rng = random.Random(6)
    rows = [(c, t, rng.choice(roles), rng.choice(tricky)) for c in (*range(12), None) for t in range(rng.randint(1, 6))] + [(3, None, "user", "first"), (4, 0, "assistant", "tie"), (4, 0, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit(1) for c in ("ids", "loss_from", "content")})
    found = read_whole(chat.format_turns(df.repartition(5), TOKENIZER), TOKENIZER)
    by_conv = collections.defaultdict(list)
    for c, *rest in rows:
        by_conv[c].append(rest)
    assert found.keys() == by_conv.keys()
    for c, turns in by_conv.items():
        r = found[c]
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0))
        assert r.n_turns == len(turns) and r.loss_chars == sum(len(x or "") for _, role, x in turns if role == "assistant")
        if len({t for t, *_ in turns}) == len(turns):  # turns in a certain order
            assert r.turns_sha256 == hashlib.sha256("".join(f"{role or ''}\n{x or ''}\n" for _, role, x in turns).encode()).hexdigest()
            assert r.loss_sha256 == hashlib.sha256("".join(x or "" for _, role, x in turns if role == "assistant").encode()).hexdigest()
    assert chat.read_back(chat.format_turns(df.limit(0), TOKENIZER), TOKENIZER).count() == 0


def test_escapes_are_reversible_and_hide_controls():
    rng = random.Random(8)
    pieces = [*chat.CONTROLS, "\\", "#", " ", "</", "turn>", "User:", "a"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
        written = chat.escape(text)
        assert chat.unescape(written) == text
        bare = re.sub(r"\\.", "|", written, flags=re.S)
        assert not any(c in bare for c in chat.CONTROLS)


# --- SQL


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_equal_their_sql(spark, sf, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = db.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    found = registry.QUERIES[name](spark, sf)
    assert sorted(found.columns) == sorted(columns)
    assert collections.Counter(map(tuple, found.select(*columns).collect())) == collections.Counter(cursor.fetchall())


# --- pipeline


def test_pipeline_stages(spark, sf):
    import corpus_pipeline
    from spanweave.llm import decontaminate, quality, repeats, simhash

    docs = table(spark, sf, "documents")
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, sf).cache()
    scored = quality.run(spark, sf).where("predicted = 1")
    assert good.columns == names and {r.doc_id for r in good.collect()} == {r.doc_id for r in scored.collect()}
    one = stages["near_duplicates"](spark, good, sf).cache()
    found = simhash.near_duplicates(good)
    assert one.columns == names and sorted(r.doc_id for r in one.collect()) == sorted({r.component_id for r in found.collect()})
    bare = stages["repeated_passages"](spark, one, sf).cache()
    digests = {r.doc_id: r for r in repeats.remove_repeats(one).collect()}
    assert bare.columns == names and bare.count() == one.count()
    for r in bare.collect():
        assert r.n_chars == len(r.text) and len(r.text.encode()) <= digests[r.doc_id].n_bytes - digests[r.doc_id].n_removed
    clean = stages["decontamination"](spark, bare, sf).cache()
    dirty = {r.doc_id for r in decontaminate.contained_items(bare, table(spark, sf, "benchmark")).collect()}
    assert clean.columns == names and {r.doc_id for r in clean.collect()} == {r.doc_id for r in bare.collect()} - dirty
    last = stages["tokens"](spark, clean, sf)
    assert collections.Counter(last.collect()) == collections.Counter(corpus_pipeline.run(spark, sf).collect())
