"""Main text of web pages by nearest-URL page differencing.

Pages of a host come from one template.  Each page is cut into text lines (one for each block),
paired with the page of the same host whose URL path is nearest, and the two line sequences are
aligned by their longest common subsequence.  Lines that the pair shares are template and deleted.

Differencing alone would also delete an article that two neighbouring pages carry, and keeps
menus that differ between pages, so the page's own markup bounds it: lines in elements marked as
navigation, header, footer, sidebar, notice, advert, form or comments go; where a page marks
its article, lines outside go, and its prose (paragraphs, headings, list items, quotes, cells)
is not deleted for being shared.

Elements are marked by their tag, or by a word of a class (or id or role) that names the block:
``sidebar`` and ``left-sidebar``, not ``has-sidebar`` or ``sidebar-closed``.  A class says nothing where the element is what it
should stand beside: where it holds the page's ``main`` or ``h1``, or the larger part of its text in
other than links.  Comments' classes always count, but for such states (``comments-open``).
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, cut, map_batches, n_partitions, table
from .urls import host_of, path_of

NOISE, LINE, PROSE = 0, 1, 2
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: What these hold is not shown as text, or is a form's; they may stand inside a line and don't end it.
HIDDEN = set("head title script style template noscript iframe svg canvas object audio video map select textarea datalist button".split())
AWAY = set("nav footer aside form dialog menu".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PROSE_IN = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption caption".split())
#: Classes of these say nothing about their text.
PLAIN = set("html body main h1 caption figcaption dt dd table tbody thead tfoot tr td th hr".split())
HEADINGS = {"h2", "h3", "h4", "h5", "h6"}
#: An open element of the key's kind ends when one of these begins, unless a list or table stands between.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
WITHIN = {"ul", "ol", "dl", "table", "menu"}
#: Words in class, id or role that mark what is not the article.
MARKS = set(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar widget footer header masthead topbar banner "
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "comment comments reply replies respond disqus pagination pager toolbar complementary contentinfo search".split()
)
#: Those of them that mark readers' comments.
REPLIES = {"comment", "comments", "reply", "replies", "respond", "disqus"}
#: Those of them that may be a heading's class without making it a header's.
TITLES = {"header", "masthead", "banner", "topbar", "promo", "alert"}
#: What a class ends with that says how an element is and not what.
STATES = set("open opened close closed enable enabled disable disabled on off active inactive allowed".split())
#: What a class says of an element that has a thing, and is not it.
HAVING = set("has have with without no not is hide show".split())
_PARTS = re.compile(r"[a-z]+")


class Lines(HTMLParser):
    """Cuts a page into lines, and says of each which elements it is in that may make it noise."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, tuple, tuple]] = []  # tag, in noise, in prose, suspects, articles
        self.text: list[str] = []
        self.at: tuple = (False, False, (), ())  # of the line begun
        self.found: list[tuple] = []  # text, code points in links, in noise, in prose, suspects, articles
        self.suspects: list[bool] = []  # elements that a class marks; whether what they hold shows it says nothing
        self.firm: list[bool] = []  # those of comments
        self.articles: list[tuple] = []  # suspects that an article is in
        self.hidden = self.links = self.linked = 0  # open elements; code points of the line in links

    def marked(self, tag: str, attrs: list, inside: bool) -> tuple[bool, bool]:
        """Whether classes mark an element as none of the article's, and whether as comments."""
        if tag not in BLOCKS or tag in PLAIN:
            return False, False
        said = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v).lower().split()
        found = set()
        for parts in map(_PARTS.findall, said):
            if parts and parts[-1] not in STATES and HAVING.isdisjoint(parts):
                found.update(w for i, w in enumerate(parts) if w in MARKS and not (inside and i and w in TITLES))
        if tag == "article":
            found &= REPLIES
        elif tag in HEADINGS:
            found -= TITLES
        return bool(found), bool(found & REPLIES)

    def flush(self) -> None:
        if line := " ".join("".join(self.text).split()):
            self.found.append((line, self.linked, *self.at))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.flush()
            if self.open and self.open[-1][0] == "p" or tag not in ("html", "body"):
                for i in range(len(self.open) - 1, -1, -1):
                    name = self.open[i][0]
                    if name == "p" or name in ENDS.get(tag, ()):
                        self.close_from(i)
                        break
                    if name in BLOCKS and (name in WITHIN or tag not in ENDS):
                        break
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        noise, prose, suspects, articles = self.open[-1][1:] if self.open else (False, False, (), ())
        noise = noise or tag in AWAY or tag == "header" and not articles
        said, firm = self.marked(tag, attrs, bool(articles))
        if said:
            suspects = (*suspects, len(self.suspects))
            self.suspects.append(False)
            self.firm.append(firm)
        if tag in ("main", "h1") and not noise:
            for i in suspects:
                self.suspects[i] = True
        if tag in ("article", "main") and not noise:
            articles = (*articles, len(self.articles))
            self.articles.append(suspects)
        self.hidden += tag in HIDDEN
        self.links += tag == "a"
        self.open.append((tag, noise, prose or tag in PROSE_IN, suspects, articles))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.close_from(i)
                return
            if tag not in BLOCKS and tag not in HIDDEN and self.open[i][0] in BLOCKS:
                return

    def close_from(self, i: int) -> None:
        if any(tag in BLOCKS for tag, *_ in self.open[i:]):
            self.flush()
        for tag, *_ in self.open[i:]:
            self.hidden -= tag in HIDDEN
            self.links -= tag == "a"
        del self.open[i:]

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            if not any(map(str.strip, self.text)):
                self.at = self.open[-1][1:] if self.open else (False, False, (), ())
            self.text.append(data)
            self.linked += len(data) if self.links else 0


def lines_of(html: str) -> tuple[list[str], list[int]]:
    """The page's text lines in order and what each is."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    found = parser.found
    if parser.suspects:
        held, linked = [0] * len(parser.suspects), [0] * len(parser.suspects)
        whole = 0
        for line, links, noise, _, suspects, _ in found:
            if not noise and not any(parser.firm[i] for i in suspects):
                whole += len(line)
                for i in suspects:
                    held[i] += len(line)
                    linked[i] += links
        clear = [not firm and (wraps or 2 * h > whole and 2 * n <= h) for wraps, firm, h, n in zip(parser.suspects, parser.firm, held, linked, strict=True)]
        bad = lambda suspects: not all(clear[i] for i in suspects)
    else:
        bad = lambda _: False
    good = [not bad(suspects) for suspects in parser.articles]
    inside = [any(good[i] for i in articles) for *_, articles in found]
    noisy = [noise or bad(suspects) for _, _, noise, _, suspects, _ in found]
    marked = any(a and not n for a, n in zip(inside, noisy, strict=True))
    kinds = [NOISE if n or marked and not a else PROSE if marked and prose else LINE for a, n, (_, _, _, prose, *_) in zip(inside, noisy, found, strict=True)]
    return [line for line, *_ in found], kinds


def aligned(a: list[str], b: list[str], block: int = 1024) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``.

    Rows of the usual table are bits of one integer; every ``block``-th row is kept and those
    between are made again on the way back, so memory grows with len(b) alone.
    """
    lead = 0
    while lead < len(a) and lead < len(b) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < min(len(a), len(b)) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(lead), *range(len(a) - tail, len(a))}
    a, b = a[lead : len(a) - tail], b[lead : len(b) - tail]
    places: dict[str, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    every = (1 << len(b)) - 1

    def rows(row: int, lines: list[str]) -> list[int]:
        out = [row]
        for line in lines:
            hit = row & places.get(line, 0)
            row = ((row + hit) | (row - hit)) & every
            out.append(row)
        return out

    kept = [every]
    for at in range(0, len(a), block):
        kept.append(rows(kept[-1], a[at : at + block])[-1])
    j = len(b)
    for part in range((len(a) - 1) // block, -1, -1):
        at = part * block
        table = rows(kept[part], a[at : at + block])
        i = len(table) - 1
        while i and j:
            if table[i] >> (j - 1) & 1:
                j -= 1
            elif not table[i - 1] >> (j - 1) & 1:
                i -= 1
            else:
                i, j = i - 1, j - 1
                found.add(lead + at + i)
    return found


def nearness(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Delete what a page shares with its nearer neighbour; rows come sorted by group and path.

    Pages of a group that stand together with the same lines are a run, held at once (a group has
    few over SHARE rows, and the lines are held once); its neighbours are the pages before and
    after it, and each of these is aligned with it once.  Rows carried from another group are
    neighbours only and are not returned.
    """
    out: list[tuple] = []

    def settle(before, run, after):
        near = [p for p in (before, after) if p and p["grp"] == run[0]["grp"]]
        shared: dict[int, set[int]] = {}
        for page in run:
            if page["carried"]:
                continue
            other = max(near, key=lambda p: nearness(p["path"], page["path"]), default=None)
            if other and id(other) not in shared:
                shared[id(other)] = aligned(page["lines"], other["lines"])
            gone = shared[id(other)] if other else ()
            kept = [x for i, (x, kind) in enumerate(zip(page["lines"], page["kinds"], strict=True)) if kind == PROSE or kind == LINE and i not in gone]
            out.append((page["page_id"], page["url"], "\n".join(kept)))

    def pack():
        while out:
            ids, urls, texts = zip(*out[:BATCH_ROWS], strict=True)
            del out[:BATCH_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    before, run = None, []
    for batch in batches:
        for page in batch.to_pylist():
            if run and page["grp"] == run[0]["grp"] and page["digest"] == run[0]["digest"]:
                page["lines"] = run[0]["lines"]
                run.append(page)
                continue
            if run:
                settle(before, run, page)
                before = run[-1]
            run = [page]
            if len(out) >= BATCH_ROWS:
                yield from pack()
    if run:
        settle(before, run, None)
    yield from pack()


#: Pages of a host in one group; a host with more is cut into ranges of its sorted paths.
SHARE = 4096

#: What orders the pages of a host, and the digest of their lines.
KEY = ("host string", "path string", "page_id long", "url string", "digest binary")
_KEY_TYPE = pa.struct([("host", pa.string()), ("path", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("digest", pa.binary())])
#: First and last page of a range, and the nearest to each of them with other lines.
ENDS_OF_RANGE = ("first", "second", "before_last", "last")


def digest_of(lines: list[str]) -> bytes:
    return hashlib.blake2b("\n".join(lines).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def order(host: str, path: str, page_id: int | None, url: str | None, digest: bytes) -> tuple:
    """A page's key in Spark's order: nulls first, texts by code point."""
    return host, path, page_id is not None, page_id or 0, url is not None, url or "", digest


def ranges(keys: DataFrame, size: int) -> list[dict]:
    """The ends of consecutive ranges of ``size`` pages of a host, in order; pages alike in all
    of KEY stay together.  The driver gets four keys for each range.
    """

    def cut_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = lambda found: pa.RecordBatch.from_arrays([pa.array([x[name] for x in found], _KEY_TYPE) for name in ENDS_OF_RANGE], list(ENDS_OF_RANGE))
        found, n = None, 0
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if found is None or row["host"] != found["last"]["host"] or n >= size and row != found["last"]:
                    if found:
                        done.append(found)
                    found, n = {"first": row, "second": None, "before_last": None}, 0
                elif row["digest"] != found["last"]["digest"]:
                    found["before_last"] = found["last"]
                    found["second"] = found["second"] or row
                found["last"] = row
                n += 1
            if done:
                yield pack(done)
        if found:
            yield pack([found])

    key = f"struct<{','.join(x.replace(' ', ':') for x in KEY)}>"
    by = [x.split()[0] for x in KEY]
    dealt = keys.repartitionByRange(n_partitions(keys.sparkSession), *by).sortWithinPartitions(*by)
    rows = dealt.mapInArrow(cut_ranges, ", ".join(f"{name} {key}" for name in ENDS_OF_RANGE)).collect()
    found = [{name: r[name] and r[name].asDict() for name in ENDS_OF_RANGE} for r in rows]
    return sorted(found, key=lambda x: order(**x["first"]))


def beyond(found: Iterable[dict], near: str, far: str, far_other: str) -> Iterator[tuple[dict, dict]]:
    """Each range with the nearest page before it, of its host, with other lines than its end ``near``."""
    last = other = None
    for x in found:
        if last and last["host"] != x[near]["host"]:
            last = other = None
        if last and (page := last if last["digest"] != x[near]["digest"] else other):
            yield x, page
        if x[far_other]:
            other = x[far_other]
        elif last and last["digest"] != x[far]["digest"]:
            other = last
        last = x[far]


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for each row of ``pages``: the article's blocks joined by newlines.

    A page's neighbours are those next to it in the order of path and page_id among its host's.
    A host with more than SHARE pages is cut into ranges of that order, so no task gets it whole;
    the pages just beyond a range's ends go with it, so the neighbours are the same.  For this
    the pages of such hosts are cut into lines twice.  Neighbours with the very same lines say
    nothing about the template and are passed over, however many stand together; a page without
    another neighbour is bounded by its markup alone.

    Null html or a page without text: empty text.  Null url: host and path empty.  Repeated
    rows: a row each.  Empty table: empty result.  Other columns are dropped.
    """
    spark = pages.sparkSession
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    keyed = keyed.select(host_of("url").alias("host"), path_of("url").alias("path"), "page_id", "url", "html")
    large = [(r["host"],) for r in keyed.groupBy("host").count().where(F.col("count") > SHARE).collect()]
    starts: dict[str, list[tuple]] = {}
    carried: dict[tuple, list[str]] = {}
    if large:

        def make_keys():
            def step(batch: pa.RecordBatch) -> pa.RecordBatch:
                digests = [digest_of(lines_of(html or "")[0]) for html in batch.column(4).to_pylist()]
                return pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(digests, pa.binary())], [x.split()[0] for x in KEY])

            return step

        of_large = keyed.join(F.broadcast(spark.createDataFrame(large, "host string")), "host", "left_semi")
        found = ranges(cut(map_batches(of_large.select("host", "path", "page_id", "url", "html"), make_keys, ", ".join(KEY))), SHARE)
        for x in found:
            of_host = starts.setdefault(x["first"]["host"], [])
            x["grp"] = f"{x['first']['host']}/{len(of_host)}"
            of_host.append(order(**x["first"]))
        for x, page in [*beyond(found, "first", "last", "before_last"), *beyond(reversed(found), "last", "first", "second")]:
            carried.setdefault(order(**page), []).append(x["grp"])

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            lines, kinds, digests, at, groups, extra = [], [], [], [], [], []
            for i, (host, path, page_id, url, html) in enumerate(zip(*(c.to_pylist() for c in batch.columns), strict=True)):
                found = lines_of(html or "")
                digest = digest_of(found[0])
                own = [f"{host}/0"]
                if host in starts:
                    key = order(host, path, page_id, url, digest)
                    own = [f"{host}/{bisect_right(starts[host], key) - 1}", *carried.get(key, ())]
                for n, group in enumerate(own):
                    at.append(i)
                    groups.append(group)
                    extra.append(n > 0)
                    lines.append(found[0])
                    kinds.append(found[1])
                    digests.append(digest)
            rows = [c.take(pa.array(at, pa.int64())) for c in batch.columns[1:4]]
            return pa.RecordBatch.from_arrays(
                [pa.array(groups, pa.string()), *rows, pa.array(digests, pa.binary()), pa.array(lines, pa.list_(pa.string())), pa.array(kinds, pa.list_(pa.int8())), pa.array(extra, pa.bool_())],
                ["grp", "path", "page_id", "url", "digest", "lines", "kinds", "carried"],
            )

        return step

    lined = map_batches(keyed, make, "grp string, path string, page_id long, url string, digest binary, lines array<string>, kinds array<tinyint>, carried boolean")
    dealt = lined.repartition(n_partitions(spark), "grp").sortWithinPartitions("grp", "path", "page_id", "url", "digest")
    return dealt.mapInArrow(_difference, "page_id long, url string, text string")


def run(spark, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


#: The same texts by patterns in SQL (DuckDB), for pages whose article holds only headings,
#: paragraphs and inline markup, and the character references that the tables have.
TEXT_SQL = r"""
WITH a AS (SELECT row_number() OVER () AS n, page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS inner_html FROM pages),
b AS (SELECT n, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS part FROM (SELECT n, regexp_split_to_array(inner_html, '</?(?:p|h1)>') AS parts FROM a)),
c AS (SELECT n, i, trim(regexp_replace(regexp_replace(replace(regexp_replace(part, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g')) AS line FROM b),
t AS (SELECT n, string_agg(line, chr(10) ORDER BY i) AS text FROM c WHERE line <> '' GROUP BY n)
SELECT page_id, url, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM a LEFT JOIN t USING (n)
"""
