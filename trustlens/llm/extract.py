"""Main text of web pages: nearest-URL page differencing guided by the markup.

Pages are parsed into blocks. Markup that names its purpose (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, comments) is left
out, and where a page marks its article only that counts. Pages of a host with
exactly the same lines are copies and prove nothing: each distinct list of lines
counts once, at the first of its paths. Within each host these lists are ordered by
path; each is paired with the neighbour whose path agrees longest, their lines are
aligned by longest common subsequence, and shared lines that the markup does not
place in the article are deleted from all copies alike. Every page is differenced;
``n_shared`` is the number of its lines that the paired page has too.

Differencing alone keeps adverts that change from page to page and deletes
passages that two articles share, so the markup goes first.

The order is made by range partitions and ranks, so a host with a third of all
pages is many tasks; only hashes of lines take part. Null html is empty. Null
urls form a host of their own. Repeated rows are extracted each. Extra columns
are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustlens.llm.common import small_batches
from trustlens.llm.urls import split_url
from trustlens.session import materialize

BROADCAST_ROWS = 500_000
# Elements and words of class, id and role.
BLOCK = frozenset("""address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary table
tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp".split())
LEAVE = frozenset("""nav header footer aside form menu dialog button select input svg canvas object video audio
map noscript template iframe head title script style textarea fieldset""".split())
NOISE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login menu menus nav navbar
navigation breadcrumb breadcrumbs sidebar aside widget widgets footer header masthead toolbar comment comments disqus reply
replies respond share sharing social related recommended pagination pager skip complementary contentinfo""".split())
# Words that only place a box; a name of them and of noise words names noise.
PLACE = frozenset("""site page main global top bottom left right upper lower primary secondary area list box block wrap wrapper
container outer inner section bar panel slot unit item items link links button buttons form text content body row col column
group post posts articles user reader""".split())
START = re.compile(r"<(?:(!--)|(!\[CDATA\[)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
OPAQUE = re.compile(r"<(?:(!--)|(!\[CDATA\[))")
REST = re.compile(r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)


def _noisy(name: str, attributes: str) -> bool:
    """An element whose name, or a class, id or role of it, says that it is no
    main text. ``comment-list`` does, ``comment-open`` or ``related-work`` do not;
    a quotation is never a reader's reply by its own name."""
    if name in LEAVE:
        return True
    if not attributes or name in ("html", "body", "main", "blockquote"):
        return False
    for value in NAMED.findall(attributes):
        for one in value.lower().strip("\"'").split():
            words = [w for w in re.split(r"[^a-z]+", one) if w]
            if not NOISE.isdisjoint(words) and all(w in NOISE or w in PLACE for w in words):
                return True
    return False


def tags(html: str):
    """(start, end, name, attributes, closing) of each tag, in one linear pass.

    The name is empty for a comment or a declaration and ``[`` for CDATA. Where the
    quotes of a tag never close, it and all tags after it end at their first ``>``;
    after the last ``>`` there are no tags. A place sent to it is where it goes on
    (after the text of a script, say).
    """
    at, last, quotes = 0, html.rfind(">"), True
    while m := (START if at <= last else OPAQUE).search(html, at):
        start, own = m.start(), m.lastindex
        if own <= 2:
            stop, size = html.find("-->" if own == 1 else "]]>", m.end()), 3
            at = len(html) if stop < 0 else stop + size
            yield start, at, "" if own == 1 else "[", "", False
        elif m.end() > last:
            at = m.end()
        elif own == 3:
            at = html.find(">", m.end()) + 1
            yield start, at, "", "", False
        else:
            rest = REST.match(html, m.end()) if quotes else None
            quotes = rest is not None
            at = rest.end() if quotes else html.find(">", m.end()) + 1
            at = (yield start, at, m[5].lower(), html[m.end():at - 1], bool(m[4])) or at


def blocks(html: str | None) -> list[tuple[str, bool, bool]]:
    """(text, in an article, left out) of every block that has text, in page order."""
    out: list[tuple[str, bool, bool]] = []
    if not html:
        return out
    parts: list[str] = []
    ends: dict[str, int] = {}
    article, leave, depth, at = 0, "", 0, 0

    def end() -> None:
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, article > 0, bool(leave)))

    def closes(name: str, after: int) -> bool:
        if name not in ends:
            ends[name] = max((m.start() for m in re.finditer(f"</{re.escape(name)}", html, re.I | re.A)), default=-1)
        return ends[name] >= after

    walk, go_on = tags(html), None
    while True:
        try:
            start, stop, name, attributes, closing = walk.send(go_on)
        except StopIteration:
            break
        go_on = None
        parts.append(html[at:start])
        at = stop
        if not name:
            continue
        if name == "[":
            parts.append(html[start + 9:stop].removesuffix("]]>"))
            continue
        if not closing and name in RAW:
            m = re.compile(f"</{name}", re.I | re.A).search(html, at)
            at = len(html) if m is None else html.find(">", m.start()) + 1 or len(html)
            go_on = at
            continue
        if name in BLOCK or (not closing and not leave and _noisy(name, attributes)) or (closing and name == leave):
            end()
        elif name == "br":
            parts.append(" ")
        if leave:
            if name == leave:
                depth += -1 if closing else 1
                leave = leave if depth else ""
            elif name in ("article", "main") and not closing and not closes(leave, at):
                leave = ""  # an element that never closes ends where the article starts
        elif not closing and name not in VOID and not attributes.endswith("/") and _noisy(name, attributes):
            leave, depth = name, 1
        if name in ("article", "main") and not leave:
            article = max(0, article + (-1 if closing else 1))
    parts.append(html[at:])
    end()
    return out


def shared(a: list[int], b: list[int]) -> list[int]:
    """Places of ``a`` in a longest common subsequence with ``b`` (bit-parallel)."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    x, y = a[head:len(a) - tail], b[head:len(b) - tail]
    places: dict[int, int] = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    row, rows = full, [full]
    for v in x:
        u = row & places.get(v, 0)
        row = (row + u | row - u) & full
        rows.append(row)
    # A zero bit j of rows[i]: the first j + 1 of y match one more line of the first i of x.
    length = lambda i, j: j - (rows[i] & (1 << j) - 1).bit_count()
    i, j, middle = len(x), len(y), []
    while i and j:
        if x[i - 1] == y[j - 1]:
            i, j = i - 1, j - 1
            middle.append(head + i)
        elif length(i - 1, j) >= length(i, j - 1):
            i -= 1
        else:
            j -= 1
    return [*range(head), *reversed(middle), *range(len(a) - tail, len(a))]


def _parsed(pages: DataFrame) -> DataFrame:
    """row, host, path, lines (hashes of all blocks)."""
    small_batches(pages.sparkSession, 256)
    host, path = split_url(F.col("url"))
    src = pages.select(F.xxhash64("page_id", "url", "html").alias("row"), host.alias("host"), path.alias("path"), "html")

    def run(batches):
        import xxhash
        for batch in batches:
            lines = [[xxhash.xxh3_64_intdigest(t.encode()) - (1 << 63) for t, _, _ in blocks(h.as_py())] for h in batch["html"]]
            yield pa.RecordBatch.from_arrays([batch["row"], batch["host"], batch["path"], pa.array(lines, pa.list_(pa.int64()))],
                                             names=["row", "host", "path", "lines"])

    return src.mapInArrow(run, "row long, host string, path string, lines array<long>")


def deletions(pages: DataFrame) -> DataFrame:
    """row, places: blocks that a page shares with the page of the nearest url on its
    host. Pages that share none are left out."""
    parsed = materialize(_parsed(pages).withColumn("list", F.xxhash64("lines")), "op10-parsed")
    ordered = (parsed.groupBy("host", "list").agg(F.min("path").alias("path"), F.first("lines").alias("lines"))
               .repartitionByRange("host", "path", "list").sortWithinPartitions("host", "path", "list")
               .withColumn("at", F.monotonically_increasing_id()))
    ordered = materialize(ordered, "op10-ordered")
    part = F.shiftright("at", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = (ordered.withColumn("part", part).join(F.broadcast(before), "part")
              .withColumn("rank", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))))
    asked = ranked.select("list", "host", "path", "lines", F.explode(F.array(
        F.col("rank") - 1, F.col("rank") + 1)).alias("rank"), F.col("rank").alias("own"))
    near = ranked.select("rank", F.col("host").alias("host2"), F.col("path").alias("path2"), F.col("lines").alias("lines2"))
    agree = F.aggregate(F.sequence(F.lit(1), F.greatest(F.length("path"), F.lit(1))), F.lit(0), lambda a, i: F.when(
        (a == i - 1) & (F.substring("path", 1, i) == F.substring("path2", 1, i)), i).otherwise(a))
    both = (asked.join(near, "rank").where("host = host2").withColumn("agree", agree))
    best = both.groupBy("host", "list").agg(F.max(F.struct("agree", -F.col("rank"), "lines", "lines2")).alias("b")) \
        .select("host", "list", "b.lines", "b.lines2")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch["host"], batch["list"], pa.array([shared(a.as_py(), b.as_py()) for a, b in zip(batch["lines"], batch["lines2"], strict=True)],
                                        pa.list_(pa.int32()))], names=["host", "list", "places"])

    gone = best.mapInArrow(run, "host string, list long, places array<int>").where(F.size("places") > 0)
    return (parsed.select("row", "host", "list").join(gone, ["host", "list"])
            .select("row", "places").dropDuplicates(["row"]))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, n_shared of every row. Where a page marks its article,
    a shared line inside it stays: two articles may quote the same passage."""
    gone = materialize(deletions(pages), "op10-deletions")
    few = gone.count() <= BROADCAST_ROWS
    src = pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("row"))
    src = src.join(F.broadcast(gone) if few else gone, "row", "left").select("page_id", "url", "html", "places")
    kind = src.schema["page_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts, shares = [], []
            for h, p in zip(batch["html"], batch["places"], strict=True):
                own, less = blocks(h.as_py()), set(p.as_py() or ())
                marked = any(inside and not left for _, inside, left in own)
                texts.append("\n\n".join(t for i, (t, inside, left) in enumerate(own)
                                         if not left and (inside if marked else i not in less)))
                shares.append(len(less))
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64()), pa.array(shares, pa.int64())],
                                             names=["page_id", "url", "text", "n_chars", "n_shared"])

    return src.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long, n_shared long")
