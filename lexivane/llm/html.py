"""Main text of web pages by template deduction from equivalence classes.

Every start tag of a page is a token, told apart by the path it stands in. Over the pages of a
host, tokens that occur equally often on each page share an occurrence vector; its hash is
summed over pages, so no page list is ever gathered. Tokens with the same vector form a class;
classes that are frequent, hold several tokens and occur once a page are the host's template,
nested by path. Their elements are its slots. The slots that hold the article are chosen once
for a host from the text all its pages have there; of the others, those count whose text
differs from page to page. Each page gives what it has in these slots, without the parts that
are furniture by their names.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import durable
from .common import query, table

SHARE = 0.5
MOST_TEXT = 0.8
SALTS = 16

# fixed values: element names of HTML by their kind, and usual names of page furniture
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style noscript template iframe textarea title svg xmp noembed noframes".split())
FURNITURE = frozenset("head nav footer aside form menu dialog button select option input label fieldset search".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification paywall popup promo promotion related replies respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget".split()
)
ROLES = frozenset("navigation complementary banner contentinfo search alert dialog menu menubar form".split())

MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


def parse(page: str | None):
    """Events ("open", path, furniture, name), ("close", path), ("text", raw) in page order.

    Open elements are closed by the end tag of an element around them; a paragraph ends where
    a block begins; end tags without a start are ignored.
    """
    page = page or ""
    stack: list[tuple[str, str]] = []
    at = 0
    while at < len(page):
        m = MARK.search(page, at)
        if not m:
            yield "text", page[at:]
            break
        if m.start() > at:
            yield "text", page[at : m.start()]
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            if any(n == name for n, _ in stack):
                while stack:
                    n, path = stack.pop()
                    yield "close", path
                    if n == name:
                        break
            elif name in BLOCK:
                yield "text", "\0"
            continue
        if name in BLOCK and any(n == "p" for n, _ in stack):
            inside = [n for n, _ in stack]
            p = len(inside) - 1 - inside[::-1].index("p")
            if not any(n in BLOCK for n in inside[p + 1 :]):
                while len(stack) > p:
                    yield "close", stack.pop()[1]
        label, furniture = _look(name, m[3])
        path = f"{stack[-1][1]}/{label}" if stack else label
        yield "open", path, furniture, name
        if name in VOID or m[3].endswith("/"):
            yield "close", path
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            yield "close", path
        else:
            stack.append((name, path))
    while stack:
        yield "close", stack.pop()[1]


def marked(page: str | None) -> list[tuple]:
    """The events of ``parse``; what holds a heading or article and most of the page's text is no furniture."""
    events, opened, total = list(parse(page)), [], 0
    ends: dict[int, int] = {}
    for i, e in enumerate(events):
        if e[0] == "open":
            opened.append([i, total, False])
            if e[3] in ("h1", "article", "main"):
                for o in reversed(opened):
                    if o[2]:
                        break
                    o[2] = True
        elif e[0] == "close":
            at, before, holds = opened.pop()
            if holds and events[at][2] and events[at][3] not in RAW:
                ends[at] = total - before
        else:
            total += len(e[1].strip())
    for at, chars in ends.items():
        if 2 * chars > total:
            events[at] = (*events[at][:2], False, events[at][3])
    return events


def _look(name: str, attributes: str) -> tuple[str, bool]:
    """The token of a start tag, and whether its names make it furniture."""
    label, furniture = name, name in FURNITURE or name in RAW
    if attributes:
        for a in ATTRIBUTE.finditer(attributes):
            key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
            if key in ("class", "id"):
                words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w]
                furniture |= name not in ("body", "html", "article", "main") and not NAMES.isdisjoint(words)
                label += "".join(f".{w}" for w in words if not re.search(r"[0-9]", value))
            elif key == "role":
                furniture |= value.lower() in ROLES
            elif key == "hidden" or key == "aria-hidden" and value == "true":
                furniture = True
    return label.replace("/", "_"), furniture


def blocks(page: str | None, core: list[str] | None, varied: list[str] | None = None, fixed: list[str] | None = None) -> str:
    """The text of the elements at ``core``, one line per block, and of other slots at ``varied``.

    Text belongs to the innermost slot around it: what lies in one of ``fixed``, which are alike
    on all pages, is left out, but not inside ``core``. A page without these slots gives its
    article or main element, and one without these its body, furniture always left out.
    """
    wanted, more = set(core or ()), dict.fromkeys(varied or (), True) | dict.fromkeys(fixed or (), False)
    events, first = marked(page), True
    for choose in (lambda p, n: p in wanted, lambda p, n: n in ("article", "main"), lambda p, n: n == "body", None):
        slots = more if first else {}
        first, around = False, [False]  # whether the innermost slot around varies
        lines: list[str] = []
        part: list[str] = []
        inside, hidden, seen = 0, 0, choose is None
        held: list[tuple[bool, bool, bool]] = []

        def flush():
            line = " ".join(unescape("".join(part)).split())
            if line:
                lines.append(line)
            part.clear()

        for e in events:
            if e[0] == "open":
                hit = choose is not None and choose(e[1], e[3])
                varies = slots.get(e[1], around[-1])
                seen |= hit
                # a header belongs to the page, or to the article if it stands in it
                bad = e[2] or e[3] == "header" and not inside and not slots.get(e[1])
                broken = e[3] in BLOCK
                if broken and not hidden:
                    flush()
                around.append(varies)
                if e[3] == "br" and not hidden:
                    part.append(" ")
                held.append((hit, bad, broken))
                inside += hit
                hidden += bad
            elif e[0] == "close":
                hit, bad, broken = held.pop()
                if broken and not hidden:
                    flush()
                around.pop()
                inside -= hit
                hidden -= bad
            elif (inside or choose is None or around[-1]) and not hidden:
                if e[1] == "\0":
                    flush()
                else:
                    part.append(e[1])
        flush()
        if seen:
            return "\n".join(lines)
    return ""


def host_of(url: str) -> Column:
    """The host of an address in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def tokens(pages: DataFrame) -> DataFrame:
    """(host, path, pages, n, h1, h2, chars, low, high): what batches of pages know of every token.

    ``h1`` and ``h2`` are sums of hashes of page and count, the fingerprint of the occurrence
    vector; ``chars`` is the visible text inside, without furniture, and ``low`` and ``high`` are
    the least and greatest hash of that text.
    """

    def run(batches):
        for batch in batches:
            known: dict[tuple[str, str], list[int]] = {}
            for host, row, page in zip(*(batch.column(c).to_pylist() for c in ("host", "row", "html"))):
                counts: dict[str, int] = {}
                chars: dict[str, int] = {}
                inner: dict[str, xxhash.xxh3_64] = {}
                hidden, held = 0, []
                bare: set[str] = set()
                for e in marked(page):
                    if e[0] == "open":
                        counts[e[1]] = counts.get(e[1], 0) + 1
                        hidden += e[2]
                        held.append((e[1], e[2]))
                        if hidden:
                            bare.add(e[1])
                    elif e[0] == "close":
                        hidden -= held.pop()[1]
                    elif not hidden:
                        n = len(e[1].strip())
                        if n:
                            for path in {"", *(p for p, _ in held)}:
                                chars[path] = chars.get(path, 0) + n
                                if path not in inner:
                                    inner[path] = xxhash.xxh3_64()
                                inner[path].update(e[1].strip().encode("utf-8", "replace"))
                counts[""] = 1
                for path, n in counts.items():
                    h = xxhash.xxh3_64_intdigest(f"{row}:{n}")
                    one = known.setdefault((host, path), [0, 0, 0, 0, 0, 2**63 - 1, 0])
                    text = inner[path].intdigest() >> 1 if path in inner and path not in bare else 0
                    one[5], one[6] = min(one[5], text), max(one[6], text)
                    for i, v in enumerate((1, n, h >> 33, h & 0x7FFFFFFF, 0 if path in bare else chars.get(path, 0))):
                        one[i] += v
            cols = [pa.array([k[i] for k in known], pa.string()) for i in (0, 1)]
            cols += [pa.array([v[i] for v in known.values()], pa.int64()) for i in range(7)]
            yield pa.RecordBatch.from_arrays(cols, ["host", "path", "pages", "n", "h1", "h2", "chars", "low", "high"])

    return pages.mapInArrow(run, "host string, path string, pages long, n long, h1 long, h2 long, chars long, low long, high long")


def templates(pages: DataFrame, share: float = SHARE) -> DataFrame:
    """(host, core, varied, fixed): paths of the article's slots, and of others whose text varies or not."""
    sums = [F.sum(c).alias(c) for c in ("pages", "n", "h1", "h2", "chars")] + [F.min("low").alias("low"), F.max("high").alias("high")]
    known = durable(tokens(pages).groupBy("host", "path").agg(*sums))
    sizes = known.filter("path = ''").select("host", F.col("pages").alias("all_pages"), F.col("chars").alias("whole"))
    classes = known.filter("path <> ''").groupBy("host", "h1", "h2").agg(
        F.count("*").alias("tokens"), F.max("pages").alias("pages"), F.max("n").alias("n")
    )
    valid = classes.join(sizes, "host").filter(
        (F.col("tokens") > 1) & (F.col("pages") >= share * F.col("all_pages")) & (F.col("n") == F.col("pages"))
    ).select("host", "h1", "h2")
    label = F.element_at(F.split("path", "/"), -1)
    named = F.regexp_extract(label, r"^(article|main)(\.|$)", 1) != ""
    slots = known.filter("path <> '' AND chars > 0").join(valid, ["host", "h1", "h2"]).select(
        "host", "path", "chars", (F.col("low") < F.col("high")).alias("varies"), named.alias("named"), F.size(F.split("path", "/")).alias("depth")
    )
    most = slots.groupBy("host").agg(F.max("named").alias("any")).join(sizes, "host")
    fit = slots.join(most, "host").filter(
        F.when(F.col("any"), F.col("named")).otherwise(F.col("chars") >= MOST_TEXT * F.col("whole"))
    )
    # all elements with such a name, else the innermost that still holds most of the text
    deepest = F.max_by("path", F.struct("depth", "chars", "path"))
    core = fit.groupBy("host").agg(F.when(F.first("any"), F.array_sort(F.collect_set("path"))).otherwise(F.array(deepest)).alias("core"))
    others = slots.groupBy("host").agg(*(
        F.array_sort(F.collect_set(F.when(which, F.col("path")))).alias(name)
        for name, which in (("varied", F.col("varies")), ("fixed", ~F.col("varies")))
    ))
    return others.join(core, "host", "left")


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) for every row.

    Null and empty pages have an empty text. Pages without a host share one template of their
    own. Rows with null keys stay, repeated rows repeat their result, other columns are
    ignored.
    """
    source = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(url).alias("host"),
        F.xxhash64(key, url, html).alias("row"),
    )
    known = durable(templates(source.select("host", "row", "html")))
    spread = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = source.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(
        spread, ["host", "salt"], "left"
    ).select("key", "url", "html", "core", "varied", "fixed")

    def run(batches):
        for batch in batches:
            texts = [blocks(*row) for row in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], [key, url, "text"]
            )

    kind = pages.schema[key].dataType.simpleString()
    return met.mapInArrow(run, f"`{key}` {kind}, `{url}` string, text string")


@query("op10_html")
def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
