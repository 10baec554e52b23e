"""Main-text extraction: template deduction from equivalence classes of tokens."""

from __future__ import annotations

import bisect
import html
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style noscript template textarea title iframe svg select option button object canvas head".split())
OUT_TAGS = frozenset("nav footer aside form menu dialog label".split())
FRAME = frozenset("html body main".split())  # never judged by name
ARTICLE = frozenset("article main".split())
# Names that pages give to parts which are not the article ...
OUT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related replies "
    "reply share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split())
# ... and the words that stand beside them in a name; with any other word (no-sidebar, ad-hoc, related-work) a name says nothing.
BESIDE = frozenset(
    "area articles bar block bottom box buttons column container content form global group header icons inner item items left link links list "
    "main meta middle outer page panel policy posts primary right secondary section site slot stories sub thread top tray unit wrap wrapper".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar toolbar".split())
MARKUP = re.compile(r"""<!--|<!\[CDATA\[|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""")
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
CLASS = re.compile(r"""\bclass\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.I)
MIN_PAGES, SHARE, MIN_CLASS = 3, 0.5, 2
ARTICLE_PAGES = 5  # a passage of the article is lost with less ease than a line of a menu
COPY = 0.5  # an article of which templates would take a larger part is a copy of others, not their template
TEASER = 0.2  # an article that is smaller than this part of the paragraphs around it is not the main text
BROADCAST_TOKENS = 1_000_000


def names_other(name: str) -> bool:
    """Whether one class or id names a part that is not the article."""
    words = [w for w in re.split(r"[-_0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
    return any(w in OUT_NAMES for w in words) and all(w in OUT_NAMES or w in BESIDE for w in words)


def outside(tag: str, attrs: str) -> bool:
    """Whether an element by its class, id or role is no part of an article; of ``article`` only whole names count, as for a comment."""
    if not attrs or tag in FRAME:
        return False
    for m in NAMED.finditer(attrs):
        kind, value = m[1].lower(), m[2].strip("\"'")
        if kind == "role":
            if value.lower() in OUT_ROLES:
                return True
        elif tag == "article":
            if len(value.split()) == 1 and value.lower() in OUT_NAMES:
                return True
        elif any(names_other(name) for name in value.split()):
            return True
    return False


def tokens(page: str | None) -> Iterator[tuple[str, int, str, bool, int, bool]]:
    """(kind, path, value, block, article, paragraph) in page order: kind ``<`` or ``>`` for a tag that opens or closes, ``t`` for a text between
    tags. A path is a hash of the open elements' names with classes, of any depth. ``article`` is 0 in parts that are no article,
    1 outside and 2 inside an ``article`` or ``main``, 3 inside one that stands in a part named as no article (by class or id, not by tag).

    One pass, linear in the page: a search for an end that is not there is made once for each tag.
    """
    page = page or ""
    stack: list[tuple[str, int, int, int]] = []  # tag, path, out (1 by name, 2 by tag), in article (2 if that lies in a part named otherwise)
    held: dict[str, int] = {}  # open elements by tag
    blocks: list[int] = []  # places of open block elements
    absent: set[str] = set()
    at, last, n = 0, page.rfind(">") + 1, len(page)

    def where() -> tuple[int, int]:
        if not stack:
            return 0, 1
        _, path, out, art = stack[-1]
        return path, 0 if out else 1 + art

    def text(s: str):
        path, state = where()
        return ("t", path, html.unescape(s), False, state, bool(stack) and stack[blocks[-1]][0] == "p" if blocks else False)

    def shut(depth: int) -> None:
        for tag, *_ in stack[depth:]:
            held[tag] -= 1
        del stack[depth:]
        while blocks and blocks[-1] >= depth:
            blocks.pop()

    while at < n:
        m = MARKUP.search(page, at, last) if at < last else None
        if m is None:
            rest = page[at:]
            yield text(rest[: rest.find("<!--")] if "<!--" in rest else rest)
            return
        if m.start() > at:
            yield text(page[at: m.start()])
        at = m.end()
        if m[0] in ("<!--", "<![CDATA["):
            end = page.find("-->" if m[0] == "<!--" else "]]>", at)
            if m[0] == "<![CDATA[":
                yield text(page[at: end if end >= 0 else n])
            at = end + 3 if end >= 0 else n
            continue
        close, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if close:
            if held.get(tag):
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                shut(depth + 1)
                path, state = where()
                shut(depth)
                yield (">", path, tag, tag in BLOCK, state, False)
            elif tag in BLOCK:
                yield (">", where()[0], tag, True, where()[1], False)
            continue
        if tag in RAW and not attrs.endswith("/"):
            end = None if tag in absent else re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if end is None:
                absent.add(tag)
            if end or tag in ("script", "style", "textarea", "title"):
                at = end.end() if end else n
                continue
        if tag in BLOCK and blocks and stack[blocks[-1]][0] == "p":  # an open paragraph ends where a block begins
            shut(blocks[-1])
        _, above, out, art = stack[-1] if stack else ("", 0, 0, 0)
        named = CLASS.search(attrs)
        path = zlib.crc32(f"{tag}.{named[1].strip() if named else ''}".encode("utf-8", "surrogatepass"), above)
        if tag in ARTICLE:
            art, out = (2, 0) if out == 1 else (art or 1, out)
        out = 2 if tag in OUT_TAGS or tag == "header" and not art or tag == "article" and outside(tag, attrs) else out or int(outside(tag, attrs))
        keep = tag not in VOID and not attrs.endswith("/")
        stack.append((tag, path, out, art))
        held[tag] = held.get(tag, 0) + 1
        yield ("<", path, tag, tag in BLOCK, where()[1], False)
        if keep:
            if tag in BLOCK:
                blocks.append(len(stack) - 1)
        else:
            shut(len(stack) - 1)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def squeeze(s: str) -> str:
    return " ".join(s.split())


def token_key(kind: str, path: int, value: str) -> str:
    return f"{kind}{path}\x00{squeeze(value) if kind == 't' else value}"


def layout_of(page: Column) -> Column:
    """A page's layout: the containers it is built of, with their classes (digits apart), what stands in the article left out."""
    page = F.coalesce(page, F.lit(""))
    before, after = F.regexp_extract(page, r"(?is)^(.*?<(?:article|main)\b[^>]*>)", 1), F.regexp_extract(page, r"(?is)^.*</(?:article|main)\s*>(.*)$", 1)
    frame = F.when(before != "", F.concat(before, after)).otherwise(page)
    tags = F.regexp_extract_all(frame, F.lit(r"(?i)<(?:body|div|section|article|main|header|footer|nav|aside|form)\b[^>]*>"), F.lit(0))
    named = F.transform(tags, lambda t: F.concat_ws(".", F.lower(F.regexp_extract(t, "^<([A-Za-z]+)", 1)), F.regexp_replace(
        F.regexp_extract(t, r"""(?i)\bclass\s*=\s*["']?([^"'>]*)""", 1), "[0-9]+", "")))
    return F.concat_ws(" ", F.array_sort(F.array_distinct(named)))


def hasher():
    """A function from tokens to their hashes as Spark's xxhash64 gives them."""
    import xxhash
    cache: dict[str, int] = {}

    def run(found: list[tuple]) -> list[int]:
        if len(cache) > 200_000:
            cache.clear()
        out = []
        for kind, path, value, *_ in found:
            k = token_key(kind, path, value)
            h = cache.get(k)
            if h is None:
                h = xxhash.xxh64_intdigest(k.encode("utf-8", "surrogatepass"), 42)
                h = cache[k] = h - (1 << 64) if h >> 63 else h
            out.append(h)
        return out

    return run


def with_scopes(pages: DataFrame) -> DataFrame:
    """``pages`` with by_host and by_layout: a page belongs to its host and to its layout within the host."""
    return pages.withColumn("by_host", F.xxhash64("host")).withColumn("by_layout", F.xxhash64("host", layout_of(F.col("html"))))


def occurrences(pages: DataFrame) -> DataFrame:
    """(by_host, by_layout, page, token, n, at): how often each token stands on each page, and where first."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = hasher()
        for pdf in batches:
            rows = []
            for host, layout, page, body in zip(pdf["by_host"], pdf["by_layout"], pdf["page"], pdf["html"]):
                found = [t for t in tokens(body) if t[0] != "t" or t[2].strip()]
                seen: dict[int, list[int]] = {}
                for i, h in enumerate(hashes(found)):
                    seen.setdefault(h, [0, i])[0] += 1
                rows += [(host, layout, page, h, n, i) for h, (n, i) in seen.items()]
            yield pd.DataFrame(rows, columns=["by_host", "by_layout", "page", "token", "n", "at"])

    return pages.select("by_host", "by_layout", "page", "html").mapInPandas(run, "by_host long, by_layout long, page long, token long, n int, at int")


def unpack(flat) -> list[tuple[int, list[int]]]:
    """(pages, tokens) of each class, from the one array that carries them."""
    out, i = [], 0
    flat = [] if flat is None else [int(x) for x in flat]
    while i < len(flat):
        out.append((flat[i], flat[i + 2: i + 2 + flat[i + 1]]))
        i += 2 + flat[i + 1]
    return out


def out_of_order(keys: list[tuple[int, int]]) -> set[int]:
    """Members (second parts) of keys that are not in a longest rising subsequence."""
    if all(x < y for x, y in zip(keys, keys[1:])):
        return set()
    tops, ends, back = [], [], []
    for i, k in enumerate(keys):
        at = bisect.bisect_left(tops, k)
        tops[at: at + 1], ends[at: at + 1] = [k], [i]
        back.append(ends[at - 1] if at else -1)
    kept, i = set(), ends[-1]
    while i >= 0:
        kept.add(i)
        i = back[i]
    return {k[1] for i, k in enumerate(keys) if i not in kept}


def violations(hashes: list[int], classes: list[tuple[int, list[int]]]) -> set[int]:
    """Tokens that keep the classes, the strongest first, from being ordered and nested on a page.

    In each class the tokens follow each other in its order, once for each repetition; those that do not are named. With the
    others, an instance of a class must lie within one slot of any other class or outside it; of two classes that
    cross, all tokens of the weaker one are named.
    """
    where = {t: (c, k) for c, (_, members) in enumerate(classes) for k, t in enumerate(members)}
    found = [where[h] for h in hashes if h in where]
    keys: dict[int, list[tuple[int, int]]] = {}
    times: dict[tuple[int, int], int] = {}
    for c, k in found:
        times[c, k] = times.get((c, k), -1) + 1
        keys.setdefault(c, []).append((times[c, k], k))
    wrong = {(c, k) for c, of in keys.items() for k in out_of_order(of)}
    last = {c: max((k for _, k in of if (c, k) not in wrong), default=-1) for c, of in keys.items()}
    crossed: set[int] = set()
    open_: list[int] = []
    for c, k in found:
        if c in crossed or (c, k) in wrong:
            continue
        if c in open_:
            while open_[-1] != c and c not in crossed:
                weaker = max(c, open_[-1])
                crossed.add(weaker)
                open_.remove(weaker)
            if c in crossed:
                continue
        else:
            open_.append(c)
        if k == last[c]:
            open_.pop()
    return {classes[c][1][k] for c, k in wrong} | {t for c in crossed for t in classes[c][1]}


def attach(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """``pages`` with classes_host and classes_layout. Classes are broadcast only if their summed size, counted before, is at
    most BROADCAST_TOKENS; beyond that they are joined, a hot host being split by adaptive execution."""
    total = classes.agg(F.coalesce(F.sum(F.size("classes") + 1), F.lit(0)).alias("n")).first().n
    near = F.broadcast(classes) if total <= BROADCAST_TOKENS else classes
    for by in ("host", "layout"):
        pages = pages.join(near.select(F.col("scope").alias(f"by_{by}"), F.col("classes").alias(f"classes_{by}")), f"by_{by}", "left")
    return pages


def host_templates(pages: DataFrame) -> DataFrame:
    """(scope, classes): the template of each host and of each layout of a host, as classes one after the other (pages, size, tokens).

    Tokens with the same occurrence vector (the count on each page of the scope, carried as a hash over pages that hold the
    token) form an equivalence class, texts of the article included. A class is frequent if it stands on MIN_PAGES pages and
    SHARE of the scope's and holds MIN_CLASS tokens. Every page is then read again: tokens that break the
    order of their class on any page leave it, and of two classes that cross on any page the weaker one goes (see ``violations``), so what is
    left is ordered and nested on every page. Aggregates are partial before the shuffle, so a host with a third of
    all pages costs each task one row per token; a scope has few frequent tokens, as each takes up half of its pages.
    """
    scopes = F.explode(F.array("by_host", "by_layout")).alias("scope")
    sizes = pages.select(scopes, "page").distinct().groupBy("scope").agg(F.count(F.lit(1)).alias("pages"))
    copies = pages.groupBy("by_host", "by_layout", "page").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("copies")
    seen = occurrences(pages)
    if copies.limit(1).count():  # pages that come several times count once
        again = seen.join(copies.select("page").distinct(), "page", "left_semi").distinct()
        seen = seen.join(copies.select("page").distinct(), "page", "left_anti").unionByName(again)
    seen = seen.select(scopes, "token", F.xxhash64("page", "n").alias("v"), "n", "at")
    vectors = seen.groupBy("scope", "token").agg(
        F.bit_xor("v").alias("vector"), F.count(F.lit(1)).alias("held"), F.sum("n").alias("n"), F.min("at").alias("low")).filter(F.col("held") >= MIN_PAGES)
    frequent = vectors.join(sizes, "scope").filter(F.col("held") >= SHARE * F.col("pages"))
    classes = (frequent.groupBy("scope", "vector", "held", "n")
               .agg(F.array_sort(F.collect_list(F.struct("low", "token"))).alias("m")).filter(F.size("m") >= MIN_CLASS))
    # strongest first: most pages, then fewest repetitions, then most tokens
    strong = F.array_sort(F.collect_list(F.struct((-F.col("held")).alias("o"), "n", (-F.size("m")).alias("s"), F.col("m.token").alias("t"))))
    ranked = cut(classes.groupBy("scope").agg(strong.alias("c")).select("scope", F.transform("c", lambda c: F.struct((-c["o"]).alias("held"), c["t"].alias("t"))).alias("c")))

    def pack(c: Column) -> Column:
        return F.flatten(F.transform(c, lambda x: F.concat(F.array(x["held"], F.size(x["t"]).cast("long")), x["t"]))).alias("classes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, named = hasher(), set()
        for pdf in batches:
            known: dict[int, list] = {}
            for host, layout, body, of_host, of_layout in zip(pdf["by_host"], pdf["by_layout"], pdf["html"], pdf["classes_host"], pdf["classes_layout"]):
                found = hashes([t for t in tokens(body) if t[0] != "t" or t[2].strip()])
                for scope, flat in ((host, of_host), (layout, of_layout)):
                    if scope not in known:
                        known[scope] = unpack(flat)
                    named |= {(scope, t) for t in violations(found, known[scope])}
            if len(named) > 100_000:
                yield pd.DataFrame(list(named), columns=["scope", "token"])
                named = set()
        yield pd.DataFrame(list(named), columns=["scope", "token"], dtype="int64")

    read = attach(pages.select("by_host", "by_layout", "html"), ranked.select("scope", pack(F.col("c"))))
    broken = cut(read.mapInPandas(run, "scope long, token long").groupBy("scope").agg(F.collect_set("token").alias("gone")))
    left = F.filter(F.transform("c", lambda c: F.struct(c["held"].alias("held"), F.array_except(c["t"], F.coalesce("gone", F.array().cast("array<long>"))).alias("t"))),
                    lambda c: F.size(c["t"]) >= MIN_CLASS)
    return ranked.join(broken, "scope", "left").select("scope", pack(left))


def main_part(found: list[tuple]) -> frozenset[int]:
    """Which states of tokens hold the main text: that of an article, where one is not a mere teaser, else all but what is marked as another part."""
    size = {s: 0 for s in range(4)}
    around = 0
    for kind, _, value, _, state, paragraph in found:
        if kind == "t":
            size[state] += len(value.strip())
            around += len(value.strip()) if state == 1 and paragraph else 0
    if size[2]:
        return frozenset((1, 2)) if size[2] < TEASER * around else frozenset((2,))
    if size[3] and size[3] >= TEASER * around:  # an article inside a part with the name of another
        return frozenset((3,))
    return frozenset((1,))


def slots(body: str | None, known: set[int], sure: set[int], hashes) -> str:
    """The text of a page's remaining slots; in the article only tokens of ``sure`` are template, and none where they are most of it."""
    found = list(tokens(body))
    part = main_part(found)
    keys = hashes(found) if known else [0] * len(found)
    inside = [(len(v.strip()), k in sure) for (kind, _, v, _, state, _), k in zip(found, keys) if kind == "t" and state in part and state > 1]
    if sum(n for n, gone in inside if gone) > COPY * sum(n for n, _ in inside):
        sure = frozenset()
    blocks, run = [], []

    def flush():
        s = squeeze("".join(run))
        if s:
            blocks.append(s)
        run.clear()

    for (kind, _, value, block, state, _), key in zip(found, keys):
        if kind == "t":
            if state in part and key not in (sure if state > 1 else known):
                run.append(value)
        elif block:
            flush()
        elif value == "br":
            run.append(" ")
    flush()
    return "\n\n".join(blocks)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page.

    Templates are deduced for each host and each of its layouts (see ``host_templates``); text tokens of either template go,
    in the article those of classes on ARTICLE_PAGES different pages, unless they are more than COPY of it (then the page is a copy of others). Of the remaining
    slots those inside ``article`` or ``main`` give text where the page has one that is no teaser (less than TEASER of the paragraphs around it), else
    all that stand outside menus, headers, footers, sidebars, notices, adverts, forms and comments (known by tag, role, or a class or id made of
    OUT_NAMES and BESIDE alone; never so on html, body and main). Blocks follow the page and are joined by an empty line. A host of fewer than
    MIN_PAGES pages has no template, so structure alone decides there. Null or empty html, and pages without text, give an empty text; a null url belongs
    to the host without name; repeated rows stay and count as one page; very long pages are read in one linear pass.
    """
    base = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    base = with_scopes(base.withColumn("host", host_of(F.col("url"))))
    marked = base.select("by_host", "by_layout", F.xxhash64("html").alias("page"), "html")
    joined = attach(base.drop("host"), cut(host_templates(marked)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = hasher()
        for pdf in batches:
            texts, sets = [], {}
            for host, layout, body, *both in zip(pdf["by_host"], pdf["by_layout"], pdf["html"], pdf["classes_host"], pdf["classes_layout"]):
                if (host, layout) not in sets:
                    classes = [c for flat in both for c in unpack(flat)]
                    sets[host, layout] = ({t for _, m in classes for t in m}, {t for n, m in classes if n >= ARTICLE_PAGES for t in m})
                texts.append(slots(body, *sets[host, layout], hashes))
            yield pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts})

    kind = dict(base.dtypes)["page_id"]
    out = joined.mapInPandas(run, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
