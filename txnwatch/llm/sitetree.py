"""Main text of web pages by site style trees.

Every page is read into a lean tree. The trees of a host are merged into one style
tree by the path of an element (tags and classes). Per style node three measures over
the different pages of the host decide: the entropy of its contents, the entropy of
the ways its children are laid out, and its share of the words of the pages that have
it. A node that holds most of the words, and of whose children none does, is the main
branch. Cut are

* branches that read the same on most pages (low importance: contents and layout);
* outside the main branch and articles: boxes of a fixed layout with a small share
  of the words, be their wording the same or not, unless they hold a first heading.

What HTML itself calls something other than text (menus, footers, asides, forms,
scripts, hidden elements, reader comments) is cut without statistics. A class or id
that speaks of adverts, notices and so on, and a place beside an article, make a
branch suspect: it is cut unless the style tree finds it to be a main branch. Within
an article a name counts only if every word of it speaks of noise or of a container.
Pages of a host that read the same count once, so copies of a page are no evidence
against what only they hold, and styles on fewer than ``PAGES`` different pages are
left to names and places.

Cases: null html counts as empty and gives an empty text; unclosed and cut-off markup
is read as far as it goes, at any depth of nesting and any length; a null url is a
host of its own; repeated rows are extracted each; an empty table gives no rows. Only
page_id, url and html are read.
"""

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from txnwatch.llm.common import join_counted, map_batches
from txnwatch.session import materialize

#: Share of the style node's importance that comes from its contents; the rest from its layout.
CONTENT_SHARE = 0.9
#: A branch is cut below this importance, if so many different pages have it, on hosts whose bodies matter at least so much.
LOW, PAGES, BODIES = 0.2, 4, 0.5
#: Share of the words from which a branch is a main one; share and layout entropy below which a box beside it is cut.
MAIN, LIGHT, FIXED = 0.5, 0.1, 0.4
#: Judged branches of all hosts, up to which they are sent to every task.
BROADCAST_BRANCHES = 100_000

# Elements of HTML by their part in a page.
_NO_END = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
_NOISE_TAGS = frozenset("head nav footer aside form script style noscript template iframe object svg canvas audio video button select option input textarea dialog menu label fieldset".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
_ENDS_PARAGRAPH = _BLOCKS - frozenset("body caption head html legend li option optgroup dd dt tbody td tfoot th thead tr summary".split())
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
_TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dd dt td th tr tbody thead table ul ol dl figure figcaption b i em strong a span br".split())
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
_NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header "
    "login masthead menu modal nav navbar navigation newsletter notice notices notification pagination paywall popup promo promoted promotion "
    "recommended related respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split())
_READERS = frozenset("comment comments disqus respond".split())
_CONTAINER_WORDS = frozenset("area bar block bottom box buttons container content form holder inner item items left links list outer posts right section site slot top unit user wrap wrapper".split())
_ARTICLE_WORDS = frozenset("banner header masthead".split())
# End of the fixed values.

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']+|"[^"]*"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)|([^\s=/>"']+)""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_KINDS = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
_HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)")


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].rpartition("@")[2].lower() if found else url


@dataclass(slots=True)
class Element:
    tag: str
    style: int  # hash of the tags and classes on the way here
    parent: int = 0  # style of the judged element above
    noise: bool = False
    article: bool = False  # an article or main element is here or above
    main: bool = False  # a main branch of the host is here or above
    judged: bool = False  # the style tree has it
    box: bool = False  # holds text blocks, rather than being one
    cut: bool = False  # it or one above is cut by the style tree
    light: bool = False  # it or one above is to be cut on pages with a main branch
    suspect: bool = False  # by its name or that of one above
    titled: bool = False  # holds a first heading
    words: int = 0
    children: list = field(default_factory=list)
    contents: list = field(default_factory=list)


@dataclass(frozen=True)
class Branches:
    """What the style tree of a host says of styles: cut on all pages, cut beside a main branch, main branches."""

    cut: frozenset = frozenset()
    light: frozenset = frozenset()
    main: frozenset = frozenset()


@dataclass
class Page:
    """Text blocks (dropped by cut or name, light, in an article, in a main branch, text), the judged elements, and words in all."""

    blocks: list
    elements: list
    words: int


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, value, alone in _ATTRIBUTE.findall(text):
        found.setdefault((name or alone).lower(), value.strip("\"'"))
    return found


def _is_noise(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether an element is no text by its tag, role or state, or holds what readers wrote."""
    if tag in _NOISE_TAGS or tag == "header" and not in_article:
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    if tag in ("html", "body", "main"):
        return False
    return attributes.get("role", "").lower() in _NOISE_ROLES or any(
        not _READERS.isdisjoint(words) and words <= _READERS | _NOISE_WORDS | _CONTAINER_WORDS for words in _names(attributes))


def _names(attributes: dict[str, str]) -> list[set[str]]:
    """The words of each class and of the id."""
    names = (attributes.get("class", "") + " " + attributes.get("id", "")).split()
    return [{word.lower() for word in _WORD.findall(name)} for name in names]


def _is_suspect(tag: str, attributes: dict[str, str], in_article: bool) -> bool:
    """Whether the name of an element speaks of noise."""
    if tag in ("html", "body", "main", "article"):
        return False
    if not in_article:
        return any(not _NOISE_WORDS.isdisjoint(words) for words in _names(attributes))
    noise = _NOISE_WORDS - _ARTICLE_WORDS
    return any(not noise.isdisjoint(words) and words <= noise | _CONTAINER_WORDS for words in _names(attributes))


def read_page(text: str, branches: Branches = Branches()) -> Page:
    root = Element("", 0)
    stack, blocks, elements = [root], [], []
    open_tags: Counter = Counter()
    held: list[str] = []
    at, size = 0, len(text)

    def put(raw: str) -> None:
        if raw and not stack[-1].noise:
            held.append(html.unescape(raw) if "&" in raw else raw)

    def close_block() -> None:
        if held:
            words = "".join(held).split()
            held.clear()
            if words:
                own, above = " ".join(words), stack[-1]
                blocks.append((above.cut or above.suspect, above.light, above.article, above.main, own))
                above.contents.append(xxhash.xxh64_intdigest(own))
                above.words += len(words)

    def pop_to(depth: int) -> None:
        if any(element.tag in _BLOCKS for element in stack[depth:]):
            close_block()
        while len(stack) > depth:
            element = stack.pop()
            open_tags[element.tag] -= 1
            above = stack[-1]
            above.words += element.words
            above.titled |= element.titled
            if len(element.contents) > 1 or element.contents and element.judged:
                above.contents.append(_hash(element.contents))
            else:
                above.contents += element.contents

    def innermost(tag: str) -> int:
        """Place of the innermost open element with a tag, 0 if none is open."""
        return next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag) if open_tags[tag] else 0

    while at < size:
        found = _TAG.search(text, at)
        if not found:
            put(text[at:])
            break
        put(text[at: found.start()])
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag, closes, rest = tag.lower(), found[1] or found[4], found[3] or found[6] or ""
        if closes:
            if depth := innermost(tag):
                pop_to(depth)
            elif tag in ("p", "br"):
                close_block() if tag == "p" else put(" ")
            continue
        if tag in _ENDS_PARAGRAPH:
            if depth := innermost("p"):
                pop_to(depth)
        if tag in _SIBLINGS:
            ends, within = _SIBLINGS[tag]
            for i in range(len(stack) - 1, 0, -1) if any(open_tags[end] for end in ends) else ():
                if stack[i].tag in within:
                    break
                if stack[i].tag in ends:
                    pop_to(i)
        if tag in _BLOCKS:
            close_block()
        elif tag in ("br", "img", "wbr"):
            put(" " if tag == "br" else "")
        above = stack[-1]
        above.children.append(tag)
        if tag in _NO_END:
            continue
        attributes = _attributes(rest) if rest else {}
        noise = above.noise or _is_noise(tag, attributes, above.article)
        classes = ".".join(sorted(attributes.get("class", "").split()))
        style = xxhash.xxh64_intdigest(f"{above.style:x}/{tag}.{classes}")
        article = above.article or tag in ("article", "main")
        text_block = tag in _TEXT_BLOCKS
        judged = not noise and tag in _BLOCKS and tag != "html" and not (article and text_block)
        main = above.main or style in branches.main
        element = Element(
            tag, style, above.style if above.judged else above.parent, noise, article, main, judged, box=judged and not text_block,
            cut=above.cut or judged and style in branches.cut,
            light=not (main or article) and (above.light or judged and style in branches.light),
            suspect=style not in branches.main and (above.suspect or _is_suspect(tag, attributes, above.article)), titled=tag == "h1")
        if judged:
            elements.append(element)
        if tag in _RAW:
            end = re.compile(f"</{tag}", re.I).search(text, at)
            stop = end.start() if end else size
            if not noise:
                put(text[at:stop])
            at = stop
            if end:
                close = text.find(">", at)
                at = close + 1 if close >= 0 else size
            continue
        if not rest.rstrip().endswith("/") or tag not in ("svg", "path"):
            stack.append(element)
            open_tags[tag] += 1
    pop_to(1)
    close_block()
    return Page(blocks, elements, root.words)


def main_text(page: Page) -> str:
    """Blocks that no branch or name drops, of articles and main branches if the page has any, two line ends between them."""
    kept = [block for block in page.blocks if not block[0]]
    if any(main for _, _, _, main, _ in kept):
        kept = [block for block in kept if not block[1]]
    if any(article for _, _, article, _, _ in kept):
        kept = [block for block in kept if block[2] or block[3]]
    return "\n\n".join(own for *_, own in kept)


def _hash(marks: list[int]) -> int:
    return xxhash.xxh64_intdigest(np.array(marks, np.uint64).tobytes())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


_NODE = "host string, style long, parent long, body boolean, box boolean, titled boolean, content long, layout long, words long, of_words long, page long"


def style_nodes(pages: DataFrame) -> DataFrame:
    """A row for each judged style of each page.

    ``parent`` is the judged style above; ``content``, ``layout`` and ``page`` are hashes
    of what the style's elements hold, of how their children are laid out, and of all
    text of the page; ``words`` are the style's, ``of_words`` the page's.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for url, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            nodes: dict[int, list] = {}
            page = read_page(text or "")
            whole = _signed(xxhash.xxh64_intdigest("\n".join(own for *_, own in page.blocks)))
            for element in page.elements:
                node = nodes.setdefault(element.style, [element, [], [], False, 0])
                node[1] += element.contents
                node[2] += [*element.children, "/"]
                node[3] |= element.titled
                node[4] += element.words
            host = host_of(url)
            for style, (first, contents, layout, titled, words) in nodes.items():
                rows.append((host, _signed(style), _signed(first.parent), first.tag == "body", first.box, titled,
                             _signed(_hash(contents)), _signed(xxhash.xxh64_intdigest(" ".join(layout))), words, page.words, whole))
        schema = pa.schema([(name, _KINDS[kind]) for name, kind in (column.split() for column in _NODE.split(", "))])
        columns = zip(*rows) if rows else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, schema.types)], schema=schema)

    return map_batches(pages.select("url", "html"), run, _NODE)


def once_each(nodes: DataFrame) -> DataFrame:
    """Style nodes with pages that read the same put together; copies counts them."""
    least = [F.min(column).alias(column) for column in ("parent", "body", "box", "content", "layout", "words", "of_words")]
    return nodes.groupBy("host", "style", "page").agg(*least, F.max("titled").alias("titled"), F.count("*").alias("copies"))


def _entropies(nodes: DataFrame, column: str) -> DataFrame:
    """Per host and style: the entropy of ``column`` over the pages as a share of the most there can be, and other sums."""
    least = [F.min(name).alias(name) for name in ("parent", "body", "box")]
    sums = [F.sum(name).alias(name) for name in ("words", "of_words", "copies")]
    counts = nodes.groupBy("host", "style", column).agg(*least, F.max("titled").alias("titled"), F.count("*").alias("n"), *sums)
    whole = counts.groupBy("host", "style").agg(
        *least, F.max("titled").alias("titled"), *sums, F.sum("n").alias("pages"), F.sum(F.col("n") * F.log("n")).alias("weighted"))
    share = F.when(F.col("pages") > 1, 1 - F.col("weighted") / (F.col("pages") * F.log("pages"))).otherwise(1.0)
    return whole.withColumn(f"{column}_entropy", share).drop("weighted")


def importances(nodes: DataFrame) -> DataFrame:
    """The merged style nodes: pages (different ones), copies (all), importance and layout_entropy (0 to 1), and share of the words."""
    layout = _entropies(nodes, "layout").select(F.col("host").alias("_host"), F.col("style").alias("_style"), "layout_entropy")
    joined = _entropies(nodes, "content").join(layout, F.col("host").eqNullSafe(F.col("_host")) & (F.col("style") == F.col("_style")))
    importance = CONTENT_SHARE * F.col("content_entropy") + (1 - CONTENT_SHARE) * F.col("layout_entropy")
    share = F.when(F.col("of_words") > 0, F.col("words") / F.col("of_words")).otherwise(0.0)
    return joined.drop("_host", "_style").withColumn("importance", importance).withColumn("share", share)


def judged_branches(pages: DataFrame) -> DataFrame:
    """host, its pages (size), and the styles that are cut, light (cut beside a main branch) and main there."""
    once = materialize(once_each(style_nodes(pages)), "style-nodes-of-pages")
    nodes = materialize(importances(once), "style-nodes").filter(F.col("host").isNotNull())
    hosts = nodes.filter("body").groupBy("host").agg(F.sum("copies").alias("size"), F.max("importance").alias("body_importance"))
    known = nodes.filter(~F.col("body") & (F.col("pages") >= PAGES))
    heavy = known.filter(F.col("box") & (F.col("share") >= MAIN) & (F.col("importance") >= LOW))
    above = heavy.select("host", F.col("parent").alias("style")).distinct()
    main = heavy.join(above, ["host", "style"], "left_anti").select("host", "style", F.lit("main").alias("kind"))
    cut = known.filter(F.col("importance") < LOW).join(hosts, "host").filter(F.col("body_importance") >= BODIES)
    light = known.filter(F.col("box") & ~F.col("titled") & (F.col("share") < LIGHT) & (F.col("layout_entropy") < FIXED))
    found = main.unionByName(cut.select("host", "style", F.lit("cut").alias("kind"))).unionByName(light.select("host", "style", F.lit("light").alias("kind")))
    sets = [F.collect_set(F.when(F.col("kind") == kind, F.col("style"))).alias(kind) for kind in ("cut", "light", "main")]
    return found.groupBy("host").agg(*sets).join(hosts.select("host", "size"), "host")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    judged = materialize(judged_branches(pages), "judged-branches")
    branches = judged.agg(F.sum(F.size("cut") + F.size("light") + F.size("main"))).first()[0] or 0
    kind = dict(pages.dtypes)["page_id"]

    host = F.lower(F.regexp_replace(F.regexp_extract("url", _HOST.pattern, 1), "^.*@", ""))
    rows = pages.withColumn("host", F.when(F.col("url").rlike(_HOST.pattern), host).otherwise(F.col("url")))
    if branches <= BROADCAST_BRANCHES:
        rows = rows.join(F.broadcast(judged.drop("size")), "host", "left")
    else:
        rows = join_counted(rows, judged, ["host"], "size", F.col("page_id"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text, *styles in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
            sets = (frozenset(style % (1 << 64) for style in own or ()) for own in styles)
            found.append(main_text(read_page(text or "", Branches(*sets))))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return map_batches(rows.select("page_id", "url", "html", "cut", "light", "main"), run, f"page_id {kind}, url string, text string, n_chars long")
