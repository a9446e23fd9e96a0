"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: a node is a path of tags (with their classes) and collects the
presentations (which child tags follow each other) and the contents that the pages have there. A node whose
presentations and contents hardly vary over the pages of a site carries the site's frame; such a branch is
removed from each page. What HTML or a class declares a branch to be (nav, article, "sidebar") is a prior that counts as
so many pages, and it tells which entropy is evidence. Menus, footers and adverts change their words from page to page as
articles do, so the contents of declared frames, and of what lies beside a declared main part, tell nothing: their presentations
decide, and a branch that is built anew on page after page stays whatever it is called. Neutral branches and those inside the
main part go by both entropies.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import stored, table

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea|title|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""",
    re.S | re.I,
)
_ATTR = re.compile(r"""(class|id|role|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 caption dt th".split())
_VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold no article text on any site: controls, media and what isn't shown.
_NEVER = frozenset("form button select dialog head object canvas audio video label input fieldset".split())
#: Elements and roles that HTML defines as frame.
_FRAME = frozenset("nav footer aside menu header".split())
_FRAME_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Words of class names and ids that speak of a frame, and those that say nothing either way. A name speaks of a frame when it has one of the
#: first and none but these: "ad-box" and "cookie-notice" do, "article-header", "sidebar-layout" and "related-work" don't.
_FRAME_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer header masthead cookie cookies consent gdpr notice popup modal newsletter subscribe share sharing social related recommended widget toolbar skip copyright pagination pager login signup".split())
_PLAIN_WORDS = frozenset("site page main top bottom left right box bar list item items block section area container wrapper inner outer panel links link buttons button posts stories global wrap slot unit zone group text".split())
#: Readers write these, so they differ on every page and no tree can tell them from articles.
_READERS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|respond|disqus|replies)(?:$|[\s_-]|\d)", re.I)


def _speaks_of_frame(name: str) -> bool:
    words = [w for w in re.split(r"[^a-z]+", name.lower()) if w]
    return any(w in _FRAME_WORDS for w in words) and all(w in _FRAME_WORDS or w in _PLAIN_WORDS for w in words)


#: What a branch is declared to be, with its prior importance, the number of pages that the prior counts as, and its weight however many pages there are.
FRAME, NAMED, OUTSIDE, NEUTRAL, MAIN = range(5)
PRIORS = {FRAME: (0.0, 8, 0.0), NAMED: (0.0, 8, 0.0), OUTSIDE: (0.0, 8, 0.0), NEUTRAL: (0.8, 2, 0.2), MAIN: (1.0, 2, 0.4)}
#: Of these the presentations alone are evidence.
DECLARED = (FRAME, NAMED, OUTSIDE)
#: A start tag on the left ends an open element on the right.
_ENDS = {"p": {"p"}, "li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = frozenset("html body div article section main ul ol table dl aside nav header footer form blockquote td th".split())


class Node:
    __slots__ = ("tag", "label", "never", "frame", "named", "main", "children")

    def __init__(self, tag: str, attrs: str = ""):
        names, role, hidden = [], "", False
        if attrs:
            for name, value in _ATTR.findall(attrs):
                value = value.strip("\"'")
                name = name.lower()
                if name in ("class", "id"):
                    names += value.split()
                elif name == "role":
                    role = value.lower()
                else:
                    hidden = True
        self.tag = tag
        # numbers in names count things of one kind
        self.label = tag + "".join("." + n for n in sorted(re.sub(r"\d+", "0", n.lower()) for n in names))
        self.main = tag in ("article", "main") or role == "main"
        body = tag in ("html", "body") or self.main
        self.never = tag in _NEVER or hidden or (not body and any(_READERS.search(n) for n in names))
        self.frame = tag in _FRAME or role in _FRAME_ROLE
        self.named = tag not in ("html", "body") and any(_speaks_of_frame(n) for n in names)
        self.children: list = []


def parse(text: str) -> Node:
    """A tree of Nodes and strings. Unclosed and misnested elements end where the next block makes them end; text that a cut-off
    tag leaves at the end is dropped with it."""
    root = Node("#")
    stack, at = [root], 0
    for m in _TOKEN.finditer(text):
        if m.start() > at:
            stack[-1].children.append(text[at : m.start()])
        at = m.end()
        tag = (m.group(3) or "").lower()
        if not tag:
            continue
        if m.group(2):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE and tag not in _SCOPE:
                    break
            continue
        if tag in _BLOCK and tag != "br":
            ended = _ENDS.get(tag, {"p"})
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ended:
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPE:
                    break
        node = Node(tag, m.group(4))
        stack[-1].children.append(node)
        if tag not in _VOID and not m.group(4).endswith("/"):
            stack.append(node)
    rest = text[at:]
    if rest:
        cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)
        stack[-1].children.append(rest[: cut.start()] if cut else rest)
    return root


def _hash(text: str) -> int:
    return xxh3_64_intdigest(text) - (1 << 63)


def branches(root: Node) -> list[tuple[Node, int, int, int | None, int]]:
    """(node, its parent's place, path, key, what it is declared to be) of all elements, parents before children; without what never holds text, and all below it.

    path is a hash of the labels from the root, of any depth. key tells branches that the tree judges together: path and what the branch is
    declared to be on its page. It is None for branches that aren't judged: the declared main part and what holds it, and headings in it, which are often the same on many pages of a site
    ("Ingredients") and go with the branch that they head."""
    order: list[tuple[Node, int, int]] = [(root, -1, 0)]
    for at, (node, _, path) in enumerate(order):
        order += [(c, at, _hash(f"{path}/{c.label}")) for c in node.children if not isinstance(c, str) and not c.never]
    # the main part is what lies in no frame, or, if there is none such, in none but frames by name
    main: set[int] = set()
    for barred in ((lambda n: n.frame or n.named), (lambda n: n.frame)):
        away = set()
        for at, (node, parent, _) in enumerate(order):
            if parent in away or barred(node):
                away.add(at)
            elif node.main and not node.named:
                main.add(at)
        if main:
            break
    holds, inside = set(main), set()
    for at in range(len(order) - 1, 0, -1):
        if at in holds:
            holds.add(order[at][1])
    out = []
    for at, (node, parent, path) in enumerate(order):
        if at in main or parent in inside:
            inside.add(at)
        if node.frame and not (node.tag == "header" and at in inside):
            kind = FRAME
        elif node.named:
            kind = NAMED
        elif at in inside:
            kind = MAIN
        else:
            # below a declared branch that stays, the tree alone decides
            declared = parent > 0 and parent not in holds and out[parent][4] in (*DECLARED, NEUTRAL)
            kind = OUTSIDE if main and not declared else NEUTRAL
        judged = at > 0 and at not in holds and not (kind == MAIN and node.tag in _HEADINGS)
        out.append((node, parent, path, _hash(f"{kind}:{path}") if judged else None, kind))
    return out


def style_nodes(page: str) -> list[tuple[int, int, int, int]]:
    """(key, what it is declared to be, hash of the presentation, hash of the content) of every judged branch of a page; elements of one key are taken together, in page order.

    The presentation of a neutral or main branch is the sequence of its child tags. That of a declared one is the set of the kinds of branches in it, to any depth: how many
    entries a menu has, and which of them is the present page's, is no difference."""
    order = branches(parse(page))
    kinds: list[set[str]] = [set() for _ in order]
    content: list[list[str]] = [[c if isinstance(c, str) else "" for c in node.children] for node, *_ in order]
    digest = [0] * len(order)
    for at in range(len(order) - 1, -1, -1):  # children before their parents
        digest[at] = _hash(" ".join("".join(content[at]).split()))
        parent = order[at][1]
        if parent >= 0:
            content[parent].append(f" {digest[at]}")
            kinds[parent].add(f"{order[at][0].label} {_hash(','.join(sorted(kinds[at]))) if kinds[at] else ''}")
    styles: dict[int, tuple[int, list[str], list[int]]] = {}
    for (node, _, _, key, kind), d, inner in zip(order, digest, kinds, strict=True):
        if key is None:
            continue
        _, seen, contents = styles.setdefault(key, (kind, [], []))
        contents.append(d)
        if kind in DECLARED:
            seen.append(",".join(sorted(inner)))
            continue
        # a run of equal tags is one tag with a plus, as in the style tree's sequences
        tags: list[str] = []
        for c in node.children:
            if not isinstance(c, str):
                if tags and tags[-1].rstrip("+") == c.label:
                    tags[-1] = c.label + "+"
                else:
                    tags.append(c.label)
        seen.append(",".join(tags))
    return [(key, kind, _hash(";".join(sorted(set(seen)) if kind in DECLARED else seen)), _hash(";".join(map(str, contents)))) for key, (kind, seen, contents) in styles.items()]


def main_text(page: str | None, unimportant: frozenset[int] = frozenset(), varying: frozenset[int] = frozenset()) -> str:
    """The blocks of a page, one a line, without what never holds text and without the branches whose keys are unimportant.

    Text that stands right in an element around the declared main part, in no branch of its own, is left out. If the tree would take all
    of a declared main part, that part stays. If it would leave nothing of a page that declares no main part, branches that go for their name alone but differ from page to page (varying) stay."""
    if not page:
        return ""
    order = branches(parse(page))
    if any(kind == MAIN and key in unimportant for *_, key, kind in order):
        beside = {key for *_, key, kind in order if key is not None and kind != MAIN}
        if not _blocks(order, unimportant | beside):
            unimportant = unimportant & beside
    names_alone = varying & unimportant and all(kind not in (MAIN, OUTSIDE) for *_, kind in order)
    return _blocks(order, unimportant) or (_blocks(order, unimportant - varying) if names_alone else "")


def _blocks(order: list[tuple], unimportant: frozenset[int]) -> str:
    place = {id(node): at for at, (node, *_) in enumerate(order)}
    around = set()  # elements that hold the main part without being inside it
    has_main = any(kind == OUTSIDE for *_, kind in order)
    for at, (_, _, _, key, kind) in enumerate(order):
        if has_main and key is None and kind == OUTSIDE:
            around.add(at)
    blocks: list[list[str]] = [[]]
    todo: list = [(order[0][0], False)]  # a node or a string with whether it counts; None ends a block
    while todo:
        x = todo.pop()
        if x is None:
            blocks.append([])
            continue
        node, counts = x
        if isinstance(node, str):
            if counts:
                blocks[-1].append(node)
            continue
        at = place.get(id(node))
        if at is None or order[at][3] in unimportant:
            continue
        if node.tag in _BLOCK:
            blocks.append([])
            todo.append(None)
        counts = at not in around
        todo.extend((c, counts) for c in reversed(node.children))
    lines = (" ".join(html.unescape("".join(b)).split()) for b in blocks if b)
    return "\n".join(line for line in lines if line)


def host_of(url: Column) -> Column:
    """Lower-case host of a url, '' if none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def importance(kind: Column, pages: Column, presentation: Column, entropy: Column) -> Column:
    """Of a branch from 0 to 1: its entropy over so many pages (of a declared one, that of its presentations), drawn to the prior as by so many pages more, and the prior itself by its weight."""
    out = F.lit(None).cast("double")
    for k, (prior, n, weight) in PRIORS.items():
        seen = presentation if k in DECLARED else entropy
        out = F.when(kind == k, (1 - weight) * (pages * seen + n * prior) / (pages + n) + weight * prior).otherwise(out)
    return out


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, key, kind, pages, presentation, entropy, importance) of all branches of all hosts.

    The entropy of a branch over the m pages that have it is the larger of two to the base m: that of its presentations, which stands beside it, and that of its
    contents, which are those of the whole branch, so that it is at least that of any branch below. It is 0 where all pages agree, 1 where all differ, and 1 for a
    branch of one page. Equal pages of a host count once. Pages without a host have no site: each stands alone.
    Counts are combined before the shuffle and keys carry the branch, so a host with a third of all pages makes no large group.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows = [(h, _hash(page or ""), *x) for h, page in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True) for x in style_nodes(page or "")]
                cols = list(zip(*rows, strict=True)) if rows else [()] * 6
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["host", "page", "key", "kind", "style", "content"])

    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInArrow(work, "host string, page bigint, key bigint, kind int, style bigint, content bigint")
    counts = rows.distinct().groupBy("host", "key", "kind", "style", "content").agg(F.count("*").alias("n"))
    each = counts.select("host", "key", "kind", "n", F.explode(F.array(F.struct(F.lit("s").alias("of"), F.col("style").alias("v")), F.struct(F.lit("c").alias("of"), F.col("content").alias("v")))).alias("x"))
    sums = each.groupBy("host", "key", "kind", "x.of", "x.v").agg(F.sum("n").alias("n"))
    entropy = sums.groupBy("host", "key", "kind", "of").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"))
    value = F.when((F.col("m") > 1) & (F.col("host") != ""), (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m")).otherwise(F.lit(1.0))
    out = entropy.groupBy("host", "key", "kind").agg(F.when(F.col("host") != "", F.max("m")).otherwise(F.lit(1)).alias("pages"), F.max(F.when(F.col("of") == "s", value)).alias("presentation"), F.max(value).alias("entropy"))
    return out.withColumn("importance", importance(F.col("kind"), F.col("pages"), F.col("presentation"), F.col("entropy")))


def extract_main_text(pages: DataFrame, threshold: float = 0.5, broadcast_limit: int = 200_000, salts: int = 64) -> DataFrame:
    """(page_id, url, text) for every row of pages (page_id, url, html).

    Null or empty html gives an empty text; a null or odd url puts the page under no host, where the priors alone decide. Repeated rows are extracted each. Other columns are not read.
    The removed branches of a host (its frame, not its pages) meet its pages by broadcast while all of them together are at most
    broadcast_limit, and else by a join on the host dealt over `salts` parts, so that a large host is no large task.
    """
    named = (F.col("kind") == NAMED) & (F.col("entropy") >= threshold)
    keys = stored(style_tree(pages).where(F.col("importance") < threshold).groupBy("host").agg(F.collect_set("key").alias("keys"), F.collect_set(F.when(named, F.col("key"))).alias("varying")), "branches")
    n = keys.agg(F.coalesce(F.sum(F.size("keys") + F.lit(1)), F.lit(0)).alias("n")).first()["n"]
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    if n <= broadcast_limit:
        rows = rows.join(F.broadcast(keys), "host", "left")
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(salts)).cast("int"))
        rows = rows.join(keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), ["host", "salt"], "left")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [main_text(h, frozenset(k or ()), frozenset(v or ())) for h, k, v in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return rows.select("page_id", "url", "html", "keys", "varying").mapInArrow(work, f"page_id {kind}, url string, text string")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
