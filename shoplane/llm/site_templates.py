"""Main text of web pages by removing each site's template (operator 1).

1. Every page is parsed to a light tree in which each element has a hash of its subtree: tag, class, id,
   texts and children. Tasks send (scope, subtree, page body) triples of elements that could be template.
   A page is in the scope of its host and, if its path has a folder, in that of the host's section: host and
   first path segment, be it a topic, a blog or a language.
2. Spark counts, per scope, on how many different page bodies a subtree occurs (copies of one page count
   once). A subtree on at least ``MIN_PAGES`` bodies and a share ``MIN_SHARE`` of the scope's is template.
   Outside the main part, one on ``MANY_PAGES`` bodies of a host is template whatever its share, so a block
   from a pool of many variants, or of a part of a large host, goes too. Headings, quotes, list items and
   table rows are not judged by that count: short ones recur in texts of their own.
3. Each page is parsed again, the template subtrees of its host are deleted, and so are elements whose
   meaning is not text of the article: menus, page headers, footers, sidebars, notices, adverts, forms,
   comments, scripts, by their tag, role, class or id, and lists that consist of links. Text inside the
   page's main element, if it has one, is what remains; paragraphs and headings in there are never
   taken for template, since articles of one site quote the same lines. A page without main element that
   would lose all but next to nothing keeps the largest block of the template: near copies of one page
   repeat its text.

The triples are counted by (scope, subtree) with map-side combining, so a host with a third of all pages is
spread over all tasks, and every subtree meets its scope's own count in a row of its own: the scopes' counts
are broadcast if there are at most ``BROADCAST_ROWS``, otherwise joined by scope and salt. Templates are written to the shared folder as sorted arrays of keys (see ``arrays``),
at most about ``SHARD_KEYS`` to an array, and mapped by the workers, so pages join nothing and a host may
have any number of them. Html is parsed inside tasks, a page at a time.

Defined results: null or empty html gives an empty text; a null url is a host of its own; unclosed,
cut-off and misnested tags are closed as browsers do in simple cases, and so are comments; rows are independent, so repeated
rows give repeated results; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_module
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import arrays
from .common import stage

MIN_PAGES = 4
MIN_SHARE = 0.3
MANY_PAGES = 50
SHARD_KEYS = 1_000_000
BROADCAST_ROWS = 500_000
SALTS = 32

_words = str.split
VOID = set(_words("area base br col embed hr img input link meta param source track wbr"))
RAW = set(_words("script style textarea title noscript iframe xmp noembed noframes"))
BLOCKS = set(_words(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul"))
SPACED = set(_words("br td th"))                # white space, but no block of their own
HEADINGS = set(_words("h1 h2 h3 h4 h5 h6"))
#: an open element of the first kind ends where one of the second kind starts
ENDS_AT = {"p": BLOCKS - {"html", "body"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
           "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"},
           "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"}}
#: elements that an implied end does not look beyond
SCOPE = set(_words("html body table td th ul ol dl article main section div aside nav form button"))
#: blocks of texts that stay in the main part
PLAIN = HEADINGS | set(_words("p blockquote pre li"))
#: blocks that a count of pages alone does not make template
SHORT = HEADINGS | set(_words("blockquote pre li dt dd caption figcaption legend option tr tbody thead tfoot"))
#: never text of the article
DROPPED_TAGS = RAW | set(_words("head template svg math canvas object embed audio video map nav footer aside form button select datalist "
                                "menu dialog"))
DROPPED_ROLES = set(_words("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form"))
#: words in a class or id that mark an element as no part of the article
DROPPED_NAMES = set(_words(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "sidebar widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments respond disqus "
    "reply replies pagination pager toolbar search"))
#: of these, the ones that may also name a part of an article: in there they go if they are a small share of it
PART_NAMES = set(_words("header footer banner notice alert related nav search"))
SMALL_PART = 0.25
#: and of these, the ones that stay with a heading inside, which is the article's
TITLE_NAMES = set(_words("header banner"))
#: of these, the ones that hold for an article element too
ARTICLE_NAMES = set(_words("ad ads advert advertisement promo sponsored comment comments reply replies related recommended"))
COMMENT_NAMES = set(_words("comment comments respond disqus reply replies"))

_TELLS = re.compile(r"(?:has|no|with|without|is|not)[-_]", re.I)
_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[/a-zA-Z][^>]*\Z""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|itemprop|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@dataclass
class Element:
    tag: str
    parent: int
    names: str = ""             # class and id
    role: str = ""
    prop: str = ""
    hidden: bool = False
    subtree: int = 0
    chars: int = 0              # of text inside
    link_chars: int = 0
    links: int = 0
    has_main: bool = False
    has_heading: bool = False
    parts: list = field(default_factory=list)


def parse(source: str) -> tuple[list[Element], list[tuple[int, str] | None]]:
    """Elements in page order, and the texts: (element, text), with None where a block begins or ends."""
    nodes, stack, texts = [Element("", -1)], [0], []

    def close() -> None:
        n = nodes[i := stack.pop()]
        n.subtree = xxhash.xxh64_intdigest("\x00".join([n.tag, n.names, *n.parts])) - (1 << 63)
        n.parts = []
        up = nodes[n.parent]
        if n.tag == "a":
            n.link_chars, n.links = n.chars, 1
        up.parts.append(f"\x01{n.subtree}")
        up.chars += n.chars
        up.link_chars += n.link_chars
        up.links += n.links
        up.has_main |= n.has_main or _is_main(n)
        up.has_heading |= n.has_heading or n.tag in HEADINGS
        if n.tag in BLOCKS:
            texts.append(None)

    def text(raw: str) -> None:
        if raw.strip():
            if "&" in raw:
                raw = html_module.unescape(raw)
            n = nodes[stack[-1]]
            words = " ".join(raw.split())
            n.parts.append(words)
            n.chars += len(words)
            texts.append((stack[-1], raw))
        elif raw:
            texts.append((stack[-1], " "))

    at = 0
    while m := _TOKEN.search(source, at):
        if m.start() > at:
            text(source[at:m.start()])
        at = m.end()
        end, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if nodes[stack[k]].tag == tag), 0)
            if depth:
                while len(stack) > depth:
                    close()
            continue
        for k in range(len(stack) - 1, 0, -1):
            above = nodes[stack[k]].tag
            if tag in ENDS_AT.get(above, ()):
                while len(stack) > k:
                    close()
                break
            if above in SCOPE:
                break
        n = Element(tag, stack[-1])
        if attrs:
            for key, value in _ATTR.findall(attrs):
                key, value = key.lower(), html_module.unescape(value.strip("\"'"))
                if key in ("class", "id"):
                    n.names += f" {value}"
                elif key == "role":
                    n.role = value.lower()
                elif key == "itemprop":
                    n.prop = value.lower()
                elif key == "hidden" or value.lower() == "true":
                    n.hidden = True
        nodes.append(n)
        if tag in BLOCKS:
            texts.append(None)
        elif tag in SPACED:
            texts.append((stack[-1], " "))
        stack.append(len(nodes) - 1)
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS and tag not in RAW:
            close()
        elif tag in RAW:
            # what is inside is not markup
            stop = re.compile(rf"</{re.escape(tag)}\b", re.I).search(source, at)
            at = stop.start() if stop else len(source)
            close()
    if at < len(source):
        text(source[at:])
    while len(stack) > 1:
        close()
    return nodes, texts


def _is_main(n: Element) -> bool:
    return n.tag in ("article", "main") or n.role == "main" or n.prop == "articlebody"


def _named(n: Element) -> set[str]:
    """Words of the class and id; a name like has-sidebar tells of something inside or elsewhere."""
    return {w.lower() for name in n.names.split() if not _TELLS.match(name) for w in _NAME.findall(name)}


def _dropped(n: Element, in_main: bool, page_chars: int, main_chars: int) -> bool:
    """Whether the element by itself is no text of the article; ``main_chars``: of the main part around it."""
    if n.tag in ("html", "body", "main"):
        return False
    if n.tag in DROPPED_TAGS or n.hidden or n.role in DROPPED_ROLES:
        return True
    if n.tag == "header" and not in_main:
        return not n.has_main
    if n.has_main or n.tag in HEADINGS:
        return False
    if names := _named(n):
        wanted = ARTICLE_NAMES if _is_main(n) else DROPPED_NAMES - PART_NAMES if in_main else DROPPED_NAMES
        # what holds most of the page's text is a layout element, unless it holds comments
        if names & wanted and (2 * n.chars < page_chars or names & COMMENT_NAMES):
            return True
        if in_main and n.chars < SMALL_PART * main_chars and names & (PART_NAMES - TITLE_NAMES if n.has_heading else PART_NAMES):
            return True
    return not in_main and n.tag in ("ul", "ol", "table", "div", "section", "p") and n.links > 1 and n.link_chars >= 0.8 * n.chars


def _survey(nodes: list[Element]) -> tuple[list[bool], list[bool]]:
    """For every element: dropped by itself or with one around it; inside the main part."""
    dropped, main, chars = [False] * len(nodes), [False] * len(nodes), [0] * len(nodes)
    for i, n in enumerate(nodes):
        if i:
            dropped[i] = dropped[n.parent] or _dropped(n, main[n.parent], nodes[0].chars, chars[n.parent])
            main[i] = main[n.parent] or (_is_main(n) and not dropped[i])
            chars[i] = chars[n.parent] or (n.chars if main[i] else 0)       # of the outermost main element
    return dropped, main


def _repeats(n: Element, in_main: bool) -> bool:
    """Whether the element is of a kind that can be template."""
    return (n.chars > 0 and n.tag in BLOCKS and n.tag not in ("html", "body") and not n.has_main and not _is_main(n)
            and not (in_main and n.tag in PLAIN))


def template_candidates(source: str) -> tuple[int, dict[int, bool]]:
    """Hash of the page's body, and the subtrees that could be template: whether a count of pages alone tells."""
    nodes, _ = parse(source)
    dropped, main = _survey(nodes)
    found: dict[int, bool] = {}
    for i, n in enumerate(nodes):
        if i and not dropped[n.parent] and _repeats(n, main[i]):
            found[n.subtree] = found.get(n.subtree, False) or not (main[i] or n.tag in SHORT)
    return nodes[1].subtree if len(nodes) > 1 else 0, found


class Templates:
    """Keys of template subtrees: scope ^ subtree, or the complement of it if for blocks outside the main part only."""

    def __init__(self, shards: list[np.ndarray]):
        self.shards = shards

    def have(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), bool)
        of = keys % len(self.shards)
        for s in np.unique(of):
            at, known = np.flatnonzero(of == s), self.shards[s]
            if len(known):
                out[at] = known[np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)] == keys[at]
        return out

    def of_page(self, nodes: list[Element], main: list[bool], scopes: list[int]) -> set[int]:
        """The elements that are template in one of the scopes, of which the first is the host."""
        at = [i for i, n in enumerate(nodes) if i and _repeats(n, main[i])]
        if not at:
            return set()
        subtrees = np.array([nodes[i].subtree for i in at], np.int64)
        outer = np.array([not (main[i] or nodes[i].tag in SHORT) for i in at])
        keys = np.concatenate([~(subtrees ^ scopes[0]), *(subtrees ^ s for s in scopes)])
        many, *shares = self.have(keys).reshape(-1, len(at))
        return {at[k] for k in np.flatnonzero(np.any(shares, axis=0) | (many & outer))}


@lru_cache(2)
def _templates(made: tuple[str, ...]) -> Templates:
    return Templates([arrays.load(d)["key"] for d in made])


def _without(nodes: list[Element], texts: list, dropped: list[bool], main: list[bool], found: set[int]) -> list[bool]:
    """What is dropped once the template goes, less the page's text where it was taken for template.

    Near copies of one page are different bodies, so that their common text recurs as a template does. If a page
    without main part keeps next to nothing beside the largest block that went, that block is its text. Pieces
    of text of one parent count as one block, and texts of links do not count.
    """
    out, block, link = list(dropped), [-1] * len(nodes), [False] * len(nodes)
    for i, n in enumerate(nodes):
        if i:
            link[i] = link[n.parent] or n.tag == "a"
            block[i] = block[n.parent]
            if block[i] < 0 and i in found and not dropped[i]:
                block[i] = n.parent if n.tag in SHORT or n.tag == "p" else i
            out[i] = dropped[i] or block[i] >= 0
    if any(main):
        return out
    gone: dict[int, int] = {}
    left = 0
    for t in texts:
        if t and not dropped[t[0]]:
            if block[t[0]] < 0:
                left += len(t[1].strip())
            elif not link[t[0]]:
                gone[block[t[0]]] = gone.get(block[t[0]], 0) + len(t[1].strip())
    if gone and left < 0.2 * max(gone.values()):
        best = max(gone, key=gone.get)
        out = [a or (b >= 0 and b != best) for a, b in zip(dropped, block)]
    return out


def main_text(source: str | None, templates: Templates | None = None, scopes: list[int] = ()) -> str:
    """The article's blocks, joined by line feeds."""
    if not source:
        return ""
    nodes, texts = parse(source)
    dropped, main = _survey(nodes)
    if templates and (found := templates.of_page(nodes, main, scopes)):
        dropped = _without(nodes, texts, dropped, main, found)
    size = {True: 0, False: 0}
    for t in texts:
        if t and not dropped[t[0]]:
            size[main[t[0]]] += len(t[1].strip())
    # a main part that holds next to nothing is not where the text is
    only_main = size[True] > 0 and size[True] >= 0.2 * size[False]
    blocks, now = [], []
    for t in [*texts, None]:
        if t is None:
            if line := " ".join("".join(now).split()):
                blocks.append(line)
            now = []
        elif not dropped[t[0]] and (main[t[0]] or not only_main):
            now.append(t[1])
    return "\n".join(blocks)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)", 1))


def section(url: Column) -> Column:
    """First segment of the path, if something may come below it; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*/([^/?#]+)/", 1)


def _scopes(url: Column) -> list[Column]:
    """Hashes of the host, and of its section (null: none)."""
    return [F.xxhash64(host(url)).alias("host"), F.when(section(url) != "", F.xxhash64(host(url), section(url))).alias("section")]


def site_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES,
                   min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """(key): of every template subtree, as ``Templates`` has them."""
    def run(batches):
        for batch in batches:
            scopes, bodies, subtrees, outer = [], [], [], []
            for h, s, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                body, found = template_candidates(source.as_py())
                for scope in (h, s):
                    if scope is not None:
                        scopes += [scope] * (len(found) + 1)
                        bodies += [body] * (len(found) + 1)
                        subtrees += [None, *found]              # null counts the scope's bodies
                        outer += [False, *(found.values() if scope == h else [False] * len(found))]
            yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (scopes, bodies, subtrees)), pa.array(outer, pa.bool_())],
                                             names=["scope", "body", "subtree", "outer"])

    triples = (pages.select(*_scopes(F.col(url_col)), F.col(html_col).cast("string").alias("html"))
               .filter(F.length("html") > 0).mapInArrow(run, "scope bigint, body bigint, subtree bigint, outer boolean"))
    counts = (triples.groupBy("scope", "body", "subtree").agg(F.max("outer").alias("outer"))
              .groupBy("scope", "subtree").agg(F.count(F.lit(1)).alias("n"), F.count_if("outer").alias("n_outer")))
    # scopes with too few bodies have no template
    often = stage(counts.filter(F.col("n") >= min_pages), "site-subtrees")
    bodies = often.filter(F.col("subtree").isNull()).select("scope", F.col("n").alias("bodies"))
    rows = often.filter(F.col("subtree").isNotNull())
    if bodies.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        rows = rows.join(F.broadcast(bodies), "scope")
    else:
        bodies = bodies.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
        rows = rows.withColumn("salt", F.pmod("subtree", F.lit(SALTS)).cast("int")).join(bodies, ["scope", "salt"])
    return _keys(rows, min_share, many_pages)


def _keys(rows: DataFrame, min_share: float, many_pages: int) -> DataFrame:
    """Keys of the template subtrees among rows (scope, bodies, subtree, n, n_outer)."""
    key, share = F.col("scope").bitwiseXOR(F.col("subtree")), F.col("n") >= F.col("bodies") * min_share
    return rows.filter(share | (F.col("n_outer") >= many_pages)).select(F.when(share, key).otherwise(F.bitwise_not(key)).alias("key"))


def _written(keys: DataFrame) -> tuple[str, ...]:
    """Descriptions of the sorted arrays that hold the keys, by the key's remainder."""
    folder = scratch_path(keys.sparkSession, "site-templates")
    n = max(1, -(-keys.count() // SHARD_KEYS))

    def write(group_key, group):
        s = group_key[0].as_py()
        made = arrays.save(folder, f"templates-{s}", key=np.sort(group["key"].to_numpy()))
        return pa.table({"shard": pa.array([s], pa.int64()), "made": [made]})

    rows = keys.withColumn("shard", F.pmod("key", F.lit(n)).cast("bigint")).groupBy("shard").applyInArrow(write, "shard bigint, made string")
    done = {r["shard"]: r["made"] for r in rows.collect()}
    none = '{"uri": "", "size": 0, "fields": {"key": ["<i8", 0, 0]}}'
    return tuple(done.get(s, none) for s in range(n))


def extractor(made: tuple[str, ...]) -> Column:
    """A function of an html column and the hashes of the page's host and section (null: none): the text."""
    @F.pandas_udf("string")
    def extract(sources: pd.Series, hosts: pd.Series, sections: pd.Series, has_section: pd.Series) -> pd.Series:
        templates = _templates(made)
        return pd.Series([main_text(x, templates, [h, s] if has else [h])
                          for x, h, s, has in zip(sources, hosts.tolist(), sections.tolist(), has_section)], dtype=object)
    return extract


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_pages: int = MIN_PAGES,
            min_share: float = MIN_SHARE, many_pages: int = MANY_PAGES) -> DataFrame:
    """Per row: id, url, text."""
    made = _written(stage(site_templates(pages, url_col, html_col, min_pages, min_share, many_pages), "site-templates"))
    h, s = _scopes(F.col(url_col))
    return pages.select(F.col(id_col), F.col(url_col),
                        extractor(made)(F.col(html_col).cast("string"), h, F.coalesce(s, F.lit(0)), s.isNotNull()).alias("text"))
