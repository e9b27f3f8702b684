"""Main text of web pages by site template removal.

1. *Subtrees.*  Each page is parsed once (a tolerant tag scanner) and every container
   element gives the hash of its subtree: tag, text and children.  Those inside an article
   or main element count apart from the others, among the host's pages with such an element.
2. *Counts.*  Per host, the distinct main contents (see ``Page.vote``: copies and near
   copies of a page are about one) whose pages hold a subtree are counted with partial
   aggregations: a hot host is many (host, subtree) keys.  Those with ``MIN_PAGES`` contents
   and ``MIN_SHARE`` of the host's are its template.
3. *Deletion.*  Template subtrees are deleted.  What a template cannot show (a host with
   few pages) is decided by kind: menus, headers, footers, sidebars, notices, adverts,
   forms, scripts and reader comments by tag, role and whole names in class and id; names
   never decide on an element with the page's heading or most of its text.

The templates are broadcast if they are at most ``MAX_BROADCAST`` hashes (counted first);
beyond that each page is joined with the hashes of its own subtrees that are template.

An article repeated on many pages is a copy, not a template: ``article`` and ``main``
themselves are never counted, and the copies have one main content, so one vote for what is
inside.  On a page with such an element the text outside it is left out whatever the counts
say; inside, the counts and the kinds decide.  Defined results: null and empty pages give the
empty text; a null url is a host of its own; repeated ids give a row each; cut-off pages
end where they end (an unfinished tag or comment is dropped); an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import html
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.workspace import by_value, stored

MIN_PAGES = 5
MIN_SHARE = 0.3
SHINGLE = 3                  # words of a piece of a page's main content
MAX_BROADCAST = 1 << 19      # template hashes, 4 MB
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg object select".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var math mi mn mo mrow mfrac msub msup msqrt mtext mstyle semantics".split())
ENDS_P = frozenset("address article aside blockquote center details div dl fieldset figure figcaption footer form h1 h2 h3 "
                   "h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table article main body".split())
DROPPED = frozenset("nav footer aside form button dialog menu head input".split()) | RAW
CONTAINERS = frozenset("div section nav header footer aside form ul ol dl li table p span center fieldset details menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
KINDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
                  "gdpr notice notification newsletter subscribe signup login popup modal overlay sidebar widget menu nav navbar "
                  "navigation breadcrumb breadcrumbs footer header masthead comment comments respond disqus share sharing social "
                  "related recommended".split())
#: Parts of a class name that add nothing to a telling one ("main-nav", "comments-area").
PLAIN = frozenset("site main page top bottom left right box bar wrapper wrap container block area section list links inner outer "
                  "primary secondary global sticky message text item items form posts articles menu button buttons".split())
#: Kinds that stay unwanted however much of the page they fill.
READERS = frozenset("comment comments respond disqus".split())


class Page:
    """Elements of a page in document order and its text pieces."""

    def __init__(self, source: str):
        self.parent, self.tag, self.kind = [-1], ["body"], [False]
        self.named: list[frozenset] = [frozenset()]      # the telling words of class and id
        self.digest: list[int] = [0]
        self.pieces: list[tuple[int, str | None]] = []   # (element, text), None: a block boundary
        self.parse(source)

    def parse(self, source: str) -> None:
        stack, inner = [0], [[]]
        opened: dict[str, int] = {}      # open elements by name
        at = 0

        def text(piece: str) -> None:
            if piece:
                piece = html.unescape(piece)
                self.pieces.append((stack[-1], piece))
                inner[-1].append(" ".join(piece.split()))

        def close() -> None:
            node, parts = stack.pop(), inner.pop()
            opened[self.tag[node]] -= 1
            body = "\x1f".join([self.tag[node], *parts])
            digest = hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=8).digest()
            self.digest[node] = int.from_bytes(digest, "little", signed=True)
            if inner:
                inner[-1].append(digest.hex())
            if self.tag[node] not in INLINE:
                self.pieces.append((node, None))

        def close_to(names: set, stop: frozenset) -> None:
            if not any(opened.get(n) for n in names):
                return
            for depth in range(len(stack) - 1, 0, -1):
                name = self.tag[stack[depth]]
                if name in names:
                    while len(stack) > depth:
                        close()
                    return
                if name in stop:
                    return

        while True:
            found = TOKEN.search(source, at)
            text(source[at:found.start() if found else len(source)])
            if not found:
                break
            at = found.end()
            name = (found["tag"] or "").lower()
            if not name:
                continue
            if found["end"]:
                close_to({name}, frozenset() if name in ENDS_P and name != "p" else frozenset(("article", "main")))
                continue
            if name == "br":
                text(" ")
                continue
            if name in ENDS_P:
                close_to({"p"}, HOLDS - {"body"})
            if name in CLOSES:
                close_to(CLOSES[name], HOLDS)
            if name in ("html", "body"):
                continue
            node = len(self.tag)
            self.parent.append(stack[-1])
            self.tag.append(name)
            unwanted, telling = self.unwanted(name, found["attrs"] or "")
            self.kind.append(unwanted)
            self.named.append(telling)
            self.digest.append(0)
            if name not in INLINE:
                self.pieces.append((node, None))
            if name in VOID or (found["attrs"] or "").endswith("/") and name in RAW:
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            stack.append(node)
            inner.append([])
            opened[name] = opened.get(name, 0) + 1
        while len(stack) > 1:
            close()
        self.judge_names()

    def unwanted(self, name: str, attrs: str) -> tuple[bool, frozenset]:
        """Whether the element's tag, role or state says it is no content; and the telling words of its class and id.

        A class or id name tells only if all its parts do or add nothing: "cookie-notice" and "main-nav", but
        not "entry-header", "has-sidebar" or "notice-period".
        """
        if name in DROPPED:
            return True, frozenset()
        if not attrs.strip():
            return False, frozenset()
        values = {k.lower(): a or b or c or "" for k, a, b, c in ATTRIBUTE.findall(attrs)}
        telling = set()
        for token in f"{values.get('class', '')} {values.get('id', '')}".lower().split():
            parts = [x for x in re.split(r"[^a-z]+", token) if x]
            if all(x in KINDS or x in PLAIN for x in parts):
                telling |= KINDS.intersection(parts)
            elif READERS.intersection(parts):
                telling.add("perhaps comments")     # "post-comments", but also "has-comments" on a whole page
        return (values.get("role", "").lower() in ROLES or "hidden" in values or values.get("aria-hidden", "").lower() == "true"
                or "display:none" in values.get("style", "").lower().replace(" ", "")), frozenset(telling)

    def judge_names(self) -> None:
        """Let telling names decide, but never on an element with the page's heading or most of its text.

        Reader comments may be most of the text, and menus may hold a heading's link: comments and
        elements unwanted by tag stay so.
        """
        size, heading = [0] * len(self.tag), [t == "h1" for t in self.tag]
        for node, piece in self.pieces:
            if piece and not self.kind[node]:
                size[node] += len(piece.strip())
        for node in range(len(self.tag) - 1, 0, -1):
            up = self.parent[node]
            if not self.kind[node]:
                size[up] += size[node]
                heading[up] |= heading[node]
        for node, words in enumerate(self.named):
            if words and (words & READERS or not (heading[node] or 2 * size[node] > size[0])):
                self.kind[node] = True

    def content(self) -> tuple[list[int], list[bool]]:
        """Per element its outermost article or main (-1: none), and whether it holds one.

        An article inside an unwanted element (a reader comment, a teaser) does not count,
        unless the page has no other and only a class or id speaks against the element.
        """
        for unwanted in (self.kind, [k and t in DROPPED for k, t in zip(self.kind, self.tag, strict=True)]):
            main, holds, gone = [-1], [False] * len(self.tag), [False]
            for node in range(1, len(self.tag)):
                up = self.parent[node]
                gone.append(gone[up] or unwanted[node])
                main.append(main[up] if main[up] >= 0 else node if self.tag[node] in ("article", "main") and not gone[node] else -1)
                if main[node] == node:
                    while up > 0 and not holds[up]:
                        holds[up] = True
                        up = self.parent[up]
            if any(m >= 0 for m in main):
                break
        return main, holds

    def subtrees(self) -> set[tuple[int, bool]]:
        """(hash, inside an article or main) of the container subtrees that may be template."""
        main, holds = self.content()
        return {(self.digest[n], main[n] >= 0) for n in range(1, len(self.tag))
                if self.tag[n] in CONTAINERS and not holds[n] and main[n] != n and self.digest[n]}

    def text(self, template) -> str:
        """The blocks that are left, joined by an empty line; ``template``: (hash, inside) to delete."""
        main, holds = self.content()
        has_main = any(m >= 0 for m in main)
        gone = [False]
        for n in range(1, len(self.tag)):
            inside, name = main[n] >= 0, self.tag[n]
            kind = (self.kind[n] and not holds[n]) or (name == "header" and not inside and not holds[n])
            own = kind or (not holds[n] and (self.digest[n], inside) in template)
            gone.append(gone[self.parent[n]] or (own and main[n] != n))
        blocks, parts = [], []
        for node, piece in [*self.pieces, (0, None)]:
            if piece is None:
                block = " ".join("".join(parts).split())
                if block:
                    blocks.append(block)
                parts = []
            elif not gone[node] and (main[node] >= 0 or not has_main):
                parts.append(piece)
        return "\n\n".join(blocks)


    def vote(self) -> int:
        """Code of the main content: its text without what kind decides, by the two least of its
        word shingles' codes.  Near copies share nearly all shingles, so nearly always these;
        pages that share a template only differ in them as far as the rest is their own.
        """
        words = self.text(frozenset()).split()
        codes = {zlib.crc32(" ".join(words[i:i + SHINGLE]).encode("utf-8", "surrogatepass"))
                 for i in range(max(1, len(words) - SHINGLE + 1))}
        return _content_key(" ".join(map(str, heapq.nsmallest(2, codes))))


def host_of(url: str | None) -> str:
    """Lower-case host of a url, without user and port."""
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#\\]*)", url or "")
    return found[1].rpartition("@")[2].partition(":")[0].lower() if found else ""


def _key(host: str, digest: int, inside: bool = False) -> int:
    """64-bit key of a subtree on a host, inside or outside its articles."""
    return int.from_bytes(hashlib.blake2b(f"{host}\x1f{digest}{'a' * inside}".encode(), digest_size=8).digest(), "little", signed=True)


def _content_key(source: str) -> int:
    return int.from_bytes(hashlib.blake2b(source.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _subtree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(space, subtree, vote, host, page) of every page: the host outside or inside its articles,
    the subtree, the main content's code, the host and the html's code."""
    for rows in batches:
        spaces, keys, votes, hosts, pages = [], [], [], [], []
        for url, source in zip(rows.column("url").to_pylist(), rows.column("html").to_pylist(), strict=True):
            host, page = host_of(url), Page(source or "")
            space = [_key(host, 0), _key(host, 0, True)]    # 0 stands for the page itself
            own = [(space[inside], _key(host, d, inside)) for d, inside in page.subtrees()]
            own += [(x, x) for x in space[:1 + any(m >= 0 for m in page.content()[0])]]
            spaces += [x for x, _ in own]
            keys += [x for _, x in own]
            votes += [page.vote()] * len(own)
            hosts += space[:1] * len(own)
            pages += [_content_key(source or "")] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (spaces, keys, votes, hosts, pages)],
                                         ["space", "subtree", "vote", "host", "page"])


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(subtree): keys of the (host, subtree) pairs that recur across the host's main contents."""
    rows = pages.select("url", "html").mapInArrow(_subtree_rows, "space long, subtree long, vote long, host long, page long")
    counts = (rows.select("space", "subtree", "vote").distinct().groupBy("space", "subtree").agg(F.count("*").alias("pages"))
              .where(F.col("pages") >= min_pages))
    counts = stored(counts, "subtree-counts")    # both uses below read it: the pages are parsed once
    total = counts.where("space = subtree").select("space", F.col("pages").alias("total"))
    return (counts.where("space <> subtree").join(total, "space")
            .where(F.col("pages") >= min_share * F.col("total")).select("subtree"))


class _OnHost:
    """Template test of one page: is a (hash, inside) template on its host?"""

    def __init__(self, host: str, keys):
        self.host, self.keys = host, keys

    def __contains__(self, subtree: tuple[int, bool]) -> bool:
        return bool(self.keys) and _key(self.host, *subtree) in self.keys


def _extractor(shared: frozenset | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            own = rows.column("own").to_pylist() if shared is None else [shared] * rows.num_rows
            texts = [Page(source or "").text(_OnHost(host_of(url), frozenset(keys or ()) if shared is None else keys))
                     for url, source, keys in zip(rows.column("url").to_pylist(), rows.column("html").to_pylist(), own, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string()),
                 pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])
    return run


def _own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page key, subtree) of every page, for the join with the templates."""
    for rows in _subtree_rows(batches):
        yield pa.RecordBatch.from_arrays([rows.column("host"), rows.column("page"), rows.column("subtree")], ["host", "page", "subtree"])


def _page_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        hosts = [_key(host_of(u), 0) for u in rows.column("url").to_pylist()]
        keys = [_content_key(s or "") for s in rows.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(hosts, pa.int64()), pa.array(keys, pa.int64())],
                                         [*rows.schema.names, "host", "page"])


def extract(pages: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html")
    result = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    known = stored(templates(pages), "templates")
    if known.count() <= max_broadcast:
        keys = frozenset(known.toArrow()["subtree"].to_pylist())
        return pages.mapInArrow(_extractor(keys), result)
    own = (pages.select("url", "html").mapInArrow(_own_keys, "host long, page long, subtree long").distinct().join(known, "subtree")
           .groupBy("host", "page").agg(F.collect_list("subtree").alias("own")))
    keyed = pages.mapInArrow(_page_keys, pages.select("*", F.lit(0).cast("long").alias("host"), F.lit(0).cast("long").alias("page")).schema)
    return keyed.join(own, ["host", "page"], "left").mapInArrow(_extractor(None), result)


by_value(__name__)
