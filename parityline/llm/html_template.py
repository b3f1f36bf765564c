"""Main text of web pages by deducing the template that pages of a host share.

A page is read as a sequence of tokens: its elements, each with the path of containers that
leads to it, and its whole text segments at their path. The template of a host is deduced
from its pages in three steps:

1. Tokens that occur on the same pages of a host share an occurrence vector and form an
   equivalence class. A vector is kept as the number of pages and two sums of their hashes,
   a grouped sum with partial sums on the map side, so a host with a third of all pages is
   no heavier than many. Pages of equal text count once.
2. Tokens with support are candidates: those on a twentieth of the host's pages, at least on
   two, about equally often on each. A text must be on half of the pages that hold its
   container, and in a class with another token, or else on nine tenths of them.
3. Candidates are placed into a tree. On every page a token lies in the slot behind the
   closest token before it that has more support, and follows the token of its own class
   before it in that slot. A token that has one such place on four fifths of its pages is
   valid: its class is ordered, and nests in one slot of a larger class. Those of a class
   that lie in different slots are placed apart.

Valid texts are the template's; the text of all other segments fills its slots and is kept,
whatever share of the page it is, but for what HTML itself or the name of an element puts
beside an article. Names are words of a class, id or role: an element is apart if one of its
names says so as a whole ("comment-list", "cookie-notice", not "has-sidebar" or
"comments-open"). A name of layout ("sidebar") counts for nothing where the element holds a
``main`` or an ``h1``; adverts, notices and reader comments are never text.

Defined results: a null page counts as empty and has an empty text; pages without a host
form a group of their own; rows that repeat are extracted each; a host whose pages all have
the same text has no template; a page of nothing but template, or of nothing but notices,
has an empty text; unclosed elements end with their parents, a quote that no other closes
is a character like others, an unfinished tag at the end is dropped; an empty table gives
an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parityline.llm.common import broadcast_if_small, written

# What elements mean in HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe template svg".split())
APART = frozenset(
    "head nav header footer aside form script style noscript iframe template svg button select "
    "textarea title menu dialog".split()
)
#: Words that name adverts and notices, and readers' comments, which are never part of an article.
FOREIGN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsbygoogle sponsor sponsored promo "
    "cookie cookies consent notice notices alert alerts popup modal newsletter subscribe subscription "
    "signup login".split()
)
COMMENT_WORDS = frozenset("comment comments commentary discussion respond reply replies disqus".split())
#: Words that name the layout around an article.
LAYOUT_WORDS = frozenset(
    "banner menu nav navigation navbar breadcrumb breadcrumbs sidebar footer header masthead branding "
    "share sharing social related recommended trending popular widget widgets toolbar pagination pager "
    "search copyright complementary contentinfo".split()
)
#: Words that may stand before and behind these in a name.
BEFORE = frozenset(
    "post page site main left right top bottom primary secondary user reader blog article entry story "
    "global mobile desktop sticky fixed inline our the js google dfp privacy gdpr legal email".split()
)
BEHIND = frozenset(
    "list lists box bar area block section container wrapper wrap inner outer panel item items body text "
    "content title head heading author form link links button buttons icon icons left right top bottom "
    "main primary secondary post posts articles stories news slot unit module group row column thread "
    "message template toggle collapse".split()
)
#: Elements whose own classes say how they look or what the page has, not what they are.
UNMARKED = frozenset("html body main h1 h2 h3 h4 h5 h6 th thead".split())
PARAGRAPHS = frozenset(("p", "li", "dt", "dd", "tr", "td", "th", "option"))
#: Shares: of a host's pages that a token is on, of its container's pages that a text is on,
#: of those that a text without another token of its class is on, and of a token's pages
#: that it has one place on.
SUPPORT, TEXT_SUPPORT, ALONE, PLACED = 0.05, 0.5, 0.9, 0.8
#: Hosts and template tokens together that are sent to all executors.
BROADCAST_ITEMS = 100_000
#: Distinct places that a task counts before it passes its counts on.
HELD_PLACES = 100_000

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"[^>\"']*")
_MARKUP = re.compile(r"[^<]*>[^<]*<(?:/?[a-zA-Z][a-zA-Z0-9]*[\s/>]|!--)")
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _kind(word: str) -> str | None:
    """What a word names, written alone or as one with what may stand behind it."""
    for kind, words in (("foreign", FOREIGN_WORDS), ("comment", COMMENT_WORDS), ("layout", LAYOUT_WORDS)):
        if word in words:
            return kind
        if any(word.startswith(w) and word[len(w) :] in BEHIND for w in words if len(w) > 2):
            return kind
    return None


@lru_cache(maxsize=10_000)
def named_apart(name: str) -> str | None:
    """What a name of an element says that it is as a whole: foreign, comment, layout or None."""
    words = [w for w in _SPLIT.split(_CAMEL.sub("-", name).lower()) if w]
    kinds = set()
    for word in words:
        kind = _kind(word)
        if kind:
            kinds.add(kind)
        elif not word.isdigit() and word not in (BEHIND if kinds else BEFORE):
            return None
    return min(kinds, key=("foreign", "comment", "layout").index, default=None)


class Hint:
    """An element of layout by its name, within another; void if it holds an article."""

    def __init__(self, around: Hint | None):
        self.around, self.void, self.apart = around, False, False


class Open:
    """An open element, the hash of its path, and what lies around its content."""

    __slots__ = ("name", "path", "beside", "hint", "inline")

    def __init__(self, name: str, path: int, beside: bool, hint: Hint | None, inline: bool = False):
        self.name, self.path, self.beside, self.hint, self.inline = name, path, beside, hint, inline


class Token:
    """An element (without text) or a text segment; ``within`` is the path of its container."""

    __slots__ = ("hash", "within", "text", "beside", "hint")

    def __init__(self, hash_: int, within: int, text: str | None, beside: bool, hint: Hint | None):
        self.hash, self.within, self.text, self.beside, self.hint = hash_, within, text, beside, hint

    @property
    def apart(self) -> bool:
        return self.beside or (self.hint is not None and self.hint.apart)


def _hash(within: int, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{within}\0{text}".encode("utf-8", "surrogatepass")) - 2**63


class Scanner:
    """One pass over a page; every character is looked at a bounded number of times."""

    def __init__(self, page: str):
        self.page = page
        self.last = {q: page.rfind(q) for q in "\"'"}
        self.stack = [Open("", 0, False, None)]
        self.places: dict[str, list[int]] = {}  # of open elements on the stack, by name
        self.blocks = [0]  # places of those that are not inline
        self.hints: list[Hint] = []
        self.tokens: list[Token] = []
        self.words: list[str] = []

    def tag_end(self, at: int) -> int:
        """Where the tag that goes on at ``at`` ends: behind its ``>``, or the page's end."""
        page = self.page
        while True:
            at = _PLAIN.match(page, at).end()
            if at == len(page):
                return at
            if page[at] == ">":
                return at + 1
            # A quote counts behind an equals sign, and if another closes it before markup.
            before = at - 1
            while page[before].isspace():
                before -= 1
            if page[before] == "=" and at < self.last[page[at]]:
                end = page.find(page[at], at + 1)
                if not _MARKUP.match(page, at + 1, end):
                    at = end
            at += 1

    def block(self) -> None:
        """End the block of text so far."""
        text = " ".join("".join(self.words).split())
        self.words.clear()
        top = self.stack[-1]
        if text:
            self.tokens.append(Token(_hash(top.path, text), top.path, text, top.beside, top.hint))

    def push(self, element: Open) -> None:
        self.places.setdefault(element.name, []).append(len(self.stack))
        if not element.inline:
            self.blocks.append(len(self.stack))
        self.stack.append(element)

    def pop_to(self, size: int) -> None:
        while len(self.stack) > size:
            element = self.stack.pop()
            self.places[element.name].pop()
            if not element.inline:
                self.blocks.pop()

    def close(self, name: str) -> None:
        """End the innermost open element of a name; an inline one only within its block."""
        places = self.places.get(name)
        if places and (name not in INLINE or places[-1] > self.blocks[-1]):
            self.pop_to(places[-1])

    def start(self, name: str, attributes: str) -> None:
        """Open an element."""
        found = {k.lower(): a or b or c for k, a, b, c in _NAMES.findall(attributes)} if "=" in attributes else {}
        kinds = set() if name in UNMARKED else {named_apart(n) for v in found.values() for n in v.split()}
        top = self.stack[-1]
        if name in INLINE:
            # Kept open only where it is an advert or a notice, or lies within one of its name.
            if name not in VOID and ("foreign" in kinds or self.places.get(name)):
                foreign = "foreign" in kinds or (top.inline and top.beside)
                self.push(Open(name, top.path, top.beside or foreign, top.hint, True))
            return
        if name in PARAGRAPHS:  # a new one ends an open one of the same container
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].name == name:
                    self.pop_to(i)
                    break
                if self.stack[i].name not in PARAGRAPHS and not self.stack[i].inline:
                    break
            top = self.stack[-1]
        if name in ("main", "h1"):
            around = top.hint
            while around is not None and not around.void:
                around.void, around = True, around.around
        beside = top.beside or name in APART or "foreign" in kinds or "comment" in kinds
        hint = top.hint
        if "layout" in kinds and not beside:
            hint = Hint(hint)
            self.hints.append(hint)
        mark = "" if name in PARAGRAPHS else " ".join((found.get("class") or found.get("id") or "").lower().split())
        path = _hash(top.path, f"<{name} {mark}")
        self.tokens.append(Token(path, top.path, None, beside, hint))
        if name not in VOID and not attributes.endswith("/"):
            # Paragraphs of a container are alike, so what they hold lies in the container.
            self.push(Open(name, top.path if name in PARAGRAPHS else path, beside, hint))

    def run(self) -> list[Token]:
        """The page's tokens in order."""
        page, at = self.page, 0
        while at < len(page):
            tag = page.find("<", at)
            text = page[at : tag if tag >= 0 else len(page)]
            if text and not (self.stack[-1].inline and self.stack[-1].beside):
                self.words.append(html.unescape(text))
            if tag < 0:
                break
            name = _NAME.match(page, tag)
            if name is None:
                at = self.other(tag)
                continue
            at = self.tag_end(name.end())
            if page[at - 1] != ">":
                break  # an unfinished tag
            kind = name[1].lower()
            if kind == "br":
                self.words.append(" ")
                continue
            if kind not in INLINE:
                self.block()
            if page[tag + 1] == "/":
                self.close(kind)
            elif kind in RAW:
                self.start(kind, "/")
                end = re.compile(rf"</{re.escape(kind)}\b[^>]*(?:>|$)", re.I).search(page, at)
                at = end.end() if end else len(page)
            else:
                self.start(kind, page[name.end() : at - 1])
        self.block()
        for hint in self.hints:  # those around come first
            hint.apart = not hint.void or (hint.around is not None and hint.around.apart)
        return self.tokens

    def other(self, at: int) -> int:
        """Pass a comment or declaration, or take a ``<`` as it is."""
        page = self.page
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return end + 3 if end >= 0 else len(page)
        if page.startswith(("<!", "<?", "</"), at):
            end = page.find(">", at)
            return end + 1 if end >= 0 else len(page)
        self.words.append("<")
        return at + 1


def parse(page: str | None) -> list[Token]:
    """The page's tokens that may be part of an article, in order."""
    return [t for t in Scanner(page or "").run() if not t.apart]


def extract(page: str | None, template: frozenset[int] = frozenset()) -> str:
    """The main text of a page, given the texts of its host's template."""
    return "\n".join(t.text for t in parse(page) if t.text is not None and t.hash not in template)


def _host() -> Column:
    return F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def skeletons(pages: DataFrame) -> DataFrame:
    """(host, key, tokens) per page that has text, of pages (host, page).

    ``tokens`` are (hash, within, is_text, n): the page's distinct tokens in the order of
    their first places; ``key`` is the hash of its texts.
    """
    token = pa.struct([("hash", pa.int64()), ("within", pa.int64()), ("is_text", pa.bool_()), ("n", pa.int32())])
    kinds = [pa.string(), pa.int64(), pa.list_(token)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                out = []
                for host, page in zip(*(c.to_pylist() for c in batch.slice(low, 500).columns), strict=True):
                    found, texts = {}, xxhash.xxh64()
                    for t in parse(page):
                        if t.text is not None:
                            texts.update(t.hash.to_bytes(8, "little", signed=True))
                        entry = found.setdefault(t.hash, [t.hash, t.within, t.text is not None, 0])
                        entry[3] += 1
                    if any(e[2] for e in found.values()):
                        rows = [dict(zip(("hash", "within", "is_text", "n"), e, strict=True)) for e in found.values()]
                        out.append((host, texts.intdigest() - 2**63, rows))
                columns = zip(*out, strict=True) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "key", "tokens"]
                )

    return pages.mapInArrow(
        run, "host string, key long, tokens array<struct<hash: long, within: long, is_text: boolean, n: int>>"
    )


def candidates(pages: DataFrame) -> DataFrame:
    """(host, token, class, pages, is_text): tokens with support, of distinct skeletons."""
    tokens = pages.select("host", "key", F.explode("tokens").alias("t")).select("host", "key", "t.*")
    vector = F.expr("struct(bit_xor(xxhash64(key)), sum(shiftrightunsigned(xxhash64(key, 1), 33)))")
    vectors = tokens.groupBy("host", F.col("hash").alias("token")).agg(
        F.min("within").alias("within"),
        F.min("is_text").alias("is_text"),
        F.count("*").alias("pages"),
        F.sum(F.col("n").cast("double")).alias("times"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"),
        vector.alias("vector"),
    )
    vectors = written(vectors, "vectors")
    total = pages.groupBy("host").agg(F.count("*").alias("total"))
    some = vectors.join(total, "host").where(f"pages >= 2 and pages >= {SUPPORT} * total")
    some = some.withColumn("class", F.xxhash64("vector", "pages"))
    # As often on every page but for a few.
    steady = some.where("8 * squares * pages <= 9 * times * times")
    size = steady.groupBy("host", "class").agg(F.count("*").alias("size"))
    held = vectors.where("not is_text").select("host", F.col("token").alias("within"), F.col("pages").alias("held"))
    found = steady.join(size, ["host", "class"]).join(held, ["host", "within"], "left")
    # Text outside of all elements lies in the page.
    found = found.withColumn("held", F.coalesce("held", "total"))
    least = f"if(size > 1, {TEXT_SUPPORT}, {ALONE}) * held"
    return found.where(f"not is_text or pages >= {least}").select("host", "token", "class", "pages", "is_text")


def _place(found: list[dict], tokens: list[int]) -> Iterator[tuple[int, int, int]]:
    """(token, slot, before) of a page's candidates.

    ``slot`` is the closest token before it that has more support, ``before`` the last one
    of its own class in that slot; 0 stands for none.
    """
    known = {c["token"]: c for c in found}
    enclosing: list[tuple[int, int, int]] = []  # (support, place, token), support going down
    last: dict[int, tuple[int, int]] = {}  # class: (place, token)
    for at, token in enumerate(tokens):
        one = known.get(token)
        if one is None:
            continue
        while enclosing and enclosing[-1][0] <= one["pages"]:
            enclosing.pop()
        _, begin, slot = enclosing[-1] if enclosing else (0, -1, 0)
        place, before = last.get(one["class"], (-1, 0))
        yield token, slot, before if place > begin else 0
        last[one["class"]] = (at, token)
        enclosing.append((one["pages"], at, token))


def places(pages: DataFrame, known: DataFrame) -> DataFrame:
    """(host, token, slot, before, n): on how many pages each candidate has each place."""
    names = ["host", "token", "slot", "before", "n"]
    kinds = [pa.string()] + [pa.int64()] * 4

    def batch_of(counts: Counter) -> pa.RecordBatch:
        rows = [(*k, n) for k, n in counts.items()]
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for host, tokens, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts.update((host, *p) for p in _place(found, tokens))
                if len(counts) > HELD_PLACES:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    rows = pages.join(known, "host").select("host", "tokens.hash", "found")
    counted = rows.mapInArrow(run, "host string, token long, slot long, before long, n long")
    return counted.groupBy("host", "token", "slot", "before").agg(F.sum("n").alias("n"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, token, slot, before, is_text): the valid tokens of each host of pages (host, page).

    ``slot`` and ``before`` make a tree of them: the token in whose slot each one lies, and
    the one of its class that comes before it there, or 0.
    """
    # Pages of equal text count once, so copies of a page are no template.
    pages = written(skeletons(pages).dropDuplicates(["host", "key"]), "skeletons")
    found = written(candidates(pages), "candidates")
    # A page's tokens over the share of support bound a host's candidates.
    known = found.groupBy("host").agg(F.collect_list(F.struct("token", "class", "pages")).alias("found"))
    placed = places(pages, broadcast_if_small(known, found.count(), BROADCAST_ITEMS))
    order = Window.partitionBy("host", "token").orderBy(F.col("n").desc(), "slot", "before")
    placed = placed.withColumn("rank", F.row_number().over(order)).where("rank = 1")
    placed = placed.join(found, ["host", "token"]).where(f"n >= {PLACED} * pages")
    return placed.select("host", "token", "slot", "before", "is_text")


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) per row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", F.col("html").alias("page"))
    rows = rows.withColumn("host", _host())
    known = templates(rows.select("host", "page")).where("is_text")
    known = written(known.groupBy("host").agg(F.collect_set("token").alias("template")), "templates")
    # A host counts as one and its texts, of eight bytes each, as one each.
    count = known.agg(F.coalesce(F.sum(1 + F.size("template")), F.lit(0))).first()[0]
    rows = rows.join(broadcast_if_small(known, count, BROADCAST_ITEMS), "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                page_id, url, page, template = batch.slice(low, 500).columns
                texts = [
                    extract(p, frozenset(t or ())) for p, t in zip(page.to_pylist(), template.to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [page_id, url, pa.array(texts, pa.string())], ["page_id", "url", "text"]
                )

    kinds = dict(pages.dtypes)
    rows = rows.select("page_id", "url", "page", "template")
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
