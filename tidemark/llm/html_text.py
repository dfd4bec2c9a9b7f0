"""Main text of web pages: page structure, and a suffix array per host for what structure leaves open.

A page is read into blocks. Scripts, styles, comments, menus, headers, footers, sidebars, notices, adverts,
forms and reader comments are recognised by element, role, class or id and left out. Where a page has
an article (or else a main) element, its blocks are the text, elsewhere all blocks are. What of these is boilerplate
is found by the suffix array of the host: the token streams of the host's pages are concatenated and their suffixes
sorted by prefix doubling until equal prefixes of RUN tokens share a rank; places whose rank occurs on several pages are
covered, and blocks that are covered for the most part are boilerplate. Pages that have all text but their chrome in
common are copies and count as one page, so copies do not cover each other. On pages without an article
two pages make a run repeated, and the streams are the text outside of articles. Inside an article authors quote each
other, so it takes INSIDE pages, in the streams of whole pages; and an article that would lose half of its tokens is
a version of others rather than a frame around text of its own, and stays whole.

A shard is up to SHARD pages that lie together, of any hosts; each sorts its own suffixes, and shard borders decide
nothing: the runs are merged over the host. That takes two steps, as nearly all runs are on one page. A shard
first gives 28 bits of the hash of every run, packed to 17 to 20, dealt to buckets of about BUCKET runs by the rest of the
hash; where a bucket has the same bits for as many pages as it takes, the shards give the whole hash and the pages. The runs
that remain go back to the shards, broadcast up to KEYS of them, beyond that by a shuffle of the pages.

Defined cases: a null page or url is an empty one; pages without text give an empty text; repeated
rows give a row each and count as one page; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import Words, batches, join_small, mix, stored, table
from tidemark.llm.queries import add
from tidemark.session import new_scratch

RUN = 8  # tokens; a power of two
COVERED = 0.8
SHARD = 256
INSIDE = 3  # pages that make a run inside an article repeated
PART = 1 << 24  # characters of pages that are worked on at once
BUCKET = 1 << 21  # runs
KEYS = 1 << 23  # hashes of runs, 8 bytes each, that are broadcast
_BITS, _LOW = 28, 16  # of a hash inside its bucket; those of them that are not packed
_CHROME_BLOCK, _INSIDE_BLOCK, _OUTSIDE_BLOCK = 0, 1, 2

# Element names of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style template noscript iframe textarea title svg math object canvas video audio select".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
_CLOSES_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "main menu nav ol p pre section table ul".split()
)
_CHROME = set("nav footer aside form menu dialog button head".split())
_CHROME_ROLE = set("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
# Words of classes and ids that name what is not the article.
_CHROME_WORD = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|sidebar|side-bar|footer|masthead|site-header|"
    r"page-header|comments?|commentlist|disqus|replies|respond|cookies?|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|"
    r"signup|share|sharing|social|related|recommended|widget|toolbar|pagination|pager|skip-link)(?:$|[\s_-])",
    re.I,
)
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_QUOTE_OR_END = re.compile("[>\"']")
_COMMENT_END = re.compile("--!?>")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)


def _is_chrome(name: str, rest: str, in_article: bool) -> bool:
    if name in _CHROME or name == "header" and not in_article:
        return True
    if "=" not in rest or name in ("html", "body", "article", "main") and not rest.strip():
        return False
    for key, *values in _ATTRIBUTE.findall(rest):
        value = next((v for v in values if v), "")
        if key.lower() == "role" and value.lower() in _CHROME_ROLE:
            return True
        if key.lower() in ("class", "id") and name not in ("html", "body", "main") and _CHROME_WORD.search(value):
            return True
    return False


# Python reads numbers of 4,300 digits at most; one of more than eight stands for no character, as does &#xFFFFFFFF;.
_LONG_NUMBER = re.compile("&#0*[1-9][0-9]{8,};?")
_ZEROS = re.compile("&#0{9,}")


def _unescape(text: str) -> str:
    return html.unescape(_ZEROS.sub("&#0", _LONG_NUMBER.sub("&#xFFFFFFFF;", text)) if "&#" in text else text)


@cache
def _raw_end(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}\s*>", re.I)


def _tokens(page: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """The markup of a page: (start, end, element or None, whether it closes, attributes). One pass forward: what was
    looked for in vain, an end of a tag, of a section or a quote, is not looked for again."""
    at, last_end, sections = 0, page.rfind(">"), True
    unbalanced: set[int] = set()  # places of quotes from which no end of a tag is reached
    while (start := page.find("<", at)) >= 0:
        if start > last_end:  # only a comment may still begin, and it takes the rest
            start = page.find("<!--", start)
            if start >= 0:
                yield start, len(page), None, False, ""
            return
        if page.startswith("<!--", start):
            close = _COMMENT_END.search(page, start + 4)
            at = close.end() if close else len(page)
            yield start, at, None, False, ""
            continue
        if page[start + 1] in "!?":
            if sections and page.startswith("<![CDATA[", start):
                end = page.find("]]>", start + 9)
                if end >= 0:
                    at = end + 3
                    yield start, at, "![CDATA[", False, page[start + 9 : end]
                    continue
                sections = False
            at = page.find(">", start) + 1
            yield start, at, None, False, ""
            continue
        named = _NAME.match(page, start)
        if not named:
            at = start + 1
            continue
        end = _tag_end(page, named.end(), unbalanced)
        if end < 0:
            end = page.find(">", named.end())
        if end < 0:
            at = start + 1
            continue
        at = yield start, end + 1, named[2].lower(), bool(named[1]), page[named.end() : end]
        at = at or end + 1


def _tag_end(page: str, at: int, unbalanced: set[int]) -> int:
    """The first > outside of quotes, or -1 if a quote does not close before."""
    seen = []
    while found := _QUOTE_OR_END.search(page, at):
        here = found.start()
        if page[here] == ">":
            return here
        seen.append(here)
        close = -1 if here in unbalanced else page.find(page[here], here + 1)
        if close < 0:
            break
        at = close + 1
    unbalanced.update(seen)
    return -1


class _Reader:
    """One pass over a page: blocks of (where, text); where is "article", "main", "open" or "chrome"."""

    def __init__(self, page: str):
        self.blocks: list[tuple[str, str]] = []
        self.stack: list[tuple[str, str]] = []  # element, where
        self.places: dict[str, list[int]] = {}  # where in the stack an element stands
        self.parts: list[str] = []
        at, tokens, goto = 0, _tokens(page), None
        while True:
            try:
                start, end, name, closes, rest = tokens.send(goto)
            except StopIteration:
                break
            self._text(page[at:start])
            at, goto = end, None
            if not name:
                continue
            if name == "![CDATA[":
                self._text(rest)
            elif closes:
                self._close(name)
            elif name in _RAW and not rest.endswith("/"):
                close = _raw_end(name).search(page, at)
                at = goto = close.end() if close else len(page)
            else:
                self._open(name, rest)
        self._text(page[at:])
        self._flush()

    def _where(self) -> str:
        return self.stack[-1][1] if self.stack else "open"

    def _text(self, text: str) -> None:
        if text:
            self.parts.append(_unescape(text) if "&" in text else text)

    def _flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts = []
        if text:
            self.blocks.append((self._where(), text))

    def _open(self, name: str, rest: str) -> None:
        if name == "br":
            self.parts.append(" ")
            return
        if name in _VOID:
            if name == "hr":
                self._flush()
            return
        if name not in _INLINE:
            self._flush()
            if name in _CLOSES_P:
                self._pop("p", stop={"article", "main", "section", "div", "td", "li", "blockquote", "button", "body"})
            elif name in ("li", "tr", "td", "th", "dt", "dd", "option"):
                self._pop(name, stop={"ul", "ol", "table", "dl", "menu", "article", "main"})
        if name in _INLINE and not ("=" in rest and _is_chrome(name, rest, True)):
            return
        where = self._where()
        if where != "chrome":
            if _is_chrome(name, rest, where == "article"):
                if name in _INLINE:
                    self._flush()
                where = "chrome"
            elif name == "article":
                where = "article"
            elif name == "main" and where == "open":
                where = "main"
        self._push(name, where)

    def _close(self, name: str) -> None:
        if name in _INLINE:
            if self.stack and self.stack[-1][0] == name:
                self._flush()
                self._pop(name, stop=set())
            return
        self._flush()
        self._pop(name, stop=set())

    def _push(self, name: str, where: str) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, where))

    def _pop(self, name: str, stop: set[str]) -> None:
        """Close the innermost ``name``, with all inside it, unless an element of ``stop`` stands inside."""
        here = self.places.get(name)
        if here and all(not (p := self.places.get(x)) or p[-1] < here[-1] for x in stop):
            for inner, _ in self.stack[(at := here[-1]) :]:
                self.places[inner].pop()
            del self.stack[at:]


def read_blocks(page: str | None) -> tuple[list[int], list[str]]:
    """The blocks of a page in their order, and of each whether it is chrome, inside the page's article or outside."""
    blocks = _Reader(page or "").blocks
    wheres = {w for w, _ in blocks}
    inside = next((w for w in ("article", "main") if w in wheres), None)
    return [_CHROME_BLOCK if w == "chrome" else _INSIDE_BLOCK if w == inside else _OUTSIDE_BLOCK for w, _ in blocks], [t for _, t in blocks]


def read_page(page: str | None) -> tuple[str | None, list[tuple[bool, str]]]:
    """The text of a page's article (None without one), and the blocks outside: (is chrome, text)."""
    kinds, blocks = read_blocks(page)
    text = "\n\n".join(t for k, t in zip(kinds, blocks) if k == _INSIDE_BLOCK) if _INSIDE_BLOCK in kinds else None
    return text, [(k == _CHROME_BLOCK, t) for k, t in zip(kinds, blocks) if k != _INSIDE_BLOCK]


def _values(token: np.ndarray, run: int) -> np.ndarray:
    """Of every place a hash of the ``run`` tokens from there, from the hashes of the tokens; the same in every shard."""
    value, length = mix(token), 1
    while length < run:
        rest = np.zeros_like(value)
        rest[:-length] = value[length:]
        value = mix(value * np.uint64(3) + rest)
        length *= 2
    return value


def _left(sizes: np.ndarray) -> np.ndarray:
    """Of every place how many tokens its stream has from there."""
    return np.repeat(np.cumsum(sizes), sizes) - np.arange(sizes.sum())


def _suffixes(token: np.ndarray, sizes: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array's classes: the rank of every place by its first ``run`` tokens, and whether its
    stream has so many left."""
    left = _left(sizes)
    _, rank = np.unique(token, return_inverse=True)
    length = 1
    while length < run and length < len(rank):  # suffixes ranked by their first ``length`` tokens; twice as many each time
        second = np.zeros(len(rank), dtype=np.int64)
        second[:-length] = rank[length:] + 1
        second[left <= length] = 0
        _, rank = np.unique(rank * (len(rank) + 2) + second, return_inverse=True)
        length *= 2
    return rank, left >= run


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _classes(token: np.ndarray, sizes: np.ndarray, page: np.ndarray, run: int = RUN) -> np.ndarray:
    """Every run of ``run`` tokens with every one of the numbers ``page`` of streams that has it: a place of the run there."""
    rank, whole = _suffixes(token, sizes, run)
    places = np.flatnonzero(whole)
    _, at = np.unique(rank[places] * (page.max(initial=0) + 1) + np.repeat(page, sizes)[places], return_index=True)
    return places[at]


def _cover(starts: np.ndarray, n: int, run: int) -> np.ndarray:
    """How many of ``n`` tokens up to each lie in one of the runs that begin at ``starts``, from none on."""
    edges = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + run, -1)
    return np.concatenate(([0], np.cumsum(np.cumsum(edges)[:-1] > 0)))


def repeated(streams: list[list[str]], pages: list, run: int = RUN) -> list[np.ndarray]:
    """Which tokens of each stream lie in a run of ``run`` tokens that two distinct pages have."""
    words = Words([" ".join(s) for s in streams], lower=False)
    sizes = np.diff(words.first)
    _, page = np.unique(np.array([str(p) for p in pages]), return_inverse=True)
    value = _values(words.hash, run)
    runs, count = np.unique(value[_classes(words.hash, sizes, page, run)], return_counts=True)
    starts = np.flatnonzero((_left(sizes) >= run) & _among(value, runs[count > 1]))
    return np.split(np.diff(_cover(starts, len(value), run)) > 0, words.first[1:-1])


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are ``known``, an array in order."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _content(main: str | None, chrome, blocks) -> int:
    """What makes a page: all its text but for chrome."""
    return _hash("\0".join([("" if main is None else "=" + main), *(b for b, c in zip(blocks, chrome) if not c)]))


# ---------------------------------------------------------------- runs of the pages of a host


def _shards(piece: pd.DataFrame, size: int, outside: bool) -> Iterator[tuple[int, Words, np.ndarray]]:
    """The pages of ``piece`` in shards: the first page, the tokens of all blocks (or those outside of articles), hashes of the runs of their hosts."""
    texts = piece["blocks"].tolist()
    if outside:
        texts = ["\n".join(b for k, b in zip(kinds, t.split("\n")) if k != _INSIDE_BLOCK) for kinds, t in zip(piece["kinds"], texts)]
    numbers = {h: _hash(h) & (1 << 64) - 1 for h in set(piece["host"])}
    hosts = np.array([numbers[h] for h in piece["host"]], dtype=np.uint64)
    for a, b in batches(texts):
        for i in range(a, b, size):
            words = Words(texts[i : min(b, i + size)], lower=False)
            host = np.repeat(hosts[i : min(b, i + size)], np.diff(words.first))
            yield i, words, mix(_values(words.hash, RUN) + host).view(np.int64)


def _pairs(piece: pd.DataFrame, outside: bool, least: int, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of a piece, each with up to ``least`` distinct contents that have it."""
    runs, contents = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    content = piece["content"].to_numpy(np.int64)
    page = piece.groupby(["host", "content"], sort=False).ngroup().to_numpy()
    for at, words, run in _shards(piece, shard, outside):
        sizes = np.diff(words.first)
        places = _classes(words.hash, sizes, page[at : at + len(sizes)])
        runs.append(run[places])
        contents.append(np.repeat(content[at : at + len(sizes)], sizes)[places])
    run, content = np.concatenate(runs), np.concatenate(contents)
    order = np.argsort(run)
    run, content = run[order], content[order]
    same = run[1:] == run[:-1]
    several = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(run) else np.empty(0, dtype=bool)
    some, having = run[several], content[several]
    order = np.lexsort((having, some))
    some, having = some[order], having[order]
    fresh = np.ones(len(some), dtype=bool)
    fresh[1:] = (some[1:] != some[:-1]) | (having[1:] != having[:-1])
    some, having = some[fresh], having[fresh]
    few = np.ones(len(some), dtype=bool)
    few[least:] = some[least:] != some[:-least]
    return np.concatenate((run[~several], some[few])), np.concatenate((content[~several], having[few]))


def _codes(runs: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each run and the bits of its hash that are compared there."""
    value = runs.view(np.uint64)
    bucket = (value >> np.uint64(_BITS)) % np.uint64(buckets)
    return (bucket << np.uint64(_BITS) | value & np.uint64((1 << _BITS) - 1)).astype(np.int64)


def _pack(codes: np.ndarray) -> bytes:
    """Sorted codes of one bucket: the lower bits as they are, the rest as a bitmap with a one for a code and a zero for a step."""
    bits = np.zeros(len(codes) + (1 << _BITS - _LOW), dtype=np.uint8)
    bits[(codes >> _LOW & (1 << _BITS - _LOW) - 1) + np.arange(len(codes))] = 1
    return codes.astype("<u2").tobytes() + np.packbits(bits).tobytes()


def _unpack(packed: bytes, n: int) -> np.ndarray:
    high = np.flatnonzero(np.unpackbits(np.frombuffer(packed, np.uint8, offset=2 * n))) - np.arange(n)
    return high << _LOW | np.frombuffer(packed, "<u2", count=n)


def _told(pages: DataFrame, keys: DataFrame, work: Callable[[pd.DataFrame, np.ndarray], pd.DataFrame], schema: str, by_piece: Callable[[], DataFrame]) -> DataFrame:
    """``work`` on every piece of ``pages`` with the ``keys`` it asks about: all of them, broadcast, or those of
    ``by_piece()``, a table of (piece, key), if they are too many."""
    if keys.count() <= KEYS:
        shared = pages.sparkSession.sparkContext.broadcast(np.sort(keys.toPandas()["key"].to_numpy(np.int64)))

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                for _, piece in part.groupby("piece", sort=False):
                    yield work(piece, shared.value)

        return pages.mapInPandas(run, schema)

    def both(piece: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return work(piece, np.sort(asked["key"].to_numpy(np.int64)))

    return pages.groupBy("piece").cogroup(by_piece().groupBy("piece")).applyInPandas(both, schema)


def _known(pages: DataFrame, outside: bool, least: int) -> tuple[DataFrame, DataFrame]:
    """The runs that ``least`` distinct contents of a host have: their hashes ``key``; the pieces that have them, (piece, key)."""
    shard = SHARD
    buckets = max(64, -(-(pages.agg(F.sum("n_tokens")).first()[0] or 0) // BUCKET))

    def prints(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, piece in part.groupby("piece", sort=False):
                codes = np.sort(_codes(_pairs(piece, outside, least, shard)[0], buckets))
                edges = np.flatnonzero(np.diff(codes >> _BITS, prepend=-1, append=-1))
                packs = [codes[a:b] for a, b in zip(edges[:-1], edges[1:])]
                yield pd.DataFrame({"piece": name, "bucket": [int(c[0]) >> _BITS for c in packs], "n": [len(c) for c in packs], "packed": [_pack(c) for c in packs]})

    def again(group: pd.DataFrame) -> tuple[list[np.ndarray], np.ndarray]:
        codes = [_unpack(p, n) for p, n in zip(group["packed"], group["n"])]
        both = np.sort(np.concatenate(codes))
        return codes, np.unique(both[least - 1 :][both[least - 1 :] == both[: len(both) - least + 1]])

    def candidates(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"key": again(group)[1] + (key[0] << _BITS)})

    def candidates_by_piece(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        codes, found = again(group)
        own = [np.unique(c[_among(c, found)]) for c in codes]
        return pd.DataFrame({"piece": np.repeat(group["piece"].to_numpy(), [len(o) for o in own]), "key": np.concatenate(own) + (key[0] << _BITS)})

    def hits(piece: pd.DataFrame, codes: np.ndarray) -> pd.DataFrame:
        if not len(piece) or not len(codes):
            return pd.DataFrame({"piece": [], "key": [], "content": []}).astype(np.int64)
        run, content = _pairs(piece, outside, least, shard)
        asked = _among(_codes(run, buckets), codes)
        return pd.DataFrame({"piece": piece["piece"].iloc[0], "key": run[asked], "content": content[asked]})

    dealt = pages.mapInPandas(prints, "piece bigint, bucket bigint, n bigint, packed binary").groupBy("bucket")
    found = stored(dealt.applyInPandas(candidates, "key bigint"), "candidates")
    of_piece = lambda: dealt.applyInPandas(candidates_by_piece, "piece bigint, key bigint")
    having = stored(_told(pages, found, hits, "piece bigint, key bigint, content bigint", of_piece), "runs")
    known = stored(having.groupBy("key").agg(F.count_distinct("content").alias("pages")).filter(F.col("pages") >= least).select("key"), "known")
    return known, having.select("piece", "key").distinct().join(known, "key")


def extract(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` to ``(page_id, url, text)``."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        piece = TaskContext.get().partitionId() << 32
        for part in parts:
            texts = part.pop("html").tolist()
            for a, b in batches(texts, PART):
                found = [read_blocks(t) for t in texts[a:b]]
                main = ["\n\n".join(t for k, t in zip(*f) if k == _INSIDE_BLOCK) if _INSIDE_BLOCK in f[0] else None for f in found]
                rest = [[(k == _CHROME_BLOCK, t) for k, t in zip(*f) if k != _INSIDE_BLOCK] for f in found]
                yield part.iloc[a:b].assign(
                    piece=piece,
                    open=[m is None for m in main],
                    n_tokens=[sum(t.count(" ") + 1 for t in f[1]) for f in found],
                    kinds=[bytes(f[0]) for f in found],
                    blocks=["\n".join(f[1]) for f in found],
                    content=[_content(m, [c for c, _ in r], [t for _, t in r]) for m, r in zip(main, rest)],
                )
                piece += 1

    host = F.lower(F.coalesce(F.regexp_extract(F.col("url").cast("string"), r"^[^/]*//(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))
    rows = pages.select(F.col("page_id").cast("bigint").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))
    # a bigint with nulls would go through pandas as a double
    schema = "page_id string, url string, host string, piece bigint, open boolean, n_tokens bigint, kinds binary, blocks string, content bigint"
    path = new_scratch(pages.sparkSession, "pages")
    rows.mapInPandas(read, schema).write.option("compression", "zstd").parquet(path)
    read_pages = pages.sparkSession.read.schema(schema).parquet(path)
    hosts = read_pages.groupBy("host").agg(F.bool_or("open").alias("has_open"), F.bool_and("open").alias("all_open"))
    shard, wanted = SHARD, "page_id string, url string, text string"

    def texts(kind: int) -> Callable[[pd.DataFrame, np.ndarray], pd.DataFrame]:
        def work(piece: pd.DataFrame, known: np.ndarray) -> pd.DataFrame:
            found, kinds = [], piece["kinds"].tolist()
            for at, words, run in _shards(piece, shard, kind == _OUTSIDE_BLOCK):
                starts = np.flatnonzero((_left(np.diff(words.first)) >= RUN) & _among(run, known))
                upto = _cover(starts, len(run), RUN)
                for i, text in enumerate(piece["blocks"].iloc[at : at + len(words.first) - 1], at):
                    own = kinds[i] if kind == _INSIDE_BLOCK else bytes(k for k in kinds[i] if k != _INSIDE_BLOCK)
                    blocks = [b for b, k in zip(text.split("\n"), kinds[i]) if kind == _INSIDE_BLOCK or k != _INSIDE_BLOCK]
                    found.append(_text(own, blocks, upto[words.first[i - at] : words.first[i - at + 1] + 1], kind))
            return pd.DataFrame({"page_id": piece["page_id"], "url": piece["url"], "text": found}, dtype=object)

        return work

    def of(kind: int, having: str, least: int) -> DataFrame:
        own = read_pages.filter("open" if kind == _OUTSIDE_BLOCK else "NOT open").select("page_id", "url", "host", "piece", "kinds", "blocks")
        known, by_piece = _known(join_small(read_pages.select("host", "piece", "n_tokens", "kinds", "blocks", "content"), hosts.filter(having).select("host"), ["host"]), kind == _OUTSIDE_BLOCK, least)
        return _told(own, known, texts(kind), wanted, lambda: by_piece)

    both = [of(kind, having, least) for kind, having, least in ((_INSIDE_BLOCK, "NOT all_open", INSIDE), (_OUTSIDE_BLOCK, "has_open", 2)) if not hosts.filter(having).isEmpty()]
    found = both[0].union(both[1]) if len(both) > 1 else both[0] if both else pages.sparkSession.createDataFrame([], wanted)
    return found.withColumn("page_id", F.col("page_id").cast("bigint"))


def _text(kinds: bytes, blocks: list[str], upto: np.ndarray, kind: int) -> str:
    """The blocks of a ``kind`` without those that are covered. ``upto``: how many tokens up to each are."""
    own = [b for k, b in zip(kinds, blocks) if k == kind]
    if upto[-1] == upto[0]:
        return "\n\n".join(own)
    kept, lost, total, at = [], 0, 0, 0
    for k, b in zip(kinds, blocks):
        n = b.count(" ") + 1
        if k == kind:
            total += n
            if upto[at + n] - upto[at] < COVERED * n:
                kept.append(b)
            else:
                lost += n
        at += n
    return "\n\n".join(own if kind == _INSIDE_BLOCK and 2 * lost >= total else kept)


def _op8(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, folder, "pages")).withColumn("n_chars", F.char_length("text").cast("bigint"))


add("op8_html_text", _op8)
