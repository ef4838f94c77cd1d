"""Main text of web pages: page structure, then a suffix array per host.

Structure: one scan over the html splits it into blocks and marks each by where it stands:
in an article, in a main part, in a part named like content, loose, or in page furniture
(menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles).
Furniture goes. Text in an article or main part is the candidate text of pages that have
any; else a part named like content, if it holds most of the text; else all that is left.
A class or id names furniture only as a whole ("cookie-notice" and "site-footer" do,
"share-price" and "notice-board" do not), and where furniture known by its name alone holds
most of the prose of a page that marks no text, the name is not believed.

Host suffix array: the candidates' token streams of a host are concatenated and their
suffixes sorted to a depth of ``RUN_TOKENS``, which finds all runs of that many tokens and
more that stand on several distinct pages (pages with equal candidates are one). A run on
a large share of them is boilerplate. Loose text loses the covered tokens and keeps its
unique runs; text that the page itself marks as article or main loses a block only if a
still larger share of pages repeats all of it, since articles do quote one another.

No task gathers a host of more than ``SHARD_PAGES`` pages, but its shares are those of the
whole host. Its distinct texts are dealt into shards with a suffix array each; a run on a
share of the host's texts has at least that share of some shard's, so the runs that have
it in their shard are all there can be. They are counted over the whole host, and the ones
that keep the share are marked on every page, again shard by shard.
Only hosts with such runs are counted and marked; all other texts are whole already.

Defined cases: null html is empty; an empty page has empty text and 0 characters; a null
or odd url makes the host ""; hosts with fewer than ``LEAST_PAGES`` distinct pages are
judged by structure alone; repeated rows each get a row; unclosed tags end with the
element around them, unclosed comments and scripts with the page; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checked, written

RUN_TOKENS = 8
SHARD_PAGES = 256
LEAST_PAGES = 5
LOOSE_SHARE = 0.2
MARKED_SHARE = 0.6
PACKED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}

PROSE_WORDS = 12  # a block of as many words is prose

FURNITURE, NAMED_AWAY, LOOSE, NAMED, MAIN, ARTICLE = range(6)

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNREAD = "script style noscript template textarea title iframe noembed noframes xmp svg math object canvas audio video select".split()
_FURNITURE_TAGS = frozenset("nav aside footer form menu dialog button".split())
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html "
    "legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
# A paragraph, item or cell without end tag ends where the next of its kind begins.
_CLOSES = {"p": _BLOCK_TAGS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option", "optgroup"]),
           "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"])}
_FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer "
    "cookie cookies consent notice notices alert gdpr popup modal overlay newsletter subscribe subscription signup login comment comments disqus reply replies share "
    "sharing social related recommended widget toolbar pagination pager skip".split())
_COMMENT_NAMES = frozenset("comment comments disqus reply replies ad ads advert adverts advertisement sponsored related recommended sidebar".split())
# Parts that say where a thing stands or how it is laid out, not what it is.
_LAYOUT_PARTS = frozenset(
    "area article articles aside bar block blocks body bottom box button buttons card col column container content fixed form global grid group header holder icon icons "
    "id inner item items label left link links list main media message outer page panel placeholder post posts primary right row secondary section site slot space sticky "
    "story stories strip text title top unit wrap wrapper".split())
_CONTENT_NAMES = frozenset("article articlebody content main post entry story".split())
_CONTENT_PARTS = _CONTENT_NAMES | frozenset("body text".split())
_FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(_UNREAD) + r")(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|\Z)", re.I)
_NAME_PARTS = re.compile(r"[^a-z0-9]+")


def _names(value: str) -> set[str]:
    """What whole class and id names say: "site-footer" says footer, "share-price" and "with-sidebar" say nothing."""
    found = set()
    for word in value.lower().split():
        parts = [x for x in _NAME_PARTS.split(word) if x and not x[0].isdigit()]
        said = set(parts) & _FURNITURE_NAMES
        if said and parts[0] not in ("with", "has", "no", "without") and _LAYOUT_PARTS.issuperset(set(parts) - said):
            found |= said
    return found


def _names_content(value: str) -> bool:
    """Whether a whole class or id names content: "content" and "post-body" do, "post-meta" and "entry-title" do not."""
    for word in value.lower().split():
        parts = {x for x in _NAME_PARTS.split(word) if x and not x.isdigit()}
        if parts & _CONTENT_NAMES and parts <= _CONTENT_PARTS:
            return True
    return False


def _kind(name: str, rest: str, around: int, held: bool) -> tuple[int, bool]:
    """What an element's text is, given what stands around it, and whether that is final."""
    if held or name in _FURNITURE_TAGS or (name == "header" and around < MAIN):
        return FURNITURE, True
    attributes = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest.strip(" /") else {}
    marked = name == "article" or (name == "main" or attributes.get("role") == "main")
    if attributes:
        if "hidden" in attributes or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
            return FURNITURE, True
        named = f"{attributes.get('class', '')} {attributes.get('id', '')}"
        names = _names(named)
        if attributes.get("role") in _FURNITURE_ROLES or names & _COMMENT_NAMES:
            return FURNITURE, True
        if names & _FURNITURE_NAMES and not marked and name not in ("html", "body"):
            return min(around, NAMED_AWAY), False  # an article inside still counts
        if "articleBody" in attributes.get("itemprop", ""):
            return max(around, ARTICLE), False
        if around == LOOSE and _names_content(named) and name not in ("html", "body"):
            around = NAMED
    if name == "article":
        return ARTICLE, False
    return (max(around, MAIN) if marked else around), False


def blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order, white space made single, character references decoded."""
    out: list[tuple[int, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int, bool]] = [("", LOOSE, False)]

    def flush() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((stack[-1][1], text))
            pieces.clear()

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at:m.start()]
            pieces.append(html.unescape(piece) if "&" in piece else piece)
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "head":  # its own elements are unread or void, so what else stands there is the body's already
            continue
        if name == "br":
            pieces.append(" ")
        if name in _BLOCK_TAGS:
            flush()
        if m["end"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                if any(x[1] != stack[depth - 1][1] for x in stack[depth:]):
                    flush()
                del stack[depth:]
        elif name not in _VOID:
            while stack[-1][0] in _CLOSES and name in _CLOSES[stack[-1][0]]:
                stack.pop()
            kind, held = _kind(name, m["rest"], stack[-1][1], stack[-1][2])
            if kind != stack[-1][1]:
                flush()
            if not m["rest"].endswith("/") or name in _BLOCK_TAGS:
                stack.append((name, kind, held))
    if at < len(page):
        pieces.append(html.unescape(page[at:]))
    flush()
    return out


def _words(found: list[tuple[int, str]], kind: int, least: int = 1) -> int:
    sizes = [len(text.split()) for k, text in found if k == kind]
    return sum(n for n in sizes if n >= least)


def candidates(page: str) -> tuple[bool, list[str]]:
    """Whether the page marks its text, and the blocks of that text."""
    found = blocks(page)
    best = max((kind for kind, _ in found), default=FURNITURE)
    if best < MAIN and _words(found, NAMED_AWAY, PROSE_WORDS) > _words(found, LOOSE) + _words(found, NAMED) or best == NAMED_AWAY:
        return False, [text for kind, text in found if kind >= NAMED_AWAY]
    least = min(best, MAIN)
    if best == NAMED:
        least = NAMED if _words(found, NAMED) >= _words(found, LOOSE) else LOOSE
    return best >= MAIN, [text for kind, text in found if kind >= max(least, LOOSE)]


def _ranked(streams: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the streams; start, rank and stream of every run of ``depth`` tokens.

    The streams are laid end to end and their suffixes ranked by prefix doubling up to
    ``depth``; suffixes of equal rank share that run. No run crosses a stream's end.
    """
    sizes = np.array([len(s) for s in streams])
    tokens = np.concatenate(streams)
    n = len(tokens)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
    rank, reach = tokens + 1, 1
    while reach < depth:
        step = min(reach, depth - reach)
        after = np.zeros(n, dtype=np.int64)
        after[:n - step] = rank[step:]
        after[left <= step] = 0
        rank = np.unique(rank * (rank.max() + 1) + after, return_inverse=True)[1] + 1
        reach += step
    whole = np.flatnonzero(left >= depth)
    return sizes, whole, rank[whole], np.repeat(np.arange(len(streams)), sizes)[whole]


def _shared(rank: np.ndarray, page: np.ndarray, pages: int, least: float) -> np.ndarray:
    """Ranks of the runs that stand on ``least`` or more of the streams."""
    runs, seen = np.unique(np.unique(rank * pages + page) // pages, return_counts=True)
    return runs[seen >= least]


def _spread(sizes: np.ndarray, starts: np.ndarray, depth: int) -> list[np.ndarray]:
    """Per stream, which tokens lie in the runs that begin at ``starts``."""
    edge = np.zeros(sizes.sum() + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + depth, -1)
    return np.split(np.cumsum(edge)[:-1] > 0, np.cumsum(sizes)[:-1])


def _covered(streams: list[np.ndarray], depth: int, least: float) -> list[np.ndarray]:
    """Tokens inside runs of ``depth`` and more that stand on ``least`` or more of the streams."""
    sizes, whole, rank, page = _ranked(streams, depth)
    return _spread(sizes, whole[np.isin(rank, _shared(rank, page, len(streams), least))], depth)


def _numbered(streams: list[list[str]]) -> list[np.ndarray]:
    number: dict[str, int] = {}
    return [np.array([number.setdefault(w, len(number)) for w in s], dtype=np.int64) for s in streams]


def _main_text(marked: bool, texts: list[str], loose: np.ndarray, common: np.ndarray) -> str:
    kept, at = [], 0
    for text in texts:
        words = text.split(" ")
        own = slice(at, at + len(words))
        at += len(words)
        if marked:
            if not common[own].all():
                kept.append(text)
        elif not loose[own].any():
            kept.append(text)
        else:
            kept.extend(w for w, gone in zip(words, loose[own], strict=True) if not gone)
    return " ".join(kept)


def _stream(blocks_: list[str]) -> list[str]:
    return " ".join(blocks_).split(" ") if len(blocks_) else []


def _texts(pages: pd.DataFrame, covers: list[tuple[np.ndarray, np.ndarray] | None]) -> pd.DataFrame:
    """The pages' texts without the tokens covered as loose and as marked text (None: no token is)."""
    texts = []
    for mark, blocks_, cover in zip(pages["marked"], pages["blocks"], covers, strict=True):
        nothing = np.zeros(0 if cover else len(_stream(blocks_)), dtype=bool)
        texts.append(_main_text(mark, list(blocks_), *(cover or (nothing, nothing))))
    return pd.DataFrame({"page_id": pages["page_id"].astype(object), "url": pages["url"].astype(object), "text": texts}, dtype=object)


def _host_texts(run_tokens: int):
    """Texts of a host's pages."""
    def of_host(pages: pd.DataFrame) -> pd.DataFrame:
        streams = [_stream(x) for x in pages["blocks"]]
        first = {}
        owner = [first.setdefault("\n".join(x), i) for i, x in enumerate(pages["blocks"])]
        distinct = [i for i in sorted(set(owner)) if streams[i]]
        covered = {}
        if len(distinct) >= LEAST_PAGES:
            ids = _numbered([streams[i] for i in distinct])
            shares = [_covered(ids, run_tokens, max(3, share * len(distinct))) for share in (LOOSE_SHARE, MARKED_SHARE)]
            covered = dict(zip(distinct, zip(*shares, strict=True), strict=True))
        return _texts(pages, [covered.get(i) for i in owner])

    return of_host


def _shard_runs(run_tokens: int):
    """Runs that stand on the least share of a shard's distinct texts."""
    def of_shard(texts: pd.DataFrame) -> pd.DataFrame:
        streams = [zlib.decompress(x).decode().split(" ") for x in texts["packed"]]
        sizes, whole, rank, page = _ranked(_numbered(streams), run_tokens)
        often, at = _shared(rank, page, len(streams), LOOSE_SHARE * len(streams)), np.cumsum(sizes) - sizes
        known, one = np.unique(rank, return_index=True)
        one = one[np.isin(known, often)]
        runs = [" ".join(streams[p][k:k + run_tokens]) for p, k in zip(page[one], whole[one] - at[page[one]], strict=True)]
        return pd.DataFrame({"host": [texts["host"].iloc[0]] * len(runs), "run": runs}, dtype=object)

    return of_shard


def _shard_texts(run_tokens: int):
    """Texts of a shard's pages, given its host's common runs."""
    def of_shard(pages: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
        streams = [_stream(x) for x in pages["blocks"]]
        covers: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(streams)
        full = [i for i, x in enumerate(streams) if x]
        if len(runs) and full:
            sizes, whole, rank, page = _ranked(_numbered([streams[i] for i in full] + [x.split(" ") for x in runs["run"]]), run_tokens)
            named = page >= len(full)
            very = np.concatenate([np.zeros(len(full), dtype=bool), runs["very"].to_numpy(dtype=bool)])
            shares = [_spread(sizes, whole[~named & np.isin(rank, rank[which])], run_tokens)[:len(full)] for which in (named, very[page])]
            for i, *cover in zip(full, *shares, strict=True):
                covers[i] = tuple(cover)
        return _texts(pages, covers)

    return of_shard


def _packed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: zlib.compress(x.encode()))


def _common_runs(held: DataFrame, run_tokens: int, shard_pages: int) -> DataFrame:
    """Runs that stand on the least share of a host's distinct texts: host, run, and whether on the larger share."""
    stream = held.filter(F.size("blocks") > 0)
    sizes = written(stream.groupBy("host").agg(F.count_distinct("digest").alias("texts")).filter(F.col("texts") >= LEAST_PAGES), "host-texts")
    shard = F.pmod(F.xxhash64("digest"), F.ceil(F.col("texts") / shard_pages))
    pack = F.pandas_udf(_packed, "binary")(F.array_join("blocks", " ")).alias("packed")  # packed texts take less of the disks they cross
    dealt = stream.join(checked(sizes), "host").select("host", shard.alias("shard"), "digest", pack).repartition("host", "shard")
    texts = dealt.groupBy("host", "shard", "digest").agg(F.any_value("packed").alias("packed"))
    found = texts.groupBy("host", "shard").applyInPandas(_shard_runs(run_tokens), "host string, run string").distinct()
    found = checked(written(found.withColumn("no", F.monotonically_increasing_id()), "host-runs"))
    words, last = F.split(F.array_join("blocks", " "), " ", -1), F.size("words") - run_tokens
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("words", i + 1, run_tokens), " "))
    asked = stream.join(checked(written(found.select("host").distinct(), "run-hosts")), "host", "left_semi")
    met = asked.select("host", "digest", words.alias("words")).filter(last >= 0).select("host", "digest", F.explode(F.array_distinct(windows)).alias("run"))
    counts = met.join(found, ["host", "run"]).select("no", "digest").distinct().groupBy("no").agg(F.count(F.lit(1)).alias("on"))
    known = found.join(checked(written(counts, "host-run-counts")), "no").join(checked(sizes), "host")
    share = lambda least: F.col("on") >= F.greatest(F.lit(3.0), F.col("texts") * F.lit(least))
    return known.filter(share(LOOSE_SHARE)).select("host", "run", share(MARKED_SHARE).alias("very"))


def main_texts(pages: DataFrame, run_tokens: int = RUN_TOKENS, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))

    @F.pandas_udf("marked boolean, blocks array<string>")
    def read(pages_: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in pages_:
            yield pd.DataFrame([candidates(x) for x in series], columns=["marked", "blocks"])

    def parsed(some: DataFrame, *more: str) -> DataFrame:
        # The id passes through pandas as text, which keeps large and null ones as they are.
        rows = some.select(F.col("page_id").cast("string").alias("page_id"), "url", "host", *more, read("html").alias("r"))
        return rows.select("page_id", "url", "host", *more, "r.*")

    large = written(pages.select(host.alias("host")).groupBy("host").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") > shard_pages), "large-hosts")
    counted = pages.select("page_id", "url", host.alias("host"), F.coalesce(F.col("html"), F.lit("")).alias("html")).join(checked(large), "host", "left")
    schema = "page_id string, url string, text string"
    texts = parsed(counted.filter(F.col("pages").isNull())).groupBy("host").applyInPandas(_host_texts(run_tokens), schema)
    if not large.isEmpty():
        held = parsed(counted.filter(F.col("pages").isNotNull()), "pages").withColumn("digest", F.unhex(F.md5(F.array_join("blocks", "\n"))))
        held = written(held, "large-host-pages", **PACKED)  # stands on disk beside the shuffle of the texts
        common = written(_common_runs(held, run_tokens, shard_pages), "common-runs")
        named = checked(written(common.select("host").distinct(), "common-run-hosts"))
        # Without common runs in its host a page's text is whole where it stands, and need not move.
        whole = held.join(named, "host", "left_anti")
        texts = texts.unionByName(whole.select("page_id", "url", F.array_join("blocks", " ").alias("text")))
        shards = F.ceil(F.col("pages") / shard_pages)
        dealt = held.join(named, "host", "left_semi").drop("digest").withColumn("shard", F.pmod(F.xxhash64("page_id", "url"), shards)).drop("pages")
        runs = common.join(checked(large), "host")
        runs = runs.select("host", F.explode(F.sequence(F.lit(0).cast("bigint"), shards - 1)).alias("shard"), "run", "very")
        both = dealt.groupBy("host", "shard").cogroup(runs.groupBy("host", "shard"))
        texts = texts.unionByName(both.applyInPandas(_shard_texts(run_tokens), schema))
    return texts.select(F.col("page_id").cast(pages.schema["page_id"].dataType), "url", "text", F.length("text").cast("bigint").alias("n_chars"))
