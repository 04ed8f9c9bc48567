"""Main text of web pages by differencing each with the nearest URL of its host.

A page is read into lines, one per block element, each with the text of the
block. Within a host the distinct pages (by their lines) are put in the order of
their URL paths, and each is paired with the neighbour whose path shares more
leading segments (the earlier one on a tie). The lines of the two are aligned by
longest common subsequence; lines they share are the site's, not the page's, and
are deleted.

Two checks follow. A shared line that stands in an element which the page itself
marks as its article (``article``, ``main``) stays: near copies of an article
and passages quoted on many pages share lines that are text. And lines no
neighbour shares go if the markup says that they are no text (``nav``,
``footer``, ``aside``, ``form``, a page's ``header``, elements whose class, id or
role names an advert, a notice, a menu, comments ...) or if the page marks its
article and they stand outside. ``n_shared`` and ``n_deleted`` tell how many
lines the alignment matched and deleted.

On Spark the pages are read twice: once into line hashes per (host, digest of
the lines), the distinct ones numbered along the URL order, so that neighbours
meet by an equi-join on consecutive numbers whatever a host's size; then for the
texts, joined with the few line masks by (host, digest). The alignment is
bit-parallel, with Hirschberg's halving where its table would be large.

Defined results: NULL html is empty, an empty page has an empty text; a NULL or
unreadable URL has the host ''; pages with the same lines on one host are one
page to the alignment, so that a repeated row or a mirror does not delete
itself; the only page of a host shares nothing; pages are read to the end,
unclosed elements to the end of what encloses them; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regcurate.llm.shared import in_arrow, small_side, staged

#: Bits of an alignment table; beyond, the longer side is halved.
TABLE_BITS = 1 << 28

# --- fixed values: element names of HTML and words that name what is not text ----
_SILENT = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg",
           "math", "object", "canvas", "audio", "video", "select", "button", "noframes", "xmp"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog",
          "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
          "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main",
          "menu", "nav", "ol", "optgroup", "option", "p", "pre", "section", "summary", "table",
          "tbody", "tfoot", "thead", "tr", "ul", "caption", "legend", "search"}
_NO_TEXT = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "search", "fieldset"}
_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor",
          "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb",
          "breadcrumbs", "toolbar", "masthead", "topbar", "footer", "copyright", "sidebar",
          "aside", "widget", "related", "recommended", "cookie", "cookies", "consent", "gdpr",
          "notice", "popup", "modal", "newsletter", "subscribe", "paywall", "comment", "comments",
          "disqus", "replies", "share", "sharing", "social", "login", "signup", "form",
          "contentinfo", "complementary", "alertdialog"}
_COMMENT_WORDS = {"comment", "comments", "reply", "replies", "disqus"}
_NOT = {"no", "with", "without", "has", "non"}
# ---------------------------------------------------------------------------------

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*+>",
    re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


def _named(attributes: str, words: set[str]) -> bool:
    """Whether class, id or role has one of the words (not after "no", "with")."""
    for found in _ATTR.finditer(attributes):
        for name in (found[2] or found[3] or found[4] or "").split():
            parts = [p.lower() for p in _PART.findall(name)]
            if any(p in words and (not k or parts[k - 1] not in _NOT)
                   for k, p in enumerate(parts)):
                return True
    return False


def lines(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, marked as no text, inside the page's article) of every block with
    text, in page order."""
    out: list[tuple[str, bool, bool]] = []
    pieces: list[str] = []
    # open elements that matter: (name, marked, article)
    stack: list[tuple[str, bool, bool]] = []
    page = page or ""
    marked = article = False
    at = 0

    def close_block() -> None:
        if pieces:
            text = " ".join("".join(pieces).split())
            pieces.clear()
            if text:
                out.append((text, marked, article))

    def top() -> tuple[bool, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else (False, False)

    while True:
        found = _TOKEN.search(page, at)
        begin = found.start() if found else len(page)
        if begin > at:
            pieces.append(html.unescape(page[at:begin]))
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name in _BLOCK:
            close_block()
        elif name in ("br", "td", "th", "wbr", "img"):
            pieces.append(" ")
        if found[1]:                                   # end tag
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close_block()
                    del stack[k:]
                    break
            marked, article = top()
            continue
        if name in _SILENT:                            # up to its own end tag
            if not found[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*+>", re.I).search(page, at)
                at = end.end() if end else len(page)
            pieces.append(" ")
            continue
        if name in _BLOCK and stack and stack[-1][0] == "p":
            stack.pop()                                # a block ends an open paragraph
            marked, article = top()
        if name in _VOID:
            continue
        attributes = found[3]
        if name in ("html", "body", "main"):
            bad = False
        elif name == "article":
            bad = _named(attributes, _COMMENT_WORDS) if attributes else False
        else:
            bad = name in _NO_TEXT or (name == "header" and not article) or (
                bool(attributes) and (_named(attributes, _WORDS)
                                      or bool(_HIDDEN.search(attributes))))
        if name in _BLOCK or bad:
            if name == "p" and not bad:
                continue                               # only a marked paragraph matters
            if bad:
                close_block()                          # text before a marked inline element
            stack.append((name, marked or bad, article or name in ("article", "main")))
            marked, article = top()
    close_block()
    return out


# --- alignment --------------------------------------------------------------------

def shared_lines(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Positions in a and b of a longest common subsequence."""
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < min(hi_a, hi_b) and a[lo] == b[lo]:
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
    in_a, in_b = set(a[lo:hi_a]), set(b[lo:hi_b])
    rest_a = [k for k in range(lo, hi_a) if a[k] in in_b]
    rest_b = [k for k in range(lo, hi_b) if b[k] in in_a]
    pairs = _lcs([a[k] for k in rest_a], [b[k] for k in rest_b])
    return ([*range(lo), *(rest_a[i] for i, _ in pairs), *range(hi_a, len(a))],
            [*range(lo), *(rest_b[j] for _, j in pairs), *range(hi_b, len(b))])


def _rows(a: list[int], b: list[int], keep: bool) -> list[int]:
    """Bit-parallel table: after row i, bit j is 0 where the common subsequence
    of a[:i + 1] and b grows at b[j]. All rows, or the last one only."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, out = full, []
    for x in a:
        u = row & where.get(x, 0)
        row = ((row + u) | (row - u)) & full
        if keep:
            out.append(row)
    return out if keep else [row]


def _lengths(row: int, n: int) -> np.ndarray:
    """Length of the common subsequence with each prefix of b."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes((n + 7) // 8, "little"), np.uint8),
                         bitorder="little")[:n]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _lcs(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) * len(b) > TABLE_BITS and len(a) > 1:
        mid = len(a) // 2
        ahead = _lengths(_rows(a[:mid], b, False)[0], len(b))
        behind = _lengths(_rows(a[:mid - 1:-1], b[::-1], False)[0], len(b))[::-1]
        cut = int(np.argmax(ahead + behind))
        return _lcs(a[:mid], b[:cut]) + [(i + mid, j + cut) for i, j in _lcs(a[mid:], b[cut:])]
    table, out = _rows(a, b, True), []
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if table[i] >> j & 1:                          # no growth at b[j]
            j -= 1
        elif i and not table[i - 1] >> j & 1:          # it grew there before a[i]
            i -= 1
        else:
            out.append((i, j))
            i, j = i - 1, j - 1
    return out[::-1]


# --- Spark ------------------------------------------------------------------------

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?([^?#]*)"


def _place(df: DataFrame) -> DataFrame:
    """page_id, url, html with host and path: no query, no final slash or .html,
    segments parted by \\x01, so that the order of paths is that of their segments."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    path = F.regexp_replace(F.regexp_extract(url, _URL, 2), r"(/|\.html?)$", "")
    return df.select(F.col("page_id"), F.col("url"), F.col("html").cast("string").alias("html"),
                     F.lower(F.regexp_extract(url, _URL, 1)).alias("host"),
                     F.translate(path, "/", "\x01").alias("path"))


def _key(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little",
                          signed=True)


def _digest(found: list[tuple[str, bool, bool]]) -> bytes:
    sha = hashlib.blake2b(digest_size=16)
    for text, *_ in found:
        sha.update(text.encode() + b"\n")
    return sha.digest()


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("host", pa.string()), ("digest", pa.binary()), ("path", pa.string()),
                        ("keys", pa.list_(pa.int64())), ("loose", pa.list_(pa.bool_()))])
    for batch in batches:
        out = []
        for host, path, page in zip(batch.column("host").to_pylist(),
                                    batch.column("path").to_pylist(), batch.column("html")):
            found = lines(page.as_py())
            if found:
                out.append({"host": host, "digest": _digest(found), "path": path,
                            "keys": [_key(t) for t, *_ in found],
                            "loose": [not article for _, _, article in found]})
        yield pa.RecordBatch.from_pylist(out, schema)


def _numbered(pages: DataFrame) -> DataFrame:
    """Distinct pages of all hosts numbered 1, 2, ... along (host, path, digest)."""
    one = pages.groupBy("host", "digest").agg(
        F.min(F.struct("path", "keys", "loose")).alias("p")).select("host", "digest", "p.*")
    order = ["host", "path", "digest"]
    parts = staged(one.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn("at", F.monotonically_increasing_id()), "page-order")
    # rows before each partition: one row per partition, so no more than tasks
    counts = sorted(tuple(r) for r in parts.groupBy(F.shiftright("at", 33).alias("part"))
                    .agg(F.count(F.lit(1))).collect())
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    before = pages.sparkSession.createDataFrame(offsets, "part long, before long")
    return parts.join(F.broadcast(before), F.shiftright("at", 33) == F.col("part")).withColumn(
        "number", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1) \
        .drop("at", "part", "before")


_SIDE = ("host string, digest binary, near int, earlier int, n_shared long, n_deleted long, "
         "gone array<boolean>")


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both sides of each pair: nearness, and the shared lines outside articles."""
    schema = pa.schema([("host", pa.string()), ("digest", pa.binary()), ("near", pa.int32()),
                        ("earlier", pa.int32()), ("n_shared", pa.int64()),
                        ("n_deleted", pa.int64()), ("gone", pa.list_(pa.bool_()))])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            near = 0
            for x, y in zip(r["path"].split("\x01"), r["other_path"].split("\x01")):
                if x != y:
                    break
                near += 1
            mine, its = shared_lines(r["keys"], r["other_keys"])
            for digest, loose, at, earlier in ((r["digest"], r["loose"], mine, 0),
                                               (r["other_digest"], r["other_loose"], its, 1)):
                shared = set(at)
                gone = [k in shared and free for k, free in enumerate(loose)]
                out.append({"host": r["host"], "digest": digest, "near": near, "earlier": earlier,
                            "n_shared": len(at), "n_deleted": sum(gone), "gone": gone})
        yield pa.RecordBatch.from_pylist(out, schema)


def deletions(pages: DataFrame) -> DataFrame:
    """host, digest, n_shared, n_deleted, gone: per distinct page that shares lines
    with its neighbour, how many, and per line whether it is deleted."""
    order = _numbered(in_arrow(_place(pages).select("host", "path", "html"), _sketches,
                               "host string, digest binary, path string, keys array<long>, "
                               "loose array<boolean>"))
    later = order.select(F.col("host").alias("_host"), (F.col("number") - 1).alias("_number"),
                         *[F.col(c).alias(f"other_{c}") for c in
                           ("digest", "path", "keys", "loose")])
    pairs = order.join(later, (F.col("number") == F.col("_number")) &
                       (F.col("host") == F.col("_host"))).drop("_host", "_number", "number")
    sides = in_arrow(pairs, _aligned, _SIDE)
    # of both neighbours the nearer one, then the earlier one
    best = sides.groupBy("host", "digest").agg(F.max(F.struct(
        "near", "earlier", "n_shared", "n_deleted", "gone")).alias("s"))
    return best.select("host", "digest", "s.n_shared", "s.n_deleted", F.expr(
        "if(s.n_deleted > 0, s.gone, null)").alias("gone")).where("n_shared > 0")


_READ = ("page_id long, url string, host string, digest binary, lines array<string>, "
         "text array<boolean>")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()),
                        ("digest", pa.binary()), ("lines", pa.list_(pa.string())),
                        ("text", pa.list_(pa.bool_()))])
    for batch in batches:
        out, size = [], 0
        for page_id, url, host, page in zip(
                *[batch.column(c).to_pylist() for c in ("page_id", "url", "host")],
                batch.column("html")):
            found = lines(page.as_py())
            # where the page marks its article, text is what stands inside
            article = any(inside and not marked for _, marked, inside in found)
            out.append({"page_id": page_id, "url": url, "host": host, "digest": _digest(found),
                        "lines": [t for t, *_ in found],
                        "text": [not marked and (inside or not article)
                                 for _, marked, inside in found]})
            size += len(page.as_py() or "")
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        yield pa.RecordBatch.from_pylist(out, schema)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_lines, n_shared, n_deleted of every row of ``pages``
    (page_id, url, html)."""
    gone = staged(deletions(pages), "page-deletions")
    n, m = gone.agg(F.coalesce(F.sum(F.size("gone")), F.lit(0)), F.count(F.lit(1))).first()
    read = in_arrow(_place(pages).select("page_id", "url", "host", "html")
                    .withColumn("page_id", F.col("page_id").cast("long")), _texts, _READ)
    # in units of about 128 bytes
    both = read.join(small_side(gone, 128, m + max(n, 0) // 32), ["host", "digest"], "left")
    kept = F.expr("transform(filter(arrays_zip(lines, text, coalesce(gone, array())), x -> "
                  "x.text and not coalesce(x.`2`, false)), x -> x.lines)")
    return both.select("page_id", "url", F.array_join(kept, "\n\n").alias("text"),
                       F.size("lines").cast("long").alias("n_lines"),
                       F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"),
                       F.coalesce("n_deleted", F.lit(0)).cast("long").alias("n_deleted"))
