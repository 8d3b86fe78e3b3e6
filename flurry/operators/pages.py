"""Link, image and table extraction over a table of crawled pages (H1-H8).

Tags are read with built-in expressions (JVM-side): comments, scripts and
style sheets go first, a tag ends at the first ``>`` outside quotes, and its
attributes are walked from the left, so text inside other attributes is never
taken for the wanted one. Character references in values are decoded. Only
HTML tables, which need a real parser for rows, cells, spans and multi-level
headers, go through a Python UDTF, one pass a page.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flurry.functions.scalar import contains_all
from flurry.functions.urls import resolve_url, target_file_name, url_host

# comments (an open one ends the page), and elements whose content is no markup
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""

# --- fixed values: character references decoded by name ----------------------
NAMED_REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0"}
# ---------------------------------------------------------------------------


def tag_pattern(tag: str) -> str:
    """Regex whose group 1 is the attribute text of every ``<tag ...>``; a ``>`` inside quotes does not end it."""
    return rf"""(?is)<{tag}(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""


def attr_pattern(attr: str) -> str:
    """Regex whose group 1 is the raw (possibly quoted) value of the attribute in a tag's attribute text:
    whole attributes are skipped from the left until the wanted name comes."""
    other = rf"""(?!{attr}\s*=)[^\s=>"'/]++(?:\s*+=\s*+{_VALUE})?+"""
    return rf"""(?is)^(?:[\s/"']++|{other}|=)*+{attr}\s*=\s*({_VALUE})"""


def _unquote(c: Column) -> Column:
    quoted = (c.startswith('"') & c.endswith('"') & (F.length(c) >= 2)) | (
        c.startswith("'") & c.endswith("'") & (F.length(c) >= 2))
    return F.when(quoted, c.substr(F.lit(2), F.length(c) - 2)).otherwise(c)


def decode_references(c: Column) -> Column:
    """Numeric and the usual named character references of a value; others stay as they are."""
    def number(part: Column) -> Column:  # "&#65;rest" -> "A" + "rest"
        dec, hexa = F.regexp_extract(part, r"^&#([0-9]{1,7});", 1), F.regexp_extract(part, r"(?i)^&#x([0-9a-f]{1,6});", 1)
        code = F.when(dec != "", dec.cast("int")).when(hexa != "", F.conv(hexa, 16, 10).cast("int"))
        fine = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
        return F.when(F.coalesce(fine, F.lit(False)), F.concat(char, F.regexp_replace(part, r"^&#[^;]*;", ""))).otherwise(part)

    out = F.array_join(F.transform(F.split(c, "(?=&#)"), number), "")
    for name, char in NAMED_REFERENCES.items():
        out = F.replace(out, F.lit(f"&{name};"), F.lit(char))
    out = F.replace(out, F.lit("&amp;"), F.lit("&"))
    return F.when(c.contains("&"), out).otherwise(c)


def _extract(pages: DataFrame, tag: str, attr: str, html: str, keep: list[str], out: str) -> DataFrame:
    shown = F.regexp_replace(F.col(html), HIDDEN, " ")
    tags = F.regexp_extract_all(shown, F.lit(tag_pattern(tag)), 1)
    raw = F.transform(tags, lambda t: F.regexp_extract(t, attr_pattern(attr), 1))
    found = pages.select(*keep, F.posexplode(F.filter(raw, lambda v: v != "")).alias("pos", "_raw"))
    return found.select(*keep, "pos", decode_references(_unquote(F.col("_raw"))).alias(out))


def extract_links(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Every ``<a href>`` of every page (H1): ``(page_id, url, pos, link)``.
    ``pos`` is the link's order in the page. Anchors without href give no row."""
    return _extract(pages, "a", "href", html, keep or ["page_id", "url"], "link")


def filter_links(links: DataFrame, tokens: list[str], col: str = "link") -> DataFrame:
    """Keep links containing every token (H2)."""
    return links.where(contains_all(col, tokens))


def extract_images(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Every ``<img src>`` (H3): ``(page_id, url, pos, src)``; an empty src is
    skipped, an img without src gives no row."""
    imgs = _extract(pages, "img", "src", html, keep or ["page_id", "url"], "src")
    return imgs.where(F.length("src") > 0)


def resolve_links(df: DataFrame, base: str = "url", ref: str = "link", out: str = "resolved") -> DataFrame:
    """Resolve each reference against its page URL (H4)."""
    return df.withColumn(out, resolve_url(base, ref))


def keep_host(df: DataFrame, host: str, col: str = "resolved") -> DataFrame:
    """Keep URLs whose host part (with port) equals ``host`` (H5)."""
    return df.where(url_host(col) == F.lit(host))


def with_file_name(df: DataFrame, col: str = "resolved", out: str = "file_name") -> DataFrame:
    """third-from-last + '_' + last path part (H6)."""
    return df.withColumn(out, target_file_name(col))


def two_hop_images(pages: DataFrame, tokens: list[str], host: str | None = None,
                   hop2_tag: str = "img", hop2_attr: str = "src") -> DataFrame:
    """pages -> filtered links -> linked pages -> their images (H7).

    Links are chosen by their text in the page (every token occurs in it). Each
    page's images are extracted once, in a narrow pass; links and images then
    meet as small rows on the page address, so html is never shuffled. A page
    that was not crawled yields nothing, one crawled several times the images
    of each. Output ``(page_id, link_page_id, image, file_name)``.
    """
    links = resolve_links(filter_links(extract_links(pages), tokens)).select("page_id", "resolved").distinct()
    imgs = _extract(pages, hop2_tag, hop2_attr, "html", ["page_id", "url"], "src").where(F.length("src") > 0)
    imgs = imgs.select(F.col("page_id").alias("link_page_id"), F.col("url").alias("resolved"), resolve_url("url", "src").alias("image"))
    if host is not None:
        imgs = imgs.where(url_host("image") == F.lit(host))
    return with_file_name(links.join(imgs, "resolved"), "image").select("page_id", "link_page_id", "image", "file_name")


# --- HTML tables -------------------------------------------------------------

MAX_COLSPAN = 1000  # as browsers read it


def _span(value: str | None) -> int:
    return int(value) if value and value.isdigit() else 1


class TableParser(HTMLParser):
    """Rows of the first table with an id: cells as (text, is header, columns, rows); nested tables belong to their cell."""

    def __init__(self, table_id: str):
        super().__init__(convert_charrefs=True)
        self.table_id, self.depth, self.ended = table_id, 0, False
        self.rows, self.cell = [], None

    def _close(self):
        if self.cell is not None:
            text, head, cols, rows = self.cell
            self.rows[-1].append((" ".join("".join(text).split()), head, cols, rows))
            self.cell = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table" and not self.ended:
            self.depth += 1 if self.depth or a.get("id") == self.table_id else 0
        elif self.depth == 1 and tag == "tr":
            self._close()
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self._close()
            if not self.rows:
                self.rows.append([])
            self.cell = ([], tag == "th", min(max(1, _span(a.get("colspan"))), MAX_COLSPAN), _span(a.get("rowspan")))

    def handle_endtag(self, tag):
        if tag == "table" and self.depth:
            if self.depth == 1:
                self._close()
                self.ended = True
            self.depth -= 1
        elif self.depth == 1 and tag in ("td", "th", "tr"):
            self._close()

    def handle_data(self, data):
        if self.depth and self.cell is not None:
            self.cell[0].append(data)


def table_grid(rows: list) -> list[tuple[bool, list[str]]]:
    """(is header row, cells) per row with every span filled in: a cell that spans rows is repeated in
    each of them (to the end of the table for ``rowspan=0``), one that spans columns in each column."""
    out, held = [], {}  # held: column -> (text, rows still to fill)
    for r, row in enumerate(rows):
        cells, below, todo, col = [], {}, list(row), 0
        while todo or any(c >= col for c in held):
            if col in held:
                text, left, cols = *held[col], 1
            elif todo:
                text, _, cols, span = todo.pop(0)
                left = len(rows) - r if span == 0 else min(span, len(rows) - r)
            else:
                text, left, cols = "", 1, 1
            for _ in range(cols):
                cells.append(text)
                over = held.get(col, (text, left))  # a wide cell may lie over one that reaches further down
                if over[1] > 1:
                    below[col] = (over[0], over[1] - 1)
                col += 1
        held = below
        out.append((bool(row) and all(cell[1] for cell in row), cells))
    return out


def _table_udtf():
    from pyspark.sql.functions import udtf

    @udtf(returnType="row_idx int, cells array<string>, header array<string>", useArrow=True)
    class HtmlTable:
        """Rows of the ``<table id=...>`` of one page. Header rows (``<th>``
        only) are joined into one header per column; with a multi-level
        header the top level is dropped, keeping the last level."""

        def eval(self, html: str, table_id: str):
            if html is None:
                return
            p = TableParser(table_id)
            p.feed(html)
            p.close()
            p._close()
            rows = table_grid(p.rows)
            headers = [r for head, r in rows if head]
            for i, r in enumerate(r for head, r in rows if not head):
                yield i, r, headers[-1] if headers else None

    return HtmlTable


def extract_table(pages: DataFrame, table_id: str, html: str = "html") -> DataFrame:
    """Rows of the HTML table with the given id in each page (H8):
    ``(page_id, row_idx, cells, header)``. A lateral join runs the parser
    once per page, in parallel across pages."""
    HtmlTable = _table_udtf()
    p = pages.select("page_id", F.col(html).alias("_html"))
    return p.lateralJoin(HtmlTable(F.col("_html").outer(), F.lit(table_id))).select(
        "page_id", "row_idx", "cells", "header")
