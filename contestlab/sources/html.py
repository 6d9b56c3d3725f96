"""Tables of stored HTML pages as long rows, and choosing among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from contestlab.schemas import PAGE_ROWS


PAGE_CELLS = 250_000  # cells that the spans of a page may fill


def _reader(with_url: bool = False, batch_cells: int = 20_000, page_cells: int = PAGE_CELLS,
            columns: tuple[str, ...] | None = None, min_rows: int = 1, max_rows: int = 0):
    """Batch function for `mapInArrow`. Everything it needs is defined inside, so that workers
    need no copy of this package. It gives a row per row of a table or, if `columns` are named, a row per table of
    min_rows..max_rows rows, with the cells of each of so many columns as a list.

    A page is parsed into its own cells, which are no larger than the page. Rows with spans repeated are made one
    at a time: a small table is laid out once, a large one twice, first for its size only. A page of plain tables, all
    tags closed and only text in their cells, is cut a row at a time instead of a tag at a time, with the same result."""
    import re
    from html import unescape

    inside = r"""(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+>"""
    hidden = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
    table_tag = re.compile(rf"<(/?)(table|tr|td|th|br)\b({inside})", re.I)
    any_tag = re.compile(rf"<[/!a-z]{inside}", re.I)
    spans = {name: re.compile(rf"""\b{name}\s*=\s*["']?\s*(\d+)""", re.I) for name in ("colspan", "rowspan")}
    most_wide, most_deep = 1000, 65534  # limits of the HTML standard
    attributes = r"""((?:\s+[\w-]+(?:\s*=\s*(?:"[^"<>]*"|[\w%-]+))?)*+\s*)"""
    plain_row = re.compile(rf"[^<]*<tr{attributes}>")
    plain_cell = re.compile(rf"<t([dh]){attributes}>([^<]*)</t[dh]>")
    next_row, seen = "</td></tr><tr><td>", {}
    not_plain = re.compile(r"</?(?:ta|tr|td|th|br)|<!-|<s", re.I)  # what outside of tables may begin one or hide it

    def end_cell(table):
        if table["cell"] is not None:
            text = unescape(any_tag.sub("", "".join(table["cell"]))).strip()
            table["rows"][-1]["cells"].append((text, *table["span"]))
            table["cell"] = None

    def size_of(tag):
        """Columns and rows that a cell spans; no rows (0) means all rows below."""
        wide, deep = (spans[name].search(tag) for name in ("colspan", "rowspan"))
        wide = min(max(int(wide[1][:6]), 1), most_wide) if wide else 1
        deep = min(int(deep[1][:6]), most_deep) if deep else 1
        return wide, deep or most_deep

    def laid_out(rows):
        """Rows of cell texts, spanning cells repeated to the right and below, and whether they hold data cells."""
        above = {}  # column -> text and number of rows it still fills
        for row in rows:
            cells, own, last = [], iter(row["cells"]), max(above, default=-1)
            waiting = next(own, None)
            while waiting is not None or len(cells) <= last:
                column = len(cells)
                if column in above:
                    text, left = above.pop(column)
                    if left > 1:
                        above[column] = (text, left - 1)
                    cells.append(text)
                elif waiting is None:
                    cells.append(None)
                else:
                    text, wide, deep = waiting
                    for c in range(column, column + wide):
                        if c not in above:
                            cells.append(text)
                            if deep > 1:
                                above[c] = (text, deep - 1)
                        else:
                            break
                    waiting = next(own, None)
            if cells:
                yield cells, row["data"]

    def sized(rows, budget):
        """Width and number of the rows after a first row of header cells, which names the columns; the cells of all; and the
        rows themselves if they are few. Stops once they are more than the budget."""
        width, number, cells, few, first = 0, 0, 0, [], True
        for row, data in laid_out(rows):
            cells += len(row)
            if cells > budget:
                return 0, 0, cells, None
            if data or not first:
                width, number = max(width, len(row)), number + 1
                few = _more(few, row, cells)
            first = False
        return width, number, cells, few

    def _more(few, row, cells):
        if few is None or cells > batch_cells:
            return None
        few.append(row)
        return few

    def without_header(rows):
        for i, (row, data) in enumerate(laid_out(rows)):
            if data or i:
                yield row

    def plain_tables(page):
        """Tables, each with the texts of its rows and, by the number of the row, the spans of its cells (None: all 1) and whether it
        has data cells where that is not a matter of course. None unless every "<" of the page belongs to a closed row or cell,
        or stands outside of the tables and means nothing to them."""
        outside, *parts = page.split("<table>")
        if not_plain.search(outside):
            return None
        tables = []
        for part in parts:
            body, end, outside = part.partition("</table>")
            if not end or ("<" in outside and not_plain.search(outside)):
                return None
            table = rows_of(body)
            if table is None:
                return None
            tables.append(table)
        return tables

    def rows_of(body):
        special = {}
        if body[:8] == "<tr><td>" and body[-10:] == "</td></tr>":
            pieces = body[8:-10].split(next_row)
            rows = [p.split("</td><td>") for p in pieces]
            if body.count("<") != 2 * sum(map(len, rows)) + 2 * len(rows):  # some pieces are no plain row, maybe several rows
                found, rows = zip(pieces, rows), []
                for piece, texts in found:
                    if piece.count("<") == 2 * len(texts) - 2:
                        rows.append(texts)
                    elif not add_rows(f"<tr><td>{piece}</td></tr>", rows, special):
                        return None
        else:
            rows = []
            if not add_rows(body, rows, special):
                return None
        if "&" in body:
            rows = [list(map(str.strip, map(unescape, texts))) for texts in rows]
        elif " <" in body or "> " in body or not body.isprintable():  # of all blanks, only the space is printable
            rows = [list(map(str.strip, texts)) for texts in rows]
        return rows, special

    def add_rows(body, rows, special):
        """Adds rows whose cells may have attributes; false if other tags are among them."""
        *lines, rest = body.split("</tr>")
        for line in lines:
            found = seen.get(line)
            if found is None:
                cells = plain_cell.findall(line)
                if line.count("<") != 2 * len(cells) + 1 or not plain_row.match(line):
                    return False
                kinds, tags, texts = zip(*cells) if cells else ((), (), ())
                found = texts, ([size_of(tag) for tag in tags] if any(tags) else None, "d" in kinds)
                if len(line) < 200 and len(seen) < 1000:  # headings are the same on many pages
                    seen[line] = found
            texts, special[len(rows)] = list(found[0]), found[1]
            rows.append(texts)
        return "<" not in rest

    def plain_layout(rows, special, budget):
        """Width and rows of a plain table, the number of its cells before and after spans are repeated; no rows if cells span rows
        or the spans go beyond the budget."""
        own = cells = sum(map(len, rows))
        if special:
            spanned = [span for spans, _ in special.values() if spans for span in spans]
            cells += sum([wide - 1 for wide, _ in spanned])
            if cells > max(budget, own) or any([deep > 1 for _, deep in spanned]):
                return 0, None, own, cells
            laid = list(rows)
            for i, (spans, _) in special.items():
                if spans:
                    laid[i] = [t for t, (wide, _) in zip(rows[i], spans) for _ in range(wide)]
            numbers = [i for i, row in enumerate(rows) if row]
            rows = [laid[i] for i in numbers if i != numbers[0] or special.get(i, (None, True))[1]]
        return max(map(len, rows), default=0), rows, own, cells

    def columns_of(rows):
        """The cells of the columns asked for; a row that is too short has none there."""
        n = len(columns)
        if min(map(len, rows)) >= n:
            return list(zip(*rows))[:n]
        return [[row[i] if i < len(row) else None for row in rows] for i in range(n)]

    def tables_of(page):
        """Tables in order of their opening tags, each a list of rows of cell texts. A nested table
        is a table of its own; end tags of cells and rows may be missing."""
        plain = plain_tables(page or "")
        left = page_cells
        for number, rows in enumerate(parsed(page) if plain is None else plain, 1):
            if plain is not None:
                texts, special = rows
                width, kept, own, cells = plain_layout(texts, special, left)
                if kept is not None:
                    left -= cells - own
                    yield number, width, len(kept), kept
                    continue
                rows = []
                for i, row in enumerate(texts):
                    spans, data = special.get(i, (None, True))
                    rows.append({"cells": [(t, *s) for t, s in zip(row, spans or [(1, 1)] * len(row))], "data": data})
            own = sum(len(row["cells"]) for row in rows)
            width, n_rows, cells, few = sized(rows, max(left, own))
            if cells > max(left, own):  # more than its page may fill: every cell once
                for row in rows:
                    row["cells"] = [(text, 1, 1) for text, _, _ in row["cells"]]
                width, n_rows, cells, few = sized(rows, own)
            left -= cells - own
            yield number, width, n_rows, without_header(rows) if few is None else few

    def parsed(page):
        """Rows of the tables of any page, read tag by tag."""
        page = hidden.sub("", page or "")
        tables, unclosed, at = [], [], 0
        for tag in table_tag.finditer(page):
            table = unclosed[-1] if unclosed else None
            if table and table["cell"] is not None:
                table["cell"].append(page[at:tag.start()])
            at = tag.end()
            closing, name = tag[1], tag[2].lower()
            if name == "table" and not closing:
                unclosed.append({"rows": [], "cell": None, "span": (1, 1)})
                tables.append(unclosed[-1])
            elif table is None:
                continue
            elif closing and name != "br":
                end_cell(table)
                if name == "table":
                    unclosed.pop()
            elif name == "br":
                if table["cell"] is not None:
                    table["cell"].append("\n")
            else:
                end_cell(table)
                if name == "tr" or not table["rows"]:
                    table["rows"].append({"cells": [], "data": False})
                if name != "tr":
                    table["span"] = size_of(tag[3])
                    table["cell"] = []
                    table["rows"][-1]["data"] |= name == "td"
        if unclosed and unclosed[-1]["cell"] is not None:
            unclosed[-1]["cell"].append(page[at:])
        for table in unclosed:
            end_cell(table)
        return [table["rows"] for table in tables]

    def read(batches):
        import pyarrow as pa

        texts = pa.list_(pa.string())
        if columns is None:
            own = {"row_no": pa.int32(), "cells": texts, "n_rows": pa.int32()}
        else:
            own = {"n_rows": pa.int32(), **dict.fromkeys(columns, texts)}
        types = {"page_id": pa.int64(), "table_no": pa.int32(), **own, **({"url": pa.string()} if with_url else {})}

        def flush(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.values())], names=list(types))

        for batch in batches:
            held, size = [], 0  # a few thousand cells at a time, or one row
            for page, html, *url in zip(*(c.to_pylist() for c in batch.columns)):
                for table_no, width, n_rows, rows in tables_of(html):
                    if columns is not None:
                        if min_rows <= n_rows <= max_rows:
                            held.append((page, table_no, n_rows, *columns_of(list(rows)), *url))
                            size += n_rows * len(columns)
                        rows = ()
                    for number, cells in enumerate(rows, 1):
                        held.append((page, table_no, number, cells + [None] * (width - len(cells)), n_rows, *url))
                        size += width
                        if size >= batch_cells:
                            yield flush(held)
                            held, size = [], 0
                    if size >= batch_cells:
                        yield flush(held)
                        held, size = [], 0
            if held:
                yield flush(held)

    return read


def html_tables(pages: DataFrame, with_url: bool = False, page_cells: int = PAGE_CELLS) -> DataFrame:
    """(page_id, url, html) to (page_id, table_no, row_no, cells, n_rows) and, if asked for, url.

    Spanning cells are repeated to the right and below, up to the limits of the HTML standard, and short
    rows padded to the width of their table; n_rows is the table's size. The spans of a page may add `page_cells` cells;
    in a table that would go beyond, every cell stands once. Rows leave the task as they are laid out."""
    schema = T.StructType([*PAGE_ROWS.fields, *([T.StructField("url", T.StringType())] if with_url else [])])
    columns = [F.col("page_id").cast("long"), "html", *(["url"] if with_url else [])]
    return pages.select(*columns).mapInArrow(_reader(with_url, page_cells=page_cells), schema)


def table_columns(pages: DataFrame, names: Sequence[str], min_rows: int, max_rows: int, with_url: bool = False,
                  page_cells: int = PAGE_CELLS) -> DataFrame:
    """(page_id, url, html) to one row per table of min_rows..max_rows rows: page_id, table_no, n_rows, an array for each of the
    first columns, named by position, and, if asked for, url. `html_tables` and `tables_by_shape` give the same cells a row each."""
    texts = T.ArrayType(T.StringType())
    number, count = PAGE_ROWS["table_no"], PAGE_ROWS["n_rows"]
    schema = T.StructType([PAGE_ROWS["page_id"], number, count, *[T.StructField(n, texts) for n in names],
                           *([T.StructField("url", T.StringType())] if with_url else [])])
    columns = [F.col("page_id").cast("long"), "html", *(["url"] if with_url else [])]
    reader = _reader(with_url, page_cells=page_cells, columns=tuple(names), min_rows=min_rows, max_rows=max_rows)
    return pages.select(*columns).mapInArrow(reader, schema)


def tables_by_shape(rows: DataFrame, min_rows: int = 1, max_rows: int | None = None,
                    n_cols: int | None = None) -> DataFrame:
    """Rows of the tables with min_rows..max_rows rows and, if given, n_cols columns."""
    fits = F.col("n_rows") >= min_rows
    if max_rows is not None:
        fits = fits & (F.col("n_rows") <= max_rows)
    if n_cols is not None:
        fits = fits & (F.size("cells") == n_cols)
    return rows.filter(fits)


# The windows below run over the rows of one page. A page is one text that one task has parsed, so
# its rows fit one task; all of them share one shuffle on page_id.


def require_tables(rows: DataFrame, k: int) -> DataFrame:
    """Keep the pages with exactly k tables and number these 1..k in `nth` (1 = home, 2 = away)."""
    on_page = Window.partitionBy("page_id")
    return (
        rows.withColumn("nth", F.dense_rank().over(on_page.orderBy("table_no")))
        .withColumn("_k", F.max("nth").over(on_page)).filter(F.col("_k") == k).drop("_k")
    )


def name_columns(rows: DataFrame, names: Sequence[str | None]) -> DataFrame:
    """Cells as columns, named by position; a position named None is left out."""
    return rows.select(
        *[c for c in rows.columns if c != "cells"],
        *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names) if n is not None])


def marker_row(marker: Column, group: Sequence[str] = ("page_id", "table_no")) -> Column:
    """Number of the first row of the table that meets the condition."""
    return F.min(F.when(marker, F.col("row_no"))).over(Window.partitionBy(*group))


def slice_after_marker(rows: DataFrame, marker: Column, value: Column, positions: dict[str, int],
                       group: Sequence[str] = ("page_id", "table_no")) -> DataFrame:
    """Values at given positions counted from the first marker row (1 = the marker row itself),
    one row per group that has a marker; NULL past the end."""
    placed = rows.withColumns({"_at": F.col("row_no") - marker_row(marker, group) + 1, "_value": value})
    return placed.filter(F.col("_at").isNotNull()).groupBy(*group).agg(
        *[F.max(F.when(F.col("_at") == at, F.col("_value"))).alias(n) for n, at in positions.items()])


def flag_after_marker(rows: DataFrame, marker: Column, flag: str, group: Sequence[str] = ("page_id", "table_no")) -> DataFrame:
    """Set `flag` to 1 before the first marker row and to 0 from it on."""
    return rows.withColumn(flag, F.when(F.col("row_no") >= marker_row(marker, group), 0).otherwise(1))
