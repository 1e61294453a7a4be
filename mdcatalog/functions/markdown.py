"""Column -> Column helpers for Markdown bodies: sections, tables, headings.

All of them work inside one row, so a corpus is processed without a shuffle. Patterns use
``(?d)`` so that only a line feed ends a line.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .text import sanitize_cell, trim_ws

# A level-1 or level-2 heading line: it delimits sections.
_HEADING = r"[^\S\n]*##?[ ][^\S\n]*\S"
_SECTION_START = rf"(?dm)^(?={_HEADING})"
_SECTION_END = rf"(?=^{_HEADING}|\z)"


def _section_pattern(heading: str, any_level: bool) -> str:
    """Groups: text before the section's heading line, its content, and what follows."""
    text = re.escape(heading)
    marker = rf"#+[ ][^\S\n]*{text}" if any_level else rf"##[ ]{text}"
    return rf"(?dms)^[^\S\n]*{marker}[^\S\n]*$(.*?){_SECTION_END}"


def has_section(body: Column, heading: str, any_level: bool = False) -> Column:
    return body.rlike(_section_pattern(heading, any_level))


def get_section(body: Column, heading: str, any_level: bool = False) -> Column:
    """Trimmed content of the first section with this heading, NULL when there is none.

    Level 2 only, or any level; the section ends at the next level-1 or level-2 heading.
    """
    # one search says both whether there is a section and what is in it
    return trim_ws(F.get(F.regexp_extract_all(body, F.lit(_section_pattern(heading, any_level)), 1), 0))


def section_chunks(body: Column) -> Column:
    """The body cut before every level-1/2 heading; a preamble, if any, comes first."""
    return F.split(body, _SECTION_START)


def chunk_level(chunk: Column) -> Column:
    """1 or 2 for a chunk that starts with a heading, 0 for a preamble."""
    return F.length(F.regexp_extract(chunk, rf"\A[^\S\n]*(##?)(?=[ ][^\S\n]*\S)", 1))


def chunk_heading(chunk: Column) -> Column:
    return trim_ws(F.regexp_extract(chunk, r"(?d)\A[^\S\n]*##?[ ](.*)", 1))


def chunk_text(chunk: Column) -> Column:
    """Content below the heading line, trimmed."""
    return trim_ws(F.regexp_replace(chunk, r"(?d)\A[^\S\n]*##?[ ].*", ""))


def headings(body: Column) -> Column:
    """Texts of all level-1/2 headings, in order."""
    chunks = F.filter(section_chunks(body), lambda c: chunk_level(c) > 0)
    return F.transform(chunks, chunk_heading)


def first_heading(body: Column) -> Column:
    """Text of the first line that starts with ``#``, "" when there is none."""
    return trim_ws(F.regexp_extract(body, r"(?dm)^[^\S\n]*#+(.*)$", 1))


def trim_newlines(c: Column) -> Column:
    return F.rtrim(c, F.lit("\n"))


def upsert_section(body: Column, heading: str, content: Column) -> Column:
    """Replace the level-2 section ``heading``, or append it; other text is kept."""
    pattern = rf"(?dms)\A(.*?)^[^\S\n]*##[ ]{re.escape(heading)}[^\S\n]*$.*?{_SECTION_END}(.*)\z"
    section = F.concat(F.lit(f"## {heading}\n\n"), trim_newlines(content), F.lit("\n"))
    before = trim_newlines(F.regexp_extract(body, pattern, 1))
    after = F.ltrim(F.regexp_extract(body, pattern, 2), F.lit("\n"))
    head = F.when(before == "", F.lit("")).otherwise(F.concat(before, F.lit("\n\n")))
    ending = F.when(after.endswith("\n"), F.lit("")).otherwise(F.lit("\n"))
    tail = F.when(after == "", F.lit("")).otherwise(F.concat(F.lit("\n"), after, ending))
    kept = trim_newlines(body)
    appended = F.when(kept == "", section).otherwise(F.concat(kept, F.lit("\n\n"), section))
    return F.when(body.rlike(pattern), F.concat(head, section, tail)).otherwise(appended)


def append_section(body: Column, heading: str, content: Column) -> Column:
    """Append a level-1 section; the body is returned as it is when there is no content."""
    kept = trim_newlines(body)
    start = F.when(kept == "", F.lit("")).otherwise(F.concat(kept, F.lit("\n\n")))
    empty = content.isNull() | (content == "")
    return F.when(empty, body).otherwise(F.concat(start, F.lit(f"# {heading}\n\n"), content))


def extra_sections(existing: Column, known: Column) -> Column:
    """Level-1/2 sections of ``existing`` whose heading is not among the ``known`` ones."""
    return F.filter(
        section_chunks(existing),
        lambda c: (chunk_level(c) > 0) & ~F.array_contains(known, chunk_heading(c)),
    )


def append_sections(fresh: Column, extras: Column) -> Column:
    """``fresh`` followed by an array of sections."""
    added = F.array_join(F.transform(extras, lambda c: F.concat(F.lit("\n\n"), trim_newlines(c))), "")
    return F.when(F.size(extras) > 0, F.concat(trim_newlines(fresh), added, F.lit("\n"))).otherwise(fresh)


# --- tables ---------------------------------------------------------------


def split_cells(row: Column) -> Column:
    """Cells of a ``| a | b |`` line: one outer pipe off each end, escaped pipes kept."""
    inner = F.regexp_replace(trim_ws(row), r"^\||(?<!\\)\|$", "")
    return F.transform(F.split(inner, r"(?<!\\)\|"), trim_ws)


def is_divider(cells: Column) -> Column:
    return F.forall(cells, lambda c: c.rlike(fv.DIVIDER_CELL))


def table_lines(section: Column, closed: bool = True) -> Column:
    """Lines of a section that are table rows (``closed``: they must also end with a pipe)."""
    lines = F.transform(F.split(section, "\n"), trim_ws)
    return F.filter(lines, lambda l: l.startswith("|") & (l.endswith("|") if closed else F.lit(True)))


def header_index(header: Column, *names: str) -> Column:
    """Zero-based position of the last header cell with one of these names, -1 if absent."""
    return F.array_max(F.transform(header, lambda h, i: F.when(h.isin(*names), i).otherwise(-1)))


def header_cell(cells: Column, header: Column, *names: str) -> Column:
    """Cell under a header, "" when the column or the cell is missing."""
    return F.coalesce(F.get(cells, header_index(header, *names)), F.lit(""))


def table_row(*cells: Column) -> Column:
    """Render one table line from columns (values are made cell-safe)."""
    safe = [sanitize_cell(F.coalesce(c, F.lit(""))) for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *safe), F.lit(" |\n"))


def table_head(*names: str) -> str:
    return "| " + " | ".join(names) + " |\n| " + " | ".join("---" for _ in names) + " |\n"


def fenced_sql(sql: Column) -> Column:
    """View SQL as a fenced block, "" when blank."""
    text = trim_ws(F.coalesce(sql, F.lit("")))
    return F.when(text == "", F.lit("")).otherwise(F.concat(F.lit("```sql\n"), text, F.lit("\n```\n")))
