"""Document text functions (D1-D5) as Spark Column expressions.

All work is JVM-side; no Python runs per row. Title and first paragraph are found by
one regular expression each over the whole text, so that no text is cut into lines
for them; possessive loops keep the matcher from backtracking into a long
paragraph. Lines end at any line end (``\\r\\n``, ``\\r`` and the Unicode ones too);
"strip" removes Unicode white space at both ends of a line.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Summary and snippet width, the heading marker, the
# ellipsis, and the section label of files at the root.
WIDTH = 220
HEADING = "# "
ELLIPSIS = "..."
ROOT_SECTION = "Repository"
WS = "[\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
# White space as characters, and the part of it that ends a line, for patterns.
WS_CHARS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_END = "\\n-\\r\\x1c-\\x1e\\x85\\u2028\\u2029"
_BLANK = "\\t\\x1f\\x20\\xa0\\u1680\\u2000-\\u200a\\u202f\\u205f\\u3000"     # white space inside a line
LINE_END = f"\\r\\n|[{_END}]"
# A heading line, and its text (which is not blank).
_HEADING_LINE = f"[{_BLANK}]*+# ([{_BLANK}]*+[^{_END}{_BLANK}][^{_END}]*+)"
_FIRST_HEADING = f"(?:^|[{_END}]){_HEADING_LINE}"
# The heading and, as the second group, the lines after it: white space skipped, up to a
# blank line or another heading.
_PARAGRAPH = (f"{_FIRST_HEADING}(?:[{_END}][{_END}{_BLANK}]*+([^{_END}]++(?:(?>{LINE_END})(?![{_BLANK}]*+(?:[{_END}]|\\z))"
              f"(?!{_HEADING_LINE})[^{_END}]++)*+))?")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    return F.btrim(_col(c), F.lit(WS_CHARS))


def lines_of(c: ColumnOrName) -> Column:
    return F.split(_col(c), LINE_END, -1)


def let(value: Column, fn) -> Column:
    """Bind ``value`` to a lambda variable: ``fn`` may use it many times, it is computed once.

    Catalyst inlines projected columns into every use (and into filters it
    pushes down), and higher-order functions are evaluated per use, so
    without this a text would be split and stripped again for every
    reference to an intermediate.
    """
    return F.element_at(F.transform(F.array(value), fn), 1)


def cut(c: ColumnOrName, width: int = WIDTH) -> Column:
    """Longer than ``width``: first ``width-3`` chars, back to the last space, plus '...'."""
    def shorten(s: Column) -> Column:
        def to_space(head: Column) -> Column:
            return F.when(F.instr(head, " ") > 0, F.regexp_extract(head, "(?s)^(.*) ", 1)).otherwise(head)
        return F.when(F.length(s) > width,
                      F.concat(let(F.substring(s, 1, width - 3), to_space), F.lit(ELLIPSIS))).otherwise(s)
    return let(_col(c), shorten)


def title(content: ColumnOrName, fallback: ColumnOrName) -> Column:
    """The text of the first line that starts with '# ' (after stripping), else ``fallback``."""
    return F.coalesce(strip(F.nullif(F.regexp_extract(_col(content), _FIRST_HEADING, 1), F.lit(""))), _col(fallback))


def summary(content: ColumnOrName, width: int = WIDTH) -> Column:
    """The first paragraph after that heading, cut to ``width``; blank lines after
    the heading are skipped and the paragraph ends at a blank line or the next heading
    (a heading can open it). '' without a heading or a paragraph."""
    lines = F.split(F.regexp_extract(F.coalesce(_col(content), F.lit("")), _PARAGRAPH, 2), LINE_END, -1)
    return cut(F.array_join(F.transform(lines, strip), " "), width)


def title_summary(content: ColumnOrName, fallback: ColumnOrName, width: int = WIDTH) -> Column:
    """D1 + D2 as ``struct(title, summary)``."""
    return F.struct(title(content, fallback).alias("title"), summary(content, width).alias("summary"))


def snippet(content: ColumnOrName, terms: Sequence[str], width: int = WIDTH) -> Column:
    """The first line holding any term with one line either side, else the text start."""
    text = _col(content)

    def joined(lines: Column) -> Column:
        return F.array_join(F.filter(F.transform(lines, strip), lambda x: x != ""), " ")

    def around(at: Column) -> Column:
        # a term never goes over a line end, so its line is that of its first character
        def by_line(i: Column) -> Column:
            first = F.greatest(i - 1, F.lit(1))
            return joined(F.slice(F.split(text, LINE_END, i + 2), first, i + 2 - first))
        before = F.substring(F.lower(text), F.lit(1), at)
        return F.when(at > 0, let(F.size(F.split(before, LINE_END, -1)), by_line)).otherwise(joined(lines_of(text)))

    if not terms:
        return cut(joined(lines_of(text)), width)
    places = let(F.lower(text), lambda low: F.array_min(F.filter(F.array(*[F.instr(low, t) for t in terms]), lambda x: x > 0)))
    return cut(let(F.coalesce(places, F.lit(0)), around), width)


def path_stem(path: ColumnOrName) -> Column:
    """File name without its last suffix (``docs/a/x.md`` -> ``x``)."""
    name = F.regexp_extract(_col(path), "[^/]*$", 0)
    return F.coalesce(F.nullif(F.regexp_extract(name, "^(.+)\\.[^.]*$", 1), F.lit("")), name)


def url_path(url: ColumnOrName) -> Column:
    """Host and path of a URL, without scheme, query, fragment or trailing '/'."""
    no_scheme = F.regexp_replace(_col(url), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.regexp_replace(F.regexp_extract(no_scheme, "^[^?#]*", 0), "/+$", "")


def section(rel_path: ColumnOrName) -> Column:
    """D3: parent folder of a relative path; files at the root get a fixed label."""
    parent = F.regexp_extract(_col(rel_path), "^(.*)/[^/]*$", 1)
    return F.coalesce(F.nullif(parent, F.lit("")), F.lit(ROOT_SECTION))


def search_terms(query: str) -> list[str]:
    """Whitespace-split, lower-case, non-empty terms of a query string."""
    import re

    return [t for t in re.split(r"\s+", query.strip().lower()) if t]


def term_count(haystack: ColumnOrName, term: str) -> Column:
    """Non-overlapping occurrences of ``term`` (left to right), as bigint."""
    h = _col(haystack)
    return ((F.length(h) - F.length(F.replace(h, F.lit(term), F.lit("")))) / len(term)).cast("bigint")


def may_score(content: ColumnOrName, fallback: ColumnOrName, terms: Sequence[str]) -> Column:
    """Whether any term can count in title, summary or text, from the text and the title's
    fallback alone. (A cut summary adds an ellipsis, so terms with a dot may.)"""
    if any("." in t for t in terms):
        return F.lit(True)

    def holds(value: ColumnOrName) -> Column:
        return let(F.lower(_col(value)), lambda low: F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: low.contains(t)))
    return F.coalesce(holds(content), F.lit(False)) | F.coalesce(holds(fallback), F.lit(False))


def score(haystack: ColumnOrName, terms: Sequence[str]) -> Column:
    """Summed counts of every term in the lower-cased haystack."""
    if not terms:
        return F.lit(0).cast("bigint")

    def count_all(low: Column) -> Column:
        total = term_count(low, terms[0])
        for t in terms[1:]:
            total = total + term_count(low, t)
        return total
    return let(F.lower(_col(haystack)), count_all)
