"""Queries for document search (D1-D5, U4) over ``documents`` and ``pages``."""

from __future__ import annotations


from ballotbox.functions import text as X
from ballotbox.operators import docsearch
from ballotbox.plans import standins
from ballotbox.plans.registry import register
from ballotbox.session import scratch_path

SEARCH_QUERY = "  The DE  "
TERMS = ["the", "de"]         # of that query, for the oracle
_WS = "[\\t-\\r\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
_LINES = "string_split_regex(content, '\\r\\n|[\\n-\\r\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]')"
# Text after '# ' on the first stripped heading line (NULL when there is none).
HEADING_TEXT_SQL = "substr(list_filter(s, lambda x: starts_with(x, '# '))[1], 3)"


# ---- DuckDB forms of the text functions, for the oracle only.

def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _cut(s: str, width: int = 220) -> str:
    head = f"substr({s}, 1, {width - 3})"
    return (f"case when length({s}) > {width} then (case when instr({head}, ' ') > 0"
            f" then regexp_extract({head}, '(?s)^(.*) ', 1) else {head} end) || '...' else {s} end")


def _stem(p: str) -> str:
    name = f"regexp_extract({p}, '[^/]*$', 0)"
    return f"coalesce(nullif(regexp_extract({name}, '^(.+)\\.[^.]*$', 1), ''), {name})"


def _section(p: str) -> str:
    return f"coalesce(nullif(regexp_extract({p}, '^(.*)/[^/]*$', 1), ''), 'Repository')"


def _index_sql() -> str:
    lines = f"list_transform({_LINES}, lambda x: {_strip('x')})"
    return (
        f"with d as (select doc_id, rel_path, content, {lines} as s from ({standins.doc_table_sql()}) t),"
        f" h as (select *, coalesce(list_position(list_transform(s, lambda x: starts_with(x, '# ')), true), 0) as h"
        f" from d),"
        f" r as (select *, list_slice(s, h + 1, len(s)) as rest from h),"
        f" p as (select *, coalesce(list_position(list_transform(rest, lambda x: x <> ''), true), 0) as p from r),"
        f" t as (select *, list_slice(rest, greatest(p, 1), len(rest)) as tail from p),"
        f" st as (select *, coalesce(list_position(list_transform(tail,"
        f" lambda x, i: i > 1 and (x = '' or starts_with(x, '# '))), true), 0) as stop from t),"
        f" para as (select *, case when h > 0 and p > 0 then array_to_string(case when stop > 0"
        f" then list_slice(tail, 1, stop - 1) else tail end, ' ') else '' end as para from st)"
        f" select doc_id, rel_path, content, {_section('rel_path')} as section,"
        f" coalesce({_strip(HEADING_TEXT_SQL)},"
        f" {_stem('rel_path')}) as title, {_cut('para')} as summary from para")


@register("doc_title", "D1", lambda: f"select doc_id, title from ({_index_sql()}) i")
def doc_title(spark, sf_dir):
    docs = standins.doc_table(spark, sf_dir)
    return docs.select("doc_id", X.title("content", X.path_stem("rel_path")).alias("title"))


@register("doc_summary", "D2", lambda: f"select doc_id, summary from ({_index_sql()}) i")
def doc_summary(spark, sf_dir):
    docs = standins.doc_table(spark, sf_dir)
    return docs.select("doc_id", X.summary("content").alias("summary"))


def _url_path_sql(u: str) -> str:
    return (f"regexp_replace(regexp_extract(regexp_replace({u}, '^[A-Za-z][A-Za-z0-9+.-]*://', ''),"
            f" '^[^?#]*', 0), '/+$', '')")


@register("doc_section", "D3", lambda: (
    f"select page_id, rel_path, {_section('rel_path')} as section"
    f" from (select page_id, {_url_path_sql('url')} as rel_path from pages) p"))
def doc_section(spark, sf_dir):
    pages = standins.table(spark, sf_dir, "pages")
    return (pages.select("page_id", X.url_path("url").alias("rel_path"))
            .select("page_id", "rel_path", X.section("rel_path").alias("section")))


def _score_sql(terms: list[str]) -> str:
    hay = "lower(concat_ws(chr(10), title, summary, content))"
    return " + ".join(f"cast((length({hay}) - length(replace({hay}, '{t}', ''))) // {len(t)} as bigint)"
                      for t in terms)


def _snippet_sql(terms: list[str]) -> str:
    hit = " or ".join(f"contains(lower(x), '{t}')" for t in terms)
    lines = _LINES
    idx = f"coalesce(list_position(list_transform({lines}, lambda x: {hit}), true), 0)"
    window = (f"case when {idx} > 0 then list_slice({lines}, greatest({idx} - 1, 1), least({idx} + 1, len({lines})))"
              f" else {lines} end")
    parts = f"list_filter(list_transform({window}, lambda x: {_strip('x')}), lambda x: x <> '')"
    return _cut(f"array_to_string({parts}, ' ')")


@register("doc_search", "D4", lambda: (
    f"select doc_id, section, title, score, snippet from (select *, {_score_sql(TERMS)}"
    f" as score, {_snippet_sql(TERMS)} as snippet from ({_index_sql()}) i) s"
    f" where score > 0"))
def doc_search(spark, sf_dir):
    return docsearch.search(standins.doc_table(spark, sf_dir), SEARCH_QUERY, keep=["doc_id"]).select(
        "doc_id", "section", "title", "score", "snippet")


@register("doc_search_top10", "D4", lambda: (
    f"select doc_id, section, title, score, snippet from (select *, {_score_sql(TERMS)}"
    f" as score, {_snippet_sql(TERMS)} as snippet from ({_index_sql()}) i) s"
    f" where score > 0 order by score desc, section, lower(title), lower(rel_path) limit 10"))
def doc_search_top10(spark, sf_dir):
    # Top-k is the feature here: a distributed TakeOrderedAndProject, no global sort.
    return docsearch.search(standins.doc_table(spark, sf_dir), SEARCH_QUERY, limit=10).select(
        "doc_id", "section", "title", "score", "snippet")


def _search_sql(terms: list[str]) -> str:
    return (f"select doc_id, section, title, score, snippet from (select *, {_score_sql(terms)}"
            f" as score, {_snippet_sql(terms)} as snippet from ({_index_sql()}) i) s where score > 0")


INDEX_BLOCK = 256 << 10     # small, so that the given tables make several blocks
RARE_QUERY = "CC BY-NC gpl apache"
RARE_TERMS = ["cc", "by-nc", "gpl", "apache"]


def _indexed(spark, sf_dir, query):
    root = docsearch.build_index(standins.doc_table(spark, sf_dir), scratch_path(spark, "doc-index"), block_bytes=INDEX_BLOCK)
    return docsearch.search_index(spark, root, query).select("doc_id", "section", "title", "score", "snippet")


@register("doc_search_indexed", "D4", lambda: _search_sql(TERMS))
def doc_search_indexed(spark, sf_dir):
    # The search over stored blocks and their postings.
    return _indexed(spark, sf_dir, SEARCH_QUERY)


@register("doc_search_rare", "D4", lambda: _search_sql(RARE_TERMS))
def doc_search_rare(spark, sf_dir):
    # Rare terms open few blocks.
    return _indexed(spark, sf_dir, RARE_QUERY)


@register("doc_snippet", "D5", lambda: (
    f"select doc_id, {_snippet_sql(TERMS)} as snippet"
    f" from ({standins.doc_table_sql()}) d"))
def doc_snippet(spark, sf_dir):
    docs = standins.doc_table(spark, sf_dir)
    return docs.select("doc_id", X.snippet("content", X.search_terms(SEARCH_QUERY)).alias("snippet"))


@register("doc_index", "U4", lambda: f"select doc_id, rel_path, section, title, summary from ({_index_sql()}) i")
def doc_index(spark, sf_dir):
    return docsearch.listing(standins.doc_table(spark, sf_dir), ["doc_id", "rel_path"]).select("doc_id", "rel_path", "section", "title", "summary")
