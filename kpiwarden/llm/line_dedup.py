"""Lines that are boilerplate of their site: they stand on too large a share of its pages.

For every site and line, the pages holding the line are counted and divided by the pages
of the site. Counting starts before the shuffle, on hashes of lines, so neither a large
site nor a line that is everywhere meets in one task. The boilerplate of a site is a
short list: no more lines than the mean number of lines of its pages divided by the
ratio. The lists are joined to the pages by site and the lines are dropped in place, so
texts are shuffled only if the lists are too long to be broadcast, and a large site is
then split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwarden.sources.scratch import stored

RATIO = 0.05
MIN_PAGES = 5

_BLOCKS = "p|br|div|li|ul|ol|nav|article|section|footer|header|main|aside|h[1-6]|tr|table|title|head|body|html"


def _line_hashes(text: Column) -> Column:
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x))
    return F.array_distinct(F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.xxhash64(x)))


def boilerplate(
    docs: DataFrame, text: Column, site: Column, ratio: float, min_pages: int, copies_once: bool = False
) -> DataFrame:
    """``site, hashes``: hashes of the lines (trimmed of spaces) that exceed the ratio on their site."""
    pages = docs.select(site.alias("site"), text.alias("text"))
    lines = pages.select("site", F.xxhash64("text").alias("page"), F.explode(_line_hashes(F.col("text"))).alias("hash"))
    if copies_once:
        pages, lines = pages.select("site", F.xxhash64("text").alias("page")).distinct(), lines.distinct()
    total = pages.groupBy("site").agg(F.count(F.lit(1)).alias("pages"))
    counts = lines.groupBy("site", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    total = total.select(F.col("site").alias("of"), "pages")
    over = counts.join(total, counts["site"].eqNullSafe(total["of"])).where(F.col("n") > ratio * F.col("pages"))
    return stored(over.groupBy("site").agg(F.collect_list("hash").alias("hashes")), "boilerplate")


def drop_boilerplate(
    docs: DataFrame,
    text_col: str = "text",
    site: Column | str = "source",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    copies_once: bool = False,
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text; every row and other column stays.

    A line is compared without spaces at its ends and counts once for a page, however
    often it stands there. It goes from every page of the site if more than ``ratio`` of
    the site's pages, and at least ``min_pages``, hold it. Blank lines are never
    boilerplate. Rows that repeat count as pages each. A null text stays null; pages
    without a site are one site together.

    With ``copies_once``, rows of a site with equal texts are one page, and no text is
    lost for having many near copies: a page of boilerplate alone stays as it is, and of
    those that lose the same lines and more than half of their text, one does.
    """
    site = F.col(site) if isinstance(site, str) else site
    names = _free_names(docs, 6)
    of, hashes, key, page, whole_of, whole = names
    lists = boilerplate(docs, F.col(text_col), site, ratio, min_pages, copies_once)
    lists = lists.select(F.col("site").alias(of), F.col("hashes").alias(hashes))
    rows = docs.withColumn(key, site)
    joined = rows.join(lists, rows[key].eqNullSafe(lists[of]), "left")
    kept = F.filter(
        F.split(F.col(text_col), "\n"), lambda x: ~F.array_contains(F.col(hashes), F.xxhash64(F.trim(x)))
    )
    text = F.when(F.col(hashes).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    if copies_once:
        joined = joined.withColumn(page, F.xxhash64(text_col))
        kept_whole = _one_of_each_loss(joined, F.col(text_col), text, key, hashes, page)
        kept_whole = kept_whole.select(F.col("site").alias(whole_of), F.col("page").alias(whole))
        same = (joined[page] == kept_whole[whole]) & joined[key].eqNullSafe(kept_whole[whole_of])
        joined = joined.join(kept_whole, same, "left")
        blank = F.forall(kept, lambda x: F.trim(x) == "")
        text = F.when(F.col(whole).isNotNull() | blank, F.col(text_col)).otherwise(text)
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def _one_of_each_loss(rows: DataFrame, text: Column, left: Column, site: str, hashes: str, page: str) -> DataFrame:
    """``site, page``: of the pages that lose the same lines and more than half of their text, one for each loss."""
    lost = F.array_intersect(_line_hashes(text), F.col(hashes))
    mostly = F.col(hashes).isNotNull() & (2 * F.char_length(left) < F.char_length(text))
    found = rows.where(mostly).select(
        F.col(site).alias("site"), F.xxhash64(F.array_sort(lost)).alias("lost"), F.col(page).alias("page")
    )
    found = found.groupBy("site", "lost").agg(F.min("page").alias("page"))
    return stored(found.select("site", "page").distinct(), "whole")


def _free_names(df: DataFrame, n: int) -> list[str]:
    """Column names that ``df`` does not have, whatever their case."""
    taken = {c.lower() for c in df.columns}
    out, i = [], 0
    while len(out) < n:
        if f"_c{i}" not in taken:
            out.append(f"_c{i}")
        i += 1
    return out


def host(url: Column) -> Column:
    """Host of an absolute URL in lower case, without user and port; null where there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    name = F.lower(F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", ""))
    return F.when(name != "", name)


def html_lines(html: Column) -> Column:
    """Visible text of a page, one line for each block; tags, scripts, styles and comments are gone."""
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->", "")
    text = F.regexp_replace(text, r"[\r\n]+", " ")
    text = F.regexp_replace(text, rf"(?i)</?({_BLOCKS})\b[^>]*>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.regexp_replace(text, " *\n[ \n]*", "\n")
    return F.trim(F.regexp_replace(text, "^\n+|\n+$", ""))


def site_line_report(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per page: host, lines, lines dropped and the SHA-256 of the lines kept.

    ``pages`` has ``page_id, url, html``. A null page has no lines and a null hash.
    """
    lines = pages.select("page_id", host(F.col("url")).alias("host"), html_lines(F.col("html")).alias("text"))
    # both passes over the lines read what one pass over the pages has made
    lines = stored(lines.withColumn("n_lines", _lines(F.col("text"))), "page-lines")
    kept = drop_boilerplate(lines, "text", "host", ratio, min_pages)
    return kept.select(
        "page_id",
        "host",
        "n_lines",
        (F.col("n_lines") - _lines(F.col("text"))).alias("n_dropped"),
        F.sha2(F.col("text"), 256).alias("kept_sha256"),
    )


def _lines(text: Column) -> Column:
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(F.size(F.split(text, "\n")))


#: Rows of op4_line_dedup.
ORACLE_SQL = rf"""
with cleaned as (
  select page_id, url,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g'),
      '[\r\n]+', ' ', 'g'),
      '(?i)</?({_BLOCKS})\b[^>]*>', chr(10), 'g'),
      '<[^>]*>', '', 'g') as t
  from pages),
unescaped as (
  select page_id,
    nullif(lower(regexp_replace(regexp_replace(
      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '') as host,
    replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
      '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') as t
  from cleaned),
texts as (
  select page_id, host,
    trim(regexp_replace(regexp_replace(t, ' *\n[ \n]*', chr(10), 'g'), '^\n+|\n+$', '', 'g'), ' ') as t
  from unescaped),
lines as (
  select page_id, host, t, case when t is null or t = '' then [] else string_split(t, chr(10)) end as ls
  from texts),
spread as (
  select page_id, host, unnest(list_distinct([trim(x, ' ') for x in ls if trim(x, ' ') <> ''])) as line
  from lines),
totals as (select host, count(*) as pages from lines group by host),
counts as (select host, line, count(*) as n from spread group by host, line),
lists as (
  select counts.host, list(line) as over
  from counts join totals on counts.host is not distinct from totals.host
  where n >= {MIN_PAGES} and n > {RATIO} * pages
  group by counts.host),
kept as (
  select page_id, lines.host, t, len(ls) as n_lines,
    case when over is null then ls
      else [x for x in ls if not list_contains(over, trim(x, ' '))] end as ks, over
  from lines left join lists on lines.host is not distinct from lists.host)
select page_id, host, cast(n_lines as integer) as n_lines,
  cast(n_lines - case when array_to_string(ks, chr(10)) = '' then 0 else len(ks) end as integer) as n_dropped,
  case when t is not null then sha256(array_to_string(ks, chr(10))) end as kept_sha256
from kept
"""
