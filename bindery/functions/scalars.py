"""Scalar normalisers, all as column expressions that stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bindery.functions.dims import Site, domain_id, domain_url, extension_id


def or_null(text: Column) -> Column:
    """Null for ''."""
    return F.when(text != "", text)


def strip(text: Column) -> Column:
    """Without white space of any kind at the edges."""
    return F.regexp_replace(text, r"(?U)\A\s+|(?<!\s)\s+\z", "")


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null without one."""
    return or_null(F.regexp_extract(text, pattern, group))


# --- addresses -------------------------------------------------------------


def slug_of(url: Column, site: Site = Site()) -> Column:
    return first_match(url, rf"{site.series_path}([^/]+)/?")


def absolute(url: Column, site: Site = Site()) -> Column:
    """http(s) addresses stay; others go below the base address."""
    return F.when(url.rlike("^https?://"), url).when(url.startswith("/"), F.concat(F.lit(site.base_url), url)).otherwise(F.concat(F.lit(site.base_url + "/"), url))


def rooted(url: Column, site: Site = Site()) -> Column:
    """Only addresses that begin with '/' go below the base address."""
    return F.when(url.startswith("/"), F.concat(F.lit(site.base_url), url)).otherwise(url)


def split_url(url: Column, site: Site = Site()) -> Column:
    """struct(domain_id, path) of an address of a known domain; else null."""
    domain, path = F.regexp_extract(url, r"^[^:]*://([^/]*)/(.*)$", 1), F.regexp_extract(url, r"^[^:]*://([^/]*)/(.*)$", 2)
    known = domain_id(site, domain)
    return F.when(known.isNotNull(), F.struct(known.alias("domain_id"), path.alias("path")))


def joined_url(domain: Column, path: Column, site: Site = Site()) -> Column:
    return F.concat(domain_url(site, domain), F.lit("/"), path)


def without_size(path: Column) -> Column:
    """The first '-<w>x<h>.' becomes '.'; later ones stay."""
    return F.regexp_replace(path, r"(?s)^(.*?)-\d+x\d+\.", r"$1.")


def thumbnail(url: Column, site: Site = Site()) -> Column:
    """struct(domain_id, path): known domains without upload folder, size and file prefix; an unknown domain gives (0, url)."""
    parts = split_url(url, site)
    below = F.regexp_replace(parts["path"], r"(?s)^.*?wp-content/uploads/", "")
    named = F.regexp_replace(without_size(below), rf"^((?:[^/]*/)*){site.title_prefix.capitalize()}-([^/]*)$", "$1$2")
    other = F.struct(F.lit(0).cast("short").alias("domain_id"), url.alias("path"))
    return F.when(url.isNull(), None).when(parts.isNotNull(), F.struct(parts["domain_id"].alias("domain_id"), named.alias("path"))).otherwise(other)


def split_name(path: Column, site: Site = Site()) -> Column:
    """struct(name, ext_id) at the last dot; without one ext_id is 0."""
    dotted = path.rlike(r"(?s)\.[^.]*$")
    name = F.when(dotted, F.regexp_extract(path, r"(?s)^(.*)\.[^.]*$", 1)).otherwise(path)
    return F.struct(name.alias("name"), F.when(dotted, extension_id(site, F.regexp_extract(path, r"(\.[^.]*)$", 1))).otherwise(F.lit(0).cast("short")).alias("ext_id"))


def url_base(url: Column, site: Site = Site()) -> Column:
    return F.regexp_replace(F.rtrim(url, F.lit("/")), rf"{site.chapter_mark}[\d.]+/?$", "")


def chapter_url(base: Column, number: Column, site: Site = Site()) -> Column:
    """'<base>-chapter-<n>/'; a fraction follows after a dash, without trailing zeros."""
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).cast("long")
    fraction = F.regexp_replace(F.element_at(F.split(F.format_string("%.10f", F.abs(number - whole).cast("double")), r"\."), 2), "0+$", "")
    return F.concat(base, F.lit(site.chapter_mark), whole.cast("string"), F.when(number == whole, "").otherwise(F.concat(F.lit("-"), fraction)), F.lit("/"))


def dotted_chapter_url(slug: Column, number: Column, site: Site = Site()) -> Column:
    """As `chapter_url`, but a fraction keeps its dot."""
    whole = number.cast("long")
    return F.concat(F.lit(site.base_url + "/"), slug, F.lit(site.chapter_mark), F.when(number == whole, whole.cast("string")).otherwise(number.cast("string")), F.lit("/"))


def series_url(slug: Column, site: Site = Site()) -> Column:
    return F.concat(F.lit(site.base_url + site.series_path), slug, F.lit("/"))


def timestamped(prefix: str, at: Column, extension: str = ".jsonl") -> Column:
    """A file name with its time: prefix_yyyyMMdd_HHmmss."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(at, "yyyyMMdd_HHmmss"), F.lit(extension))


def masked_url(url: Column) -> Column:
    """A connection address without its password; '' is told as unset, a file by its beginning."""
    return F.when(url.isNull() | (url == ""), "(not set)").when(url.startswith("file:"), F.concat(F.substring(url, 1, 30), F.lit("... (SQLite)"))).otherwise(F.regexp_replace(url, r"://([^:/@]+):[^@]*@", "://$1:***@"))


# --- texts -----------------------------------------------------------------


def title(text: Column, site: Site = Site()) -> Column:
    """Without the site's word at the start (also within a longer word), trimmed."""
    return strip(F.regexp_replace(text, rf"(?i)^{site.title_prefix}\s*", ""))


def synopsis(text: Column, site: Site = Site()) -> Column:
    bare = F.regexp_replace(text, rf"(?is)^Update chapter terbaru {site.title_prefix}.*?Sinopsis\s*", "")
    return strip(F.regexp_replace(bare, r"^(Manga|Manhwa|Manhua)\s+", ""))


def after_label(text: Column) -> Column:
    """What follows the first colon, else the text; trimmed."""
    return strip(F.when(text.contains(":"), F.regexp_extract(text, r"(?s)^[^:]*:(.*)$", 1)).otherwise(text))


def comma_list(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: strip(x)), lambda x: x != "")


def titled(text: Column, slug: Column) -> Column:
    """The title, or the slug for a missing or empty one."""
    return F.coalesce(or_null(text), slug)


# --- numbers ---------------------------------------------------------------


def number(text: Column) -> Column:
    """A plain decimal number, else null (no suffixes, infinities or hexadecimals)."""
    plain = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
    return F.when(text.rlike(plain), text.try_cast("double"))


def chapter_number(text: Column, url: Column) -> Column:
    """From the text ('Chapter 7.5'), else from the address ('chapter-7'); null if neither parses."""
    return F.coalesce(number(F.regexp_extract(text, r"(?i)chapter\s*([\d.]+)", 1)), number(F.regexp_extract(url, r"(?i)chapter-([\d.]+)", 1)))


def url_chapter_number(url: Column) -> Column:
    """From the address only; 0 if the digits do not parse, null without a match."""
    found = F.regexp_extract(url, r"(?i)chapter-([\d.]+)", 1)
    return F.when(found != "", F.coalesce(number(found), F.lit(0.0)))


def age_minutes(text: Column) -> Column:
    """Minutes of a relative age in minutes, hours or days; 99999 for anything else, 0 for digits too many."""
    t = F.lower(F.trim(text))
    of = lambda unit, size: F.coalesce((F.when(F.regexp_extract(t, rf"(\d+)\s*{unit}", 1).try_cast("long") <= 4294967295, F.regexp_extract(t, rf"(\d+)\s*{unit}", 1).try_cast("long")) * size), F.lit(0))
    told = F.when(t.rlike(r"\d+\s*menit"), of("menit", 1)).when(t.rlike(r"\d+\s*jam"), of("jam", 60)).when(t.rlike(r"\d+\s*hari"), of("hari", 1440))
    return F.coalesce(told, F.lit(99999)).cast("long")


def gap(new: Column, old: Column) -> Column:
    """Difference of the whole parts."""
    return new.cast("long") - old.cast("long")


def flags(text: Column) -> dict[str, Column]:
    return {
        "has_rating": text.rlike(r"\b\d\.\d\b"),
        "has_chapter": text.rlike(r"(?i)(chapter|bab)\s*\d+"),
        "has_year": text.rlike(r"\b(19|20)\d{2}\b"),
    }


def log_length(text: Column) -> Column:
    return F.least(F.log1p(F.char_length(text)) / 6, F.lit(1.0))


def is_content_image(url: Column, site: Site = Site()) -> Column:
    lower = F.lower(url)
    some = lambda marks: F.exists(F.array(*(F.lit(m) for m in marks)), lambda m: F.contains(lower, m))
    return some(site.image_marks) & ~some(site.other_marks)


def response_fault(status: Column, body: Column) -> Column:
    """Why a response is no content: 'status', 'challenge', 'short'; null if it is."""
    challenge = r"(?i)just a moment|checking your browser|cf-challenge|verify you are human"
    short = (F.octet_length(body) < 100) & (body.contains("error") | body.contains("Access denied"))
    return F.when(status >= 400, "status").when(body.rlike(challenge), "challenge").when(short, "short")


def common_prefix(least: Column, greatest: Column) -> Column:
    """Longest common prefix of a set, from its least and greatest member."""
    n = F.least(F.char_length(least), F.char_length(greatest))
    same = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (i <= n) & (F.substring(least, F.lit(1), i) == F.substring(greatest, F.lit(1), i)))
    return F.substring(least, F.lit(1), F.coalesce(F.array_max(same), F.lit(0)))


def folder_prefix(least: Column, greatest: Column, count: Column) -> Column:
    """The common folder of a set of paths; of a single path the folder above its own."""
    up = lambda p: F.when(p.contains("/"), F.regexp_extract(p, r"(?s)^(.*)/[^/]*$", 1)).otherwise("")
    return up(F.when(count == 1, up(least)).otherwise(common_prefix(least, greatest)))


def fuzzy_equal(a: Column, b: Column) -> Column:
    return F.lower(F.trim(a)) == F.lower(F.trim(b))


def set_match(a: Column, b: Column) -> Column:
    """'ok', 'partial' or 'miss' of two sets of names, ignoring case."""
    low = lambda x: F.array_distinct(F.transform(x, lambda e: F.lower(F.trim(e))))
    both = F.size(F.array_intersect(low(a), low(b)))
    return F.when((both == F.size(low(a))) & (both == F.size(low(b))), "ok").when(both > 0, "partial").otherwise("miss")
