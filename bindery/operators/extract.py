"""Records from pages: list, detail, chapter reader, home and latest-feed pages.

Every field is an ordered chain of fallbacks over the DOM column, in one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions import scalars as S
from bindery.functions.dims import Site, status_id
from bindery.operators.dom import all_of, attr, first_attr, first_of, first_text, text, with_dom
from bindery.runtime import let

_CHAPTER = "array<struct<number:double,url:string>>"
_IMAGE = "array<struct<domain_id:smallint,path:string>>"


def _dom() -> Column:
    return F.col("dom")


def first_distinct(items: Column, key: str) -> Column:
    """Structs whose key no earlier one has; null keys go."""
    known = F.filter(items, lambda x: x[key].isNotNull())
    # Equal keys stand together in the sorted array, the first place of each before the others.
    placed = F.array_sort(F.transform(known, lambda x, i: F.struct(x[key].alias("k"), i.alias("i"), x.alias("x"))))
    firsts = let(placed, lambda p: F.filter(p, lambda y, j: (j == 0) | (F.get(p, j - 1)["k"] != y["k"])))
    return F.transform(F.array_sort(F.transform(firsts, lambda y: F.struct(y["i"].alias("i"), y["x"].alias("x")))), lambda y: y["x"])


def _hrefs(nodes: Column) -> Column:
    return F.transform(nodes, lambda n: attr(n, "href"))


def list_slugs(pages: DataFrame, key: str, site: Site = Site()) -> DataFrame:
    """(key, pos, slug): distinct slugs of a list page in document order; `a.tip`, else any link to a series."""
    tips = all_of(_dom(), "a.tip")
    links = F.when(F.size(tips) > 0, tips).otherwise(all_of(_dom(), f"a[href*='{site.series_path}']"))
    found = F.transform(_hrefs(links), lambda h: F.struct(F.when(h.contains(site.series_path), S.slug_of(h, site)).alias("slug")))
    return with_dom(pages).select(key, F.posexplode(first_distinct(found, "slug")).alias("pos", "s")).select(key, "pos", "s.slug")


def _kind(node: Column) -> Column:
    return F.get(F.filter(node["classes"], lambda c: c != "typeflag"), F.lit(0))


def _thumbnail(site: Site) -> Column:
    src = F.coalesce(*(first_attr(_dom(), "src", c, "img") for c in ("div.infoanime", "div.thumb", "div.itemprop")))
    marked = F.get(F.filter(F.transform(all_of(_dom(), "img[itemprop='image']"), lambda n: attr(n, "src")), lambda s: F.lower(s).contains(f"/{site.title_prefix}-")), F.lit(0))
    return let(F.coalesce(src, marked), lambda u: S.thumbnail(u, site))


def model_thumbnail(site: Site = Site()) -> Column:
    """struct(domain_id, path) of the first image, by the detector's chain of places, whose address has a known domain."""
    paths = (("div.thumb", "img"), ("div.imgdesc", "img"), ("img.wp-post-image",))
    return F.coalesce(*(let(first_attr(_dom(), "src", *p), lambda u: let(S.thumbnail(u, site), lambda t: F.when(t["domain_id"] > 0, t))) for p in paths))


def numbered(links: Column) -> Column:
    """Distinct (number, url) of structs (url, t), greatest number first (equal numbers in order); without a number they are none."""
    found = F.transform(first_distinct(links, "url"), lambda r: F.struct(S.chapter_number(r["t"], r["url"]).alias("number"), r["url"].alias("url")))
    placed = F.transform(F.filter(found, lambda r: r["number"].isNotNull()), lambda r, i: F.struct((-r["number"]).alias("k"), i.alias("i"), r["number"].alias("number"), r["url"].alias("url")))
    return F.transform(F.array_sort(placed), lambda r: F.struct(r["number"].alias("number"), r["url"].alias("url")))


def _labelled() -> Column:
    """array(struct(label, value)) of the spans with a bold label in the info block."""

    def one(span: Column) -> Column:
        bold = F.get(F.filter(F.slice(_dom()["nodes"], span["pre"] + 2, span["last"] - span["pre"]), lambda n: n["tag"] == "b"), F.lit(0))
        of = lambda b: F.when(b.isNotNull(), F.struct(F.lower(F.rtrim(text(_dom(), b), F.lit(":"))).alias("label"), F.trim(F.replace(text(_dom(), span), text(_dom(), b), F.lit(""))).alias("value")))
        return let(bold, of)

    return F.filter(F.transform(all_of(_dom(), "span", first_of(_dom(), "div.spe")), one), lambda x: x.isNotNull())


# Words of the labels; the first group that a label contains decides.
LABELS = (("genre", ("genre",)), ("status", ("status",)), ("author", ("pengarang", "author")), ("artist", ("ilustrator", "artist")), ("tipe", ("tipe", "type")), ("alternative_title", ("alternative", "alternatif")))


def _label_of(label: Column) -> Column:
    told = F.lit(None).cast("string")
    for name, words in reversed(LABELS):
        said = label.contains(words[0])
        for w in words[1:]:
            said = said | label.contains(w)
        told = F.when(said, name).otherwise(told)
    return told


def _info(name: str, first: bool = False) -> Column:
    """The value of the last (or first) span whose label means `name`."""
    same = F.filter(F.col("info"), lambda x: x["name"] == name)
    return F.when(F.size(same) > 0, F.element_at(same, 1 if first else -1)["value"])


def _rating() -> Column:
    return F.coalesce(*(S.number(first_text(_dom(), c, "i")) for c in ("div.archiveanime-rating", "div.infoanime-rating", "div.rating")), S.number(first_text(_dom(), "span.skor")))


def _synopsis(site: Site) -> Column:
    chain = (("div.entry-content.entry-content-single",), ("div.entry-content",), ("div#sinopsis", "div.entry-content"))
    return F.coalesce(*(S.or_null(S.synopsis(first_text(_dom(), *c), site)) for c in chain))


def _chapters(site: Site) -> Column:
    """Distinct chapters, greatest number first (equal numbers in document order)."""
    marked = f"a[href*='{site.chapter_mark}']"

    def of(links: Column) -> Column:
        return numbered(F.transform(links, lambda n: F.struct(S.rooted(F.nullif(attr(n, "href"), F.lit("")), site).alias("url"), text(_dom(), n).alias("t"))))

    def within(container: str) -> list[Column]:
        box = first_of(_dom(), container)
        spans = all_of(_dom(), "span.lchx", box)
        inner = F.flatten(F.transform(spans, lambda s: F.filter(F.slice(_dom()["nodes"], s["pre"] + 2, s["last"] - s["pre"]), lambda n: n["tag"] == "a")))
        return [of(all_of(_dom(), marked, box)), of(inner)]

    tries = [*within("div.bxcl"), *within("div#chapter_list"), of(all_of(_dom(), marked))]
    return F.coalesce(*(let(t, lambda a: F.when(F.size(a) > 0, a)) for t in tries), F.array().cast(_CHAPTER))


def _similar(site: Site) -> Column:
    nodes_in = lambda n: F.slice(_dom()["nodes"], n["pre"] + 2, n["last"] - n["pre"])
    head = lambda a: F.get(a, F.lit(0))

    def one(li: Column) -> Column:
        link = head(F.filter(nodes_in(li), lambda n: (n["tag"] == "a") & F.array_contains(n["classes"], "series")))
        h3 = head(F.filter(nodes_in(li), lambda n: n["tag"] == "h3"))
        named = let(h3, lambda h: let(head(F.filter(nodes_in(h), lambda n: n["tag"] == "a")), lambda a: F.nullif(text(_dom(), a), F.lit(""))))
        return F.struct(S.slug_of(attr(link, "href"), site).alias("slug"), named.alias("judul"))

    return first_distinct(F.transform(all_of(_dom(), "li", first_of(_dom(), "div#mirip")), one), "slug")


def details(pages: DataFrame, key: str, site: Site = Site()) -> DataFrame:
    """One record per page that is not blank; what a page lacks is null, or an empty array.

    genre_list are names; ids come from dims.genre_ids (a join), so a page needs no table.
    """
    read = with_dom(pages).filter("dom.nodes is not null")
    labelled = read.withColumn("info", F.transform(_labelled(), lambda x: F.struct(_label_of(x["label"]).alias("name"), x["value"].alias("value"))))
    tags = [F.filter(F.transform(all_of(_dom(), "a[rel='tag']", first_of(_dom(), c)), lambda n: text(_dom(), n)), lambda t: t != "") for c in ("div.genre-info", "div.spe")]
    some = lambda a: F.when(F.size(a) > 0, a)
    statuses = F.filter(F.transform(F.filter("info", lambda x: x["name"] == "status"), lambda x: status_id(site, x["value"])), lambda s: s.isNotNull())
    titles = F.coalesce(first_text(_dom(), "h1.titless"), first_text(_dom(), "h1.entry-title"), first_text(_dom(), "div.infox", "h1"))
    rows = labelled.select(
        key,
        S.title(titles, site).alias("judul"),
        F.coalesce(_kind(first_of(_dom(), "span.typeflag")), _info("tipe", first=True)).alias("tipe"),
        _thumbnail(site).alias("thumb"),
        F.when(F.size(statuses) > 0, F.element_at(statuses, -1)).alias("status_id"),
        *(_info(n).alias(n) for n in ("author", "artist", "alternative_title")),
        _synopsis(site).alias("sinopsis"),
        _rating().alias("rating"),
        F.coalesce(some(tags[0]), some(tags[1]), S.comma_list(_info("genre")), F.array().cast("array<string>")).alias("genre_list"),
        _chapters(site).alias("chapters"),
        _similar(site).alias("similar"),
    )
    return rows.withColumn("latest_chapter_number", F.get("chapters", F.lit(0))["number"]).withColumns({"thumb_domain_id": F.col("thumb.domain_id"), "thumb_path": F.col("thumb.path")}).drop("thumb")


def chapter_images(pages: DataFrame, key: str, site: Site = Site()) -> DataFrame:
    """(key, cdn_domain_id, cdn_path_prefix, image_filenames, image_ext_ids, total_images) of reader pages.

    The domain is the most frequent (ties: smallest id); images of unknown domains are left out.
    """
    sources = lambda nodes: F.filter(F.transform(nodes, lambda n: attr(n, "src")), lambda s: S.is_content_image(s, site))
    some = lambda a: let(a, lambda x: F.when(F.size(x) > 0, x))
    raw = F.coalesce(*(some(sources(all_of(_dom(), "img", first_of(_dom(), c)))) for c in ("div#chimg-auh", "div.chimg-auh")), sources(all_of(_dom(), "img")))
    known = F.filter(F.transform(raw, lambda u: S.split_url(u, site)), lambda p: p.isNotNull())
    read = with_dom(pages).select(key, F.coalesce(known, F.array().cast(_IMAGE)).alias("p"))
    paths, ids = F.transform("p", lambda x: x["path"]), F.transform("p", lambda x: x["domain_id"])
    counted = F.transform(F.array_distinct(ids), lambda d: F.struct((-F.size(F.filter(ids, lambda x: x == d))).alias("n"), d.alias("d")))
    prefix = F.when(F.size("p") > 0, S.folder_prefix(F.array_min(paths), F.array_max(paths), F.size("p"))).otherwise("")
    read = read.withColumn("prefix", prefix)
    rest = F.transform(paths, lambda p: S.split_name(F.when((F.col("prefix") != "") & p.startswith(F.concat("prefix", F.lit("/"))), F.substring(p, F.char_length("prefix") + 2, F.char_length(p))).otherwise(p), site))
    return read.select(
        key,
        F.coalesce(F.array_min(counted)["d"], F.lit(0).cast("short")).alias("cdn_domain_id"),
        F.col("prefix").alias("cdn_path_prefix"),
        F.transform(rest, lambda r: r["name"]).alias("image_filenames"),
        F.transform(rest, lambda r: r["ext_id"]).alias("image_ext_ids"),
        F.size("p").alias("total_images"),
    )


def with_images(chapters: DataFrame, images: DataFrame, key: str = "url") -> DataFrame:
    """Chapters with their image block, joined on the address, never by position."""
    return chapters.join(images, key, "left")


def _cards(*paths: tuple[str, ...]) -> Column:
    some = lambda a: let(a, lambda x: F.when(F.size(x) > 0, x))
    lists = [some(all_of(_dom(), p[-1], first_of(_dom(), *p[:-1]) if len(p) > 1 else None)) for p in paths]
    return F.coalesce(*lists)


def _card_rows(pages: DataFrame, key: str, cards: Column) -> DataFrame:
    return with_dom(pages).select(key, "dom", F.posexplode(cards).alias("pos", "card"))


def _first_per_page(rows: DataFrame, key: str) -> DataFrame:
    """Cards whose slug no earlier card of the page has."""
    ranked = rows.filter("slug is not null").groupBy(key, "slug").agg(F.min_by(F.struct(*(c for c in rows.columns if c not in (key, "slug"))), "pos").alias("r"))
    return ranked.select(key, "slug", "r.*")


def home_updates(pages: DataFrame, key: str, site: Site = Site()) -> DataFrame:
    """(key, pos, slug, judul, latest_chapter_number, tipe, thumbnail) of a home page; the number comes from the address only."""
    rows = _card_rows(pages, key, _cards(("div.listupd", "div.animepost"), ("div.listupd", "div.bsx")))
    card = F.col("card")
    inside = lambda selector: F.get(all_of(_dom(), selector, card), F.lit(0))
    heading = let(inside("h3"), lambda h: F.get(all_of(_dom(), "a", h), F.lit(0)))
    named = rows.withColumn("a", F.coalesce(heading, inside(f"a[href*='{site.series_path}']")))
    limited = let(inside("div.limit"), lambda d: F.get(all_of(_dom(), "img", d), F.lit(0)))
    picked = named.select(
        key,
        "pos",
        S.slug_of(S.rooted(attr(F.col("a"), "href"), site), site).alias("slug"),
        text(_dom(), F.col("a")).alias("judul"),
        S.number(F.regexp_extract(attr(inside(f"a[href*='{site.chapter_mark}']"), "href"), r"(?i)chapter-([\d.]+)", 1)).alias("latest_chapter_number"),
        _kind(inside("span.typeflag")).alias("tipe"),
        attr(F.coalesce(limited, inside("img")), "src").alias("thumbnail"),
    )
    return _first_per_page(picked, key)


def latest_feed(pages: DataFrame, key: str, site: Site = Site()) -> DataFrame:
    """(key, pos, slug, judul, chapter_number, chapter_url, url_base, time_str, minutes) of a feed page.

    A card takes its slug even if it has no chapter link and gives no row itself.
    """
    rows = _card_rows(pages, key, _cards(("div.animepost",)))
    card = F.col("card")
    inside = lambda selector: F.get(all_of(_dom(), selector, card), F.lit(0))
    heading = let(inside("h3"), lambda h: F.get(all_of(_dom(), f"a[href*='{site.series_path}']", h), F.lit(0)))
    named = rows.withColumn("a", F.coalesce(heading, inside(f"a.animposx[href*='{site.series_path}']")))
    link = let(inside("div.lsch"), lambda d: F.get(all_of(_dom(), f"a[href*='{site.chapter_mark}']", d), F.lit(0)))
    picked = named.select(
        key,
        "pos",
        S.slug_of(attr(F.col("a"), "href"), site).alias("slug"),
        F.coalesce(text(_dom(), F.col("a")), F.lit("")).alias("judul"),
        S.absolute(attr(link, "href"), site).alias("chapter_url"),
        F.coalesce(text(_dom(), inside("span.datech")), F.lit("")).alias("time_str"),
    )
    kept = _first_per_page(picked, key).withColumn("chapter_number", S.url_chapter_number(F.col("chapter_url"))).filter("chapter_number is not null")
    return kept.select(key, "pos", "slug", "judul", "chapter_number", "chapter_url", S.url_base(F.col("chapter_url"), site).alias("url_base"), "time_str", S.age_minutes(F.col("time_str")).alias("minutes"))
