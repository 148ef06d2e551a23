"""Features of DOM elements: 44 numbers per element, from the DOM column of its page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.operators.dom import NODE, all_of, attr, first_of, text, with_dom
from bindery.runtime import let

# The features in order, the tags of the first nine, the tags that are no candidates, the fields in order.
TAGS = "h1 h2 h3 span div a td i meta".split()
NAMES = [
    *(f"is_{t}" for t in TAGS),
    *(f"has_class_{c}" for c in "title entry info rating archive".split()),
    *"has_id depth sibling_index sibling_count child_count text_length_log1p text_starts_prefix parent_is_div parent_has_info".split(),
    *"has_itemprop itemprop_is_rating_value is_inside_spe is_inside_infox is_inside_infoanime bold_text_ratio link_count has_rel_tag".split(),
    *"font_size_indicator bold_contains_status bold_contains_author bold_contains_alternative has_class_desc_or_synopsis".split(),
    *"href_contains_chapter is_inside_mirip_or_bxcl has_class_lchx_or_series text_contains_chapter".split(),
    *"contains_rating_float contains_chapter_number contains_year normalized_document_position".split(),
]
CANDIDATES = ("h1", "h2", "h3", "span", "div", "a", "td", "i", "meta", "p", "b", "strong", "label", "section", "article")
NO_CANDIDATES = ("script", "style", "meta", "link", "noscript", "head")
FIELDS = ("title", "rating", "genre", "synopsis", "alt_title", "author", "status", "similar", "chapters")
FONTS = {"h1": 1.0, "h2": 0.8, "h3": 0.6, "h4": 0.5, "h5": 0.4, "h6": 0.3}


def elements(pages: DataFrame, key: str) -> DataFrame:
    """(key, pre, n, t, up, parent, bold): candidate elements with text, ancestors and bold texts; still one page per row group."""
    d = F.col("dom")

    def around(n: Column) -> Column:
        inside = F.slice(d["nodes"], n["pre"] + 2, n["last"] - n["pre"])
        bold = F.transform(F.filter(inside, lambda x: x["tag"].isin("b", "strong")), lambda x: text(d, x))
        up = F.transform(n["path"], lambda i: F.get(d["nodes"], i))
        return F.struct(
            n.alias("n"),
            F.regexp_replace(text(d, n), r"\s+", " ").alias("t"),
            F.flatten(F.transform(up, lambda x: F.transform(x["classes"], lambda c: F.lower(c)))).alias("up_classes"),
            F.filter(F.transform(up, lambda x: F.lower(attr(x, "id"))), lambda i: i.isNotNull()).alias("up_ids"),
            F.get(d["nodes"], n["parent"]).alias("parent"),
            bold.alias("bold"),
            F.size(F.filter(inside, lambda x: x["tag"] == "a")).alias("links"),
        )

    candidates = F.filter(d["nodes"], lambda n: ~n["tag"].isin(*NO_CANDIDATES))
    return with_dom(pages).select(key, F.size(candidates).alias("n_candidates"), F.posexplode(F.transform(candidates, around)).alias("pos", "e")).select(key, "n_candidates", "pos", "e.*")


def vector() -> Column:
    """The array of 44 features over the columns of `elements`."""
    n, t, low = F.col("n"), F.col("t"), F.lower("t")
    classes = F.transform(n["classes"], lambda c: F.lower(c))
    some = lambda array, part: F.exists(array, lambda c: c.contains(part))
    inside = lambda c: F.array_contains("up_classes", c)
    bold = F.lower(F.array_join("bold", " "))
    bold_length = F.aggregate("bold", F.lit(0), lambda a, b: a + F.char_length(b))
    font = F.lit(0.0)
    for tag, size in FONTS.items():
        font = F.when(n["tag"] == tag, size).otherwise(font)
    bits = [
        *(n["tag"] == tag for tag in TAGS),
        *(some(classes, c) for c in "title entry info rating archive".split()),
        F.coalesce(attr(n, "id"), F.lit("")) != "",
    ]
    values = [
        F.least(n["depth"] / 20, F.lit(1.0)), F.least(n["sib_index"] / 20, F.lit(1.0)), F.least(n["sib_count"] / 20, F.lit(1.0)), F.least(n["child_count"] / 50, F.lit(1.0)),
        F.least(F.log1p(F.char_length(t)) / 6, F.lit(1.0)), low.startswith("komik"), F.coalesce(F.col("parent.tag") == "div", F.lit(False)),
        F.coalesce(F.exists("parent.classes", lambda c: F.lower(c).contains("info")), F.lit(False)),
        F.coalesce(attr(n, "itemprop"), F.lit("")) != "", F.coalesce(attr(n, "itemprop") == "ratingValue", F.lit(False)), inside("spe"), inside("infox"), inside("infoanime"),
        F.when(F.char_length(t) > 0, bold_length / F.char_length(t)).otherwise(0.0), F.least(F.col("links") / 10, F.lit(1.0)),
        F.coalesce(F.array_contains(F.split(attr(n, "rel"), " "), "tag"), F.lit(False)), font, bold.contains("status"), bold.contains("pengarang") | bold.contains("author"),
        bold.contains("alternative") | bold.contains("alternatif"), F.exists(classes, lambda c: c.isin("desc", "synopsis", "entry-content")),
        F.coalesce(F.lower(attr(n, "href")).contains("-chapter-"), F.lit(False)),
        F.array_contains("up_ids", "mirip") | inside("mirip") | inside("bxcl") | F.array_contains("up_ids", "chapter_list"), F.exists(classes, lambda c: c.isin("lchx", "series")),
        low.contains("chapter"), t.rlike(r"\b\d\.\d\b"), t.rlike(r"(?i)(chapter|bab)\s*\d+"), t.rlike(r"\b(19|20)\d{2}\b"),
        F.coalesce(F.try_divide(F.col("pos"), F.col("n_candidates") - 1), F.lit(0.0)),
    ]
    return F.array(*(F.coalesce(v.cast("float"), F.lit(0.0).cast("float")) for v in [*bits, *values]))


def features(pages: DataFrame, key: str) -> DataFrame:
    """(key, pre, pos, tag, text, href, features)."""
    return elements(pages, key).select(key, F.col("n.pre").alias("pre"), "pos", F.col("n.tag").alias("tag"), F.col("t").alias("text"), attr(F.col("n"), "href").alias("href"), vector().alias("features"))


def padded(vector_: Column, width: int) -> Column:
    """A vector of an older set of features, filled with zeros to `width`."""
    return F.concat(vector_, F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(width) - F.size(vector_), F.lit(0))))


def truths(pages: DataFrame, key: str, chapter_mark: str = "-chapter-") -> DataFrame:
    """(key, field, pre): the elements that the extraction's selectors hold for each field."""
    d = F.col("dom")
    one = lambda *path: F.filter(F.array(first_of(d, *path)), lambda n: n.isNotNull())
    chain = lambda *paths: F.coalesce(*(let(one(*p), lambda a: F.when(F.size(a) > 0, a)) for p in paths), F.array().cast(f"array<{NODE}>"))

    def labelled(*words: str) -> Column:
        spans = all_of(d, "span", first_of(d, "div.spe"))

        def says(span: Column) -> Column:
            inside = F.slice(d["nodes"], span["pre"] + 2, span["last"] - span["pre"])
            return F.exists(inside, lambda b: (b["tag"] == "b") & F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(F.lower(text(d, b)), w)))

        return F.filter(spans, says)

    found = {
        "title": chain(("h1.titless",), ("h1.entry-title",), ("div.infox", "h1")),
        "synopsis": chain(("div.entry-content.entry-content-single",), ("div.entry-content",)),
        "rating": chain(("div.archiveanime-rating", "i"), ("div.infoanime-rating", "i"), ("div.rating", "i"), ("span.skor",)),
        "genre": all_of(d, "a[rel='tag']"),
        "status": labelled("status"),
        "author": labelled("pengarang", "author"),
        "alt_title": labelled("alternatif", "alternative"),
        "similar": all_of(d, "a.series", first_of(d, "div#mirip")),
        "chapters": all_of(d, f"a[href*='{chapter_mark}']"),
    }
    cells = [F.struct(F.lit(f).alias("field"), F.transform(nodes, lambda n: n["pre"]).alias("pres")) for f, nodes in found.items()]
    return with_dom(pages).select(key, F.inline(F.array(*cells))).select(key, "field", F.explode("pres").alias("pre"))


def labelled_single(pages: DataFrame, key: str, field: str) -> DataFrame:
    """(key, pre, features, labels): as `labelled`, with the one label of `field`; pages without its truth are left out."""
    known = truths(pages, key).filter(F.col("field") == field).select(key, "pre").distinct().withColumn("_y", F.lit(1))
    rows = features(pages, key).join(known.select(key).distinct(), key, "left_semi").join(known, [key, "pre"], "left")
    return rows.select(key, "pre", "features", F.array(F.coalesce("_y", F.lit(0))).alias("labels"))


def labelled(pages: DataFrame, key: str) -> DataFrame:
    """(key, pre, features, labels): labels is an array of 0/1 in the order of FIELDS. Pages without any truth are left out."""
    known = truths(pages, key).groupBy(key, "pre").agg(F.collect_set("field").alias("fields"))
    told = known.select(key).distinct()
    rows = features(pages, key).join(told, key, "left_semi").join(known, [key, "pre"], "left")
    marks = F.array(*(F.coalesce(F.array_contains("fields", f), F.lit(False)).cast("int") for f in FIELDS))
    return rows.select(key, "pre", "features", marks.alias("labels"))
