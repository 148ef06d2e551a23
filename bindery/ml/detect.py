"""Fields of pages by the detector, with the selectors as fallback, and how far both agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions import scalars as S
from bindery.functions.dims import Site, status_id, status_name
from bindery.ml import evaluate
from bindery.ml.features import CANDIDATES, FIELDS, features
from bindery.ml.model import Network, scores
from bindery.operators import extract
from bindery.operators.dom import with_dom

SINGLE = ("title", "rating", "synopsis", "alt_title", "author", "status")
MULTI = ("genre", "similar", "chapters")


def detections(pages: DataFrame, key: str, network: Network, strict: bool = True) -> DataFrame:
    """(key, field, pos, score, text, tag, href): every element of a candidate tag with text that is above its field's threshold (strictly, if `strict`)."""
    listed = features(pages, key).filter(F.col("tag").isin(*CANDIDATES) & (F.col("text") != ""))
    scored = scores(listed, network)
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col("probs")[i].alias("score"), F.lit(network.thresholds[i]).alias("least")) for i, f in enumerate(network.fields)))
    rows = scored.select(key, "pos", "text", "tag", "href", F.inline(cells))
    return rows.filter(F.col("score") > F.col("least") if strict else F.col("score") >= F.col("least")).drop("least")


def detect_all(pages: DataFrame, key: str, network: Network, field: str, least: float = 0.0) -> DataFrame:
    """(key, rank, score, text, tag, href): what is detected for one field with a score of at least `least`, best first; the best alone is rank 1."""
    found = detections(pages, key, network).filter((F.col("field") == field) & (F.col("score") >= least))
    item = F.struct((-F.col("score")).alias("s"), "pos", F.struct("score", "text", "tag", "href").alias("d"))
    lists = found.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("found"))
    return lists.select(key, F.posexplode("found").alias("rank", "x")).select(key, (F.col("rank") + 1).alias("rank"), "x.d.*")


def detect(pages: DataFrame, key: str, network: Network, site: Site = Site()) -> DataFrame:
    """One row per page with any detection: single fields as the best element's cleaned text, the others as arrays, best first."""
    found = detections(pages, key, network)
    item = F.struct((-F.col("score")).alias("s"), F.col("pos").alias("pos"), F.struct("text", "score", "tag", "href").alias("d"))
    lists = found.groupBy(key).agg(*(F.sort_array(F.collect_list(F.when(F.col("field") == f, item))).alias(f"_{f}") for f in FIELDS))
    top = lambda f: F.get(f"_{f}", F.lit(0))["d"]["text"]
    cleaned = {"title": S.title(top("title"), site), "rating": S.strip(top("rating")), "synopsis": S.strip(top("synopsis"))} | {f: S.after_label(top(f)) for f in ("alt_title", "author", "status")}
    return lists.select(key, *(c.alias(f) for f, c in cleaned.items()), *(F.transform(f"_{f}", lambda x: x["d"]).alias(f) for f in MULTI))


def details_with_model(pages: DataFrame, key: str, network: Network, site: Site = Site()) -> DataFrame:
    """As extract.details: for each field what the detector says, else what the selectors find.

    Of detected genres the texts count, of similar series and chapters the links; a
    link that names no series or chapter is none. The thumbnail has a chain of its own.
    """
    own = extract.details(pages, key, site)
    images = with_dom(pages).select(key, extract.model_thumbnail(site).alias("_thumb"))
    told = detect(pages, key, network, site).join(images, key, "right").select(key, "_thumb", *(F.col(f).alias(f"_{f}") for f in (*SINGLE, *MULTI)))
    joined = own.join(told, key, "left")
    by = {"judul": S.or_null(F.col("_title")), "sinopsis": S.or_null(S.synopsis(F.col("_synopsis"), site)), "rating": S.number(F.col("_rating")), "alternative_title": S.or_null(F.col("_alt_title")), "author": S.or_null(F.col("_author")), "status_id": status_id(site, F.col("_status"))}
    some = lambda a: F.when(F.size(a) > 0, a)
    by["genre_list"] = some(F.filter(F.transform("_genre", lambda x: S.strip(x["text"])), lambda t: t != ""))
    by["similar"] = some(extract.first_distinct(F.transform("_similar", lambda x: F.struct(S.slug_of(x["href"], site).alias("slug"), S.or_null(S.strip(x["text"])).alias("judul"))), "slug"))
    by["chapters"] = some(extract.numbered(F.transform("_chapters", lambda x: F.struct(S.rooted(F.nullif(x["href"], F.lit("")), site).alias("url"), x["text"].alias("t")))))
    by |= {f"thumb_{n}": F.coalesce(F.col(f"_thumb.{n}"), F.col(f"thumb_{n}")) for n in ("domain_id", "path")}
    found = joined.select(*(F.coalesce(by[c], F.col(c)).alias(c) if c in by else F.col(c) for c in own.columns))
    return found.withColumn("latest_chapter_number", F.get("chapters", F.lit(0))["number"])


def _verdicts(site: Site) -> dict[str, Column]:
    """By field: 'ok', 'partial', 'mismatch', 'miss', or null where both sides have nothing."""
    text = lambda c: S.strip(F.lower(c))

    def told(lm: Column, own: Column, same: Column) -> Column:
        nothing = F.coalesce(own.cast("string"), F.lit("")) == ""
        return F.when(lm.isNull() & nothing, None).when(lm.isNull(), "miss").when(F.coalesce(same, F.lit(False)), "ok").otherwise("mismatch")

    c = F.col
    rating = S.number(c("rating"))
    core = lambda x: S.strip(F.regexp_replace(F.regexp_replace(text(x), r"\s+", " "), "^(sinopsis)+", ""))
    head = lambda x: F.substring(core(x), 1, 50)
    state = status_name(site, c("own_status_id"))
    counted = lambda lm, own: F.when((F.size(lm) == 0) & (F.size(own) == 0), None).when(F.size(lm) == 0, "miss")
    return {
        "title": told(c("title"), c("own_judul"), text(c("title")) == text(c("own_judul"))),
        "rating": told(rating, c("own_rating"), F.abs(rating - c("own_rating")) < 0.01),
        "synopsis": told(c("synopsis"), c("own_sinopsis"), F.contains(core(c("synopsis")), head(c("own_sinopsis"))) | F.contains(core(c("own_sinopsis")), head(c("synopsis")))),
        "alt_title": told(c("alt_title"), c("own_alternative_title"), F.contains(text(c("alt_title")), text(c("own_alternative_title"))) | F.contains(text(c("own_alternative_title")), text(c("alt_title")))),
        "author": told(c("author"), c("own_author"), text(c("author")) == text(c("own_author"))),
        "status": told(c("status"), state, text(c("status")) == text(state)),
        "genre": counted(c("genre"), c("own_genre_list")).when(F.size("genre") >= 0, S.set_match(F.transform("genre", lambda x: x["text"]), c("own_genre_list"))),
        "similar": counted(c("similar"), c("own_similar")).otherwise("ok"),
        "chapters": counted(c("chapters"), c("own_chapters")).when(F.size("chapters") >= F.size("own_chapters"), "ok").otherwise("partial"),
    }


def agreement(pages: DataFrame, key: str, network: Network, site: Site = Site()) -> DataFrame:
    """(field, n_match, n_mismatch, n_miss, percent) of the detector against the selectors."""
    own = extract.details(pages, key, site)
    renamed = own.select(key, *(F.col(c).alias(f"own_{c}") for c in own.columns if c != key))
    joined = renamed.join(detect(pages, key, network, site), key, "left")
    joined = joined.withColumns({f: F.coalesce(F.col(f), F.array().cast(joined.schema[f].dataType)) for f in MULTI})
    cells = F.array(*(F.struct(F.lit(f).alias("field"), v.alias("verdict")) for f, v in _verdicts(site).items()))
    return evaluate.tally(joined.select(F.inline(cells)).filter("verdict is not null"), "field", F.col("verdict"))
