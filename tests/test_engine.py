"""The engine's own operators: normalisers, merges, feed, pages, store, jobs, streams, detection."""

import json
from datetime import datetime

import numpy as np
import pages as html
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bindery.functions import scalars as S
from bindery.functions.dims import Site, extension_id, status_id, status_name
from bindery.ml import detect, evaluate, export, features, model
from bindery.operators import dom, extract, feed, merge, read
from bindery.plans import pipelines
from bindery.plans.store import Store
from bindery.sources import database, jsonl, pages
from bindery.streaming import feeds


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("column", "value", "want"),
    [
        (S.slug_of, "https://x/komik/a-b/?q", "a-b"), (S.slug_of, "/lain/a", None), (S.absolute, "/a", "https://baca.komikraya.example/a"), (S.absolute, "a", "https://baca.komikraya.example/a"), (S.absolute, "http://q/a", "http://q/a"),
        (S.without_size, "a-30x40.jpg-1x2.png", "a.jpg-1x2.png"), (S.url_base, "https://x/a-chapter-3.5/", "https://x/a"), (S.title, "Komik Kabut", "Kabut"), (S.title, "Komikus", "us"), (S.title, "Kabut", "Kabut"),
        (S.after_label, "Status:  x:y ", "x:y"), (S.number, "9.2f", None), (S.number, "309.", 309.0), (S.number, ".", None), (S.number, "inf", None), (S.age_minutes, "5 menit lalu", 5), (S.age_minutes, "2 JAM", 120),
        (S.age_minutes, "3 hari", 4320), (S.age_minutes, "kemarin", 99999), (S.age_minutes, None, 99999), (S.age_minutes, "99999999999 menit", 0), (S.url_chapter_number, "/a-chapter-307-5/", 307.0), (S.url_chapter_number, "/a-chapter-./", 0.0),
        (S.url_chapter_number, "/a/", None), (S.masked_url, "pg://u:secret@h/d", "pg://u:***@h/d"), (S.comma_list, "a, ,b ,", ["a", "b"]), (lambda c: S.split_name(c)["ext_id"], "a.b/c.JPG", 1), (lambda c: S.split_name(c)["ext_id"], "c", 0),
        (lambda c: S.thumbnail(c)["path"], "https://cdn.komikraya.example/wp-content/uploads/2020/Komik-a-30x40.jpg", "2020/a.jpg"), (lambda c: S.thumbnail(c)["domain_id"], "https://no.example/a.jpg", 0),
        (lambda c: S.chapter_number(c, F.lit("/a-chapter-9/")), "Bab 3", 9.0), (lambda c: S.chapter_number(c, F.lit("/a-chapter-307-5/")), "Chapter 307.5", 307.5),
        (lambda c: extension_id(Site(), c), ".WEBP", 4), (lambda c: status_id(Site(), c), "BERJALAN", 1), (lambda c: status_id(Site(), c), "?", None), (lambda c: status_name(Site(), c), "7", ""),
    ],
)
def test_scalars(spark, column, value, want):
    assert one(spark, column, value) == want


@pytest.mark.parametrize(("n", "want"), [(7.0, "b-chapter-7/"), (7.5, "b-chapter-7-5/"), (0.25, "b-chapter-0-25/")])
def test_chapter_url(spark, n, want):
    assert one(spark, lambda c: S.chapter_url(F.lit("b"), c), n, "double") == want


def test_response_faults(spark):
    rows = [(500, "x" * 200), (200, "Just a moment..."), (200, "error"), (200, "fine"), (200, "x" * 200 + "error"), (200, None)]
    df = spark.createDataFrame(rows, "status int, html string")
    assert [r["fault"] for r in pages.judged(df).collect()] == ["status", "challenge", "short", None, None, None]
    stats = pages.fetch_stats(pages.judged(df).withColumn("attempts", F.lit(2))).first()
    assert (stats["requests"], stats["success"], stats["failed"], stats["retries"]) == (12, 3, 3, 6)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("ab/", max_size=6), min_size=1, max_size=5))
def test_common_prefix_law(spark, paths):
    df = spark.createDataFrame([(min(paths), max(paths))], "a string, b string")
    got = df.select(S.common_prefix(F.col("a"), F.col("b"))).first()[0]
    want = next(min(paths)[:i] for i in range(len(min(paths)), -1, -1) if all(p.startswith(min(paths)[:i]) for p in paths))
    assert got == want


def test_merges(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), (None, 3, "z")], "k string, v int, t string")
    delta = spark.createDataFrame([("a", None, "n"), ("c", 9, "m")], "k string, v int, t string")
    for _ in range(2):
        merged = merge.upsert(base, delta, ["k"])
        assert sorted(map(tuple, merged.collect()), key=str) == sorted([("a", None, "n"), ("c", 9, "m"), ("b", 2, "y"), (None, 3, "z")], key=str)
        base2 = merge.upsert(merged, delta, ["k"])
        assert sorted(base2.collect(), key=str) == sorted(merged.collect(), key=str)  # idempotent
    assert ("a", 1, "n") in set(map(tuple, merge.upsert(base, delta, ["k"], preserve=True).collect()))
    assert tuple(merge.upsert_counts(base, delta, ["k"]).first()) == (1, 1)
    raised = merge.monotone(base, delta.withColumn("v", F.lit(5)), "k", "v")
    assert {r["k"]: r["v"] for r in raised.collect()} == {"a": 5, "b": 2, None: 3}
    rows = spark.createDataFrame([("a", 1, "p"), ("a", 2, "q"), ("a", 2, "r"), ("b", None, "s")], "k string, o int, t string")
    assert {(r["k"], r["t"]) for r in merge.last_wins(rows, ["k"], ["o"]).collect()} == {("a", "r"), ("b", "s")}
    assert {(r["k"], r["t"]) for r in merge.first_wins(rows, ["k"], ["o"]).collect()} == {("a", "p"), ("b", "s")}
    assert merge.last_wins(rows.limit(0), ["k"], ["o"]).count() == 0
    sets = spark.createDataFrame([(1, 1), (1, 2), (2, 5)], "o int, m int")
    new = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "o int, m int")
    owners = spark.createDataFrame([(1,), (2,)], "o int")
    assert sorted(map(tuple, merge.replace_sets(sets, new, "o").collect())) == [(1, 2), (1, 3), (2, 5)]
    assert sorted(map(tuple, merge.replace_sets(sets, new, "o", owners).collect())) == [(1, 2), (1, 3)]
    assert [r[0] for r in merge.changed_sets(sets, new, "o", "m").collect()] == [1]
    ids = merge.with_ids(spark.createDataFrame([(x,) for x in "dcbae"], "k string"), 10, ["k"]).collect()
    assert sorted((r["id"], r["k"]) for r in ids) == [(11, "a"), (12, "b"), (13, "c"), (14, "d"), (15, "e")]


def test_feed(spark):
    items = spark.createDataFrame([(1, 1, 5), (1, 2, 900), (1, 3, 20), (2, 1, 10), (2, 2, 800), (3, 1, 1)], "page int, place int, minutes int")
    assert sorted(map(tuple, feed.until_old(items, 360).collect())) == [(1, 1, 5), (1, 2, 900), (1, 3, 20), (2, 1, 10)]
    assert feed.until_old(items.filter("page <> 2"), 360).count() == 3  # a missing page ends the feed
    assert feed.until_old(items.limit(0), 360).count() == 0
    stored = spark.createDataFrame([("a", 3.0), ("b", None), ("c", 2.0)], "slug string, latest double")
    other = spark.createDataFrame([("b", 1.0), ("d", 1.0)], "slug string, latest double")
    told = feed.classify(spark.createDataFrame([("a", 3.0), ("b", 4.0), ("c", 5.5), ("d", 2.0), ("e", 1.0)], "slug string, number double"), stored, other)
    assert {r["slug"]: (r["action"], r["gap"]) for r in told.collect()} == {"a": ("skipped", None), "b": ("new", None), "c": ("updated", 3), "d": ("updated", 1), "e": ("new", None)}
    listed = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "slug string, place int")
    assert [r["slug"] for r in feed.after(listed, "b", "slug", "place").collect()] == ["c"]
    assert feed.after(listed, "zz", "slug", "place").count() == 3 and feed.limited(listed, 0, "place").count() == 3


def page(spark, text):
    return spark.createDataFrame([(1, text), (2, ""), (3, "<p>nothing<b>here"), (4, None)], "page_id int, html string")


def test_pages(spark):
    assert [r["slug"] for r in extract.list_slugs(page(spark, html.LIST), "page_id").orderBy("pos").collect()] == ["satu", "dua", "tiga"]
    full, empty = extract.details(page(spark, html.DETAIL), "page_id").orderBy("page_id").collect()
    assert (full["judul"], full["tipe"], full["status_id"], full["author"], full["artist"], full["alternative_title"]) == ("Menara & Kabut", "Manhwa", 1, "Sari Dewi", "Budi", "Tower - Mist")
    assert (full["rating"], full["genre_list"], full["thumb_domain_id"], full["thumb_path"], full["sinopsis"]) == (8.5, ["Laga", "Misteri"], 2, "menara.jpg", "Menara itu tinggi sekali")
    assert [c["number"] for c in full["chapters"]] == [10.0, 2.5, 1.0] and full["latest_chapter_number"] == 10.0
    assert [tuple(s) for s in full["similar"]] == [("kabut", "Kabut")]
    assert empty["page_id"] == 3 and empty["judul"] is None and empty["chapters"] == []
    images = extract.chapter_images(page(spark, html.READER), "page_id").orderBy("page_id").first()
    assert (images["cdn_domain_id"], images["cdn_path_prefix"], images["image_filenames"], images["image_ext_ids"]) == (3, "data/menara/10", ["001", "002", "003"], [1, 4, 0])
    home = {r["slug"]: r for r in extract.home_updates(page(spark, html.HOME), "page_id").collect()}
    assert set(home) == {"satu", "dua"} and home["satu"]["latest_chapter_number"] == 7.0 and home["satu"]["tipe"] == "Manga" and home["satu"]["thumbnail"] == "/a.jpg"
    latest = {r["slug"]: r for r in extract.latest_feed(page(spark, html.FEED), "page_id").collect()}
    assert {k: (r["chapter_number"], r["minutes"]) for k, r in latest.items()} == {"satu": (12.0, 5), "dua": (3.5, 120)}  # the first card of "tiga" takes its slug


def test_large_page_and_selectors(spark):
    links = "".join(f'<li><a href="/a-chapter-{i}/">Chapter {i}</a>' for i in range(500))
    big = extract.details(page(spark, f'<div class="bxcl"><ul>{links}</ul></div>'), "page_id").orderBy("page_id").first()
    assert len(big["chapters"]) == 500 and big["latest_chapter_number"] == 499.0
    with pytest.raises(ValueError):
        dom.matches("div p")
    built = dom.build("<ul><li>a<li>b<p>c<div>d</div></ul><br/><!-- x --><script>if (a<b) '</p>'</script>")
    tags = [(n["tag"], n["parent"]) for n in built["nodes"]]
    assert tags[:5] == [("ul", -1), ("li", 0), ("li", 0), ("p", 2), ("div", 2)] and built["text"] == "abcd"


def test_top_children_and_details(spark):
    kids = spark.createDataFrame([(i, i % 2, float(i // 4)) for i in range(20)], "id int, komik_id int, chapter_number double")
    top = read.top_children(kids, "komik_id", "chapter_number", 2)
    assert sorted((r["komik_id"], r["rank"], r["id"]) for r in top.collect()) == [(0, 1, 16), (0, 2, 18), (1, 1, 17), (1, 2, 19)]
    parents = spark.createDataFrame([(0, "a"), (9, "b")], "id int, slug string")
    bridge = spark.createDataFrame([(0, 4), (0, 2), (0, 4)], "komik_id int, genre_id smallint")
    got = {r["id"]: (r["latest"], r["genre_ids"]) for r in read.detail(parents, kids, bridge, 3).collect()}
    assert got == {0: ([4.0, 4.0, 3.0], [2, 4]), 9: ([], [])}


RECORD = {"slug": "a", "judul": None, "chapters": [{"number": 1.0, "url": "u1"}, {"number": 1.0, "url": "u2"}, {"number": 2.0, "url": "u3"}], "genre_ids": [3, 3, 1], "latest_chapter_number": 2.0, "genre_list": []}


def staged(spark, tmp_path, *texts):
    path = tmp_path / "in"
    path.mkdir()
    (path / "full_1.jsonl").write_text("\n".join(t if isinstance(t, str) else json.dumps(t) for t in texts))
    return str(path)


def test_staging_and_load(spark, tmp_path):
    path = staged(spark, tmp_path, RECORD, "", "{broken", {"slug": "x", "_status": "failed", "_error": "e"}, RECORD | {"judul": "Later"}, {"slug": "b"})
    rows = jsonl.read(spark, path)
    assert {(r["slug"], r["reason"]) for r in jsonl.dead_letters(rows).collect()} == {(None, "corrupt"), ("x", "failed")}
    good = jsonl.newest_by_slug(jsonl.valid(rows), ["_file", "_block", "_row"])
    assert {r["slug"]: (r["judul"], r["similar"]) for r in good.collect()} == {"a": ("Later", []), "b": (None, [])}
    assert jsonl.count(spark, path) == 6 and jsonl.last_slug(spark, path) == "b" and jsonl.latest_file(spark, path).endswith("full_1.jsonl")
    store = Store(spark, str(tmp_path / "store"))
    store.setup()
    records = good.drop("_file", "_block", "_row")
    assert pipelines.load(records, store) == pipelines.Counts(2, 2, 0, 0)
    assert pipelines.load(records, store) == pipelines.Counts(2, 0, 2, 0)  # again: nothing new
    series = {r["slug"]: r for r in store.table("series").collect()}
    assert series["a"]["judul"] == "Later" and series["b"]["judul"] == "b" and sorted(r["id"] for r in series.values()) == [1, 2]
    kids = store.table("chapters").collect()
    assert sorted((r["chapter_number"], r["chapter_url"]) for r in kids) == [(1.0, "u1"), (2.0, "u3")]
    assert sorted(r["genre_id"] for r in store.table("series_genres").collect()) == [1, 3]
    items = spark.createDataFrame([(1, 1, "a", 5.0, 3), (1, 2, "n", 1.0, 4), (1, 3, "a", 4.0, 5)], "page int, place int, slug string, number double, minutes int")
    _, dry = pipelines.incremental_update(items, store, dry_run=True)
    assert (dry.new, dry.updated) == (1, 1) and store.table("series").filter("latest_chapter_number = 5").count() == 0
    pipelines.incremental_update(items, store, records.withColumn("slug", F.lit("n")).limit(1))
    after = {r["slug"]: r["latest_chapter_number"] for r in store.table("series").collect()}
    assert after["a"] == 5.0 and "n" in after and store.last_run().first()["operation"] == "smart_update"
    assert store.columns("series").count() == 16
    with pytest.raises(ValueError):
        store.columns("nope")
    store.reset()
    assert store.table("chapters").count() == 0
    store.drop()


def test_streams_equal_batches(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.setup()
    path = staged(spark, tmp_path, RECORD, {"slug": "b"})
    feeds.load_staged(feeds.staged(spark, path), store, str(tmp_path / "c1")).awaitTermination()
    assert store.table("series").count() == 2
    seen = [("a", 7.0, datetime(2025, 1, 1), 5), ("a", 6.0, datetime(2025, 1, 1), 9), ("zz", 1.0, datetime(2025, 1, 1), 3)]
    items = spark.createDataFrame(seen, "slug string, number double, seen_at timestamp, minutes int")
    items.coalesce(1).write.parquet(str(tmp_path / "feed"))
    stream = feeds.parquet(spark, str(tmp_path / "feed"), items.schema)
    told = []
    feeds.into_store(stream, store, str(tmp_path / "c2"), on_batch=lambda df, n: told.extend(map(tuple, df.select("slug", "action").collect()))).awaitTermination()
    assert sorted(told) == [("a", "updated"), ("zz", "new")]
    assert {r["slug"]: r["latest_chapter_number"] for r in store.table("series").collect()}["a"] == 7.0
    single = feeds.deduplicated(feeds.event_time(stream, "seen_at", "minutes"), ["slug"])
    single.writeStream.format("memory").queryName("single").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c3")).start().awaitTermination()
    assert sorted(r["slug"] for r in spark.table("single").collect()) == ["a", "zz"]


def test_full_extract_and_load(spark, tmp_path):
    site_pages = spark.createDataFrame([("menara", html.DETAIL), ("old", html.DETAIL)], "slug string, html string")
    done = spark.createDataFrame([("old",)], "slug string")
    reader = spark.createDataFrame([("https://baca.komikraya.example/menara-chapter-10/", html.READER)], "url string, html string")
    genres = spark.createDataFrame([("Misteri", 7), ("Laga", 3), ("Lain", 9)], "nama string, genre_id smallint")
    found = pipelines.full_extract(site_pages, done, reader)
    rows = found.collect()
    assert [r["slug"] for r in rows] == ["menara"] and [c["total_images"] for c in rows[0]["chapters"]] == [3, None, None]
    for n, images in enumerate((None, reader)):
        store = Store(spark, str(tmp_path / f"store{n}"), parts=4)
        store.setup()
        assert pipelines.load(pipelines.full_extract(site_pages, done, images), store, genres=genres) == pipelines.Counts(1, 1, 0, 0)
        assert sorted(r["genre_id"] for r in store.table("series_genres").collect()) == [3, 7]
        kids = {r["chapter_number"]: (r["image_filenames"], r["total_images"]) for r in store.table("chapters").collect()}
        assert set(kids) == {1.0, 2.5, 10.0} and kids[10.0] == ((["001", "002", "003"], 3) if images is not None else (None, None))
        assert pipelines.load(found, store, genres=genres) == pipelines.Counts(1, 0, 1, 0)


def test_store_survives_a_broken_write(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"), parts=4)
    store.setup()
    series = store.table("series")
    rows = spark.createDataFrame([(i, f"s{i}", float(i)) for i in range(20)], "id long, slug string, latest_chapter_number double")
    store.replace({"series": series.unionByName(rows, allowMissingColumns=True)})
    with monkeypatch.context() as broken:  # tables are written, the pointer is not
        broken.setattr(Store, "_flip", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.replace({"series": series})
    assert Store(spark, store.root, parts=4).table("series").count() == 20
    (tmp_path / "store" / "_pointer-000000000003.json").write_text('{"tables": {"ser')  # a writer broke within the pointer
    assert store.table("series").count() == 20
    with pytest.raises(RuntimeError):  # it may still be at work
        store.replace({"series": series})
    store.lease = 0
    store.setup()
    first = store._pointer()
    pipelines.raise_latest(spark.createDataFrame([("s3", 50.0), ("s4", 1.0)], "slug string, latest_chapter_number double"), store)
    assert {r["slug"]: r["latest_chapter_number"] for r in store.table("series").collect()} == {f"s{i}": 50.0 if i == 3 else float(i) for i in range(20)}
    stamps = store._pointer()[1]["series"]
    assert len(stamps) == 2 and sorted(p for ps in stamps.values() for p in ps) == [0, 1, 2, 3]  # other parts stayed where they are
    with pytest.raises(RuntimeError):  # a writer that read an older pointer loses
        store._flip(*first)
    assert store.vacuum(keep=1) > 0 and store.table("series").count() == 20 and store.table("chapters").count() == 0


def test_dead_letters_of_a_stream(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"), parts=4)
    store.setup()
    path = staged(spark, tmp_path, RECORD, "{broken", {"slug": "x", "_status": "failed", "_error": "e"}, RECORD | {"judul": "Later"})
    feeds.load_staged(feeds.staged(spark, path), store, str(tmp_path / "c"), str(tmp_path / "letters")).awaitTermination()
    assert [r["judul"] for r in store.table("series").collect()] == ["Later"]
    assert {r["reason"] for r in spark.read.json(str(tmp_path / "letters")).collect()} == {"corrupt", "failed"}


def test_page_folders_and_database(spark, tmp_path):
    folder = tmp_path / "pages"
    folder.mkdir()
    (folder / "a.html").write_text(html.DETAIL)
    (folder / "b.html").write_text("<p>Just a moment...")
    (folder / "c.txt").write_text("no page")
    read_pages = pages.files(spark, str(folder))
    assert [r["judul"] for r in extract.details(read_pages, "page_id").collect()] == ["Menara & Kabut"]
    asked = pages.wanted(spark.createDataFrame([("u", "<p>x")], "url string, html string"), spark.createDataFrame([("u",), ("u",), ("v",)], "url string"))
    assert sorted(tuple(r) for r in asked.collect()) == [("u", "<p>x"), ("v", None)]
    options = {"url": f"jdbc:derby:{tmp_path}/db;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, slug string")
    try:
        database.write(rows, "series", mode="overwrite", **options)
    except Exception as e:
        pytest.skip(f"no embedded database: {e!r:.80}")
    assert sorted(tuple(r) for r in database.read(spark, "series", **options).collect()) == [(1, "a"), (2, "b")]
    assert database.pooled("h:6543/db") == "h:5432/db"


def test_addresses_and_names(spark):
    row = spark.range(1).select(
        S.dotted_chapter_url(F.lit("a"), F.lit(307.5)).alias("a"), S.dotted_chapter_url(F.lit("a"), F.lit(3.0)).alias("b"), S.series_url(F.lit("a")).alias("c"),
        S.timestamped("full", F.lit(datetime(2025, 1, 2, 3, 4, 5))).alias("d"), *(S.masked_url(F.lit(u)).alias(f"m{i}") for i, u in enumerate(("", "file:" + "x" * 40, "postgresql://u:p@h:5432/d"))),
    ).first()
    base = "https://baca.komikraya.example"
    assert tuple(row)[:4] == (f"{base}/a-chapter-307.5/", f"{base}/a-chapter-3/", f"{base}/komik/a/", "full_20250102_030405.jsonl")
    assert tuple(row)[4:] == ("(not set)", "file:" + "x" * 25 + "... (SQLite)", "postgresql://u:***@h:5432/d")


def test_matrices_metadata_and_exchange(spark, tmp_path):
    rows = spark.createDataFrame([([1.0, 2.0], [1]), ([3.0, 4.0], [0])], "features array<float>, labels array<int>")
    export.write_matrix(rows, str(tmp_path / "m"))
    assert sorted((r["features"], r["labels"]) for r in export.read_matrix(spark, str(tmp_path / "m"), 3, 2).collect()) == [([1.0, 2.0, 0.0], [1, 0]), ([3.0, 4.0, 0.0], [0, 0])]
    rng = np.random.default_rng(1)
    net = model.Network([0.5] * 44, [2.0] * 44, [rng.normal(size=(44, 16)).tolist(), rng.normal(size=(16, 9)).tolist()], [rng.normal(size=16).tolist(), rng.normal(size=9).tolist()], list(features.FIELDS), [0.1] * 9)
    told = export.metadata(net, features.NAMES)
    assert export.thresholds_of(told, list(features.FIELDS)) == [0.1] * 9
    assert export.thresholds_of('{"field_thresholds": {"title": 0.2, "rating": "x"}}', ["title", "rating", "genre"]) == [0.2, 0.5, 0.5]
    assert export.thresholds_of(None, ["a"]) == export.thresholds_of("{", ["a"]) == export.thresholds_of("[]", ["a"]) == [0.5]
    pytest.importorskip("onnxruntime")
    assert export.largest_difference(net, export.to_onnx(net), rng.normal(size=(50, 44))) < 1e-4


def test_splits_and_single_fields(spark):
    data = spark.createDataFrame([(i, [float(i % 7), float(i % 3)], [int(i % 7 > 3), int(i % 50 == 0)]) for i in range(501)], "id int, features array<double>, labels array<int>")
    assert {r["field"]: (r["n_positive"], r["n_rows"]) for r in model.positives(data, ["x", "y"]).collect()} == {"x": (213, 501), "y": (11, 501)}
    for column, sizes in (("labels[1]", {0: 490, 1: 11}), ("1", {1: 501})):
        parts = model.exact_split(data, ["id"], F.expr(column)).groupBy(F.expr(column).alias("s"), "is_train").count().collect()
        assert {r["s"]: r["count"] for r in parts if r["is_train"]} == {s: -(-n * 4 // 5) for s, n in sizes.items()} and sum(r["count"] for r in parts) == 501
    assert model.exact_split(data.limit(0), ["id"], F.lit(1)).count() == 0
    net = model.train_single(data, "x", ["x", "y"], 2, hidden=(8,), epochs=40, rate=1e-2)
    probs = {r["id"]: r["probs"][0] for r in model.scores(data, net).collect()}
    assert net.fields == ["x"] and all((probs[i] > 0.5) == (i % 7 > 3) for i in range(501))
    own = features.labelled_single(page(spark, html.DETAIL), "page_id", "genre")
    assert own.filter("labels[0] = 1").count() == 2 and {r["page_id"] for r in own.collect()} == {1}


def test_model_thumbnail(spark):
    known, other = "https://cdn.komikraya.example/data/wp-content/uploads/Komik-a-300x400.jpg", "https://else.example/b.jpg"
    texts = [f'<div class="imgdesc"><img src="{known}"></div>', f'<div class="thumb"><img src="{other}"></div><img class="wp-post-image" src="{known}">', f'<div class="thumb"><img src="{other}"></div>']
    found = dom.with_dom(spark.createDataFrame(list(enumerate(texts)), "i int, html string")).select("i", extract.model_thumbnail().alias("t")).orderBy("i").collect()
    assert [r["t"] and tuple(r["t"]) for r in found] == [(2, "a.jpg"), (2, "a.jpg"), None]


def test_sets_that_become_empty_have_changed(spark):
    base = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "o int, m int")
    delta = spark.createDataFrame([(2, 6), (2, 6), (4, 1)], "o int, m int")
    owners = spark.createDataFrame([(1,), (2,), (4,), (5,)], "o int")
    assert sorted(r["o"] for r in merge.changed_sets(base, delta, "o", "m", owners).collect()) == [1, 4]
    assert sorted(r["o"] for r in merge.changed_sets(base, delta, "o", "m").collect()) == [4]


def test_exact_match(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (1, 1)], "a int, b int")
    assert evaluate.exact_match(df, "a", "b").first()[0] == 0.75


def test_detection(spark):
    rows = features.labelled(page(spark, html.DETAIL), "page_id").collect()
    assert len(features.NAMES) == 44 and all(len(r["features"]) == 44 for r in rows)
    by = {f: sum(r["labels"][i] for r in rows) for i, f in enumerate(features.FIELDS)}
    assert by == {"title": 1, "rating": 1, "genre": 2, "synopsis": 1, "alt_title": 1, "author": 1, "status": 1, "similar": 3, "chapters": 4}
    data = spark.createDataFrame([([float(i % 7), float(i % 3), i % 2 * 1.0], [int(i % 7 > 3), int(i % 50 == 0)], i) for i in range(600)], "features array<double>, labels array<int>, id int")
    mean, scale = model.scaler(data, 3)
    assert abs(mean[1] - 1.0) < 0.01 and scale[0] > 1
    over = model.oversampling(data, 2)
    assert over.count() > data.count() and over.filter("labels[1] = 1").count() / over.count() > 0.035
    parts = {r["is_train"]: r["count"] for r in model.split(data, ["id"], F.col("labels")[0]).groupBy("is_train").count().collect()}
    assert 0.7 < parts[True] / 600 < 0.9
    net = model.train(data, ["x", "y"], mean, scale, hidden=(8,), epochs=60, rate=1e-2)
    scored = model.scores(data, model.Network.from_json(net.to_json()))
    both = scored.withColumn("same", model.forward_columns(F.col("features"), net)).select("probs", "same").collect()
    assert max(np.abs(np.array(r["probs"]) - np.array(r["same"])).max() for r in both) < 1e-9
    flat = scored.select(F.lit("x").alias("field"), F.col("probs")[0].alias("score"), F.col("labels")[0].alias("label"))
    best = evaluate.best_thresholds(flat).first()
    assert best["f1"] > 0.95 and 0.1 <= best["threshold"] <= 0.95
    figures = evaluate.confusion(flat, F.col("score") >= best["threshold"], F.col("label") == 1, "field").first()
    assert figures["f1"] > 0.95
    assert evaluate.best_thresholds(flat.withColumn("label", F.lit(0))).first()["threshold"] == 0.5
    assert len(model.feature_weights(net, ["a", "b", "c"])) == 3


def test_detected_fields_and_agreement(spark):
    data = features.labelled(page(spark, html.DETAIL), "page_id")
    mean, scale = model.scaler(data, 44)
    many = data.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(12)))).drop("copy")
    net = model.train(many, list(features.FIELDS), mean, scale, hidden=(32,), epochs=150, batch=64, rate=1e-2, patience=150)
    found = {r["page_id"]: r for r in detect.details_with_model(page(spark, html.DETAIL), "page_id", net).collect()}
    assert (found[1]["judul"], found[1]["author"], found[1]["rating"], found[1]["artist"]) == ("Menara & Kabut", "Sari Dewi", 8.5, "Budi")
    assert found[3]["judul"] is None and len(found[1]["chapters"]) == 3
    tally = {r["field"]: r for r in detect.agreement(page(spark, html.DETAIL), "page_id", net).collect()}
    assert tally["title"]["n_match"] == 1 and tally["author"]["n_match"] == 1 and tally["chapters"]["n_match"] == 1
    best = detect.detect_all(page(spark, html.DETAIL), "page_id", net, "genre").orderBy("rank").collect()
    assert [r["rank"] for r in best] == [1, 2] and {r["text"] for r in best} == {"Laga", "Misteri"}


def test_page_records_keep_pages_without_chapters(spark, tmp_path):
    """Every field of a record goes through its page, with and without chapters."""
    from bindery.plans import catalogue

    full = {"slug": "a", "judul": "Menara <b>", "tipe": "Manga", "thumb_domain_id": 2, "thumb_path": "a-300x400.jpg", "status_id": 2, "author": "Sari", "artist": "Budi", "alternative_title": "Tower; Mist", "sinopsis": "Kisah & laut.", "rating": 8.5, "genre_list": ["Laga", "Misteri"]}
    chapters = [{"number": 1, "url": "/a-chapter-1/"}, {"number": 2, "url": "https://x/a-chapter-2/"}]
    rows = [(1, json.dumps(full | {"chapters": chapters})), (2, json.dumps(full | {"thumb_domain_id": 9})), (3, json.dumps({"slug": "b"}))]
    spark.createDataFrame([(i, datetime(2025, 1, 1), "f", i, t) for i, t in rows], "line_id long, fetched_at timestamp_ntz, file_name string, line_no int, line string").write.parquet(str(tmp_path / "detail_lines.parquet"))
    got = {r["line_id"]: r.asDict() for r in catalogue.QUERIES["page_records"](spark, str(tmp_path)).collect()}
    same = {"judul": "Menara <b>", "tipe": "Manga", "status_id": 2, "author": "Sari", "artist": "Budi", "alternative_title": "Tower; Mist", "sinopsis": "Kisah & laut.", "rating": 8.5, "genres": "Laga|Misteri"}
    assert got[1] == same | {"line_id": 1, "thumb_domain_id": 2, "thumb_path": "a.jpg", "n_chapters": 2, "latest": 2.0}
    assert got[2] == same | {"line_id": 2, "thumb_domain_id": 0, "thumb_path": "https://else.example/data/wp-content/uploads/Komik-a-300x400.jpg", "n_chapters": 0, "latest": None}
    assert got[3] == dict.fromkeys(got[3]) | {"line_id": 3, "judul": "", "genres": "", "n_chapters": 0}


def test_ids_and_scaler_of_whole_tables(spark, tmp_path):
    from bindery.plans import catalogue

    rows = [(i, json.dumps({"slug": f"s{i % 40:02}", "judul": f"T{i}", "author": "Sari" if i % 3 else None})) for i in range(60)]
    spark.createDataFrame([(i, datetime(2025, 1, 1), "f", i, t) for i, t in rows], "line_id long, fetched_at timestamp_ntz, file_name string, line_no int, line string").write.parquet(str(tmp_path / "detail_lines.parquet"))
    spark.createDataFrame([(7, "s00"), (9, "s01")], "id long, slug string").write.parquet(str(tmp_path / "komik.parquet"))
    chapters = [(k, n / 2) for k in (3, 1, 2) for n in range(50)]
    spark.createDataFrame(chapters + chapters + [(None, 1.0)], "komik_id long, chapter_number double").write.parquet(str(tmp_path / "chapters.parquet"))
    run = lambda name: catalogue.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in run("surrogate_keys_series")) == [(10 + i, f"s{i:02}") for i in range(40)]
    assert sorted(tuple(r) for r in run("surrogate_keys_chapters")) == [(1001 + i, *k) for i, k in enumerate(sorted(chapters))]
    values = np.array([r["features"] for r in features.features(catalogue.pages(spark, str(tmp_path)), "line_id").collect()], dtype="float64")
    got = run("scaler_features")
    assert [r["feature"] for r in got] == list(features.NAMES)
    assert np.allclose([r["mean"] for r in got], values.mean(0), atol=1e-6)
    assert np.allclose([r["scale"] for r in got], np.where(values.std(0) == 0, 1, values.std(0)), atol=1e-6)
