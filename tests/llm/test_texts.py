"""The text operators on small inputs: usual cases, nulls, empties, ties, repeats, clashing columns, brute force."""

import itertools
import json
import random
import re
import unicodedata
from datetime import datetime

import pytest
from pyspark.sql import functions as F

pytest.importorskip("bindery.llm")

from bindery.llm import encoding, leakage, lookalike, names, repetition, residue  # noqa: E402
from bindery.llm.words import words  # noqa: E402

WORD = re.compile(r"[^\W_]+")


def spell(text):
    return WORD.findall((text or "").lower())


# --- look-alikes ---------------------------------------------------------------


def looks(spark, *texts):
    df = spark.createDataFrame([(i, t, None, "x", "y") for i, t in enumerate(texts)], "id long, judul string, alternative_title string, look string, fld string")
    return sorted((r["id_a"], r["id_b"]) for r in lookalike.pairs(df).collect())


@pytest.mark.parametrize(
    "other",
    ["Café  Lumi", " Café Lumi　", "Café Lumi", "Café Lumi", "Cаfé Lumi", "Cafе́ Lumi", "Ｃafé Lumi", "Ca​fé Lu­mi", "Cafe​́ Lumi", "﻿Café Lu͏mi", "Сafé Lumі"],
)
def test_same_look(spark, other):
    assert looks(spark, "Café Lumi", other, "Cafe Lumi", "café Lumi", "Café Lumi!", "Café Lumi2", "CaféLumi") == [(0, 1)]


def test_looks_of_scripts_marks_and_widths(spark):
    assert looks(spark, "ガラ", "ｶﾞﾗ", "ガラ", "カラ") == [(0, 1), (0, 2), (1, 2)]
    assert looks(spark, unicodedata.normalize("NFD", "한글"), "한글", "한굴") == [(0, 1)]
    assert looks(spark, "x²", "x2", "I", "l", "™", "TM") == []
    assert looks(spark, "a", "a", "а", None, "", " ", "​") == [(0, 2), (1, 2)]
    assert looks(spark) == []
    assert looks(spark, "հotel", "hotel", "γou υnit", "you unit", "ցhost", "ghost", "ᎪᏴᏟ", "ꓮꓐꓚ", "ⲀⲂⲤ", "ABC", "Abc") == [(0, 1), (2, 3), (4, 5)] + [(i, j) for i in range(6, 10) for j in range(i + 1, 10)]
    long = "ab " * 40_000
    assert looks(spark, long, long.replace("a", "а")) == [(0, 1)]


def test_members_of_classes(spark):
    df = spark.createDataFrame([(i, t, None, "x", "y") for i, t in enumerate(["a", "a", "а", "b", None])], "id long, judul string, alternative_title string, look string, fld string")
    assert sorted((r["id"], r["fld"]) for r in lookalike.members(df).collect()) == [(0, "judul"), (1, "judul"), (2, "judul")]


def test_representatives_follow_frequency():
    table = lookalike.rewriting({"о": 9, "o": 2, "a": 5, "а": 1, " ": 1})
    assert table["o"] == "о" and table["а"] == "a" and "a" not in table
    assert lookalike.rewriting({}).get("А") == "A"


# --- names -----------------------------------------------------------------------


def groups(spark, *spelled, nicks=(("Bertrand", "Bibi"), ("Bernard", "Bibi"))):
    df = spark.createDataFrame([(s, None, "z") for s in spelled], "author string, artist string, name string")
    table = spark.createDataFrame(list(nicks), "given_form string, short_form string")
    return sorted(map(tuple, names.pairs(names.variants(df, table)).collect()))


def all_pairs(*group):
    ordered = sorted(group)
    return sorted((a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :])


def test_names_of_one_person(spark):
    one = ["Judenko Kusoyewa", "KUSOYEWA, JUDENKO", "Judenko_Kusoyewa", "JudenkoKusoyewa", "J. Kusoyewa", "Jud. Kusoyewa", "Kusoyewa J.", "Judenko Kusōyewa", "Judenko Kusoyewa-sensei", "by Judenko Kusoyewa", "Judenko \"Jobby\" Kusoyewa", "Judenko Kusoyewa (Art)", "Juednko Kusoyewa", "Judenko Kusoywea", "Judenko  Kusoyewa ", "Judenko Kusoyewwa", "Judenko Kusyewa"]
    circle = ["Studio Bamumeya", "STUDIO BAMUMEYA", "St. Bamumeya", "Std. Bamumeya", "studiobamumeya", "Bamumeya Studios", "Studio Bamumeya Co., Ltd."]
    others = ["Tewesin Kusoyewa", "Studio Kusoyewa", "Judenko Pedirede", "?", "-", "", "N/A", "n/a", "Unknown", "unknown", "Tidak diketahui", None]
    assert groups(spark, *one, *circle, *others) == sorted(all_pairs(*one) + all_pairs(*circle))


def test_names_nicknames_and_ambiguity(spark):
    assert groups(spark, "Bibi Momosa", "Bertrand Momosa") == [("Bertrand Momosa", "Bibi Momosa")]
    assert groups(spark, "Tina Momosa", "Tomo Momosa", "T. Momosa") == []  # fits two
    assert groups(spark, "T. Momosa", "Momosa, T.") == [("Momosa, T.", "T. Momosa")]
    assert groups(spark, "Kelano Momosa", "KELANO MOMOSA", "Kelano Rirusa") == [("KELANO MOMOSA", "Kelano Momosa")]
    assert groups(spark) == [] and groups(spark, "Satu", "SATU", "Satu") == [("SATU", "Satu")]


def test_names_with_short_tokens(spark):
    same = [("Oda", "ODA"), ("Yi Kim", "YI KIM"), ("Kim Min Soo", "Kim, Min Soo"), ("Van der Berg", "VAN DER BERG"), ("Lee Junho", "Lee Junhoo"), ("RINA A PUTRI", "Rina A. Putri", "Rina Putri"), ("D. Lee", "Dewanto Lee")]
    assert groups(spark, *(n for g in same for n in g)) == sorted(p for g in same for p in all_pairs(*g))
    assert groups(spark, "R. Ayu Putri", "Rina Ayu Putri", "R. A. Putri", "Rina A. Putri") == all_pairs("R. Ayu Putri", "Rina Ayu Putri", "R. A. Putri", "Rina A. Putri")
    assert groups(spark, "R. Ayu Putri", "Rina Ayu Putri", "Rosa Ayu Putri") == []  # fits two
    assert groups(spark, "R. Kim Putri", "Rina Kim Putri", "R. Tan Putri") == [("R. Kim Putri", "Rina Kim Putri")]
    assert groups(spark, "la " * 12, "LA " * 12) == [("LA " * 12, "la " * 12)]
    assert groups(spark, "A. B. C. D. Momosa", "Amin Budi Citra Dewi Momosa", "J. K.", "Joko Kusuma") == [("A. B. C. D. Momosa", "Amin Budi Citra Dewi Momosa")]


def test_names_of_beginnings_that_fit_nobody(spark):
    assert groups(spark, "Jud. Kusoyewa", "KUSOYEWA, JUD.", "Jan. Kusoyewa", "J. Kusoyewa", "Ju. Kusoyewa") == all_pairs("Jud. Kusoyewa", "KUSOYEWA, JUD.", "Ju. Kusoyewa")
    assert groups(spark, "Studio Abe", "STUDIO ABE", "Studio Ako") == [("STUDIO ABE", "Studio Abe")]


def test_rarity_decides():
    similar = lambda a, b, df, total=30_000: names._similar(a.split(), b.split(), df, total)
    df = {"judenko": 400, "judanko": 1, "kusoyewa": 4, "momosa": 2, "a": 900, "studio": 5000, "xa": 1}
    assert similar("judenko kusoyewa", "judanko kusoyewa", df) >= names.LEAST  # written once: an error
    assert similar("judenko kusoyewa", "judanko kusoyewa", df | {"judanko": 300}) < names.LEAST  # a name of its own
    assert similar("judenko kusoyewa", "judenko momosa", df) < 0.5 < similar("studio kusoyewa", "kusoyewa", df)
    assert similar("judenko kusoyewa a", "judenko kusoyewa", df) > similar("judenko kusoyewa xa", "judenko kusoyewa", df)
    assert similar("a b", "b a", {"a": 1, "b": 1}) == 1 and similar("", "", {}) == 0
    many = " ".join(f"w{i:03d}x" for i in range(60))
    assert similar(many, many.replace("w007x", "w070x"), {w: 1 for i in range(60) for w in (f"w{i:03d}x",)} | {"w070x": 1}) > 0.95


def test_assignment_against_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randrange(1, 5)
        gain = [[rng.choice([0, 0, 0.5, rng.random()]) for _ in range(rng.randrange(n, 6))] for _ in range(1)]
        m = len(gain[0])
        gain = [[rng.choice([0, 0, 0.5, rng.random()]) for _ in range(m)] for _ in range(n)]
        best = max(sum(gain[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(m), n))
        got = names._assigned(gain)
        assert len(set(got)) == n and abs(sum(gain[i][j] for i, j in enumerate(got)) - best) < 1e-9


def test_frequent_tokens_are_names_of_their_own(spark):
    crowd = [f"{given} Sur{'abcdefghij'[i]}one{'klmnopqrst'[i]}{end}" for given, end in (("Kelano", "u"), ("Kelana", "o")) for i in range(10)]
    assert groups(spark, "Kelano Momosa", "Kelana Momosa", *crowd) == []
    assert groups(spark, "Kelano Momosa", "Kelana Momosa", *crowd[:10]) == [("Kelana Momosa", "Kelano Momosa")]


def test_near_tokens_against_brute_force(spark):
    rng = random.Random(2)
    pool = {"".join(rng.choice("abk") for _ in range(rng.randrange(4, 8))) for _ in range(250)}

    def one_error(a, b):
        swaps = {a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1)}
        drops = lambda x: {x[:i] + x[i + 1 :] for i in range(len(x))}
        changed = len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1
        return a != b and (b in swaps or changed or b in drops(a) or a in drops(b))

    got = {tuple(r) for r in names.near_tokens(spark.createDataFrame([(t,) for t in pool], "token string")).collect()}
    assert got == {(a, b) for a in pool for b in pool if one_error(a, b)}
    assert all(names._one_error(a, b) == one_error(a, b) for a in list(pool)[:60] for b in pool if a != b)


# --- residue ---------------------------------------------------------------------

RESIDUE = [
    "{{ title }}", "{{title", "{{ a.b | safe }}", "${x_1}", "#{x}", "<%= x %>", "<%- x -%>", "<?= $x ?>", "{% block x %}", "%(x)s", "[[x]]", "@@x@@", "__X__", "%X%", "{x}", "<x>", "&lt;x.y&gt;", "[x here]", "%s",
    "undefined", "null null", "NaN", "[object Object]", "Lorem ipsum dolor sit amet", "test test", "asdf asdf", "xxxxx xxxxx", "Your title here", "Coming soon...", "TBA", "Untitled Document", "No description has been added yet.",
    "404 Not Found", "Error 503", "[502] Not available", "Bad Gateway", "Sorry. The page you requested could not be loaded, try again later.", "Maaf, Halaman ini tidak ditemukan (kode 404).", "Please enable JavaScript and cookies to continue.",
    "Aktifkan JavaScript di peramban Anda, lalu muat ulang.", "noscript: JS required", "Checking your browser before you proceed... 9fb91", "The hero walks {{ year }} miles to the sea and back.",
]
CONTENT = [
    None, "", "  ", "The Undefined Girl", "Null Knight of Radoolda", "Page Not Found: A Mystery", "Room 404 of Umaxis", "Error 404: Love Found in Umagora", "Lorem, Penyihir Vadoello", "50% Peshiira", "Test of Courage",
    "Kode pintunya himpunan {3, 7, 65}, kata Tedenko.", "Harganya naik 50% dan Jeria membayar $7 (tujuh).", "Di layar tua hanya tertulis '404 not found', dan Puwesin tertawa.", "Tomoko adalah pemrogram yang menulis JavaScript untuk robot.",
    "In this tutorial the template shows `{{ title }}` where a title goes.", "She taught the syntax \"{{ name }}\" to the robots, a placeholder of hope.", "word " * 20_000,
]


def test_residue(spark):
    df = spark.createDataFrame([(t,) for t in RESIDUE + CONTENT], "t string")
    got = [r["r"] for r in df.select("t", residue.residue(F.col("t")).alias("r")).collect()]
    assert [t for t, r in zip(RESIDUE, got) if not r] == [] and [t for t, r in zip(CONTENT, got[len(RESIDUE) :]) if r] == []


def judged(spark, *texts):
    """The texts that are residue."""
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").filter(residue.residue(F.col("t"))).collect()
    return [texts[i] for i in sorted(r["i"] for r in rows)]


def test_residue_of_any_number_of_sentences(spark):
    kinds = ["Error 503.", "Bad Gateway!", "Coming soon...", "Page not found.", "Please enable JavaScript.", "Access denied. Your IP was blocked.", "TBA.", "Maaf, halaman ini tidak ditemukan.", "Loading..."]
    whole = ["Coming soon. " * n for n in (1, 6, 7, 20, 38, 40, 5000)] + [" ".join(kinds), *(f"{s} ".join(["Error 503"] * n) for s in ";,:" for n in (7, 100, 3000))]
    assert judged(spark, *whole) == whole
    assert judged(spark, *(f"{t} Lalu Tomoko pergi ke laut." for t in whole), "Coming soon. Todo list of a hero", "!!!") == []


def test_residue_messages_of_any_length(spark):
    frames = " ".join(f"#{i} /var/www/html/includes/db.php({i}): PDO->__construct('mysql:host=localhost')" for i in range(400))
    whole = [
        "Fatal error: Uncaught PDOException: SQLSTATE[HY000] [2002] Connection refused in /var/www/html/includes/db.php:14 Stack trace: #0 /var/www/html/index.php(3): connect() #1 {main} thrown in /var/www/html/includes/db.php on line 14",
        f"Fatal error: Uncaught PDOException: no driver. Stack trace: {frames}", "Parse error: syntax error, unexpected end of file, expecting variable or dollar-open-curly or quoted string and whitespace in the view of the series page",
        "SQLSTATE[42S02]: Base table or view not found: 1146 Table 'komik.chapters' doesn't exist (SQL: select * from chapters where komik_id = 17 and deleted_at is null order by chapter_number desc limit 50)",
        "ORA-00942: table or view does not exist while running select id, judul, sinopsis from komik where slug = 'a-b-c' and deleted_at is null",
        "Warning: include(/var/www/html/templates/series/detail/synopsis/long-name-of-a-template-file.php): failed to open stream: No such file or directory in /var/www/html/index.php on line 9",
        "Notice: Undefined index: synopsis", f"Error: template '{'series.' * 20}title' missing",
    ]
    assert judged(spark, *whole) == whole
    content = ["Warning: this comic contains violence.", "Notice: chapter 12 comes a week later, the author is ill.", "PG-13: a story of two robots " * 5, "Ora-ora: teriakan Tomoko di laut " * 5]
    assert judged(spark, *content) == []


def test_residue_of_words_and_kinds(spark):
    whole = ["Testing", "Testing 1 2 3", "testing 123", "test test 12", "null. Error 503", "N/A - undefined", "Coming soon. Null, null.", "undefined | TBA", "foo bar. Error 503", "null\nBad Gateway", "null, " * 5000 + "Error 503"]
    assert judged(spark, *whole) == whole
    assert judged(spark, "Bar None", "Testing Courage", "Test", "Null Knight", "Error 503: Null Knight", "N/A - undefinedly", "Testing 1 2 3 hearts") == []


def test_residue_within_long_quotes(spark):
    told = "the letter said that every reader who comes to the harbour at night, {{ name }}, shall be given a lamp and a map of the islands"
    assert judged(spark, *(f"Tomoko read it aloud: {a}{told}{b} and then she slept." for a, b in ('""', "''", "“”"))) == []
    lacking = ["It's the year {{ year }} and she can't go home.", f"Tomoko said \"hello\" and {told}.", "\"Unclosed {{ name }} goes on"]
    assert judged(spark, *lacking) == lacking


def test_residue_of_lines(spark):
    rows = [(1, json.dumps({"slug": "a", "judul": "%s", "sinopsis": "Kisah."})), (2, json.dumps({"slug": "b", "judul": "Kabut"})), (3, "{broken %s"), (4, None)]
    df = spark.createDataFrame([(i, datetime(2025, 1, 1), t, "f") for i, t in rows], "line_id long, fetched_at timestamp_ntz, line string, fld string")
    assert [tuple(r) for r in residue.found(df).collect()] == [(1, "judul")]
    assert {r["line_id"]: (r["judul"], r["sinopsis"]) for r in residue.clean(df).collect()} == {1: (None, "Kisah."), 2: ("Kabut", None)}
    assert residue.found(df.limit(0)).count() == 0


# --- documents -------------------------------------------------------------------------


def documents(spark, texts):
    rows = [(i, t, ["id", "EN", None, " ID "][i % 4], ["Forum ", "forum", None][i % 3], 1, "h") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, pos int, h string")


ODD = ["", None, " ", "\n\t  x", "I'm  don't 12ab!?　 ok", "café café ‍\U0001f469‍\U0001f3a8", "<|endoftext|> a", "\x85a᠎ b\x1cc", "한국어 日本語ｶﾞ", "a" * 3000, "word " * 2000, "  trailing   "]


@pytest.mark.parametrize("most", [200_000, 40, 5, 0])
def test_ids_equal_the_tokenizer(spark, most):
    texts = ODD + ["repeat me", "repeat me"]
    got = {r["doc_id"]: r["ids"] for r in encoding.encode(documents(spark, texts), "byte_bpe_50k", hot_words=most).collect()}
    tokenizer = encoding.tokenizer(encoding.vocabulary("byte_bpe_50k"))
    assert got == {i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}


def test_ids_round_trip_repeats_and_null_keys(spark):
    docs = documents(spark, ODD)
    back = {r["doc_id"]: r["text"] for r in encoding.decode(encoding.encode(docs, "byte_bpe_50k"), "byte_bpe_50k").collect()}
    assert back == {i: t or "" for i, t in enumerate(ODD)}
    twice = docs.union(docs).withColumn("doc_id", F.lit(None).cast("long"))
    assert encoding.encode(twice, "byte_bpe_50k").count() == 2 * len(ODD)
    assert encoding.encode(docs.limit(0), "byte_bpe_50k").count() == 0


def test_words(spark):
    df = documents(spark, ODD)
    assert all(r["w"] == spell(r["text"]) for r in df.select("text", words(F.col("text")).alias("w")).collect())


def leaked(docs, items, span=12):
    grams = {}
    for i, t in enumerate(items):
        w = spell(t)
        for n in range(len(w) - span + 1):
            grams.setdefault(tuple(w[n : n + span]), set()).add(i)
    found = set()
    for d, t in enumerate(docs):
        w = spell(t)
        for n in range(len(w) - span + 1):
            found |= {(d, i) for i in grams.get(tuple(w[n : n + span]), ())}
    return sorted(found)


@pytest.mark.parametrize("bound", [500_000, 70, 0])
def test_leaks_against_brute_force(spark, bound):
    rng = random.Random(3)
    pool = [f"w{i}" for i in range(12)]
    items = [" ".join(rng.choice(pool) for _ in range(40)) for _ in range(12)] + [None, "", "too short", "a " * 30]
    docs = []
    for _ in range(60):
        source = spell(rng.choice(items))
        at, size = rng.randrange(30), rng.randrange(8, 20)
        noise = lambda: [rng.choice(pool) for _ in range(rng.randrange(15))]
        docs.append(", ".join(noise() + [x.upper() for x in source[at : at + size]] + noise()))
    docs += [None, "", items[0], items[0], "a " * 12, "a " * 11]
    table = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, h int")
    got = sorted(map(tuple, leakage.leaks(documents(spark, docs), table, broadcast_prints=bound).collect()))
    assert got == leaked(docs, items) and 10 < len(got)
    assert leakage.leaks(documents(spark, []), table).count() == 0 and leakage.leaks(documents(spark, docs), table.limit(0)).count() == 0


def share(text):
    w = spell(text)
    seen, covered = set(), set()
    for n in range(len(w) - 4):
        gram = tuple(w[n : n + 5])
        if gram in seen:
            covered |= set(range(n, n + 5))
        seen.add(gram)
    return len(covered) / len(w) if w else None


def test_repetition_against_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(60)] + [None, "", "...", "a " * 19, "a " * 20, "x y z. " * 5000, " ".join(map(str, range(20)))]
    docs = documents(spark, texts)
    got = {r["doc_id"]: (r["n_words"], r["share"]) for r in repetition.measured(docs.select("doc_id", "text")).collect()}
    for i, t in enumerate(texts):
        assert got[i][0] == len(spell(t)) and (got[i][1] == share(t) if share(t) is None else abs(got[i][1] - share(t)) < 1e-12)
    found = sorted(r["doc_id"] for r in repetition.repetitive(docs, exact=0.4).collect())
    assert found == [i for i, t in enumerate(texts) if len(spell(t)) >= 20 and share(t) >= 0.4]
    twice = repetition.repetitive(docs.union(docs), exact=0.4).count()
    assert twice == 2 * len(found) and repetition.repetitive(docs.limit(0)).count() == 0
    assert {r["within"] for q in (0.1, 0.5, 0.95) for r in repetition.rank_check(docs, q).collect()} == {1}


def test_a_fixed_share_loses_no_document_above_it(spark):
    texts = ["a b c d e f g h " * 4] * 50 + [" ".join(map(str, range(n, n + 40))) for n in range(5)] + ["a b c d e f " * 2 + " ".join(map(str, range(20)))]
    docs = documents(spark, texts).withColumn("lang", F.lit("id")).withColumn("source", F.lit("x"))
    for quantile in (0.01, 0.5, 1.0):
        assert sorted(r["doc_id"] for r in repetition.repetitive(docs, quantile=quantile, exact=0.4).collect()) == list(range(50))
    assert repetition.repetitive(docs, quantile=0.01).count() == 56


def test_thresholds_follow_their_group(spark):
    calm = [" ".join(str(n * 100 + k) for k in range(40)) for n in range(40)]
    noisy = ["a b c d e f g h " * 3 + " ".join(map(str, range(n, n + 10))) for n in range(40)]
    rows = [(i, t, "id", "a", 0) for i, t in enumerate(calm)] + [(i + 40, t, "in", "b", 0) for i, t in enumerate(noisy)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, share int")
    g = repetition.group_of(F.col("lang"), F.col("source"))
    shares = repetition.measured(docs.select(g[0].alias("g_lang"), g[1].alias("g_source"), "text"))
    limits = {(r["g_lang"], r["g_source"]): r["threshold"] for r in repetition.thresholds(shares, 0.5, 0.05, 0.9).collect()}
    assert limits[("id", "a")] == 0.05 and limits[("id", "b")] > 0.3
    assert all(r["doc_id"] >= 40 for r in repetition.repetitive(docs, quantile=0.5, least=0.05, most=0.9).collect())
