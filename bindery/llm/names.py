"""Variant spellings of one person's or circle's name.

Distinct spellings are parsed into tokens, and spellings of the same tokens count
as one form. Tokens that differ by one typing error are found by a prefix-filtered
join of their q-grams: of a token's padded q-grams, rarest first, the first q + 3
hold two in common with every token an insertion, loss, change or swap away, so
tokens of nearly one length meet under pairs of grams. Forms meet under all their tokens
together, each as it is or as a near one that is more frequent, and are verified
by a soft similarity: aligned and left-over tokens count by their rarity, and a
token with an error counts the less, the more often it is written like that.
Abbreviations are verified by the same sum. Links become groups by minimum labels
with pointer jumping; an abbreviated spelling joins a group only if it fits no other.

Work follows distinct forms, not rows. Keys hold all tokens of a form, so nothing
grows with the square of a frequent token.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import bounded_broadcast, cut

Q = 4
#: Least soft similarity of two spellings of one name; the similarity that a beginning or initial has with what it stands for.
LEAST, BEGINNING = 0.75, 0.9
# Words that name a kind of circle in its forms; words that name nobody; stand-ins for unknown.
KINDS = {"st": "studio", "std": "studio", "studios": "studio"}
NOISE = {"by", "art", "sensei", "co", "ltd", "inc", "llc", "corp", "story", "oleh"}
STAND_INS = {"", "n a", "na", "unknown", "tidak diketahui", "none", "null", "anonymous", "anonim", "various", "tba", "tbd"}


def tokens(name: str | None) -> list[str]:
    """Tokens of a spelling: no accents, case, order marks, titles, nicknames in quotes; empty for stand-ins."""
    folded = "".join(c for c in unicodedata.normalize("NFKD", name or "") if not unicodedata.combining(c))
    folded = re.sub(r"([a-z])([A-Z])", r"\1 \2", folded).lower()
    cut_of = lambda t: [x for x in re.findall(r"[^\W_]+", t) if x not in NOISE]
    if " ".join(re.findall(r"[^\W_]+", folded)) in STAND_INS:
        return []
    bare = cut_of(re.sub(r"[\"“(\[][^\"”)\]]*[\"”)\]]", " ", folded))
    found = bare if len(bare) >= 2 else cut_of(folded)
    found = [KINDS.get(x, x) if len(found) > 1 else x for x in found]
    if len(found) == 1 and (kind := re.fullmatch(r"(studio)(\w{4,})", found[0])):
        found = list(kind.groups())
    return found


def _swapped(a: Column, b: Column) -> Column:
    """Whether b is a with two neighbours swapped."""
    n = F.char_length(a)
    at = lambda i: F.concat(F.substring(a, F.lit(1), i - 1), F.substring(a, i + 1, F.lit(1)), F.substring(a, i, F.lit(1)), F.substring(a, i + 2, n))
    return (n == F.char_length(b)) & F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: at(i) == b)


def near_tokens(words: DataFrame, q: int = Q) -> DataFrame:
    """(a, b), both orders: tokens of (token) one typing error apart. Tokens of fewer than four letters have none.

    One error spoils at most q + 1 of a token's grams, so the first two that both
    have, in order of rarity, are among the first q + 3 of each.
    """
    padded = F.concat(F.lit("\x02" * (q - 1)), F.col("token"), F.lit("\x03" * (q - 1)))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length("token") + q - 1), lambda i: F.substring(padded, i, F.lit(q))))
    posted = words.filter(F.char_length("token") >= 4).select("token", F.explode(grams).alias("g"))
    rarity = posted.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    ordered = posted.join(rarity, "g").groupBy("token").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "g"))), 1, q + 3).alias("gs"))
    two = F.flatten(F.transform("gs", lambda x, i: F.transform(F.slice(F.col("gs"), i + 2, q + 3), lambda y: F.xxhash64(x["g"], y["g"]))))
    keyed = cut(ordered.select("token", F.char_length("token").alias("n"), F.explode(two).alias("key")))
    met = keyed.toDF("a", "n_a", "key").join(keyed.toDF("b", "n_b", "key"), "key").filter((F.col("a") < F.col("b")) & (F.abs(F.col("n_a") - F.col("n_b")) <= 1))
    near = met.filter((F.levenshtein("a", "b", 1) >= 0) | _swapped(F.col("a"), F.col("b"))).select("a", "b").distinct()
    return near.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))


def _one_error(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 4:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :] or (a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])


def rarity(token: str, df: int, total: int) -> float:
    """What a token counts: the rarer, the more; short ones in proportion to their letters."""
    return math.log(1 + total / df) * min(1.0, len(token) / 4)


def near_similarity(letters: int, few: int, many: int) -> float:
    """Similarity of tokens an error apart, of which `few` and `many` spellings hold one.

    1 - 1 / letters if the rarer is written once; the more often it is written in
    comparison to the other, the more it is a name of its own, and the less alike they are.
    """
    return 1 - (1 / letters) ** (1 / (1 + (few - 1) * few / many))


def _alike(a: str, b: str, df: dict[str, int]) -> float:
    if a == b:
        return 1.0
    if min(len(a), len(b)) <= 3:
        return BEGINNING if max(a, b, key=len).startswith(min(a, b, key=len)) else 0.0
    return near_similarity(max(len(a), len(b)), *sorted((df[a], df[b]))) if _one_error(a, b) else 0.0


def _assigned(gain: list[list[float]]) -> list[int]:
    """By row of a table with at least as many columns: its column in the assignment of the greatest sum (shortest augmenting paths)."""
    n, m = len(gain), len(gain[0]) if gain else 0
    up, down, of = [0.0] * (n + 1), [0.0] * (m + 1), [0] * (m + 1)
    for i in range(1, n + 1):
        of[0], j0 = i, 0
        least, way, seen = [math.inf] * (m + 1), [0] * (m + 1), [False] * (m + 1)
        while True:
            seen[j0] = True
            i0, step, j1 = of[j0], math.inf, 0
            for j in range(1, m + 1):
                if not seen[j]:
                    cost = -gain[i0 - 1][j - 1] - up[i0] - down[j]
                    if cost < least[j]:
                        least[j], way[j] = cost, j0
                    if least[j] < step:
                        step, j1 = least[j], j
            for j in range(m + 1):
                if seen[j]:
                    up[of[j]] += step
                    down[j] -= step
                else:
                    least[j] -= step
            j0 = j1
            if not of[j0]:
                break
        while j0:
            of[j0], j0 = of[way[j0]], way[j0]
    rows = {of[j]: j - 1 for j in range(1, m + 1)}
    return [rows[i] for i in range(1, n + 1)]


def _similar(a: list[str], b: list[str], df: dict[str, int], total: int) -> float:
    """Soft similarity: what aligned tokens count times how alike they are, over what all tokens count, left-over ones too.

    An aligned pair counts what its commoner token does: an abbreviation what it
    may stand for, an error what the name does.
    """
    if len(a) > len(b):
        a, b = b, a
    left = list(b)
    equal = [t for t in a if t in left and (left.remove(t) or True)]
    rest = list(a)
    for t in equal:
        rest.remove(t)
    got = of = sum(rarity(t, df[t], total) for t in equal)
    if rest:
        weight = lambda x, y: min(rarity(x, df[x], total), rarity(y, df[y], total))
        for i, j in enumerate(_assigned([[weight(x, y) * _alike(x, y, df) for y in left] for x in rest])):
            x, y = rest[i], left[j]
            if alike := _alike(x, y, df):
                got, of = got + weight(x, y) * alike, of + weight(x, y)
            else:
                of += rarity(x, df[x], total) + rarity(y, df[y], total)
            left[j] = ""
    of += sum(rarity(t, df[t], total) for t in left if t)
    return got / of if of else 0.0


def groups(edges: DataFrame) -> DataFrame:
    """(name, label) of the connected components of (a, b): the least name of each."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    if both.isEmpty():
        return both.toDF("name", "label")
    labels = cut(both.groupBy(F.col("a").alias("name")).agg(F.least(F.min("b"), F.col("name")).alias("label")))
    while True:
        seen = both.join(labels.withColumnRenamed("name", "b"), "b").select(F.col("a").alias("name"), "label")
        least = labels.unionByName(seen).groupBy("name").agg(F.min("label").alias("label"))
        jumped = least.alias("x").join(labels.alias("y"), F.col("x.label") == F.col("y.name")).select("x.name", F.least("x.label", "y.label").alias("label"))
        jumped = cut(jumped)
        if labels.join(jumped.withColumnRenamed("label", "next"), "name").filter("label <> next").isEmpty():
            return jumped
        labels = jumped


def _spellings(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    @F.pandas_udf("array<string>")
    def parse(batch: pd.Series) -> pd.Series:
        return batch.map(tokens)

    names = df.select(F.explode(F.array(*fields)).alias("name")).filter("name is not null").distinct()
    return names.select("name", parse("name").alias("ts")).filter(F.size("ts") > 0)


def _full_forms(spelled: DataFrame, nicknames: DataFrame, given: str, short: str) -> DataFrame:
    """(name, ts) with nicknames in their full forms; a nickname of several names gives a row for each."""
    table = nicknames.select(F.lower(F.trim(short)).alias("token"), F.lower(F.trim(given)).alias("given")).dropna().distinct()
    placed = spelled.select("name", F.posexplode("ts").alias("at", "token")).join(bounded_broadcast(table), "token", "left")
    meant = placed.groupBy("name", "at").agg(F.array_sort(F.collect_set(F.coalesce("given", "token"))).alias("any"))
    whole = meant.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("at", "any"))).alias("all"))
    return whole.select("name", F.explode(_combined(F.col("all"))).alias("ts"))


def _places(forms: DataFrame, up: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(name, ts, places): by place of a form its token (t), then its more frequent near ones, with what the token counts (w), its df, and what is lost by the choice."""
    weight = F.ln(1 + F.lit(float(total)) / F.col("df")) * F.least(F.lit(1.0), F.char_length("token") / 4)
    own = F.array(F.struct(F.col("token").alias("t"), F.lit(0.0).alias("loss")))
    choices = forms.select("name", "ts", F.posexplode("ts").alias("at", "token")).join(counts.join(up.groupBy("token").agg(F.collect_list(F.struct(F.col("upper").alias("t"), "loss")).alias("ups")), "token", "left"), "token")
    either = F.struct("at", weight.alias("w"), "df", F.concat(own, F.coalesce("ups", F.array())).alias("any"))
    return choices.groupBy("name", "ts").agg(F.transform(F.sort_array(F.collect_list(either)), lambda p: p.dropFields("at")).alias("places"))


def _meeting(places: DataFrame) -> DataFrame:
    """(name, ts, dfs, key, own): each form under every row of its tokens, each as it is or as a more frequent near one; own tells the key of just its tokens.

    Two forms whose tokens correspond by at most one error each share a key:
    the more frequent of the two tokens at every place. Keys hold all tokens, so a
    frequent token, or a third of all spellings that have it, makes no large group.
    Short tokens have no near ones and stay as they are.
    """
    keys = _combined(F.transform("places", lambda p: F.struct(F.transform(p["any"], lambda x: x["t"]).alias("any"))))
    text = lambda k: F.array_join(F.array_sort(k), " ")
    keyed = places.select("name", "ts", F.transform("places", lambda p: p["df"]).alias("dfs"), F.explode(F.array_distinct(F.transform(keys, text))).alias("key"))
    return keyed.withColumn("own", F.col("key") == text(F.col("ts")))


def _combined(places: Column) -> Column:
    """All rows of one choice from each place's array `any`."""
    return F.aggregate(
        places,
        F.array(F.array().cast("array<string>")),
        lambda acc, p: F.flatten(F.transform(acc, lambda head: F.transform(p["any"], lambda t: F.concat(head, F.array(t))))),
    )


def variants(df: DataFrame, nicknames: DataFrame, fields: tuple[str, ...] = ("author", "artist"), given: str = "given_form", short: str = "short_form", least: float = LEAST) -> DataFrame:
    """(name, label): spellings that have others of the same person or circle, and their group.

    Null, blank and stand-in names name nobody and are left out. A spelling of a
    surname with an initial or a beginning of the given name joins the group it
    fits best, unless it fits several as well. An empty table gives no rows.
    """
    spelled = _full_forms(_spellings(df, fields), nicknames, given, short)
    # Spellings of the same tokens are one form, named by the least of them.
    named = cut(spelled.select("name", F.array_sort("ts").alias("ts")).distinct())
    forms = cut(named.groupBy("ts").agg(F.min("name").alias("least"), F.count(F.lit(1)).alias("n_names")))
    counts = cut(forms.select(F.explode(F.array_distinct("ts")).alias("token"), "n_names").groupBy("token").agg(F.sum("n_names").alias("df")))
    total = max(1, forms.agg(F.sum("n_names")).first()[0] or 0)
    # From a token to the near ones that are more frequent; equals go to the smaller string.
    known = near_tokens(counts.select("token")).toDF("token", "upper").join(counts, "token").join(counts.toDF("upper", "df_up"), "upper")
    higher = known.filter("df_up > df or (df_up = df and upper < token)")
    letters = F.greatest(F.char_length("token"), F.char_length("upper"))
    unlike = F.pow(1.0 / letters, 1.0 / (1.0 + (F.col("df") - 1) * F.col("df") / F.col("df_up")))
    up = higher.select("token", "upper", (unlike * F.ln(1 + F.lit(float(total)) / F.col("df_up"))).alias("loss"))
    places = cut(_places(forms.select(F.col("least").alias("name"), "ts"), up, counts, total))
    met = cut(_meeting(places))

    @F.pandas_udf("double")
    def similarity(ta: pd.Series, tb: pd.Series, da: pd.Series, db: pd.Series) -> pd.Series:
        return pd.Series([_similar(list(a), list(b), dict(zip(a, x)) | dict(zip(b, y)), total) for a, b, x, y in zip(ta, tb, da, db)], dtype="float64")

    side = lambda rows, s: rows.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("name", "ts", "dfs")))
    # Where a form of just the key's tokens is there, the others meet it alone; else they meet each other.
    middle = met.filter("own")
    apart = met.join(middle.select("key"), "key", "left_anti")
    through = side(met.filter("not own"), "a").join(side(middle, "b"), "key")
    among = side(apart, "a").join(side(apart, "b"), "key").filter("name_a < name_b")
    candidates = through.unionByName(among).filter("name_a <> name_b").drop("key").dropDuplicates(["name_a", "name_b", "ts_a", "ts_b"])
    alike = candidates.filter(similarity("ts_a", "ts_b", "dfs_a", "dfs_b") >= least - 1e-9).select(F.col("name_a").alias("a"), F.col("name_b").alias("b"), _shorts(F.col("ts_a")).alias("k"))
    # A nickname of several names belongs to several forms.
    several = named.groupBy("name").count().filter("count > 1").select("name")
    bound = named.join(several, "name", "left_semi").join(forms, "ts").filter("name <> least").select(F.col("name").alias("a"), F.col("least").alias("b"), _shorts(F.col("ts")).alias("k"))
    links = cut(alike.unionByName(bound))
    labels = _abbreviated(places, links, counts, least).groupBy(F.col("name").alias("least")).agg(F.min("label").alias("label"))
    told = named.join(forms, "ts").join(labels, "least", "left").filter("label is not null or n_names > 1")
    return told.groupBy("name").agg(F.min(F.coalesce("label", "least")).alias("label"))


def _shorts(ts: Column) -> Column:
    """How many tokens of a form have at most three letters. Short tokens have no near ones, so forms that meet have the same."""
    return F.size(F.filter(ts, lambda t: F.char_length(t) <= 3))


def _units(loss: float) -> int:
    """A loss as a whole number, so that equal ones are equal."""
    return round(loss * 10_000)


def _asked(places: list[dict], least: float = LEAST) -> list[tuple[list[str], list[str], int]]:
    """(anchor, shorts, loss): what a form with short tokens asks of a fuller one.

    The anchor is its long tokens, each as it is or as a near one. Of short tokens
    only, each of two letters or more is the anchor in turn. An initial (at most two
    letters) may be left out if two tokens remain; of more than ten initials, all or
    none. Losses are those of the soft similarity: errors, beginnings, what is left
    out; what leaves less than `least` of all that the tokens count is not asked.
    """
    long = [p for p in places if len(p["any"][0]["t"]) > 3]
    short = sorted((p["any"][0]["t"], p["w"]) for p in places if len(p["any"][0]["t"]) <= 3)
    most = (1 - least) * sum(p["w"] for p in places) + 1e-9
    if long:
        anchors = [(sorted(x["t"] for x in c), sum(x["loss"] for x in c), short) for c in itertools.product(*(p["any"] for p in long))]
    else:
        anchors = [([t], 0.0, short[:i] + short[i + 1 :]) for i, (t, _) in enumerate(short) if len(t) > 1]
    found: dict = {}
    for anchor, loss, rest in anchors:
        initials = [i for i, (t, _) in enumerate(rest) if len(t) <= 2]
        counts = range(len(initials) + 1) if len(initials) <= 10 else (0, len(initials))
        for gone in itertools.chain.from_iterable(itertools.combinations(initials, n) for n in counts):
            kept = [x for i, x in enumerate(rest) if i not in gone]
            lost = loss + sum(rest[i][1] for i in gone) + (1 - BEGINNING) * sum(w for _, w in kept)
            if len(anchor) + len(kept) >= 2 and lost <= most:
                key = (tuple(anchor), tuple(t for t, _ in kept))
                found[key] = min(found.get(key, lost), lost)
    return [(list(a), list(k), _units(c)) for (a, k), c in found.items()]


def _fits(short: list[str], rest: list[str]) -> bool:
    """Whether each of `short` is one of the short tokens of `rest` or begins a long one, and none is left over."""
    left = sorted(short, key=len, reverse=True)
    for t in rest:
        if len(t) <= 3:
            if t not in left:
                return False
            left.remove(t)
    long = [t for t in rest if len(t) > 3]
    # Tokens that a beginning fits lie within those of a shorter beginning or apart from them, so the longest first is best.
    for h in left:
        if (t := next((t for t in long if t.startswith(h)), None)) is None:
            return False
        long.remove(t)
    return not long


def _offered(places: list[dict], anchor: list[str], asked: list[int], deep: list[list[str]]) -> list[tuple[list[str], int]]:
    """(shorts, loss): the short tokens with which the anchor may stand for this form; many at once are only tried, not listed."""
    states: dict = {tuple(range(len(places))): 0.0}
    for token in anchor:
        after: dict = {}
        for state, loss in states.items():
            for i in state:
                for x in places[i]["any"]:
                    if x["t"] == token:
                        left = tuple(j for j in state if j != i)
                        after[left] = min(after.get(left, math.inf), loss + x["loss"])
        states = after
    found: dict = {}
    for state, loss in states.items():
        rest = [places[i]["any"][0]["t"] for i in state]
        if len(rest) not in asked:
            continue
        if len(rest) <= 3:
            heads = itertools.product(*([t] if len(t) <= 3 else [t[:1], t[:2], t[:3]] for t in rest))
            shorts = [tuple(sorted(h)) for h in heads]
        else:
            shorts = [tuple(d) for d in deep if len(d) == len(rest) and _fits(d, rest)]
        for x in shorts:
            found[x] = min(found.get(x, math.inf), loss)
    return [(list(x), _units(c)) for x, c in found.items()]


def _abbreviated(places: DataFrame, links: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """(name, label) of all groups: of links, and of spellings with initials or beginnings and the fuller spellings that they join.

    Fuller spellings are aggregated by the tokens kept and the beginnings of the others
    to their least and greatest label; a spelling fits one group if these are equal.
    The fit with the least loss counts, if the soft similarity stays at `least` or
    more. Spellings with fewer short tokens get their labels first.
    """

    @F.pandas_udf("array<struct<anchor: array<string>, shorts: array<string>, cost: int>>")
    def asking(batch: pd.Series) -> pd.Series:
        return batch.map(lambda p: [{"anchor": a, "shorts": s, "cost": c} for a, s, c in _asked(list(p), least)])

    @F.pandas_udf("array<struct<shorts: array<string>, own: int>>")
    def offering(ps: pd.Series, anchors: pd.Series, ns: pd.Series, deep: pd.Series) -> pd.Series:
        return pd.Series([[{"shorts": s, "own": c} for s, c in _offered(list(p), list(a), list(n), [list(x) for x in d])] for p, a, n, d in zip(ps, anchors, ns, deep)])

    all_of = lambda ps: F.flatten(F.transform(ps, lambda p: F.transform(p["any"], lambda x: x["t"])))
    spelled = places.withColumn("k", _shorts(F.col("ts")))
    shortened = spelled.filter("k > 0")
    allowed = F.aggregate("places", F.lit(1e-4), lambda n, p: n + p["w"] * (1 - least)) * 10_000
    asked = cut(shortened.select("name", "k", allowed.alias("allowed"), F.inline(asking("places"))))
    needs = cut(asked.groupBy("anchor").agg(F.collect_set(F.size("shorts")).alias("ns"), F.collect_set(F.when(F.size("shorts") > 3, F.col("shorts"))).alias("deep")))
    rarest = needs.select("anchor", F.explode("anchor").alias("token")).join(counts, "token").groupBy("anchor").agg(F.min_by("token", F.struct("df", "token")).alias("token"))
    tokens_of = spelled.select("name", "ts", "places", "k", F.explode(F.array_distinct(all_of("places"))).alias("token"))
    able = tokens_of.join(needs.join(rarest, "anchor"), "token").filter(F.size(F.array_except("anchor", all_of("places"))) == 0)
    offered = cut(able.select("name", "k", "anchor", F.inline(offering("places", "anchor", "ns", "deep"))))

    labels = groups(links.filter("k = 0"))
    for k in sorted(r["k"] for r in asked.select("k").unionByName(links.select("k")).filter("k > 0").distinct().collect()):
        fuller = offered.filter(F.col("k") < k).join(labels, "name", "left").withColumn("label", F.coalesce("label", "name"))
        fits = fuller.groupBy("anchor", "shorts", "own").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        tried = asked.filter(F.col("k") == k).join(fits, ["anchor", "shorts"]).withColumn("cost", F.col("cost") + F.col("own")).filter("cost <= allowed")
        ends = tried.groupBy("name", "cost").agg(F.min("low").alias("low"), F.max("high").alias("high")).groupBy("name").agg(F.min_by(F.struct("low", "high"), "cost").alias("r"))
        ends = cut(ends.select("name", (F.col("r.low") == F.col("r.high")).alias("sure"), F.col("r.low").alias("fit")))
        level = shortened.filter(F.col("k") == k)
        sure = ends.filter("sure").select("name", F.col("fit").alias("label"))
        # Spellings that meet are one name unless they fit different groups.
        met = links.filter(F.col("k") == k).select("a", "b")
        end = lambda s: ends.select(F.col("name").alias(s), F.col("sure").alias(f"sure_{s}"), F.col("fit").alias(f"fit_{s}"))
        agreed = met.join(end("a"), "a", "left").join(end("b"), "b", "left").filter("sure_a is null or sure_b is null or (sure_a = sure_b and (not sure_a or fit_a = fit_b))").select("a", "b")
        own = cut(groups(agreed.unionByName(_nested(level.join(ends, "name", "left_anti")))))
        # What fits by itself keeps its group; what does not follows those that it met, if they agree.
        led = own.join(sure.select("name", F.col("label").alias("fit")), "name").groupBy("label").agg(F.min("fit").alias("low"), F.max("fit").alias("high")).filter("low = high").select("label", "low")
        followed = own.join(sure, "name", "left_anti").join(led, "label", "left").select("name", F.coalesce("low", "label").alias("label"))
        labels = cut(labels.unionByName(sure).unionByName(sure.select(F.col("label").alias("name"), "label")).unionByName(followed).groupBy("name").agg(F.min("label").alias("label")))
    return labels


def _nested(alone: DataFrame) -> DataFrame:
    """(a, b): links of spellings that fit nobody and differ in one beginning, from the shorter to the longest that it begins.

    A beginning of several that do not begin each other is left out. Of one initial there are few (at most three letters).
    """
    turn = F.transform(F.filter(F.sequence(F.lit(0), F.size("ts") - 1), lambda i: F.char_length(F.get("ts", i)) <= 3), lambda i: F.struct(F.get("ts", i).alias("head"), F.array_sort(F.filter("ts", lambda t, j: j != i)).alias("others")))
    heads = alone.filter(F.size("ts") > 1).select("name", F.inline(turn)).groupBy("others", "head").agg(F.min("name").alias("name"))
    sets = heads.groupBy("others", F.substring("head", 1, 1).alias("initial")).agg(F.collect_list(F.struct("head", "name")).alias("hs")).filter(F.size("hs") > 1)
    longer = F.filter("hs", lambda x: F.startswith(x["head"], F.col("x.head")) & (x["head"] != F.col("x.head")))
    tops = sets.select("hs", F.explode("hs").alias("x")).select("x", longer.alias("longer")).filter(F.size("longer") > 0)
    top = F.array_max(F.transform("longer", lambda y: F.struct(F.char_length(y["head"]).alias("n"), y["head"].alias("head"), y["name"].alias("name"))))
    return tops.select("x", "longer", top.alias("top")).filter(F.forall("longer", lambda y: F.startswith(F.col("top.head"), y["head"]))).select(F.col("x.name").alias("a"), F.col("top.name").alias("b")).filter("a <> b")


def pairs(labelled: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b: every pair of spellings of a group."""
    labelled = cut(labelled)
    a, b = labelled.toDF("name_a", "label"), labelled.toDF("name_b", "label")
    return a.join(b, "label").filter("name_a < name_b").select("name_a", "name_b")
