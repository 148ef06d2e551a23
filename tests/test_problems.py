"""The general data problems on small inputs: usual cases, nulls, empties, ties, repeats, clashing columns."""

import json
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from bindery.operators import flatten, packed, references, snapshots

LINES = "line_id long, fetched_at timestamp_ntz, line string, child string, pos int, o string, rec string"
AT = datetime(2025, 1, 2, 3, 4, 5)


def lines(spark, *texts):
    return spark.createDataFrame([(i, AT, t, "x", 7, "y", "z") for i, t in enumerate(texts)], LINES)


def flat(spark, *texts):
    return sorted(map(tuple, flatten.all_children(lines(spark, *texts)).collect()), key=str)


def test_flatten_forms(spark):
    record = {
        "slug": "a",
        "chapters": [{"url": "u0", "image_filenames": ["1", None, "3"]}, None, {"url": None, "image_filenames": '["x"]'}],
        "similar": ["s0", {"slug": "s1"}, None],
        "genre_ids": "[5, null, \"6\", 7.0]",
    }
    lone = {"slug": "b", "chapters": {"url": "v"}, "similar": "bare", "genre_ids": 9}
    for wrap in (lambda r: r, lambda r: {"data": r}, lambda r: {"run": 1, "payload": {"detail": r}}):
        got = flat(spark, json.dumps(wrap(record)), json.dumps(wrap(lone)))
        assert got == sorted(
            [
                (0, "chapters", -1, 0, "u0"), (0, "chapters", -1, 2, None), (0, "image_filenames", 0, 0, "1"), (0, "image_filenames", 0, 2, "3"), (0, "image_filenames", 2, 0, "x"),
                (0, "similar", -1, 0, "s0"), (0, "similar", -1, 1, "s1"), (0, "genre_ids", -1, 0, "5"), (0, "genre_ids", -1, 2, "6"), (0, "genre_ids", -1, 3, "7"),
                (1, "chapters", -1, 0, "v"), (1, "similar", -1, 0, "bare"), (1, "genre_ids", -1, 0, "9"),
            ],
            key=str,
        )


def test_flatten_invalid_lines_and_empty_tables(spark):
    bad = ["", " ", None, "{", '{"slug":"a"', '{"slug":"a"} x', '{"slug":"a"}{"slug":"b"}', '{"slug":"a"},{"slug":"b"}', "[]", "5", "null", "{'slug':'a'}", '{"no":1}']
    assert flat(spark, *bad) == []
    assert flat(spark) == []
    assert flatten.children(lines(spark, '{"slug":"a","similar":["x"]}'), "similar").count() == 1
    twice = lines(spark, '{"slug":"a","genre_ids":[1]}')
    assert flatten.all_children(twice.union(twice)).count() == 2


def split(spark, *texts):
    df = spark.createDataFrame([(i, t, 1, "v") for i, t in enumerate(texts)], "id int, t string, pos int, val string")
    rows = packed.unpack(df, "id", "t").collect()
    return [[r["val"] for r in sorted((r for r in rows if r["id"] == i), key=lambda r: r["pos"])] for i in range(len(texts))]


def test_packed_fields(spark):
    cases = {
        "A; B;C": ["A", "B", "C"],
        "A, B": ["A", "B"],
        "A, B; C": ["A, B", "C"],
        "A / B - C": ["A", "B", "C"],
        "A/B-C": ["A/B-C"],
        "A|B•C\nD；E｜F，G、H": list("ABCDEFGH"),
        '"A; ""B"", C", D': ['A; "B", C', "D"],
        'The "A" B, C': ['The "A" B', "C"],
        '"A" B; C': ['"A" B', "C"],
        "“A, B”, C": ["A, B", "C"],
        ' " A " ;; ; B ; ': ["A", "B"],
        "A; A; A": ["A", "A", "A"],
        "-": [], " — ": [], "": [], "  \n": [], ";": [], '""': [],
        "A0; \"B; C\"": ["A0", "B; C"],
        "A\r\nB": ["A", "B"],
        "x" * 50_000 + ";y": ["x" * 50_000, "y"],
    }
    assert split(spark, *cases, None) == [*cases.values(), []]
    assert split(spark) == []


def snapshot_state(spark, rows):
    df = spark.createDataFrame(rows, "snapshot_no int, delivered_at timestamp_ntz, k long, v string, rel string, digest string")
    return snapshots.deliveries(df, "t", "k", [snapshots.number_text(F.col("v"))])


def brute(rows):
    state = {}
    for no, at, key, value, *_ in rows:
        if key is not None and no is not None:
            kept = state.setdefault(no, {}).get(key)
            if kept is None or at > kept[0]:
                state[no][key] = (at, None if value is None else float(value.replace(",", ".")))
    out = []
    for a, b in zip(sorted(state), sorted(state)[1:]):
        for key in {*state[a], *state[b]}:
            kind = "added" if key not in state[a] else "removed" if key not in state[b] else "changed" if state[a][key][1] != state[b][key][1] else None
            if kind:
                out.append(("t", b, key, kind))
    return sorted(out)


def test_snapshots_against_brute_force(spark):
    rng = random.Random(1)
    rows, n = [], 0
    for no in (1, 2, 5):
        for key in range(800):
            if rng.random() < 0.8:
                n += 1
                value = rng.choice([None, str(key % 7), f"00{key % 7}", f"{key % 7},0", f"{key % 7}.00", str(rng.randrange(3))])
                rows.append((no, AT + timedelta(seconds=n), key, value, "r", "d"))
                if rng.random() < 0.2:
                    n += 1
                    rows.append((no, AT + timedelta(seconds=n), key, str(rng.randrange(9)), "r", "d"))
    rows += [(None, AT, 1, "1", "r", "d"), (1, AT, None, "1", "r", "d")]
    state = snapshot_state(spark, rows)
    for buckets, cells in ((100, 90), (10_000, 9)):  # the second fails at first and is enlarged
        assert sorted(map(tuple, snapshots.deltas(state, buckets, cells).collect())) == brute(rows)
    assert brute(rows)
    only = [r for r in rows if r[0] == 1]
    assert snapshots.deltas(snapshot_state(spark, only)).count() == 0
    assert snapshots.deltas(snapshot_state(spark, [])).count() == 0


def test_snapshots_fall_back_to_the_join(spark, monkeypatch):
    rows = [(no, AT, k, str(k * no % 5), "r", "d") for no in (1, 2) for k in range(200)]
    monkeypatch.setattr(snapshots, "ROUNDS", 1)
    assert sorted(map(tuple, snapshots.deltas(snapshot_state(spark, rows), 10_000, 6).collect())) == brute(rows)


def test_snapshots_with_a_record_of_a_third_of_all_rows(spark):
    rows = [(no, AT + timedelta(seconds=i), 7, str(i), "r", "d") for no in (1, 2) for i in range(100)] + [(no, AT, k, str(k), "r", "d") for no in (1, 2) for k in range(10, 210)]
    state = snapshot_state(spark, rows + [(2, AT, 999, "1", "r", "d"), (2, AT + timedelta(days=1), 7, "x", "r", "d")])
    assert sorted(map(tuple, snapshots.deltas(state, 50).collect())) == [("t", 2, 7, "changed"), ("t", 2, 999, "added")]


def test_snapshot_rows_are_moved_once(spark):
    state = snapshot_state(spark, [(no, AT, k, str(k), "r", "d") for no in (1, 2) for k in range(50)])
    state = state.unionByName(state.withColumn("rel", F.lit("u")))
    steps = spark.createDataFrame([("t", 1, 50, []), ("t", 2, 50, [])], "rel string, snapshot_no int, n long, hot array<long>")
    plan = snapshots._cells(snapshots._elements(state, steps, 4), 30)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(rel" in plan


def test_number_text(spark):
    df = spark.createDataFrame([(x,) for x in ("5", "05", "5.0", " 5,00 ", "-0", "", None, "x", "1e1", "10")], "v string")
    got = [r[0] for r in df.select(snapshots.number_text(F.col("v"))).collect()]
    assert got == ["5", "5", "5", "5", "0", None, None, "t:x", "10", "10"]


def test_orphans(spark, monkeypatch):
    day = lambda n: AT + timedelta(days=n)
    refs = spark.createDataFrame(
        [(1, "a", day(0), "q"), (1, "a", day(0), "q"), (1, "b", day(0), "q"), (2, "c", day(0), "q"), (2, "c", day(9), "q"), (3, None, day(0), "q"), (4, "d", None, "q"), (5, "A", day(40), "q"), (6, "e", day(0), "q"), (7, "b", None, "q")],
        "parent_id long, ref_key string, at timestamp_ntz, why string",
    )
    parents = spark.createDataFrame([("a", day(-1), 1), ("c", day(5), 1), ("c", day(7), 1), ("d", day(3), 1), ("e", None, 1), (None, day(0), 1)], "ref_key string, created_at timestamp_ntz, why int")
    deleted = spark.createDataFrame([("b",), ("a",), (None,)], "ref_key string")
    want = [(1, "b", "deleted", "2025-01"), (2, "c", "late", "2025-01"), (5, "A", "missing", "2025-02"), (7, "b", "deleted", None)]
    for salted in (False, True):
        if salted:
            monkeypatch.setattr(references, "small", lambda df: False)
        assert sorted(map(tuple, references.orphans(refs, parents, deleted).collect()), key=str) == sorted(want, key=str)
    assert references.orphans(refs.limit(0), parents, deleted).count() == 0
    assert references.orphans(refs, parents.limit(0), deleted.limit(0)).filter("why = 'missing'").count() == 7
