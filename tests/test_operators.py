import random

import pytest
from pyspark.sql import functions as F

from garimpo.operators import caps, dedup, joins, stats, submit


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_keep_latest_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "b", " ", None, "c"]), rng.choice(["1", "2", None]), rng.choice(["x", "y", None])) for i in range(200)]
    best, first = {}, {}
    for r in rows:
        if not (r[1] or "").strip():
            continue
        first.setdefault(r[1], r[0])
        if r[1] not in best or ((r[2] or ""), (r[3] or "")) > ((best[r[1]][2] or ""), (best[r[1]][3] or "")):
            best[r[1]] = r
    got = dedup.keep_latest(frame(spark, rows, "seq int, k string, g string, u string"), "k", ["g", "u"], "seq").collect()
    assert {r.k: (r.seq, r.first_seq) for r in got} == {k: (r[0], first[k]) for k, r in best.items()}


def test_keep_first_nulls_ties_and_clashing_names(spark):
    df = frame(spark, [(1, "a", 5), (0, "a", 6), (0, "a", 6), (2, None, 7), (3, "b", None)], "seq int, `a.b` string, __row int")
    got = dedup.keep_first(df, ["a.b"], "seq").collect()
    assert sorted((r["a.b"], r.seq) for r in got) == [("a", 0), ("b", 3)]
    assert dedup.keep_first(df.limit(0), ["a.b"], "seq").count() == 0


def test_union_distinct(spark):
    a = frame(spark, [(1, "x"), (2, "y")], "seq long, url string")
    b = frame(spark, [(1, "y"), (2, "z"), (3, "z")], "seq long, url string")
    got = dedup.union_distinct([a, b], ["url"]).orderBy("seq").collect()
    assert [(r.url, r.seq.part) for r in got] == [("x", 0), ("y", 0), ("z", 1)]


def test_running_sums_match_one_pass(spark):
    rng = random.Random(2)
    rows = [(i * 3 - 50, rng.choice("ab"), rng.randint(0, 3)) for i in range(150)]
    got = {(r.g, r.seq): r.before for r in caps.running(frame(spark, rows, "seq int, g string, v int"), "seq", {"before": F.col("v")}, group=["g"], chunks=7).collect()}
    sums = {"a": 0, "b": 0}
    for seq, g, v in rows:
        assert got[(g, seq)] == sums[g]
        sums[g] += v
    assert len(got) == len(rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_budget_and_streaks_against_loops(spark, seed):
    rng = random.Random(seed)
    rows = [(i, "g", rng.random() < 0.5) for i in range(80)]
    done, tried = 0, []
    for r in rows:
        if done >= 10:
            break
        tried.append(r[0])
        done += r[2]
    df = frame(spark, rows, "seq int, g string, ok boolean")
    assert sorted(r.seq for r in caps.success_budget(df, 10, F.col("ok"), "seq").collect()) == tried
    streak, kept = 0, []
    for r in rows:
        streak = 0 if r[2] else streak + 1
        kept.append(r[0])
        if streak == 4:
            break
    assert sorted(r.seq for r in caps.stop_after_streak(df, 4, ~F.col("ok"), "seq", ["g"]).collect()) == kept


def test_stale_pages_and_page_caps(spark):
    rows = [("s", 1, "a"), ("s", 2, "a"), ("s", 3, "b"), ("s", 4, "a"), ("s", 5, "b"), ("s", 6, "c"), ("t", 1, "x"), ("t", 2, None), ("t", 3, "y")]
    df = frame(spark, rows, "g string, page int, k string")
    assert sorted((r.g, r.page) for r in caps.stop_at_stale_pages(df, 2, "page", "k", ["g"]).collect()) == [("s", 1), ("s", 2), ("s", 3), ("s", 4), ("s", 5), ("t", 1), ("t", 2)]
    assert caps.page_cap(df, "page", 10, F.lit("2")).count() == 4
    assert caps.page_cap(df, "page", 10, F.lit("odd")).count() == 2
    pages = frame(spark, [("g", p, i) for p in (1, 2, 3) for i in range(4)], "g string, page int, i int")
    assert caps.cap_by_page(pages, 5, "page", ["g"]).count() == 8
    assert caps.cap(pages, 2, "i", ["page"]).count() == 6
    assert caps.cap_reached(pages, 12, ["g"]).first().cap_reached


def test_batches_and_submission(spark):
    df = frame(spark, [(i * 10,) for i in range(65)], "seq int")
    got = submit.batches(df, seq="seq").orderBy("seq").collect()
    assert [(r.batch_no, r.place) for r in got] == [divmod(i, 30) for i in range(65)]
    sent, waits = [], []

    def send(rows):
        sent.append(len(rows))
        return (503, None) if len(sent) == 1 else (200, "text") if len(sent) == 2 else (400, None)

    out = submit.submit(df, send, seq="seq", sleep=waits.append)
    assert (out["submitted"], out["batches"], out["failed_batches"], waits) == (30, 2, 1, [5])
    assert out["last_result"] == {"status": "accepted"} and sent == [30, 30, 30]
    state = frame(spark, [("a", 1), ("b", 2)], "k string, v int")
    change = frame(spark, [("b", 3), ("c", 4)], "k string, v int")
    once = submit.upsert(state, change, ["k"], compare=["v"])
    assert {r.k: (r.v, r.outcome) for r in once.collect()} == {"a": (1, "kept"), "b": (3, "updated"), "c": (4, "inserted")}
    assert {r.outcome for r in submit.upsert(once.drop("outcome"), change, ["k"], compare=["v"]).collect()} == {"kept", "duplicate"}


def test_joins_leases_and_stats(spark):
    left = frame(spark, [(1, "a"), (2, None), (3, "")], "id int, k string")
    right = frame(spark, [("a", 5), ("", 6), (None, 7)], "k string, v int")
    assert [(r.id, r.v) for r in joins.dependent(left, right, {"k": "k"}).collect()] == [(1, 5)]
    q = frame(spark, [(1,), (2,), (3,)], "id int")
    now = F.lit("2026-01-01 12:00:00").cast("timestamp")
    leases = frame(spark, [(1, "t1", "2026-01-01 13:00:00", "running"), (2, "t2", "2026-01-01 11:00:00", "running")], "id int, token string, e string, state string").withColumn("expires_at", F.col("e").cast("timestamp")).drop("e")
    assert [r.id for r in joins.claim(q, leases, key="id", order=[F.col("id")], now=now, limit=5).collect()] == [2, 3]
    calls = frame(spark, [(1, "t1", "complete"), (2, "t2", "renew"), (9, "x", "fail")], "id int, token string, action string")
    answers = joins.settle(leases, calls, key="id", now=now)
    assert {r.id: r.status for r in answers.collect()} == {1: 200, 2: 409, 9: 409}
    assert {r.id: r.state for r in joins.apply_calls(leases, answers, key="id", now=now, seconds=60).collect()} == {1: "done", 2: "running"}
    m = stats.counter_map(right, "k", {"big": F.col("v") > 5}).collect()
    assert {r.k: r.counters["big"] for r in m} == {"a": 0, "": 1, None: 1}
    primary, fallback = frame(spark, [("a", 1)], "g string, x int"), frame(spark, [("a", 2), ("b", 3)], "g string, x int")
    assert sorted(r.x for r in joins.coalesce_relations(primary, fallback, "g").collect()) == [1, 3]
