"""De-duplication (D1-D3) against definitions written as lookups over all rows before."""

import datetime as dt
import random
from bisect import bisect_left

import pytest
from pyspark.sql import functions as F

from eventloom.operators import stretches
from eventloom.operators.dedupe import AcceptCounter, dedupe_fifo, dedupe_first, dedupe_within_horizon, mark_fifo, mark_horizon

SCHEMA = "source string, source_event_endpoint string, source_event_id string, seq long, body string"


def fifo_by_definition(ids, size):
    """Positions of the accepted: an id is refused if it is among the last ``size`` accepted."""
    accepted = []
    for i, v in enumerate(ids):
        if v not in [ids[j] for j in accepted[-size:]]:
            accepted.append(i)
    return accepted


def frame(spark, ids, scope="harbour"):
    return spark.createDataFrame([("ferry", scope, str(v), i, f"p{i}") for i, v in enumerate(ids)], SCHEMA)


def accepted(df):
    return sorted(r.seq for r in df.collect())


STREAMS = {
    "few ids": lambda r: [r.randrange(9) for _ in range(1500)],
    "more ids than memory": lambda r: [r.randrange(60) for _ in range(1500)],
    "hardly a repeat": lambda r: [r.randrange(4000) for _ in range(1500)],
    "one hot id": lambda r: [0 if r.random() < 0.4 else r.randrange(300) for _ in range(1500)],
    "overlapping polls": lambda r: [i for p in range(60) for i in range(10 * p, 10 * p + 30)],
    "a cycle longer than the memory": lambda r: list(range(40)) * 30,
    "a cycle shorter than the memory": lambda r: list(range(5)) * 200,
    "all new, then all again, twice": lambda r: list(range(500)) * 3,
}


@pytest.mark.parametrize("name", STREAMS)
@pytest.mark.parametrize("size,chunk", [(1, 200), (7, 170), (25, 400)])
def test_fifo_in_chunks(spark, name, size, chunk):
    ids = STREAMS[name](random.Random(size))
    assert accepted(dedupe_fifo(frame(spark, ids), max_size=size, chunk_rows=chunk)) == fifo_by_definition(ids, size)


def test_a_counter_that_starts_blind_is_never_wrong():
    """Whatever the memory was, a decided row is decided as it would have been, and so is the memory at the end."""
    r = random.Random(3)
    for _ in range(300):
        size, universe = r.randint(1, 6), r.randint(2, 20)
        before, after = ([r.randrange(universe) for _ in range(r.randint(0, 30))] for _ in range(2))
        sighted = set(before)
        exact, blind = AcceptCounter(size, []), AcceptCounter(size, None)
        for v in before:
            exact.take(v)
        for v in after:
            truth, guess = exact.take(v), blind.take(v, first_sighting=v not in sighted)
            sighted.add(v)
            assert guess is None or guess == truth
        assert blind.memory() is None or blind.memory() == exact.memory()[-size:]


def test_fifo_scopes_do_not_mix(spark):
    r = random.Random(8)
    parts = {s: [r.randrange(30) for _ in range(r.randint(50, 400))] for s in ("a", "b", "c")}
    df = None
    for s, ids in parts.items():
        df = frame(spark, ids, s) if df is None else df.unionByName(frame(spark, ids, s))
    got = sorted((x.source_event_endpoint, x.seq) for x in dedupe_fifo(df, max_size=6, chunk_rows=90).collect())
    assert got == [(s, i) for s in sorted(parts) for i in fifo_by_definition(parts[s], 6)]


def test_fifo_rows_are_untouched_and_marked(spark):
    df = frame(spark, [4, 5, 4]).withColumn("payload", F.parse_json(F.lit('{"deck": 1}')))
    assert dedupe_fifo(df).columns == df.columns
    assert sorted((r.seq, r.is_duplicate, r.body) for r in mark_fifo(df).collect()) == [(0, False, "p0"), (1, False, "p1"), (2, True, "p2")]
    assert dedupe_fifo(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        dedupe_fifo(df, max_size=0)


def test_tied_arrivals_fail(spark):
    tied = frame(spark, [1, 2, 1, 3]).withColumn("seq", F.lit(7).cast("long"))
    with pytest.raises(Exception, match="same arrival order"):
        dedupe_fifo(tied).collect()
    with pytest.raises(Exception, match="same arrival order"):
        dedupe_first(tied).collect()


def test_first_wins(spark):
    r = random.Random(5)
    rows = [("ferry", "harbour", str(0 if r.random() < 0.4 else r.randrange(300)), None if r.random() < 0.01 else i, f"p{i}") for i in r.sample(range(10**6), 3000)]
    by_key = {}
    for row in rows:
        by_key.setdefault(row[2], []).append(row)
    single_null = {k: v for k, v in by_key.items() if sum(x[3] is None for x in v) <= 1}
    df = spark.createDataFrame([x for v in single_null.values() for x in v], SCHEMA)
    want = {k: min(v, key=lambda x: (x[3] is None, x[3]))[3:] for k, v in single_null.items()}
    got = dedupe_first(df)
    assert {x.source_event_id: (x.seq, x.body) for x in got.collect()} == want and got.columns == df.columns


def test_first_wins_aggregates_narrow_rows_and_sorts_no_full_row(spark):
    plan = dedupe_first(frame(spark, [1, 1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort [" not in plan and "Aggregate" not in plan  # the narrow aggregation is stored before
    assert "ShuffledHashJoin" in plan or "BroadcastHashJoin" in plan


def horizon_by_definition(rows, horizon):
    last, out = {}, []
    for key, t, seq in sorted(rows, key=lambda x: (x[1], x[2])):
        if key not in last or t - last[key] >= horizon:
            last[key] = t
            out.append(seq)
    return sorted(out)


@pytest.mark.parametrize("gap", [0.2, 3, 40])
def test_horizon_over_a_table(spark, gap):
    r = random.Random(int(gap * 10))
    start, minute = dt.datetime(2031, 3, 4), dt.timedelta(minutes=1)
    rows, t = [], start
    for i in range(1200):
        t += minute * r.expovariate(1 / gap)
        rows.append((0 if r.random() < 0.4 else r.randrange(20), t.replace(microsecond=t.microsecond // 1000 * 1000), i))
    rows += [(k, t, i + 5000) for k, t, i in rows[::40]]  # the same key at the same time
    df = spark.createDataFrame([("ferry", "harbour", str(k), i, t.isoformat(timespec="milliseconds") + "+00:00") for k, t, i in rows],
                               "source string, source_event_endpoint string, source_event_id string, seq long, observed_at string")
    got = dedupe_within_horizon(df, "10 minutes", order=["seq"])
    assert accepted(got) == horizon_by_definition(rows, 10 * minute) and got.columns == df.columns
    with pytest.raises(Exception, match="same order"):
        dedupe_within_horizon(df, "10 minutes").collect()


def test_horizon_without_a_time(spark):
    df = spark.createDataFrame([("ferry", "h", "1", 1, None), ("ferry", "h", "1", 2, None)], "source string, source_event_endpoint string, source_event_id string, seq long, observed_ts timestamp")
    assert [r.is_duplicate for r in mark_horizon(df).collect()] == [False, False]


@pytest.mark.parametrize("chunk_rows", [7, 60, 10**6])
def test_horizon_of_keys_that_never_pause(spark, chunk_rows):
    """One key that is dense, one far denser than a chunk in a horizon, and others between them, over chunks of all sizes."""
    r = random.Random(chunk_rows)
    start = dt.datetime(2031, 3, 4)
    rows = []
    for key, gap, n in (("a", 100, 300), ("b", 9, 400), ("c", 700, 60), ("d", 3000, 20), ("e", 1, 40)):
        t = start
        for _ in range(n):
            t += dt.timedelta(seconds=r.randint(1, 2 * gap))
            rows.append((key, t, len(rows)))
    df = spark.createDataFrame([("ferry", "harbour", k, i, t) for k, t, i in rows], "source string, source_event_endpoint string, source_event_id string, seq long, observed_ts timestamp")
    got = mark_horizon(df, "10 minutes", order=["seq"], chunk_rows=chunk_rows)
    assert accepted(got.where("NOT is_duplicate")) == horizon_by_definition(rows, dt.timedelta(minutes=10))


def test_effects_compose():
    """A chunk's effect on every entry equals the walk."""
    r = random.Random(3)
    for _ in range(200):
        times = sorted(r.sample(range(1000), r.randint(1, 60)))
        span = r.choice([1, 7, 50, 400, 5000])
        bounds, exits = stretches.effect(times, 0, len(times), span)
        assert bounds == sorted(set(bounds)) and len(bounds) == len(exits) <= len(times)
        for entry in [stretches.OPEN, *range(0, 1010, 13)]:
            out = entry
            for t in times:
                if t >= out:
                    out = t + span
            assert out == (exits[bisect_left(bounds, entry)] if entry <= bounds[-1] else entry)


def test_small_chunks_do_not_become_ever_more_tasks(spark, monkeypatch):
    assert [stretches.chunk_number(n, 200) for n in (0, 150, 1000, 36_000_000)] == [1, 1, 5, stretches.MOST_CHUNKS]
    assert stretches.chunk_number(10**9, 200) == 4000  # a chunk has CHUNK_ROWS at most
    monkeypatch.setattr(stretches, "MOST_CHUNKS", 6)
    made = []
    repartition = type(spark.range(0)).repartitionByRange
    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", lambda self, n, *a: made.append(n) or repartition(self, n, *a))
    begin = dt.datetime(2031, 3, 4)
    df = spark.createDataFrame([("harbour", "1", i, begin + dt.timedelta(minutes=i)) for i in range(600)], "source_event_endpoint string, source_event_id string, seq long, observed_ts timestamp")
    got = mark_horizon(df, "10 minutes", ["source_event_endpoint", "source_event_id"], order=["seq"], chunk_rows=2)
    assert sorted(r.seq for r in got.where("NOT is_duplicate").collect()) == list(range(0, 600, 10))
    assert made == [6]


def test_fifo_sorts_no_full_row_and_replays_beginnings_only(spark, monkeypatch):
    from eventloom.operators import dedupe

    replayed = []
    real = dedupe.stored
    monkeypatch.setattr(dedupe, "stored", lambda df, name: (out := real(df, name), replayed.append((name, out.count())))[0])
    ids = [i for p in range(60) for i in range(10 * p, 10 * p + 30)]
    marked = mark_fifo(frame(spark, ids), max_size=40, chunk_rows=300)
    plan = marked._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    counts = dict(replayed)
    refused = len(ids) - len(fifo_by_definition(ids, 40))
    chunks = counts["fifo-chunks"]
    assert marked.where("is_duplicate").count() == refused == counts["fifo-rejected"]
    assert counts["fifo-ends"] - chunks > refused / 2  # most are decided in the pass over all chunks
    assert [n for n, _ in replayed].count("fifo-done") == 1


def test_fifo_ties_of_null_and_nan(spark):
    schema = "source string, source_event_endpoint string, source_event_id string, seq double"
    for at in (None, float("nan")):
        df = spark.createDataFrame([("a", "b", "1", at), ("a", "b", "2", at)], schema)
        with pytest.raises(Exception, match="same arrival order"):
            mark_fifo(df).collect()
    df = spark.createDataFrame([("a", None, "1", None), ("a", None, "1", float("nan")), (None, None, "1", 0.0)], schema)
    assert sorted((r.source or "", r.is_duplicate) for r in mark_fifo(df).collect()) == [("", False), ("a", False), ("a", True)]
