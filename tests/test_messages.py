"""Book maintenance: batch windows and the stream against a plain replay."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidebook.operators import messages as M
from tidebook.schema import L2_MESSAGE
from tidebook.sources.messages import MICROS, read_l2_messages
from tidebook.streaming import book_state as B


@pytest.fixture(scope="module")
def feed():
    """Messages of two symbols with clears, unknown updates, repeated inserts and deletes."""
    rnd = random.Random(7)
    start, rows = datetime(2024, 5, 1), []
    for symbol in ("A", "B"):
        at = start
        for seq in range(300):
            at += timedelta(seconds=rnd.randint(1, 40))
            action = "partial" if seq % 90 == 10 else rnd.choice(["insert", "update", "update", "delete"])
            ids = rnd.sample(range(12), rnd.randint(1, 4))
            data = [(i, 100.0 + rnd.randint(0, 20), float(rnd.randint(1, 9)), rnd.choice(["Buy", "Sell"])) for i in ids]
            rows.append(("orderBookL2", symbol, seq, at, action, data))
        rows.append(("trade", symbol, 999, at, "insert", [(1, 1.0, 1.0, "Buy")]))
    return rows


def replay(feed, symbol, until=None):
    book = {}
    for table, s, _, ts, action, data in feed:
        if table != "orderBookL2" or s != symbol or (until and ts > until):
            continue
        if action == "partial":
            book.clear()
        for i, price, size, side in data:
            if action in ("partial", "insert"):
                book[i] = (price, size, side)
            elif action == "update" and i in book:
                book[i] = (book[i][0], size, book[i][2])
            elif action == "delete":
                book.pop(i, None)
    return book


@pytest.fixture(scope="module")
def entries(spark, feed):
    return M.flatten_messages(spark.createDataFrame(feed, L2_MESSAGE))


def books(rows):
    out = {}
    for r in rows:
        out.setdefault(r["symbol"], {})[r["id"]] = (r["price"], r["size"], r["side"])
    return out


def test_batch_book_at_end_and_over_time(spark, feed, entries):
    # Blocks of 9 messages, carried in ranges of 5 blocks.
    few = [tuple(r) for r in M.book_intervals(entries, 9, 5).collect()]
    intervals = M.book_intervals(entries, 40).persist()
    assert sorted(few, key=repr) == sorted((tuple(r) for r in intervals.collect()), key=repr)
    assert books(M.book_at_end(intervals).collect()) == {s: replay(feed, s) for s in "AB"}
    levels = M.sample_levels(intervals, M.last_time(entries), "5 minutes").collect()
    ticks = {r["tick"] for r in levels}
    assert len(ticks) > 10
    for t in ticks:
        have = books([r for r in levels if r["tick"] == t])
        for s in "AB":
            assert have.get(s, {}) == replay(feed, s, t), (s, t)


def test_stream_equals_batch(spark, feed, entries, tmp_path):
    src = str(tmp_path / "in")
    df = spark.createDataFrame(feed, L2_MESSAGE)
    for i, part in enumerate((df.filter("seq < 120"), df.filter("seq >= 120"))):
        part.coalesce(1).write.mode("append").option("timestampFormat", MICROS).json(src)
    stream = read_l2_messages(spark, src, streaming=True)
    changes, levels = str(tmp_path / "changes"), str(tmp_path / "levels")
    B.run_available(B.maintain_book(stream), changes, str(tmp_path / "cp1"))
    assert books(B.current_book(spark.read.parquet(changes)).collect()) == {s: replay(feed, s) for s in "AB"}
    B.run_available(B.maintain_book(stream, "snapshots", "5 minutes"), levels, str(tmp_path / "cp2"))
    until = M.last_time(entries) - timedelta(minutes=1)
    want = M.sample_levels(M.book_intervals(entries, 100000), until, "5 minutes").filter(F.col("tick") < F.lit(until))
    cols = ["symbol", "tick", "id", "price", "size", "side"]
    got = sorted(map(tuple, spark.read.parquet(levels).select(*cols).filter(F.col("tick") < F.lit(until)).collect()))
    assert got == sorted(map(tuple, want.select(*cols).collect()))


def test_sides_are_sorted(spark, entries):
    snaps = M.sample_snapshots(M.book_intervals(entries), M.last_time(entries), "5 minutes").collect()
    for r in snaps:
        assert [x[0] for x in r.bids] == sorted((x[0] for x in r.bids), reverse=True)
        assert [x[0] for x in r.asks] == sorted(x[0] for x in r.asks)


def test_final_book_of_the_given_events(spark):
    from tidebook.contract.fixtures import entries as given

    assert M.book_at_end(M.book_intervals(given(spark, "/root/testdata/sf0.01"))).count() == 93


def at(minute):
    return datetime(2024, 1, 1, 0, minute)


@pytest.fixture(scope="module")
def gaps():
    """An empty partial clears the book; nothing is live until the next insert. The second symbol starts empty."""
    level = lambda i, price: (i, float(price), 5.0, "Buy")
    return [
        ("orderBookL2", "A", 1, at(0), "partial", [level(1, 10), level(2, 11)]),
        ("orderBookL2", "A", 2, at(3), "partial", []),
        ("orderBookL2", "A", 3, at(4), "update", []),
        ("orderBookL2", "A", 4, at(6), "insert", [level(3, 12)]),
        ("orderBookL2", "B", 5, at(1), "partial", []),
        ("orderBookL2", "B", 6, at(5), "insert", [level(1, 9)]),
    ]


def as_messages(spark, rows):
    names = ["table", "symbol", "seq", "ts", "action", "data"]
    return spark.createDataFrame([tuple(dict(zip(names, r))[c] for c in L2_MESSAGE.fieldNames()) for r in rows], L2_MESSAGE)


def test_empty_partial_clears_and_empty_ticks_stay(spark, gaps, tmp_path):
    messages = as_messages(spark, gaps)
    rows = M.flatten_messages(messages)
    assert rows.filter("id is null").count() == 2
    intervals = M.book_intervals(rows, 2)
    assert books(M.book_at_end(intervals).collect()) == {"A": {3: (12.0, 5.0, "Buy")}, "B": {1: (9.0, 5.0, "Buy")}}
    snaps = M.sample_snapshots(intervals, at(7), "1 minute", rows).orderBy("symbol", "tick").collect()
    live = {(r.symbol, r.tick.minute): len(r.bids) for r in snaps}
    want = {("A", m): 2 if m < 3 else 0 if m < 6 else 1 for m in range(0, 8)} | {("B", m): 0 if m < 5 else 1 for m in range(1, 8)}
    assert live == want and all(r.asks == [] for r in snaps)
    src, changes = str(tmp_path / "in"), str(tmp_path / "changes")
    messages.coalesce(1).write.option("timestampFormat", MICROS).json(src)
    B.run_available(B.maintain_book(read_l2_messages(spark, src, streaming=True)), changes, str(tmp_path / "cp"))
    assert books(B.current_book(spark.read.parquet(changes)).collect()) == books(M.book_at_end(intervals).collect())


def delayed(feed):
    """Files of arrival order: every fifth message of A arrives 30 messages late."""
    arrival = lambda m: m[2] + (30 if m[1] == "A" and m[2] % 5 == 0 else 0)
    return [[m for m in feed if m[0] == "orderBookL2" and arrival(m) // 80 == k] for k in range(5)]


def test_late_entries_are_counted_and_left_out(spark, feed, tmp_path):
    import duckdb

    src, table = str(tmp_path / "in"), str(tmp_path / "changes")
    parts = delayed(feed)
    for part in parts:
        as_messages(spark, part).coalesce(1).write.mode("append").option("timestampFormat", MICROS).json(src)
    stream = read_l2_messages(spark, src, streaming=True, maxFilesPerTrigger=1)
    counts = B.run_available(B.maintain_book(stream, buckets=1), table, str(tmp_path / "cp"))
    assert counts["behind_watermark"] == 0
    con = duckdb.connect()
    con.execute("CREATE TABLE e (file INT, symbol TEXT, seq INT, id INT)")
    con.executemany("INSERT INTO e VALUES (?, ?, ?, ?)", [(k, m[1], m[2], x[0]) for k, part in enumerate(parts) for m in part for x in m[5]])
    want = con.execute("""SELECT symbol, count(*), count(DISTINCT id) FROM (SELECT *, max(seq) OVER (PARTITION BY symbol ORDER BY file
        RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM e) WHERE seq <= before GROUP BY symbol""").fetchall()
    changes = spark.read.parquet(table)
    assert sorted(map(tuple, B.late_entries(changes).collect())) == sorted(want) and [w[0] for w in want] == ["A"]
    late, most = set(), {}
    for part in parts:
        late |= {(m[1], m[2]) for m in part if m[2] <= most.get(m[1], -1)}
        for m in part:
            most[m[1]] = max(most.get(m[1], -1), m[2])
    kept = [m for m in feed if (m[1], m[2]) not in late]
    assert books(B.current_book(changes).collect()) == {s: replay(kept, s) for s in "AB"}


def test_entries_behind_the_watermark_are_counted(spark, feed, tmp_path):
    src, table = str(tmp_path / "in"), str(tmp_path / "levels")
    own = [m for m in feed if m[1] == "B"]
    for part in (own[50:150], own[150:250], own[:3]):
        as_messages(spark, part).coalesce(1).write.mode("append").option("timestampFormat", MICROS).json(src)
    stream = read_l2_messages(spark, src, streaming=True, maxFilesPerTrigger=1)
    counts = B.run_available(B.maintain_book(stream, "snapshots", "5 minutes", buckets=2), table, str(tmp_path / "cp"))
    assert counts["behind_watermark"] == sum(len(m[5]) for m in own[:3] if m[0] == "orderBookL2")


class FakeMap:
    """A map state that counts what is read and written."""

    def __init__(self, rows):
        self.rows, self.reads, self.writes = dict(rows), 0, 0

    def getValue(self, key):
        self.reads += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self.rows[key] = value

    def removeKey(self, key):
        self.writes += 1
        self.rows.pop(key, None)

    def iterator(self):
        return iter(self.rows.items())

    def clear(self):
        self.rows = {}


def test_only_named_levels_are_read_and_changed_ones_written():
    state = FakeMap({(i,): (float(i), 1.0, "Buy") for i in range(1000)})
    levels = B._Levels(state)
    levels.put(5, (5.0, 2.0, "Buy"))
    levels.put(5, (5.0, 3.0, "Buy"))
    levels.put(7, None)
    assert levels.get(9) and levels.get(9) and levels.get(5000) is None
    levels.write()
    assert state.reads == 2 and state.writes == 2 and len(state.rows) == 999
    assert len(levels.live()) == 999 and len(levels.clear()) == 999 and not state.rows and levels.live() == []


def test_frames_are_merged_in_order():
    import pandas as pd

    def frame(seqs):
        return pd.DataFrame({"seq": seqs, "pos": 0, "us": 1, "action": "insert", "id": [None if s == 4 else s for s in seqs], "price": 1.0, "size": 1.0, "side": "Buy"})

    rows = list(B._in_order(iter([frame([5, 1, 9]), frame([4, 2]), frame([])])))
    assert [r[0] for r in rows] == [1, 2, 4, 5, 9] and [r[4] for r in rows] == [1, 2, -1, 5, 9]
