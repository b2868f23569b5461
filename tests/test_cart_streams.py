import random

import pytest
from pyspark.sql import functions as F

from cartwright import lineage
from cartwright.plans import cart
from cartwright.streaming import cart_store
from cartwright.streaming.cart import apply_batch as cart_batch
from cartwright.streaming.cart import cart_state_stream

EVENTS = "event_id long, ts timestamp, user_id long, product_id long, action string, delta int"


def events(spark, rows):
    stamped = [(i, t, u, p, a, d) for i, (t, u, p, a, d) in enumerate(rows)]
    raw = spark.createDataFrame(stamped, "event_id long, s long, user_id long, product_id long, action string, delta int")
    return raw.select("event_id", F.timestamp_seconds("s").alias("ts"), "user_id", "product_id", "action", "delta")


def state(df):
    return {(r.user_id, r.product_id): r.qty for r in df.collect()}


def apply_actions(qty, actions, deltas):
    """Replay actions on a quantity one by one; an absent item has quantity 0."""
    for action, delta in zip(actions, deltas):
        if action == "add":
            qty += 1
        elif action == "remove":
            qty = 0
        elif qty > 0:
            qty = max(qty + delta, 0)
    return qty


def replay(rows):
    out = {}
    for t, u, p, a, d in sorted(rows, key=lambda r: r[0]):
        out.setdefault((u, p), []).append((a, d))
    folded = {k: apply_actions(0, *zip(*v)) for k, v in out.items()}
    return {k: q for k, q in folded.items() if q > 0}


def test_small_log(spark):
    rows = [
        (1, 1, 1, "add", 0), (2, 1, 1, "delta", -1), (3, 1, 1, "delta", 1), (4, 1, 1, "add", 0), (5, 1, 1, "delta", 2),
        (1, 1, 2, "delta", -1), (2, 1, 2, "delta", 3), (1, 2, 1, "add", 0), (2, 2, 1, "remove", 0), (3, 2, 1, "add", 0),
        # Late in the log, early in time.
        (9, 3, 1, "add", 0), (4, 3, 1, "remove", 0),
    ]
    got = state(cart.cart_state(events(spark, rows)))
    assert got == {(1, 1): 3, (2, 1): 1, (3, 1): 1} == replay(rows)


@pytest.mark.parametrize("chunk,hot_rows", [(65536, 10**6), (4, 100)])
def test_random_log_with_a_hot_item(spark, chunk, hot_rows):
    rng = random.Random(5)
    rows = []
    for t in range(900):
        key = (1, 1) if t % 3 == 0 else (rng.randrange(6), rng.randrange(5))
        action = rng.choices(["add", "delta", "remove"], [5, 6, 1])[0]
        rows.append((t * 37, *key, action, rng.choice([-3, -2, -1, 1, 2]) if action == "delta" else 0))
    got = state(cart.cart_state(events(spark, rows), chunk, hot_rows))
    assert got == replay(rows)


def test_totals(spark):
    s = spark.createDataFrame([(1, 1, 2), (1, 2, 1), (2, 9, 4)], "user_id long, product_id long, qty long")
    p = spark.createDataFrame([(1, 1.5), (2, 4.0)], "product_id long, price double")
    got = {r.user_id: tuple(r)[1:] for r in cart.cart_totals(s, p).collect()}
    assert got == {1: (2, 3, 7.0), 2: (1, 4, 0.0)}


def run_stream(spark, tmp_path):
    source = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    places = [str(tmp_path / name) for name in ("out", "state", "checkpoint")]
    cart_state_stream(source, *places).awaitTermination()
    rows = spark.read.parquet(places[0])
    return rows, rows.groupBy("user_id", "product_id").agg(F.max_by("qty", "batch").alias("qty"))


def arrive(spark, tmp_path, rows, first_id=0):
    """One more file of events."""
    stamped = [(first_id + i, t, u, p, a, d) for i, (t, u, p, a, d) in enumerate(rows)]
    raw = spark.createDataFrame(stamped, "event_id long, s long, user_id long, product_id long, action string, delta int")
    raw = raw.withColumn("ts", F.timestamp_seconds("s")).select("event_id", "ts", "user_id", "product_id", "action", "delta")
    raw.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def test_state_carries_over_micro_batches(spark, tmp_path):
    arrive(spark, tmp_path, [(1, 1, 1, "add", 0), (2, 1, 1, "add", 0), (1, 1, 2, "add", 0), (3, 3, 3, "add", 0)])
    run_stream(spark, tmp_path)
    arrive(spark, tmp_path, [(5, 1, 1, "delta", -1), (6, 1, 2, "remove", 0), (7, 2, 2, "add", 0)], 10)
    rows, latest = run_stream(spark, tmp_path)
    assert state(latest) == {(1, 1): 1, (1, 2): 0, (2, 2): 1, (3, 3): 1}
    assert rows.where("batch = 1").count() == 3


def test_late_events_apply_when_they_arrive(spark, tmp_path):
    """By event time the removal comes first and one item is left; by arrival it empties the cart."""
    files = [[(5, 1, 1, "add", 0), (9, 1, 2, "add", 0)], [(7, 1, 1, "delta", 2)], [(2, 1, 1, "remove", 0), (3, 1, 2, "add", 0)]]
    for i, rows in enumerate(files):
        arrive(spark, tmp_path, rows, 10 * i)
    rows, latest = run_stream(spark, tmp_path)
    assert rows.select("batch").distinct().count() == 3
    assert state(latest) == {(1, 1): 0, (1, 2): 2}
    everything = [r for rows in files for r in rows]
    assert state(cart.cart_state(events(spark, everything))) == replay(everything) == {(1, 1): 3, (1, 2): 2}


def test_random_log_in_order_of_files(spark, tmp_path):
    rng = random.Random(8)
    rows = [
        (t, rng.randrange(3), rng.randrange(4), rng.choice(["add", "add", "delta", "remove"]), rng.choice([-2, -1, 1, 2])) for t in range(300)
    ]
    rows = [(t, u, p, a, d if a == "delta" else 0) for t, u, p, a, d in rows]
    for i in range(3):
        arrive(spark, tmp_path, rows[i * 100 : i * 100 + 100], 100 * i)
    _, latest = run_stream(spark, tmp_path)
    assert {k: q for k, q in state(latest).items() if q} == replay(rows)


def test_staged_tables_of_a_scope_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "folder", lambda s: str(tmp_path))
    kept = lineage.stage(spark.range(3), "kept")
    with lineage.temporary():
        lineage.stage(spark.range(3), "gone")
    assert kept.count() == 3
    assert [p.name.split("-")[0] for p in (tmp_path / "cartwright").iterdir()] == ["kept"]


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(cart_store, "BUCKETS", 4)


def batches(rng, n, size, users=30):
    """Actions in the order of their arrival, which is that of their time."""
    out, t = [], 0
    for _ in range(n):
        rows = []
        for _ in range(size):
            t += 1
            action = rng.choice(["add", "add", "delta", "remove"])
            rows.append((t, rng.randrange(users), rng.randrange(4), action, rng.choice([-2, -1, 1, 2]) if action == "delta" else 0))
        out.append(rows)
    return out


def apply_all(spark, tmp_path, parts, first=0):
    for i, rows in enumerate(parts, first):
        cart_batch(events(spark, rows), i, str(tmp_path / "out"), str(tmp_path / "state"))


def test_a_batch_writes_what_it_touches(spark, tmp_path, monkeypatch):
    """A large first batch, then small ones: their runs hold their own items, and the base stays."""
    monkeypatch.setattr(cart_store, "SMALL_BASE", 10)
    rng = random.Random(3)
    parts = batches(rng, 1, 400) + batches(rng, 3, 5)
    parts = [[(1000 * i + t, *rest) for t, *rest in rows] for i, rows in enumerate(parts)]
    apply_all(spark, tmp_path, parts)
    now = cart_store.latest(spark, str(tmp_path / "state"))
    assert [n for n, _ in now.base] == ["base-0"] and [n for n, _ in now.changes] == ["batch-1", "batch-2", "batch-3"]
    assert all(rows <= 5 for _, rows in now.changes)
    assert state(cart_store.read_carts(spark, str(tmp_path / "state"))) == replay([r for rows in parts for r in rows])


def test_compaction_keeps_the_state_and_drops_old_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cart_store, "MANY_RUNS", 3)
    monkeypatch.setattr(cart_store, "SMALL_BASE", 60)
    parts = batches(random.Random(4), 8, 6)
    apply_all(spark, tmp_path, parts)
    place = str(tmp_path / "state")
    assert state(cart_store.read_carts(spark, place)) == replay([r for rows in parts for r in rows])
    now = cart_store.latest(spark, place)
    kept = {p.name.removeprefix("run=") for p in (tmp_path / "state" / "runs").iterdir()}
    assert now.folders() <= kept and kept == now.folders() | cart_store.manifest(spark, place, 6).folders()
    assert {p.name for p in (tmp_path / "state" / "manifest").iterdir()} == {"6", "7"}


def test_a_replayed_batch_gives_the_same_state(spark, tmp_path, monkeypatch):
    """A batch dies after its run is written, or is delivered again: nothing counts twice."""
    monkeypatch.setattr(cart_store, "MANY_RUNS", 2)
    parts = batches(random.Random(5), 3, 12, users=4)
    place = str(tmp_path / "state")
    apply_all(spark, tmp_path, parts[:2])
    with monkeypatch.context() as broken:
        broken.setattr(cart_store, "_write_manifest", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            apply_all(spark, tmp_path, parts[2:], 2)
    assert state(cart_store.read_carts(spark, place)) == replay([r for rows in parts[:2] for r in rows])
    for _ in range(2):
        apply_all(spark, tmp_path, parts[2:], 2)
    assert state(cart_store.read_carts(spark, place)) == replay([r for rows in parts for r in rows])


def test_an_empty_batch(spark, tmp_path):
    parts = [[], batches(random.Random(6), 1, 5)[0], []]
    apply_all(spark, tmp_path, parts)
    assert state(cart_store.read_carts(spark, str(tmp_path / "state"))) == replay(parts[1])
    assert cart_store.read_carts(spark, str(tmp_path / "nowhere")).count() == 0
