import itertools
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartwright.config import Mining
from cartwright.plans import rule_updates as updates
from cartwright.plans import rules
from cartwright.sources import run_log, set_counts as store

# Three items often bought together first, others later: sets become frequent, others no longer are, and
# the context of mornings passes its gate with the second batch.
M = Mining(min_support=0.2, level_min_txns={"L1": 12, "L2": 12, "L3": 12, "L4": 12, "L5": 0}, floor=12, least_count=2)
BATCHES = {
    "first": [("night", [1, 2, 3, 4])] * 8 + [("night", [5, 6, 7])] * 3 + [("morning", [1, 5, 6])] * 4,
    "second": [("morning", [5, 6, 7, 8])] * 9 + [("night", [1, 2])] * 2 + [("night", [9])] * 3,
    "third": [("night", [5, 6, 7, 8, 9])] * 20 + [("morning", [2, 3, 2])] * 2 + [("evening", [1, 2, 3, 4])] * 30,
}


def batch(spark, name):
    begin = 1000 * list(BATCHES).index(name)
    keys = [*(f"context_{level}" for level in rules.LEVELS)]
    rows = [(begin + i, items, *[f"{level}={time}" for level in rules.LEVELS[:-1]], "GLOBAL") for i, (time, items) in enumerate(BATCHES[name])]
    return spark.createDataFrame(rows, "order_id long, products array<long>, " + ", ".join(f"{k} string" for k in keys))


def mined_anew(names, m=M):
    """Every set of every context that is frequent in the named batches, by counting all subsets."""
    baskets = [(time, sorted(set(items))) for name in names for time, items in BATCHES[name] if len(set(items)) > 1]
    out = []
    for level in rules.LEVELS:
        sizes = Counter("GLOBAL" if level == "L5" else f"{level}={time}" for time, _ in baskets)
        counts = Counter()
        for time, items in baskets:
            key = "GLOBAL" if level == "L5" else f"{level}={time}"
            counts.update((key, s) for k in range(1, len(items) + 1) for s in itertools.combinations(items, k))
        passing = {key: n for key, n in sizes.items() if n >= max(m.level_min_txns[level], m.floor)}
        out += [
            (level, key, items, len(items), cnt, passing[key])
            for (key, items), cnt in counts.items()
            if key in passing and cnt >= max(m.least_count, math.ceil(m.min_support * passing[key]))
        ]
    return sorted(out)


def rows(df):
    return sorted((r.context_level, r.context_key, tuple(r["items"]), r["size"], r.cnt, r.n) for r in df.collect())


def test_every_batch_gives_what_mining_anew_gives(spark, tmp_path):
    path, seen = str(tmp_path / "s"), []
    assert rows(store.read(spark, path)) == []
    for i, name in enumerate(BATCHES):
        assert store.add(batch(spark, name), path, name, M)
        seen.append(rows(store.read(spark, path)))
        assert seen[-1] == mined_anew(list(BATCHES)[: i + 1])
    sets = [{(level, key, items) for level, key, items, *_ in one} for one in seen]
    # Sets became frequent, others no longer are, and a context passed its gate.
    assert sets[1] - sets[0] and sets[0] - sets[1] and sets[2] - sets[1]
    assert ("L4", "L4=morning", (5, 6, 7, 8)) in sets[1] and not any(key == "L4=morning" for _, key, _ in sets[0])
    # A batch that comes again changes nothing; states of earlier runs go, their blocks stay.
    assert not store.add(batch(spark, "first"), path, "first", M)
    assert store.expire(spark, path) == [1, 2]
    assert rows(store.read(spark, path)) == seen[-1]
    assert store.add(batch(spark, "second"), path, "second again", M)
    assert rows(store.read(spark, path)) == mined_anew([*BATCHES, "second"])


def test_other_thresholds_empty_batches_and_batches_that_die(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    loose = Mining(min_support=0.05, level_min_txns=M.level_min_txns, floor=12, least_count=2)
    assert store.add(batch(spark, "first").limit(0), path, "nothing", M)
    assert rows(store.read(spark, path)) == []
    store.add(batch(spark, "first"), path, "first", M)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(run_log, "append", dies)
        with pytest.raises(RuntimeError):
            store.add(batch(spark, "second"), path, "second", M)
    assert rows(store.read(spark, path)) == mined_anew(["first"])
    assert store.add(batch(spark, "second"), path, "second", loose)
    assert rows(store.read(spark, path)) == mined_anew(["first", "second"], loose)
    assert store.expire(spark, path) == [1, 2, 3]


def test_earlier_blocks_are_read_only_for_new_candidates(spark, monkeypatch):
    earlier = []
    real = updates._Levels.counted

    def watched(self, blocks, grown):
        earlier.append(blocks is self.before.blocks)
        return real(self, blocks, grown)

    monkeypatch.setattr(updates._Levels, "counted", watched)
    whole = Mining(min_support=0.2, level_min_txns={f"L{i}": 0 if i == 5 else 10**6 for i in range(1, 6)}, floor=1, least_count=2)
    one = updates.advance(updates.empty(spark), batch(spark, "first"), whole)
    assert earlier and not any(earlier)
    earlier.clear()
    # The same purchases again: all shares stay, so nothing becomes frequent.
    two = updates.advance(one, batch(spark, "first"), whole)
    assert earlier and not any(earlier)
    doubled = [(*row[:4], 2 * row[4], 2 * row[5]) for row in rows(updates.itemsets(one))]
    assert rows(updates.itemsets(two)) == doubled
