"""The pipeline's near copies against all pairs."""

import random
from itertools import combinations

import brute
import pytest
from test_pipeline_ids import SMALL, frame, prose, stage

from cartwright.llm import near_copies


def shingles(text):
    w = [x.lower() for x in brute.words(text, brute.VISIBLE)]
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 0.0


def replaced(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"x{rng.randrange(5000)}"
    return out


def test_similar_pairs_are_all_pairs(spark):
    rng, texts = random.Random(5), [None, "", " \n", "a b", "A  b", "a b c"]
    for n in (100, 300, 1000):
        for _ in range(20):
            words = prose(rng, n)
            texts += [" ".join(words), " ".join(replaced(rng, words, rng.randrange(1, n // 25)))]
    family = prose(rng, 200)
    texts += [" ".join(replaced(rng, family, rng.randrange(3))) for _ in range(60)]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, text string").repartition(4)
    got = {(min(r), max(r)) for r in near_copies.similar(docs, "id").collect()}
    want = {(a, b) for a, b in combinations(range(len(texts)), 2) if jaccard(texts[a], texts[b]) >= 0.8}
    assert got <= want
    of = lambda pairs: brute.components([(i, i) for i in range(len(texts))] + sorted(pairs))
    assert of(got) == of(want)
    assert len(want) > 500


def test_a_near_copy_goes_and_a_distant_one_stays(spark):
    rng = random.Random(1)
    words = prose(rng, 400)
    near, far = replaced(rng, words, 6), replaced(rng, words, 30)
    texts = {1: " ".join(words), 2: " ".join(near), 3: " ".join(far)}
    assert 0.8 <= jaccard(texts[1], texts[2]) < 0.95 and max(jaccard(texts[1], texts[3]), jaccard(texts[2], texts[3])) < 0.6
    fps = {i: brute.fingerprint(x) for i, x in texts.items()}
    assert all((fps[a] ^ fps[b]).bit_count() > 4 for a, b in combinations(fps, 2))
    kept = stage("simhash_near_dedup")(spark, frame(spark, texts.items()), SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def crowd(rng, rows, pairs):
    """Texts at 0.785 of each other, so no two are similar, but for pairs that share two of their changes."""
    words, texts = prose(rng, 1000), []
    for i in range(rows):
        at = rng.sample(range(0, 1000, 5), 12)
        changes = {k: f"x{i}y{k}" for k in at}
        texts.append(changes)
    middle = list(range(rows // 3, rows // 3 + 2 * pairs))
    for a, b in zip(middle[::2], middle[1::2]):
        for k in list(texts[b])[:2]:
            del texts[b][k]
        texts[b].update(list(texts[a].items())[:2])
    return [" ".join(changes.get(k, x) for k, x in enumerate(words)) for changes in texts]


@pytest.mark.parametrize("cell_shingles", [near_copies.CELL_SHINGLES, 60_000])
def test_rows_of_a_crowded_key_all_meet(spark, cell_shingles):
    texts = crowd(random.Random(11), 400, 30)
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id long, text string").repartition(4)
    got = {(min(r), max(r)) for r in near_copies.similar(docs, "id", cell_shingles=cell_shingles).collect()}
    sets = [shingles(x) for x in texts]
    both = lambda a, b: len(sets[a] & sets[b])
    want = {(a, b) for a, b in combinations(range(len(sets)), 2) if (n := both(a, b)) / (len(sets[a]) + len(sets[b]) - n) >= 0.8}
    assert got <= want and len(want) >= 30
    of = lambda pairs: brute.components([(i, i) for i in range(len(texts))] + sorted(pairs))
    assert of(got) == of(want)


def test_texts_are_not_shuffled(spark, tmp_path, monkeypatch):
    rng, plans = random.Random(3), {}
    words = prose(rng, 100)
    rows = [(1, " ".join(words)), (2, " ".join(replaced(rng, words, 1))), (3, " ".join(prose(rng, 100)))]
    spark.createDataFrame(rows, "id long, text string").write.parquet(f"{tmp_path}/docs")

    def noted(df, name, **options):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return made(df, name, **options)

    made = near_copies.stage
    monkeypatch.setattr(near_copies, "stage", noted)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [tuple(sorted(r)) for r in near_copies.similar(spark.read.parquet(f"{tmp_path}/docs"), "id").collect()] == [(1, 2)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "text" in plans["near-sets"] and "Exchange" not in plans["near-sets"]
