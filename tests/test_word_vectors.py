"""Repeatable word vectors: shards by content, exact means, documents."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from reviewlens.operators import word_vectors as WV
from reviewlens.operators.text import token_table, vocabulary
from reviewlens.plans.sentiment import prepare_features

ANIMALS, TOOLS = ["cat", "dog", "horse", "sheep"], ["saw", "hammer", "drill", "wrench"]


def texts(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, " ".join(rng.choice((ANIMALS, TOOLS)[i % 2], 12))) for i in range(n)]
    rows += [(n + i, "the a of") for i in range(3)] + [(n + 5, ""), (n + 6, None), (n + 7, "once"), (n + 8, rows[0][1]), (0, rows[0][1])]
    return spark.createDataFrame(rows, "id long, t string")


def as_dict(table):
    return {r["token"]: (r["n"], tuple(r["units"])) for r in table.collect()}


def hashed(word, dim, seed):
    h = [int(hashlib.md5(f"{word}:{seed}:{i}".encode()).hexdigest()[:8], 16) - 2**31 for i in range(dim)]
    return [int(np.floor(x * (2**30 / (dim * 2.0**32)))) for x in h]


def test_untrained_vectors_are_hashes_of_the_words(spark):
    df = texts(spark)
    got = as_dict(WV.train_word_vectors(df, "t", dim=6, passes=0)[0])
    assert got == {r["token"]: (r["n"], tuple(hashed(r["token"], 6, 42))) for r in vocabulary(df.filter("t is not null"), "t").collect()}


def test_equal_vectors_whatever_the_layout(spark):
    kwargs = dict(dim=8, passes=2, shard_tokens=500)
    df = texts(spark)
    first = as_dict(WV.train_word_vectors(df.coalesce(1), "t", **kwargs)[0])
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        second = as_dict(WV.train_word_vectors(df.repartition(7, F.rand(1)), "t", **kwargs)[0])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert first == second
    assert set(first) == set(ANIMALS + TOOLS)


def test_means_over_shards_against_plain_loops(spark):
    df = texts(spark)
    got = as_dict(WV.train_word_vectors(df, "t", dim=5, shard_tokens=900)[0])
    total = sum(r["n"] * len(r["tokens"]) for r in WV.windows(df, "t").collect())
    shards = -(-total // 900)
    assert shards > 2
    start = as_dict(WV.train_word_vectors(df, "t", dim=5, passes=0)[0])
    dealt = {}
    for r in WV.deal(WV.windows(df, "t"), shards).collect():
        dealt.setdefault(r["shard"], []).append((r["order"], list(r["tokens"])))
    assert sum(len(t) for s in dealt.values() for _, t in s) == total
    sums = {}
    for shard, rows in dealt.items():
        flat = [(w, k) for k, (_, tokens) in enumerate(sorted(rows)) for w in tokens if w in start]
        words = sorted({w for w, _ in flat})
        if not words:
            continue
        x = np.array([np.array(start[w][1]) / 2**30 for w in words], np.float32)
        y = np.zeros_like(x)
        m = np.array([sum(v == w for v, _ in flat) for w in words])
        ids, own = np.array([words.index(w) for w, _ in flat]), np.array([k for _, k in flat])
        WV.skip_gram(ids, own, x, y, m, np.random.default_rng([42, 0, shard]))
        for w, v in zip(words, np.rint(x.astype(float) * 2**30).astype(int).tolist()):
            sums.setdefault(w, []).append(v)
    want = {w: tuple(int(sum(c) / len(v)) for c in zip(*v)) for w, v in sums.items()}
    assert {w: v for w, (_, v) in got.items()} == want


def test_words_of_a_kind_come_together(spark):
    got = as_dict(WV.train_word_vectors(texts(spark, 1000), "t", dim=16, passes=3, shard_tokens=4000)[0])
    unit = {w: np.array(v) / np.linalg.norm(v) for w, (_, v) in got.items()}
    mean = lambda a, b: np.mean([unit[i] @ unit[j] for i in a for j in b if i != j])
    assert mean(ANIMALS, ANIMALS) > mean(ANIMALS, TOOLS) + 0.5
    assert mean(TOOLS, TOOLS) > mean(ANIMALS, TOOLS) + 0.5


def test_pull_and_push_are_the_gradient_of_the_loss():
    rng = np.random.default_rng(3)
    ids, own = np.array([0, 1, 2, 1, 3]), np.array([0, 0, 0, 1, 1])
    x, y = rng.normal(size=(4, 3)).astype(np.float32), rng.normal(size=(4, 3)).astype(np.float32)
    counts = np.array([1, 2, 1, 1])
    draw = np.random.default_rng(9)
    reach = draw.integers(1, WV.REACH + 1, 5)
    weights = np.cumsum(counts.astype(float) ** 0.75)
    others = np.searchsorted(weights, draw.random(WV.NEGATIVES) * weights[-1], side="right").clip(0, 3)
    pairs = [(i, j) for i in range(5) for j in range(5) if i != j and own[i] == own[j] and abs(i - j) <= reach[i]]

    def loss(x, y):
        near = sum(np.log1p(np.exp(-x[ids[i]] @ y[ids[j]])) for i, j in pairs)
        return near + sum(np.log1p(np.exp(x[ids[i]] @ y[o])) for i, _ in pairs for o in others) * WV.PER_PAIR / WV.NEGATIVES

    moved_x, moved_y = x.copy(), y.copy()
    WV.skip_gram(ids, own, moved_x, moved_y, counts, np.random.default_rng(9))
    times = np.bincount(ids, minlength=4)
    times_y = times + np.bincount(others, minlength=4)
    for which, moved, before, n in ((0, moved_x, x, times), (1, moved_y, y, times_y)):
        for k in np.ndindex(*before.shape):
            step = np.zeros(before.shape)
            step[k] = 1e-5
            up, down = ((x + s, y) if which == 0 else (x, y + s) for s in (step, -step))
            slope = (loss(*map(np.float64, up)) - loss(*map(np.float64, down))) / 2e-5
            assert (moved - before)[k] == pytest.approx(-WV.RATE * slope / np.sqrt(n[k[0]]), abs=2e-4)


def test_windows_keep_every_copy_and_token(spark, monkeypatch):
    monkeypatch.setattr(WV, "WINDOW_TOKENS", 5)
    monkeypatch.setattr(WV, "COPIES", 4)
    df = spark.createDataFrame([("w1 w2 w3 w4 w5 w6 w7",)] * 23 + [("w8",), (None,), ("",)], "t string")
    rows = WV.deal(WV.windows(df, "t"), 6).collect()
    assert sum(len(r["tokens"]) for r in rows) == 23 * 7 + 2  # an empty text has one empty token
    assert len({(tuple(r["tokens"]), r["order"]) for r in rows}) == 23 * 2 + 2
    assert len({r["shard"] for r in rows if len(r["tokens"]) == 5}) > 3  # copies spread


def test_document_vectors_against_the_mean_of_their_words(spark):
    df = texts(spark)
    words, _ = WV.train_word_vectors(df, "t", dim=4)
    vectors = {r["token"]: np.array(r["units"]) / 2**30 for r in words.collect()}
    got = WV.embed_by_words(df.withColumn("a", F.lit(1)), {"t": words}, 4, ["id", "a", "t"]).collect()
    tokens = {}
    for r in token_table(df.filter("t is not null").dropDuplicates(["id"]), "t", "id", stop_words=True).collect():
        tokens.setdefault(r["id"], []).append(r["token"])
    assert sorted(r["id"] for r in got) == sorted(r["id"] for r in df.collect())
    for r in got:
        mine = tokens.get(r["id"], [])
        want = sum((vectors.get(w, np.zeros(4)) for w in mine), np.zeros(4)) / max(1, len(mine))
        assert np.allclose(r["features"].toArray(), want, atol=1e-12)
    blank = spark.createDataFrame([(i, "") for i in range(9)] + [(9, None)], "id long, t string")
    words, _ = WV.train_word_vectors(blank, "t", dim=4, passes=0)
    known = {r["id"]: any(r["features"].toArray()) for r in WV.embed_by_words(blank, {"t": words}, 4, ["id"]).collect()}
    assert known[0] and not known[9]
    empty = df.limit(0)
    none, _ = WV.train_word_vectors(empty, "t", dim=4)
    assert none.count() == 0 and WV.embed_by_words(empty, {"t": none}, 4, ["id"]).count() == 0


def test_packed_vectors_come_back(spark):
    units = [[0, -1, 1 << 30], [-(1 << 38), (1 << 38) - 1, -(1 << 31)], [1 << 32, -(1 << 32) - 5, 7]]
    df = spark.createDataFrame([(str(i), u, u[::-1]) for i, u in enumerate(units)], "token string, units array<long>, out array<long>")
    rows = WV.packed(df, ["units", "out"]).orderBy("token").collect()
    assert WV.unpacked([r["units"] for r in rows], 3).tolist() == units
    assert WV.unpacked([r["out"] for r in rows], 3).tolist() == [u[::-1] for u in units]
    assert WV.unpacked([], 3).shape == (0, 3)


def test_a_task_holds_one_block_of_texts(spark, monkeypatch):
    df = texts(spark)
    words, _ = WV.train_word_vectors(df, "t", dim=4)
    taken = lambda: {(r["a"], r["b"]): r["vector"] for r in WV.document_vectors(df, "t", words, 4).collect()}
    whole = taken()
    monkeypatch.setattr(WV, "BLOCK_CHARS", 3000)
    monkeypatch.setattr(WV, "STRETCH", 5)
    found = WV.document_vectors(df, "t", words, 4)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "sum(" not in plan and "FlatMapCoGroupsInArrow" in plan  # no sums of vectors are shuffled
    assert len(whole) > 250 and taken() == whole


def test_features_repeat(spark, tmp_dir):
    rows = [(i, 8.0 if i % 2 else 2.0, " ".join(np.random.default_rng(i).choice((ANIMALS, TOOLS)[i % 2], 6))) for i in range(120)]
    df = spark.createDataFrame(rows, "review_id long, rating double, review_summary string")
    taken = lambda **kw: sorted(
        (r["review_id"], tuple(r["v"]))
        for r in prepare_features(df, "summary", k=3, dim=6, repeatable=True, **kw).train.select("review_id", vector_to_array("features").alias("v")).collect()
    )
    first = taken()
    assert first == taken(persist=False) == taken(folder=tmp_dir) == taken(folder=tmp_dir)
    assert len(first) > 70


def small_tables(spark, folder, n=120):
    """``documents`` and ``labels`` of a scale-factor folder."""
    rng = np.random.default_rng(1)
    docs = [(i, "\n".join(" ".join(rng.choice((ANIMALS, TOOLS)[i % 2], 8)) for _ in range(3))) for i in range(1, n)]
    docs += [(n, None), (n + 1, "the a"), (n + 2, docs[0][1])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2) for i, _ in docs]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return docs


def test_registered_features_hold_no_vocabulary_on_the_driver(spark, tmp_dir, monkeypatch):
    from pyspark.ml.feature import Word2Vec

    from reviewlens.plans.catalog import QUERIES

    def whole_vocabulary(*_):
        raise AssertionError("Word2Vec keeps its vocabulary on the driver")

    monkeypatch.setattr(Word2Vec, "_fit", whole_vocabulary)
    docs = small_tables(spark, tmp_dir)
    with_summary = sorted(i for i, t in docs if t is not None and i % 31)
    for name, dims, ids in (
        ("summary", 100, with_summary), ("detail", 100, sorted(i for i, t in docs if t is not None)), ("both", 200, with_summary)
    ):
        rows = QUERIES[f"embed_{name}"](spark, tmp_dir).collect()
        assert sorted(r["review_id"] for r in rows) == ids
        assert {len(r["features"]) for r in rows} == {dims}
        facts = QUERIES[f"embed_facts_{name}"](spark, tmp_dir).collect()
        assert {r["review_id"] for r in facts if r["is_zero"]} == {len(docs) - 1}  # stop words only


def test_hashes_of_words_of_any_length():
    words = ["", "a", "ünï", "日本", *("x" * n for n in range(40, 70)), "y" * 300, *(f"w{i}" for i in range(600))]
    for dim, seed in ((100, 42), (1, 7), (1001, 3)):
        assert WV.hashed_units(words, dim, seed).tolist() == [hashed(w, dim, seed) for w in words]
    assert WV.hashed_units([], 5, 1).shape == (0, 5)


def test_a_group_of_shards_sends_a_word_once(spark):
    df = texts(spark)
    shards = 5
    dealt = WV.deal(WV.windows(df, "t"), shards)
    words = [r["token"] for r in vocabulary(df.filter("t is not null"), "t").collect()]
    words = spark.createDataFrame([(w,) for w in words], "token string").toArrow()
    train = WV._group_trainer(42, 0, 1, 4, ["units"])
    together = train(dealt.toArrow(), words).to_pylist()
    assert sorted(r["token"] for r in together) == sorted(ANIMALS + TOOLS)
    assert {r["k"] for r in together} == {shards}
    apart = {}
    for shard in range(shards):
        for r in train(dealt.filter(F.col("shard") == shard).toArrow(), words).to_pylist():
            k, n, units = apart.get(r["token"], (0, 0, np.zeros(4, np.int64)))
            apart[r["token"]] = k + r["k"], n + r["n"], units + WV.unpacked([r["units"]], 4)[0]
    for r in together:
        k, n, units = apart[r["token"]]
        assert (r["k"], r["n"], WV.unpacked([r["units"]], 4)[0].tolist()) == (k, n, units.tolist())


def test_groups_change_no_vector(spark, monkeypatch):
    kwargs = dict(dim=6, passes=2, shard_tokens=300)
    df = texts(spark)
    found = []
    for tasks, shards in ((1, 100), (1, 3), (100, 1)):
        monkeypatch.setattr(WV, "TASKS_A_CORE", tasks)
        monkeypatch.setattr(WV, "SHARDS_A_TASK", shards)
        found.append(as_dict(WV.train_word_vectors(df, "t", **kwargs)[0]))
    assert found[0] == found[1] == found[2] and set(found[0]) == set(ANIMALS + TOOLS)


def test_sums_of_a_word_go_on_in_the_next_batch():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    rows = [(w, int(rng.integers(1, 4)), int(rng.integers(1, 9)), rng.integers(-(10**6), 10**6, 3)) for w in "aaabccccd" for _ in range(2)]
    for size in (1, 2, 3, 5, 18):
        batches = [
            pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in some]) for i in range(3)] + [WV._packed_rows(np.array([r[3] for r in some]))], ["token", "k", "n", "units"]
            )
            for some in (rows[i : i + size] for i in range(0, len(rows), size))
        ]
        got = [r for b in WV._means(3, ["units"])(iter(batches)) for r in b.to_pylist()]
        assert [r["token"] for r in got] == list("abcd")
        for r in got:
            mine = [x for x in rows if x[0] == r["token"]]
            k, sums = sum(x[1] for x in mine), sum(x[3] for x in mine)
            assert r["n"] == sum(x[2] for x in mine) and r["units"] == [int(abs(s) // k * np.sign(s)) for s in sums]


def test_packed_vectors_are_no_wider_than_their_largest_component(spark):
    units = np.array([[1, -(1 << 23)], [1 << 23, 0], [-(1 << 31), 5], [1 << 31, 0], [0, -(1 << 38)]])
    rows = WV._packed_rows(units).to_pylist()
    assert [len(r) // 2 for r in rows] == [3, 4, 4, 5, 5]
    assert WV.unpacked(rows, 2).tolist() == units.tolist()


def test_every_block_has_a_task_of_its_own(spark, monkeypatch):
    df = texts(spark)
    words, _ = WV.train_word_vectors(df, "t", dim=4, passes=0)
    monkeypatch.setattr(WV, "BLOCK_CHARS", 3000)
    blocks = -(-df.agg(F.sum(F.length("t"))).first()[0] // 3000)
    found = WV.document_vectors(df, "t", words, 4).select(F.pmod("a", F.lit(blocks)).alias("block"), F.spark_partition_id().alias("task"))
    tasks = found.groupBy("task").agg(F.countDistinct("block").alias("n")).collect()
    assert blocks > 4 and {r["n"] for r in tasks} == {1}


def test_labels_are_joined_to_texts_once(spark, tmp_dir, monkeypatch):
    from reviewlens.plans import sentiment as SE

    plans = []
    trained = SE.train_word_vectors

    def seen(train, *args, **kwargs):
        plans.append(train._jdf.queryExecution().optimizedPlan().toString())
        return trained(train, *args, **kwargs)

    monkeypatch.setattr(SE, "train_word_vectors", seen)
    small_tables(spark, tmp_dir)
    from reviewlens.sources.fixtures import reviews_view

    feats = prepare_features(reviews_view(spark, tmp_dir), "both", k=3, dim=6, repeatable=True)
    assert len(plans) == 2 and not any("Join" in p for p in plans)
    feats.close()
