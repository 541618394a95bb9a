"""The corpus pipeline, stage by stage, against what each stage must do to its own input."""

import collections

import corpus_pipeline
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from reviewlens.llm.bpe import default_tokenizer


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t.parquet")
        stage(spark, out[-1], SF_SMALL).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "passage_dedup", "packing"]


def test_filters_return_the_columns_of_documents(stages):
    for docs in stages[1:-1]:
        assert docs.columns == stages[0].columns


def test_language_stage_keeps_documents_with_letters(stages):
    before, after = ({r["doc_id"] for r in d.collect()} for d in stages[:2])
    assert after <= before and len(after) >= 0.97 * len(before)


def shingles(text, size=5):
    words = text.lower().split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


def test_near_duplicates_go(stages):
    before = {r["doc_id"]: shingles(r["text"]) for r in stages[1].collect()}
    after = {r["doc_id"] for r in stages[2].collect()}
    alike = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    parent = {i: i for i in before}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in before:
        for b in before:
            if a < b and alike(before[a], before[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert after == {find(i) for i in before}


def test_passages_go_and_the_rest_stays(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2].collect()}
    seen = collections.Counter()
    for t in before.values():
        raw = t.encode()
        seen.update(raw[a : a + 200] for a in range(len(raw) - 199))
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages[3].collect()}
    for i, t in before.items():
        raw, gone = t.encode(), bytearray(len(t.encode()))
        for a in range(len(raw) - 199):
            if seen[raw[a : a + 200]] > 1:
                gone[a : a + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(raw, gone) if not g).decode("utf-8", "ignore")
        if kept:
            assert after[i] == (kept, len(kept))
        else:
            assert i not in after


def test_windows_hold_all_tokens(stages):
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(default_tokenizer())
    want = {r["doc_id"]: len(library.encode(r["text"], add_special_tokens=False).ids) + 1 for r in stages[3].collect()}
    got = {r["doc_id"]: r["n"] for r in stages[4].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == want


def test_run_gives_the_rows_of_the_stages(spark, stages):
    one, two = (collections.Counter(r["doc_id"] for r in d.collect()) for d in (corpus_pipeline.run(spark, SF_SMALL), stages[-1]))
    assert one.keys() == two.keys()


def test_stages_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 456"), (None, "some words without id " * 20), (4, "some words without id " * 20), (4, "some words without id " * 20)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "c", 1.0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, hash string, score double")
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF_SMALL)
        assert empty.collect() == []
        if name != "packing":
            assert stage(spark, docs, SF_SMALL).columns == docs.columns
    first = corpus_pipeline.STAGES[0][1](spark, docs, SF_SMALL)
    assert sorted(r["doc_id"] or 0 for r in first.collect()) == [0, 4, 4]
    untold = corpus_pipeline.STAGES[0][1](spark, docs.withColumn("lang", F.lit(None).cast("string")), SF_SMALL)
    assert sorted(r["doc_id"] or 0 for r in untold.collect()) == [0, 4, 4]
    second = corpus_pipeline.STAGES[1][1](spark, docs, SF_SMALL)
    assert sorted(r["doc_id"] or 0 for r in second.collect()) == [0, 1, 2, 3, 4]


def test_columns_with_names_that_stages_use(spark):
    """Extra columns that clash with working columns stay as they are in every stage."""
    from pyspark.sql.types import StringType, StructField, StructType

    names = ["__hash", "__cut", "__found", "__id", "__spans", "__gone_id", "__gone_hash", "__HASH_", "hash", "kept", "score"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(60)
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names}).persist()
    assert isinstance(docs.schema, StructType) and docs.schema["__cut"] == StructField("__cut", StringType(), True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() >= 60


def test_characters_away_from_a_cut_stay(spark):
    from reviewlens.llm import passages

    shared = "".join(f"shared {i * i} ŝ " for i in range(60))
    docs = spark.createDataFrame(
        [(1, "own � start é" + shared + "é end �"), (2, "è" + shared + "è�"), (3, "ê� other")], "doc_id long, text string"
    )
    kept = {r["doc_id"]: r["text"] for r in passages.without_passages(docs).collect()}
    assert kept[3] == "ê� other"
    assert kept[1].startswith("own � start") and kept[1].endswith("end �") and "shared" not in kept[1]
    assert kept[2].endswith("�") and "shared" not in kept[2]


def test_a_cut_through_characters_leaves_none_behind():
    import numpy as np

    from reviewlens.llm.passages import remaining_text

    text = "aéb�cèd".encode()  # a é(2) b U+FFFD(3) c è(2) d
    assert remaining_text(text, np.array([2, 3]), 1) == "ab�cèd"  # the second byte of é
    assert remaining_text(text, np.array([2, 9]), 1) == "aèd"[:1] + "d"  # from inside é into è
    assert remaining_text(text, np.array([0, 1]), len(text)) == ""
