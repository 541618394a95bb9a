"""Each operator against a brute-force form, on hand-made rows with every edge case, and on the small tables."""

import collections
import functools
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from reviewlens.llm import ann, bpe, html_text, lang_id, minhash, order_minhash, packing, passages, sharding, url_trust
from reviewlens.llm.common import small_batches
from reviewlens.llm.queries import ORACLE, QUERIES

xxhash = pytest.importorskip("xxhash")

WORDS = [f"w{i}" for i in range(60)]
LONG = " ".join(WORDS[(i * i + 7 * i) % 60] for i in range(9000))
TEXTS = [
    (1, LONG),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3),  # a copy
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, "two words"),
    (8, "Größe übertrifft 日本語テキスト naïve café 12½ <|endoftext|> don't"),
    (9, "x" * 5000),  # no white space
    (10, "ab" * 400),  # repeats itself
    (None, "a text without an id, long enough to matter " * 8),
    (None, None),
    (12, "a text without an id, long enough to matter " * 8),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3),  # a repeated row
    (13, "one \x1ctwo\x1d three"),
    (14, LONG[:20000] + " some other end"),
]
#: Columns that operators use inside, as clashing names.
CLASH = ["hash", "spans", "kept", "score", "size", "bytes", "shard", "key", "host", "ids", "n", "__index"]


@pytest.fixture(scope="module")
def docs(spark):
    small_batches(spark)
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in TEXTS], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def small_documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


# --- op 7: tokens -------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(bpe.default_tokenizer())


def test_bpe_equals_the_library(spark, docs, none, library):
    got = docs.select("text", bpe.encode("text").alias("tokens")).withColumn("back", bpe.decode("tokens"))
    for r in got.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["tokens"] == ids
        assert r["back"] == library.decode(ids, skip_special_tokens=False)
    assert none.select(bpe.encode("text")).collect() == []


def test_bpe_of_odd_texts_with_a_small_dictionary(library):
    odd = ["ÉΣΑΣ Σ İx", "a<|endoftext|>b <|startoftext|>", "'s 's'S'T ''s", "été ́a", "😀😀 ﬁ Ⅷ", "a" * 700, "he" * 50, "<| <|x"]
    few = bpe.WordBpe(bpe.default_tokenizer(), entries=3)
    for text in odd * 2:
        assert few.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_where_no_token_joins_two_bytes():
    one = bpe.load(None)
    assert not one.joined[ord("q"), ord(" ")]
    assert one.joined[ord("t"), ord("h")]
    assert 0 < one.joined.sum() < 65536


# --- op 10: packing -----------------------------------------------------------


def check_pieces(pieces, texts, library, window=2048):
    want = collections.Counter()
    for i, t in texts:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[i] += len(ids)
    have = collections.Counter()
    for r in pieces:
        have[r["doc_id"]] += r["length"]
        assert len(r["ids"]) == 4 * r["length"] > 0
    assert have == want
    by_sequence = collections.defaultdict(list)
    for r in pieces:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0  # no sequence needs padding


def test_packing(docs, none, library):
    pieces = rows_of(packing.pack(docs))
    check_pieces(pieces, TEXTS, library)
    texts = dict((i, t) for i, t in TEXTS if i)
    for i in (1, 8, 14):
        ids = np.array([*library.encode(texts[i], add_special_tokens=False).ids, 1], "<u4").tobytes()
        own = sorted((r["start"], r["ids"]) for r in pieces if r["doc_id"] == i)
        assert b"".join(p for _, p in own) == ids
        assert all(ids[4 * s : 4 * s + len(p)] == p for s, p in own)
    assert packing.pack(none).collect() == []


def test_level_array_keeps_the_sum_of_squares_smallest():
    rng = np.random.default_rng(0)
    levels = packing.LevelArray(64)
    for size in rng.integers(1, 64, 600).tolist():
        n = levels.count.copy()
        sums = {}
        for h in range(64 - size + 1):
            if h == 0 or n[h]:
                after = n.copy()
                after[h] -= h > 0
                after[h + size] += h + size < 64
                sums[h] = int((after**2).sum())
        assert sums[levels.level(size)] == min(sums.values())
        levels.place((0, 0, bytes(4 * size), size), size)


# --- op 5: shards -------------------------------------------------------------


def test_shards(docs, none):
    rows = rows_of(sharding.shard_documents(docs, shards=5))
    assert len(rows) == len(TEXTS)
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r["shard"] for r in rows if r["doc_id"] in (2, 3)}) == 1  # equal texts stay together
    assert sharding.shard_documents(none, shards=5).collect() == []


def test_shards_through_several_levels(spark, monkeypatch):
    texts = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    monkeypatch.setattr(sharding, "FANOUT", 6)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 3)
    rows = rows_of(sharding.shard_documents(texts, shards=4))
    sizes = collections.Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(rows) == texts.count()
    assert max(sizes.values()) - min(sizes.values()) < 0.02 * sum(sizes.values())
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))


def test_differencing_is_tighter_than_greedy():
    rng = np.random.default_rng(4)
    sizes = (rng.pareto(1.5, 400) * 1000 + 16).astype(np.int64)
    vectors = np.zeros((len(sizes), 7), np.int64)
    vectors[:, 0] = sizes
    places, sums = sharding.difference(vectors)
    assert (np.bincount(places[:, 0], weights=sizes, minlength=7) == sums).all()
    greedy = [0] * 7
    for s in sorted(sizes, reverse=True):
        greedy[greedy.index(min(greedy))] += s
    assert sums.max() - sums.min() <= max(greedy) - min(greedy)


# --- op 9: near-duplicates ----------------------------------------------------


def near_brute(texts, size, percent):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    sets = []
    for _, t in texts:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(lower))
        grams = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and texts[a][0] is not None and texts[b][0] is not None:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[find(a)] = find(b)
    lowest = {}
    for a, (i, _) in enumerate(texts):
        if i is not None:
            lowest[find(a)] = min(i, lowest.get(find(a), i))
    return collections.Counter((i, len(s), lowest.get(find(a)) if i is not None else None) for a, ((i, _), s) in enumerate(zip(texts, sets)))


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, docs, none, size, percent):
    found = rows_of(minhash.near_duplicates(docs, size=size, percent=percent))
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == near_brute(TEXTS, size, percent)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert minhash.near_duplicates(none).collect() == []


def test_near_duplicates_that_meet_only_through_others(spark):
    """A chain: neighbours are similar, ends are not; and a base with variants that are less alike than to it."""
    rng = np.random.default_rng(8)
    words = [f"v{i}" for i in rng.permutation(400)]
    texts = [(k, " ".join(words[5 * k : 5 * k + 120])) for k in range(20)]
    base = [f"b{i}" for i in range(150)]
    for k in range(30):
        own = list(base)
        for at in rng.choice(150, 4, replace=False):
            own[at] = f"other{k}{at}"
        texts.append((100 + k, " ".join(own)))
    texts.append((99, " ".join(base)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = minhash.near_duplicates(df, size=3, percent=85)
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()) == near_brute(texts, 3, 85)


def test_near_duplicates_of_the_small_table(spark):
    texts = small_documents(spark)
    found = QUERIES["op9_minmax"](spark, SF_SMALL).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == near_brute(texts, 3, 85)


def test_min_and_max_estimate_similarity():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 1 << 63, 600, np.uint64)
    a, b = (np.sort(np.concatenate([shared, rng.integers(0, 1 << 63, 200, np.uint64)])) for _ in range(2))
    s = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a)]))
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.2


def test_deduplicate_keeps_one_of_each_group_and_the_columns(docs):
    left = minhash.deduplicate(docs)
    assert left.columns == docs.columns
    ids = sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None)
    assert ids == [1, 2, 4, 5, 6, 7, 8, 9, 10, 12, 13]  # 14 has the shingles of 1


# --- op 6: repeated passages --------------------------------------------------


def passages_brute(texts, length):
    raw = [(t or "").encode() for _, t in texts]
    seen = collections.Counter(t[a : a + length] for t in raw for a in range(len(t) - length + 1))
    out = collections.Counter()
    for (i, _), t in zip(texts, raw):
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - length + 1):
            if seen[t[a : a + length]] > 1:
                gone[a : a + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(t) else 0
        out[i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def digest_of(cut):
    return collections.Counter(
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in cut.collect()
    )


def test_repeated_passages(docs, none):
    assert digest_of(passages.remove(docs)) == passages_brute(TEXTS, 200)
    assert passages.remove(none).collect() == []


def edited(seed, n):
    """Variants of passages with edits, in one another's company."""
    rng = np.random.default_rng(seed)
    base = [bytes(rng.integers(97, 103, 700).astype(np.uint8)).decode() for _ in range(3)]
    texts = []
    for k in range(n):
        t = list(base[rng.integers(3)])
        for at in rng.choice(700, rng.integers(0, 5), replace=False):
            t[at] = "#"
        a = int(rng.integers(0, 300))
        texts.append((k, "".join(t[a:]) + base[rng.integers(3)][: int(rng.integers(100, 400))]))
    return texts


@pytest.mark.parametrize("limit", [passages.CORE_SYMBOLS, 50])
def test_repeated_passages_of_edited_texts(spark, monkeypatch, limit):
    """By suffix arrays alone, and with most cores beyond their limit."""
    monkeypatch.setattr(passages, "CORE_SYMBOLS", limit)
    texts = edited(1, 25)
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    assert digest_of(passages.remove(df)) == passages_brute(texts, 200)


def test_without_passages_keeps_columns_and_whole_characters(spark):
    shared = "é" * 101 + "ö" * 30
    df = spark.createDataFrame(
        [(1, "a" + shared + "x", "k", "h"), (2, "b" + shared + "y", "k", "h"), (3, shared, "k", "h"), (4, None, "k", "h")],
        "doc_id long, text string, spans string, hash string",
    )
    left = passages.without_passages(df)
    assert left.columns == df.columns
    assert {(r["doc_id"], r["text"]) for r in left.collect()} == {(1, "ax"), (2, "by"), (4, None)}


# --- op 8: order MinHash ------------------------------------------------------


def order_minhash_brute(text):
    every = (1 << 64) - 1
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    def chain(parts):
        h = 42
        for p in parts:
            h = xxhash.xxh64_intdigest(p, seed=h)
        return h

    words = [w.encode() for w in cut_words(text or "")]
    k, low = order_minhash.KMER, order_minhash.PLACE
    grams = [chain(words[i : i + k]) for i in range(len(words) - k + 1)] or ([chain(words)] if words else [])
    items, seen = [], collections.Counter()
    for v in sorted(signed(h & ~low & every | i) for i, h in enumerate(grams)):
        gram = v >> order_minhash.PLACE_BITS
        h = chain([(gram & every).to_bytes(8, "little"), seen[gram].to_bytes(4, "little")])
        seen[gram] += 1
        items.append(signed(h & ~low & every | v & low))
    bins = collections.defaultdict(list)
    for v in sorted(items):
        if len(bins[(v & every) >> order_minhash.BIN_SHIFT]) < order_minhash.KEEP:
            bins[(v & every) >> order_minhash.BIN_SHIFT].append(v)
    out = set()
    for b, kept in bins.items():
        ordered = [h for _, h in sorted((v & low, (v & every) >> order_minhash.PLACE_BITS + 1) for v in kept)]
        out.add(b << 32 | chain([h.to_bytes(8, "little") for h in ordered]) >> 32)
    return out


def test_order_minhash(docs, none):
    some = docs.filter("doc_id is null or doc_id not in (1, 14)")
    texts = [(i, t) for i, t in TEXTS if i not in (1, 14)]
    got = rows_of(order_minhash.fingerprint_documents(some))
    assert len(got) == len(texts)
    key = lambda r: (r[0] is None, -(r[0] or 0))
    single = {(i, t or "") for i, t in texts}
    ring = sorted(single, key=lambda r: (key(r), xxhash_signed(r[1])))
    want = collections.Counter()
    for i, t in texts:
        n = ring[(ring.index((i, t or "")) + 1) % len(ring)][1]
        third = len(t or "") // 3
        new = (t or "")[: len(t or "") - third] + n[:third]
        a, b, c = map(order_minhash_brute, (t, new, n))
        like = [1.0 if not x | y else len(x & y) / len({v >> 32 for v in x | y}) for x, y in ((a, b), (a, c))]
        want[i, len(t or ""), hashlib.sha256(new.encode()).hexdigest(), frozenset(a), frozenset(b), *like] += 1
    have = collections.Counter(
        (r["doc_id"], r["n_chars"], r["edited_sha256"], frozenset(r["tuples"]), frozenset(r["edited_tuples"]), r["near_edited"], r["near_next"])
        for r in got
    )
    assert have == want
    assert order_minhash.fingerprint_documents(none).collect() == []


def xxhash_signed(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def test_order_minhash_joins_no_signatures(docs):
    plan = order_minhash.fingerprint_documents(docs)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") + plan.count("BroadcastHashJoin") == 3
    assert "tuples" not in "".join(line for line in plan.splitlines() if "Scan" in line)


def test_order_minhash_falls_with_reordering(spark):
    words = [f"w{i}" for i in range(300)]
    turned = words[150:] + words[:150]
    df = spark.createDataFrame([(" ".join(words), " ".join(turned), " ".join(words))], "a string, b string, c string")
    r = df.select(*[order_minhash.order_minhash(c).alias(c) for c in "abc"])
    r = r.select(order_minhash.likeness("a", "b").alias("moved"), order_minhash.likeness("a", "c").alias("same")).first()
    assert r["same"] == 1.0 and r["moved"] < 0.8


def cut_words(text):
    """Words by hand: runs between white space, those beyond 16 code points cut by their content."""
    out = []
    for run in re.split(r"[ \t\n\x0b\f\r]+", text):
        if len(run) <= 16:
            out += [run] * bool(run)
            continue
        part = ""
        for c in run:
            if not "!" <= c <= "~":
                out += [part] * bool(part) + [c]
                part = ""
                continue
            part += c
            if ord(c) % 4 == 0:
                out.append(part)
                part = ""
        out += [part] * bool(part)
    return out


@pytest.mark.parametrize("letters", ["chinese", "printable"])
def test_one_edit_in_a_run_without_spaces_stays_local(spark, letters):
    rng = np.random.default_rng(8)
    codes = rng.integers(0x4E00, 0x4E00 + 2000, 3000) if letters == "chinese" else rng.integers(33, 127, 3000)
    text = "".join(map(chr, codes))
    edits = [text[:at] + new + text[at + cut :] for at, new, cut in ((5, "一", 0), (700, "", 1), (1500, "a", 0), (2999, "z", 1))]
    df = spark.createDataFrame([(text, e) for e in edits], "a string, b string")
    signed = df.select(*[order_minhash.order_minhash(c, whole=True).alias(c) for c in "ab"])
    near = [r[0] for r in signed.select(order_minhash.likeness("a", "b")).collect()]
    assert min(near) > 0.8, near
    words = df.select(F.regexp_extract_all("b", F.lit(order_minhash.WORD), F.lit(0))).collect()
    assert [r[0] for r in words] == [cut_words(e) for e in edits]


def test_registered_likeness_against_the_signatures(spark):
    """near_edited and near_next of the query's form, from brute-force slots of texts without repeated bigrams."""
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(rng.permutation([f"w{j}" for j in range(24)]))) for i in range(6)]
    texts.append((6, texts[2][1].replace("w7 ", "")))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    found = {r["doc_id"]: r for r in order_minhash.fingerprint_documents(df, whole=True).collect()}
    signs = {i: whole_brute(t) for i, t in texts}
    by_id = dict(texts)

    def share(a, b):
        return len(a & b) / len({v >> 32 for v in a | b})

    for i, t in texts:
        after = by_id[i - 1] if i else by_id[6]
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        assert found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert set(found[i]["tuples"]) == signs[i]
        assert found[i]["near_next"] == pytest.approx(share(signs[i], whole_brute(after)))
        if len(set(zip(edited.split(), edited.split()[1:]))) == len(edited.split()) - 1:  # no bigram twice
            assert found[i]["near_edited"] == pytest.approx(share(signs[i], whole_brute(edited)))


def reordered(words, half):
    """Halves swapped, or the blocks of eight words in reverse order."""
    if half:
        return words[len(words) // 2 :] + words[: len(words) // 2]
    return [w for a in range(len(words) - 8, -1, -8) for w in words[a : a + 8]]


def whole_brute(text):
    """Two smallest of all k-mers in each slot's own order, in text order (without repeated k-mers)."""
    every = (1 << 64) - 1
    chain = lambda parts: functools.reduce(lambda h, p: xxhash.xxh64_intdigest(p, seed=h), parts, 42)
    words = [w.encode() for w in text.split()]
    low, items = order_minhash.PLACE, []
    for i in range(len(words) - 1):
        gram = (chain(words[i : i + 2]) & ~low & every) >> order_minhash.PLACE_BITS
        gram -= (gram >> 35) << 36  # the sign stays
        items.append(chain([(gram & every).to_bytes(8, "little"), (0).to_bytes(4, "little")]) & ~low & every | i)
    out = set()
    for slot in range(64):
        two = sorted(items, key=lambda v: (v - (slot << 58)) & every)[:2]
        kept = [v >> 29 for v in sorted(two, key=lambda v: v & low)]
        out.add(slot << 32 | chain([(v & (1 << 35) - 1).to_bytes(8, "little") for v in kept]) >> 32)
    return out


def test_slots_hold_the_order_of_short_texts(spark):
    rows = [
        (n, half, " ".join(words), " ".join(reordered(words, half)))
        for n in (16, 32, 64)
        for half in (True, False)
        for words in ([f"t{i}w{j}" for j in range(n)] for i in range(100))
    ]
    df = spark.createDataFrame(rows, "n int, half boolean, a string, b string")
    signed = df.select("n", "half", "a", *[order_minhash.order_minhash(c, whole=True).alias(f"{c}s") for c in "ab"])
    for r in signed.filter("n = 16").limit(3).collect():
        assert set(r["as"]) == whole_brute(r["a"]) and len(r["as"]) == 64
    mean = signed.groupBy("n", "half").agg(F.avg(order_minhash.likeness("as", "bs")).alias("m"))
    got = {(r["n"], r["half"]): r["m"] for r in mean.collect()}
    assert all(m < 0.55 for (_, half), m in got.items() if half), got
    assert got[64, False] < 0.15, got


def test_query_takes_whole_slots(spark, tmp_path):
    texts = [(1, "one two"), (2, "a b c d e f g h"), (3, None), (4, "w")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: len(r["fingerprint"]) for r in QUERIES["op8_order_minhash"](spark, str(tmp_path)).collect()}
    assert got == {1: 640, 2: 640, 3: 0, 4: 640}


def test_order_minhash_runs_no_python(spark):
    df = order_minhash.fingerprint_documents(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


# --- op 4: nearest neighbours -------------------------------------------------


def neighbours_brute(rows, k=20):
    out = {}
    for q, v in rows.items():
        if q % 20 == 0:
            near = [(-sum_in_order(v, w), i) for i, w in rows.items() if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def sum_in_order(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    rows = {i: rng.standard_normal(24).tolist() for i in range(300)}
    rows[41] = rows[40]  # a tie
    rows |= {900: [1.0, 2.0], 901: [0.5, -1.0]}  # another dimension
    bad = [(500, None), (520, [0.0] * 24), (540, [1.0, None] * 12), (560, [float("nan")] * 24), (580, [float("inf")] * 24), (600, []), (None, rows[1])]
    table = [*rows.items(), *bad, (7, rows[7])]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>").withColumn("score", F.lit(0)).repartition(4)
    found = collections.defaultdict(list)
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    want = neighbours_brute(rows)
    assert set(found) == set(want)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert found[900] == want[900]
    assert all(dict(want[q]).get(i, s) == s for q in want for i, s in found[q])
    assert ann.search(df.limit(0)).collect() == []


def test_neighbours_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "CODE_ROWS", 50)
    monkeypatch.setattr(ann, "QUERY_ROWS", 5)
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = {r["vec_id"]: [float(x) for x in r["embedding"]] for r in df.collect()}
    want = neighbours_brute(rows)
    found = collections.defaultdict(list)
    for r in ann.search(df).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_estimates_stay_inside_their_bounds():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((2000, 64)), rng.standard_normal(64)
    bits, norms, a = ann.encode(x)
    signs = np.unpackbits(bits, axis=1, count=64) * 2.0 - 1
    estimate = signs @ (q @ ann.rotation(64)) * norms / (a * 8)
    bound = ann.EPSILON * np.linalg.norm(q) * norms * np.sqrt(1 - a * a) / (a * np.sqrt(63))
    assert (np.abs(estimate - x @ q) <= bound).mean() > 0.99


@pytest.mark.parametrize("dim", [1, 2, 7, 8, 24, 65])
def test_products_from_packed_bits_equal_those_of_the_signs(dim):
    rng = np.random.default_rng(dim)
    x, q = rng.standard_normal((300, dim)), rng.standard_normal((5, dim))
    bits, _, _ = ann.encode(x)
    signs = np.unpackbits(bits, axis=1, count=dim) * 2.0 - 1
    got = ann.code_products(np.ascontiguousarray(bits.T), q)
    assert np.abs(got - q @ signs.T).max() <= 2.0**-22 * (dim + 8) * np.abs(q).sum(axis=1).max()


# --- op 1: urls ---------------------------------------------------------------

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "bad.org/"), ("allow", "good.org/")]


def page(*links):
    return "<p>" + "".join(f'<a class="x" href="{u}">t</a>' for u in links) + "</p>"


def test_rules(spark):
    urls = {
        "http://A.Example.com/en/1?x": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://x.net/es/#a": ("x.net", "/es/", "net/es/", "block"),
        "http://x.net/en": ("x.net", "/en", None, "allow"),
        "no url": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "ftp://É.Com/a/?b": ("É.com", "/a/", "com/", "allow"),
    }
    df = spark.createDataFrame([(i, u, None, "c") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_trust.judge_urls(df, RULES).collect()}
    assert got == dict(enumerate(urls.values()))
    assert url_trust.judge_urls(df.limit(0), RULES).collect() == []


def propagate_brute(hosts, links, seeds, damping=0.85):
    out = collections.Counter()
    for (a, _), n in links.items():
        out[a] += n
    trust = {h: float(seeds.get(h, 0) > 0) for h in hosts}
    distrust = {h: float(seeds.get(h, 0) < 0) for h in hosts}
    t, d = dict(trust), dict(distrust)
    for _ in range(300):
        t2, d2 = dict(trust), dict(distrust)
        for (a, b), n in links.items():
            t2[b] += damping * t[a] * n / out[a]
            d2[a] += damping * d[b] * n / out[a]
        t, d = t2, d2
    return t, d


def test_trust_and_distrust_flow_over_links(spark):
    pages = [
        ("http://good.org/1", page("http://friend.org/", "//friend.org/x", "/own")),
        ("http://friend.org/1", page("http://third.org/")),
        ("http://farm.org/1", page("http://bad.org/a", "HTTP://BAD.org/b")),
        ("http://second.org/1", page("http://farm.org/")),
        ("http://mixed.org/1", page("http://bad.org/")),
        ("http://bad.org/1", page("http://victim.org/")),
        ("http://victim.org/1", "<!-- " + page("http://bad.org/") + " --><script>" + page("http://bad.org/") + "</script>"),
        ("http://alone.org/1", None),
        ("http://good.org/2", page("http://mixed.org/")),
    ]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    links = {
        ("good.org", "friend.org"): 2, ("friend.org", "third.org"): 1, ("farm.org", "bad.org"): 2, ("second.org", "farm.org"): 1,
        ("mixed.org", "bad.org"): 1, ("bad.org", "victim.org"): 1, ("good.org", "mixed.org"): 1,
    }
    hosts = {h for pair in links for h in pair} | {"alone.org"}
    trust, distrust = propagate_brute(hosts, links, {"good.org": 1, "bad.org": -1})
    seeds = spark.createDataFrame([(h, {"good.org": 1, "bad.org": -1}.get(h, 0)) for h in hosts], "host string, seed int")
    edges = spark.createDataFrame([(a, b, n) for (a, b), n in links.items()], "src string, dst string, n long")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_trust.propagate(seeds, edges).collect()}
    assert got.keys() == hosts
    for h in hosts:
        assert got[h] == pytest.approx((trust[h], distrust[h]), abs=1e-6)
    verdicts = {r["host"]: r["verdict"] for r in url_trust.judge_urls(df, RULES).collect()}
    want = {h: "block" if distrust[h] >= url_trust.MIN_DISTRUST and distrust[h] > trust[h] else "allow" for h in hosts}
    assert {h: v for h, v in verdicts.items()} == {h: want[h] for h in verdicts}
    assert verdicts["farm.org"] == verdicts["second.org"] == "block" and verdicts["victim.org"] == "allow"


@pytest.mark.parametrize("size", [2, 16, 18, 100])
def test_a_farm_is_blocked_at_any_size(spark, size):
    """Each farm host links to the blocked host alone; a directory links to it once among twenty hosts."""
    pages = [(f"http://farm{i}.org/", page("http://bad.org/")) for i in range(size)]
    pages += [("http://directory.org/", page("http://bad.org/", *[f"http://site{i}.org/" for i in range(19)]))]
    pages += [("http://bad.org/", None), ("http://behind.org/", page("http://farm0.org/"))]
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    got = {r["host"]: r["verdict"] for r in url_trust.judge_urls(df, RULES).collect()}
    farm = {f"farm{i}.org" for i in range(size)} | {"bad.org", "behind.org"}
    assert {h for h, v in got.items() if v == "block"} == farm and got["directory.org"] == "allow"


def test_url_verdicts_equal_the_sql_on_hosts_that_link_to_each_other(spark, tmp_dir):
    """Random links, repeated rows and rules of the query: every row as DuckDB has it, and the flow decides some."""
    rng = np.random.default_rng(4)
    hosts = [f"h{i}.{end}" for i, end in enumerate(["org", "org", "org", "com", "net", "net"] * 3)]
    pages = []
    for i in range(200):
        k, path = rng.integers(len(hosts)), rng.choice(["/", "/es/1", "/fr/2?x", "/en/3#y"], p=[0.1, 0.5, 0.2, 0.2])
        html = None if i % 19 == 0 else page(*[f"http://{t}/" for t in rng.permutation(hosts[k + 1 :])[: rng.integers(0, 4)]])
        pages.append((i, f"http://{hosts[k]}{path}", html))
    pages += pages[:20] + [(900, None, "<p>"), (901, "no scheme", page("http://h0.org/"))]
    table = pa.table(dict(zip(["page_id", "url", "html"], map(list, zip(*pages)))))
    pq.write_table(table, f"{tmp_dir}/pages.parquet")
    got = QUERIES["op1_url_trust"](spark, tmp_dir)
    names = got.columns
    with duckdb.connect() as db:
        db.execute(f"create view pages as select * from read_parquet('{tmp_dir}/pages.parquet')")
        want = db.execute(f"select {', '.join(names)} from ({ORACLE['op1_url_trust']})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
    assert {v for _, _, _, rule, v in rows if rule is None} == {"allow", "block"}


def test_url_filter_runs_no_python(spark):
    df = QUERIES["op1_url_trust"](spark, SF_SMALL)
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


# --- op 2: main text ----------------------------------------------------------


def text_of(html, templates=()):
    return html_text.main_text(html_text.parse(html), set(templates))


def test_article_text():
    html = (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body class='has-sidebar'>"
        "<nav><ul><li>menu</li></ul></nav><header>site</header><div class='cookie-notice'>we use cookies</div>"
        "<aside>side</aside><!-- c --><article><header><h1>Title &amp; more</h1></header><p><b>One\n two.<br>three<p>A &lt;b&gt; &#233;&nbsp;x"
        "<div class=ad>buy</div><ul><li>i<li>j</ul><form>f<input></form><section id='comments'>c</section></article>"
        "<footer>&copy;</footer></body></html>"
    )
    assert text_of(html) == "Title & more\n\nOne two. three\n\nA <b> é x\n\ni\n\nj"


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\n\nb"),
        ("<p>cut <b", "cut"),
        ("<p>cut &amp", "cut &"),
        ("<p>x<script>never closed <p>y", "x"),
        ("<p>x<!-- never closed <p>y", "x"),
        ("<main><p>in</p></main><p>out</p>", "in"),
        ("<div hidden>h</div><div style='display: none'>h</div><p>v", "v"),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
        ("<table><tr><td>a<td>b</table>", "a\n\nb"),
    ],
)
def test_odd_pages(html, text):
    assert text_of(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><p>one two three</p><h2 id='related-work'>Related</h2><p class='notice-period'>N</p><ul><li class=share>S</ul></article>", "one two three\n\nRelated\n\nN\n\nS"),
        ("<article><div class='article-header'><h1>H</h1></div><section id='social-history'>S</section><p>one two three</p></article>", "H\n\nS\n\none two three"),
        ("<article><p>one two three four</p><div class='x share'>s</div><section id=Comments>c</section></article>", "one two three four"),
        ("<div class='no-sidebar'><h1>H</h1><p>all of it</p></div>", "H\n\nall of it"),
        ("<div class='page header-fixed'><p>all of it</p></div>", "all of it"),
        ("<div class=banner><h1>H</h1></div><p>one two three</p><section id='social-history'>S</section><div class='site-footer'>f</div>", "H\n\none two three\n\nS"),
        ("<div class=widget>most of the text of this page</div><p>tail</p>", "most of the text of this page\n\ntail"),
        ("<article><p>short</p><div class=comments>much longer than the article itself</div></article>", "short"),
        ("<article class='ad-hoc report'><p>a</p></article>", "a"),
    ],
)
def test_class_words_drop_no_text_of_the_article(html, text):
    assert text_of(html) == text


def test_templates_are_what_recurs_across_different_pages_of_a_host(spark):
    def site(i, host, extra=""):
        return (i, f"http://{host}/p{i}", f"<body><div>Welcome to {host}</div><article><p>shared passage</p><p>text {i}</p><div>call us {extra}</div></article><div>tail</div></body>")

    plain = lambda i: (i, "http://c.org/x", f"<body><div>top line</div><p>own {i}</p><div>top line</div></body>")
    rows = [site(i, "a.org") for i in range(12)] + [site(20 + i, "b.org", i) for i in range(3)]
    rows += [plain(40 + i) for i in range(10)]
    rows += [(60 + i, "http://d.org/x", "<body><div>mirror</div><p>same</p></body>") for i in range(12)]  # one page, mirrored
    rows += [(90, None, "<p>no url</p>"), (91, "http://e.org/", None), (92, "http://e.org/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit("c"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extract(df).collect()}
    assert got[3][0] == "shared passage\n\ntext 3"
    assert got[21][0] == "shared passage\n\ntext 21\n\ncall us 1"
    assert got[44][0] == "own 44"
    assert got[65][0] == "mirror\n\nsame"
    assert got[90] == ("no url", 6) and got[91] == got[92] == ("", 0)
    assert len(got) == len(rows)
    assert html_text.extract(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><p>one</p><p class='advert'>buy</p><p class='Lead'>two</p></article>", "one\n\ntwo"),
        ("<article><p>one</p><section class='entry-comments'><p>c</p></section></article>", "one"),
        ("<article><p>one</p><ul><li class=comment>c</li><li>two</li></ul></article>", "one\n\ntwo"),
        ("<div class=sidebar><p>far longer than the little article of this page</p></div><p>one</p>", "one"),
        ("<article><div class=notice><p>far longer than the little article</p></div><p>one</p></article>", "one"),
        ("<article><h2 class=notice>one</h2><section id='no-comments'><p>two</p></section></article>", "one\n\ntwo"),
        ("<div class='content-with-sidebar'><p>one</p></div>", "one"),
        ("<div class=comments><p>nothing but readers</p></div>", ""),
    ],
)
def test_what_is_no_article_goes_whatever_its_share(html, text):
    assert text_of(html) == text


def site_of_templates(pages, rng):
    """A host on which only counting tells: plain containers in changing places, each on some of its pages."""
    blocks = [f"<div><p>block {b} of the site</p><div>inner {b % 3}</div></div>" for b in range(12)]
    rows = []
    for i in range(pages):
        picked = [blocks[b] for b in np.flatnonzero(rng.random(12) < np.linspace(0.02, 0.6, 12))]
        cut = rng.integers(0, len(picked) + 1)
        article = f"<article><p>shared passage</p><div><p>own {i}</p></div>{''.join(picked[cut:])}</article>"
        rows.append((i, "http://t.org/x", f"<body>{''.join(picked[:cut])}{article}</body>"))
    return rows


def subtrees_brute(node, out):
    """Containers as nested tuples, without hashes."""
    kids = []
    for part in node.parts:
        if isinstance(part, str):
            kids += ["".join(part.split())] if part.split() else []
        else:
            own = subtrees_brute(part, out)
            if own[1] and not part.content and part.tag == "div":
                out.add(own)
            kids += [own]
    return (node.tag, tuple(k for k in kids if k and (isinstance(k, str) or k[1])))


def test_templates_against_a_count_of_nested_tuples(spark):
    rows = site_of_templates(100, np.random.default_rng(4))
    counts = collections.Counter()
    for _, _, html in rows:
        seen = set()
        subtrees_brute(html_text.parse(html), seen)
        counts.update(seen)
    want = sum(n >= html_text.MIN_PAGES for n in counts.values())
    assert any(html_text.MIN_PAGES <= n < 20 for n in counts.values())  # less than a fifth of the pages
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    keyed = df.select(F.lit("t.org").alias("host"), "html", F.col("page_id").alias("page_a"), F.lit(0).cast("long").alias("page_b"))
    assert html_text.recurring(html_text.page_subtrees(keyed)).count() == want
    rare = {f"block {b} of the site" for b in range(12) if sum(f"block {b} " in h for _, _, h in rows) < html_text.MIN_PAGES}
    for r in html_text.extract(df).collect():
        blocks = r["text"].split("\n\n")
        assert blocks[:2] == ["shared passage", f"own {r['page_id']}"]
        assert all(b in rare for b in blocks[2:] if b.startswith("block"))


def test_a_large_host_has_templates_on_few_of_its_pages(spark):
    rows = [(i, "http://h.org/", f"<article><p>own <b>and</b> {i}</p>{'<div>join us</div>' if i < 9 else ''}</article>") for i in range(900)]
    rows += [(3000 + i, "http://h.org/", f"<article><table><tr><td>{i}<tr><td>yes</table></article>") for i in range(20)]
    rows += [(1000 + i, "http://h.org/", f"<div>page {i}</div><article><div>copied whole</div></article>") for i in range(9)]
    rows += [rows[3]] * 3 + [(2000, "http://h.org/", "<article>" + "<p>long</p>" * 100_000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = collections.defaultdict(list)
    for r in html_text.extract(df).collect():
        got[r["page_id"]].append(r["text"])
    assert got[3] == ["own and 3"] * 4 and got[500] == ["own and 500"] and got[3007] == ["7\n\nyes"]
    assert got[1004] == ["copied whole"]
    assert got[2000] == ["\n\n".join(["long"] * 100_000)]


def test_pages_of_the_small_table(spark):
    from html import unescape

    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*$", "", body).replace("<br>", " ").replace("<b>", ""))
        want = "\n\n".join(x for x in (" ".join(unescape(b).split()) for b in blocks) if x)
        assert text_of(r["html"]) == want


# --- op 3: languages ----------------------------------------------------------


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = lang_id.train([("a", b"hello"), ("b", b"world")], steps=0, hidden=3)
    for name in ("table", "hidden", "out", "bias"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    symbols = rng.integers(97, 110, (3, 6))
    symbols[0, 4:] = lang_id.PAD
    lang = np.array([0, 1, 1])
    _, grads = lang_id.gradients(model, symbols, lang)
    for weight, grad in zip((model.table, model.hidden, model.out, model.bias), grads):
        for at in np.argwhere(np.abs(grad) > 1e-3)[:4]:
            at, was, step = tuple(at), weight[tuple(at)], 1e-3
            sides = []
            for to in (was + step, was - step):
                weight[at] = to
                sides.append(lang_id.gradients(model, symbols, lang)[0])
            weight[at] = was
            assert (sides[0] - sides[1]) / (2 * step) == pytest.approx(grad[at], rel=0.05, abs=1e-4)


def test_languages_of_held_out_documents(spark):
    path = SF_SMALL.replace("0.001", "0.01")
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = QUERIES["op3_byte_gru"](spark, path).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.97


def test_language_edges(spark, docs, none):
    told = {r["doc_id"]: r["f"] for r in docs.select("doc_id", lang_id.identify("text", lang_id.learn(docs)).alias("f")).collect()}
    assert told[7]["lang_pred"] == "en"  # the only language there is
    for i in (4, 5, 6):
        assert told[i].asDict() == {"lang_pred": "und", "score": 0.0}
    assert lang_id.learn(none) is None and lang_id.learn(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r[0]["lang_pred"] for r in docs.select(lang_id.identify("text", None)).collect()} == {"und"}
    assert none.select(lang_id.identify("text", None)).collect() == []


def test_copies_do_not_empty_the_sample(spark):
    ids = F.col("id")
    hot = F.when(ids < 60, F.concat(F.lit("another text "), ids.cast("string"))).otherwise("a hot text with many copies")
    few = F.concat(F.lit("a small language "), (ids % 2).cast("string"))
    docs = spark.range(40000).select(
        ids.alias("doc_id"), F.when(ids < 20000, hot).otherwise(few).alias("text"), F.when(ids < 20000, "big").otherwise("few").alias("lang")
    )
    pieces = lang_id.training_pieces(docs, "doc_id", "text", "lang")
    learnt = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(60)) + 1
    assert collections.Counter(lang for lang, _ in pieces) == {"big": learnt * lang_id.PIECES, "few": 2 * lang_id.PIECES}


def test_padding_changes_nothing():
    model = lang_id.train([("a", b"some text here and there"), ("b", b"und noch etwas text dazu")], steps=3)
    text = np.frombuffer(b"some words", np.uint8).astype(np.int64)[None]
    padded = np.concatenate([text, np.full((1, 9), lang_id.PAD)], axis=1)
    a, b = (lang_id.probabilities(model, lang_id.forward(model, s))[:10] for s in (text, padded))
    assert np.allclose(a, b, atol=1e-5)
