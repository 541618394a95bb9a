"""Sentencepiece BPE, filter audit and hard negatives against the library and brute force."""

import hashlib
import itertools
import math
import re

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from reviewlens.llm import filter_audit, hard_negatives, piece_bpe
from reviewlens.llm.common import small_batches
from reviewlens.llm.queries import QUERIES

# --- op 11: bytes through a sentencepiece model ------------------------------------


@pytest.fixture(scope="module")
def encoding():
    tiktoken = pytest.importorskip("tiktoken")
    pytest.importorskip("sentencepiece")
    ranks = {t: i for i, t in enumerate(piece_bpe.read_ranks(piece_bpe.default_ranks()))}
    return tiktoken.Encoding("own", pat_str=piece_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


ODD = [
    None,
    "",
    " \t\n ",
    "  two  spaces   here \r\n\r\n x",
    "Größe 日本語 naïve café 12½ <|endoftext|> don't I'LL we'll",
    "\x00\x1c\x1d\x85\xa0 ﻿�",
    "x" * 5000,
    "ab" * 3000,
    " " * 3000,
    "😀👩‍👩‍👧 ﬁ Ⅷ ́a",
    "▁ <unk> <s> </s> ▁x",
    "one \x1ctwo\x1d three",
    "repeated row",
    "repeated row",
]


def test_pieces_equal_the_library(spark, encoding):
    small_batches(spark)
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(ODD)], "doc_id long, text string, packed string").repartition(3)
    rows = docs.select("doc_id", "text", piece_bpe.encode("text").alias("ids")).withColumn("back", piece_bpe.decode("ids")).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert np.frombuffer(r["ids"], "<u4").tolist() == encoding.encode_ordinary(r["text"] or "")
        assert bytes(r["back"]) == (r["text"] or "").encode()
    assert docs.limit(0).select(piece_bpe.encode("text")).collect() == []
    assert [bytes(r[0]) for r in docs.limit(2).select(piece_bpe.decode(F.lit(None).cast("binary"))).collect()] == [b"", b""]


def test_every_token_is_built_by_its_own_pairs(encoding):
    bpe = piece_bpe.load(None, None)
    for i, token in enumerate(bpe.tokens):
        assert bpe.pieces.encode(token.decode("latin-1").translate(bpe.letters)) == [i]
    beyond = np.array([0, len(bpe.tokens), 1], "<u4").tobytes()
    assert bpe.unpack(beyond) == bpe.tokens[0] + bpe.tokens[1]


def test_long_texts_and_a_small_table(encoding, monkeypatch):
    monkeypatch.setattr(piece_bpe, "LONG", 100)
    monkeypatch.setattr(piece_bpe, "AT_ONCE", 7)
    few = piece_bpe.PieceBpe(piece_bpe.default_ranks(), piece_bpe.default_pattern(), known=5)
    text = " ".join(f"word{i * i % 97} ,\n  {i}" for i in range(3000))
    for t in (text, "y" * 200_000, "a \n" * 5000):
        assert np.frombuffer(few.pack(t), "<u4").tolist() == encoding.encode_ordinary(t)


def test_other_files_of_ranks(spark, tmp_path):
    """A small vocabulary of its own: all bytes and a few merges."""
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"th", b"the", b" the", b"he"]
    path = tmp_path / "own.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens)))
    bpe = piece_bpe.PieceBpe(str(path), r"\S+|\s+")
    assert np.frombuffer(bpe.pack("the he"), "<u4").tolist() == [257, 32, 259]
    path.write_bytes(b"YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="ranks"):
        piece_bpe.read_ranks(str(path))


def test_registered_tokens(spark, encoding):
    truth = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_piece_bpe"](spark, SF_SMALL).collect()
    assert len(rows) == len(truth)
    for r in rows:
        ids = np.array(encoding.encode_ordinary(truth[r["doc_id"]]), "<u4")
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(truth[r["doc_id"]].encode()).hexdigest()


# --- op 12: filter audit -----------------------------------------------------------

LONG = " ".join(f"w{i}" for i in range(400_000))
AUDITED = [
    (1, "a", "few words"),
    (2, "a", "few words"),  # a copy
    (2, "b", "few words"),  # a copy in another part, same id
    (3, None, None),
    (4, "", ""),  # a copy of the null text, in the same part
    (None, "a", "few words"),
    (5, "b", "SHOUTING " * 60),
    (5, "b", "SHOUTING " * 60),  # a repeated row
    (6, "b", " ".join(f"word{i}" for i in range(60)) + " #"),
    (7, "c", " ".join(f"word{i}" for i in range(60))),
    (8, "c", LONG),
    (9, "c", LONG),
    (10, "c", "ÄÖ É " * 50),  # capitals beyond A-Z do not count
    (11, "only", "x\x1cy \x0bz\xa0w"),
]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (5, None, 1), (7, 1, 1), (9, 1, 0), (99, 1, 1), (None, 1, 1), (6, 0, 0), (6, 0, 0)]


def fails(i, text, docs):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 50,
        "B": 100 * len(set(words)) < 65 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": i is not None and any(j is not None and j < i and (t or "") == text for j, _, t in docs),
    }


def brute_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed = [(i, p or "", fails(i, t or "", docs)) for i, p, t in docs]
    rows = {}
    for part in {p for _, p, _ in failed}:
        own = [(i, f) for i, p, f in failed if p == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                rows[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(f[letter] for _, f in own) - len(gone),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in own),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for letter in "ABCDE":
            steps = [(o, s) for p, o, s in rows if p == part and o[s - 1] == letter]
            total = sum(rows[part, o, s][1] for o, s in steps)
            for o, s in steps:
                rows[part, o, s].append(total)
    return rows


def test_audit_equals_counting_every_order(spark):
    small_batches(spark)
    docs = spark.createDataFrame([(*d, "clash") for d in AUDITED], "doc_id long, source string, text string, digest string").repartition(4)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("source", F.lit("clash"))
    got = {tuple(r)[:3]: list(r)[3:] for r in filter_audit.audit_documents(docs, labels).collect()}
    assert got == brute_audit(AUDITED, LABELS)
    assert filter_audit.audit_documents(docs.limit(0), labels).collect() == []
    unlabelled = filter_audit.audit_documents(docs, labels.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost")).first()
    assert tuple(unlabelled) == (0, 0)


def test_lattice_counts_paths():
    lattice = filter_audit.Lattice(4)
    assert lattice.reach[-1] == lattice.leave[0] == math.factorial(4)
    for s in range(16):
        n = bin(s).count("1")
        assert lattice.reach[s] == math.factorial(n) and lattice.leave[s] == math.factorial(4 - n)
    assert len(lattice.edges) == 4 * 2**3 and len(lattice.paths()) == 24


def test_shapley_sums_add_up_and_other_numbers_of_filters(spark):
    counts = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 4, 0, 2), ("p", 4, 1, 1, 1)], "part string, mask int, n long, good long, toxic long")
    rows = filter_audit.audit(counts, "XYZ").collect()
    assert len(rows) == 6 * 3
    by = {r["filter_order"][r["step"] - 1]: r["shapley"] for r in rows}
    assert by == {"X": 12, "Y": 12, "Z": 6}  # all that the filters remove together, times the orders
    assert all(r["kept"] == 5 for r in rows if r["step"] == 3)


def test_words_of_a_long_text_come_in_stretches(monkeypatch):
    monkeypatch.setattr(filter_audit, "STRETCH", 10)
    text = b"  alpha beta\x0b gamma " + b"x" * 50 + b" y\n z  "
    assert [w for words in filter_audit.words_of(text) for w in words] == text.split()
    assert [w for words in filter_audit.words_of(b"x" * 50) for w in words] == [b"x" * 50]


# --- op 13: hard negatives ---------------------------------------------------------


def brute_negatives(rows, every=100, positives=5, negatives=10, scale=256):
    valid = {}
    for i, x, label in rows:
        if i is None or x is None or label is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        row = [math.floor(c * scale) for c in x], label
        valid[i] = min(valid.get(i, row), row)
    out = []
    for a, (q, label) in valid.items():
        if a % every:
            continue
        scores = [(-sum(x * y for x, y in zip(q, v)), i, other) for i, (v, other) in valid.items() if i != a and len(v) == len(q)]
        scores.sort()
        for p, i, _ in [s for s in scores if s[2] == label][:positives]:
            fit = [s for s in scores if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out += [(a, i, r, j, -p, -n) for r, (n, j, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, rank int")
    return sorted(tuple(r) for r in hard_negatives.mine(df.repartition(3), **options).collect())


def test_negatives_equal_brute_force(spark, monkeypatch):
    small_batches(spark)
    monkeypatch.setattr(hard_negatives, "CANDIDATE_ROWS", 16)
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((4, 6)) / 2
    rows = [(int(i), (centres[i % 4] + rng.standard_normal(6) / 4).tolist(), int(i % 4 if i % 9 else 1)) for i in range(-40, 160)]
    rows += [(i, rows[i % 7][1], i % 3) for i in range(200, 230)]  # ties
    rows += [rows[0], rows[0], (rows[3][0], [9.0] * 6, 2)]  # a repeated row, an id with two vectors
    rows += [(300, None, 1), (310, [None] + [0.0] * 5, 1), (320, [math.nan] * 6, 1), (330, [math.inf] * 6, 1), (340, [0.1] * 6, None)]
    rows += [(None, [0.1] * 6, 1), (350, [], 1), (351, [], 2), (352, [], 1), (360, [0.2] * 3, 1), (361, [0.3] * 3, 1), (362, [0.2] * 3, 2)]
    rows += [(370, [-0.5] * 6, 8), (371, [0.5] * 6, 8)]  # its only positive has a negative score
    rows += [(380, [0.5] * 6, 9), (390, [1e5] * 6, 1), (391, [1e5, 0.0, 0.0, 0.0, 0.0, -1.0], 2), (392, [9e4] * 6, 1)]
    got = mined(spark, rows, every=10)
    assert got and got == brute_negatives(rows, every=10)
    assert mined(spark, [], every=10) == []
    assert mined(spark, [(10, [1.0], 1)], every=10) == []  # nothing to compare with


def test_scores_beyond_doubles_are_exact(spark):
    small_batches(spark)
    rows = [(i, [4.0e6 + i / 256, 3.9e6 - i, 1.0 * i], i % 2) for i in range(12)] + [(40, [1e15, 0.0, 0.0], 0)]
    got = mined(spark, rows, every=10, lowest=0, highest=200)
    kept = [r for r in rows if r[0] != 40]  # its scores do not fit a long

    def exact(limit):
        return [r for r in brute_negatives_window(kept, limit)]

    assert got == exact(200)


def brute_negatives_window(rows, highest):
    q = {i: ([math.floor(c * 256) for c in x], label) for i, x, label in rows}
    out = []
    for a in (i for i in q if i % 10 == 0):
        scores = sorted((-sum(x * y for x, y in zip(q[a][0], v)), i, label) for i, (v, label) in q.items() if i != a)
        for p, i, _ in [s for s in scores if s[2] == q[a][1]][:5]:
            fit = [s for s in scores if s[2] != q[a][1] and 0 <= 100 * -s[0] <= highest * -p][:10]
            out += [(a, i, r, j, -p, -n) for r, (n, j, _) in enumerate(fit, 1)]
    return sorted(out)


def test_spanning_tree_and_bounds_decide_what_is_scored():
    rng = np.random.default_rng(3)
    near = rng.integers(-60, 60, (1, 24)) * 4 + rng.integers(-4, 5, (120, 24))  # close anchors
    order, parent, length = hard_negatives.spanning_tree(near.astype(float))
    assert sorted(order) == list(range(120)) and parent[0] == -1 and (parent[1:] < np.arange(1, 120)).all()
    gaps = np.linalg.norm(near[:, None] - near[None], axis=2)
    left, total = {0}, 0.0  # Prim by brute force
    while len(left) < 120:
        d, j = min((gaps[i, j], j) for i in left for j in range(120) if j not in left)
        left.add(j)
        total += d
    assert length.sum() == pytest.approx(total)
    rows = rng.integers(-250, 250, (4000, 24))
    low, high = np.full((120, 1), hard_negatives.NOTHING), np.full((120, 1), np.iinfo(np.int64).max)
    labels = np.zeros(120, np.int64)
    tree = hard_negatives.Tree(-1 - np.arange(120), labels, near[order], parent, length, low, high, True, 5)
    for at in range(0, 4000, 500):
        tree.meet(np.arange(at, at + 500), np.zeros(500, np.int64), rows[at : at + 500])
    want = np.sort(near[order] @ rows.T, axis=1)[:, ::-1][:, :5]
    assert (tree.scores[:, 0] == want).all()
    assert tree.scored < 0.5 * 120 * 4000  # the bounds spare most pairs
