"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW`` bytes in both directions and gives every byte a
probability for each language; a document's probabilities are the mean over the bytes of
its letters, all windows of the whole text.  It is trained in numpy by backpropagation
through time, on the driver, from a bounded sample: at most ``SAMPLE_TEXTS`` different texts
a language, and of each ``PIECES`` stretches of ``PIECE_CHARS`` code points.  Sampling is done in
Spark by text hash, at a share of the language's different texts, so that copies neither crowd
the sample nor empty it; rows whose id falls into the held-out fold are never read for it.

Prediction is a narrow Arrow function of the text alone: no shuffle, and a task holds one
Arrow batch and ``AT_ONCE`` windows.

Edge cases: a null text, or one without a letter, is ``und`` with score 0, as is everything
when there is nothing to learn from; a null ``doc_id`` is not held out and not learnt from; a
null language is not learnt; one language only is always predicted; repeated rows get a row
each; an empty table gives no rows; other columns pass unread.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlens.llm.common import give_back

UNDETERMINED = "und"
ASCII_LETTER = re.compile(rb"[A-Za-z]")
FOLDS = 5
#: Bound of the training sample: different texts a language, stretches of a text, code points of a stretch.
SAMPLE_TEXTS = 400
PIECES = 4
PIECE_CHARS = 96
#: Bytes of a window, hidden units of a direction.
WINDOW = 64
HIDDEN = 8
STEPS = 350
BATCH = 256
SEED = 3
#: Windows predicted at once.
AT_ONCE = 2048
#: Symbol of the places behind the end of a text; its update gate is held open, so it changes no state.
PAD = 256
HELD = 30.0


@dataclass
class Model:
    """Languages, and the network: input tables, recurrent and output weights."""

    langs: list[str]
    table: np.ndarray  # gate (update, reset, candidate) x (forward symbols, backward symbols) x unit
    hidden: np.ndarray  # gate x direction x unit x unit
    out: np.ndarray  # (forward units, backward units) x language
    bias: np.ndarray


def letters() -> np.ndarray:
    """Whether a byte is an ASCII letter or part of a longer character."""
    b = np.arange(256)
    return ((b | 32) >= ord("a")) & ((b | 32) <= ord("z")) & (b < 128) | (b >= 128)


def sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def forward(model: Model, symbols: np.ndarray, keep: bool = False):
    """States of both directions for each place: direction x place x window x unit.

    ``symbols``: windows x places.  With ``keep`` the gates as well, for training.
    """
    count, places = symbols.shape
    units = model.hidden.shape[-1]
    both = np.stack([symbols.T, symbols.T[::-1]], axis=1).astype(np.intp)  # place x direction x window
    both[:, 1] += PAD + 1
    state = np.zeros((2, count, units), np.float32)
    states = np.empty((2, places, count, units), np.float32)
    kept = []
    for t, row in enumerate(both):
        z = sigmoid(model.table[0].take(row, axis=0) + state @ model.hidden[0])
        r = sigmoid(model.table[1].take(row, axis=0) + state @ model.hidden[1])
        q = state @ model.hidden[2]
        n = model.table[2].take(row, axis=0)
        n += r * q
        np.tanh(n, out=n)
        if keep:
            kept.append((state, z, r, q, n))
        state = state - n
        state *= z
        state += n
        states[0, t] = state[0]
        states[1, places - 1 - t] = state[1]
    return (states, both, kept) if keep else states


def probabilities(model: Model, states: np.ndarray) -> np.ndarray:
    """place x window x language."""
    units = states.shape[-1]
    score = states[0] @ model.out[:units] + states[1] @ model.out[units:] + model.bias
    score -= score.max(axis=-1, keepdims=True)
    np.exp(score, out=score)
    return score / score.sum(axis=-1, keepdims=True)


def gradients(model: Model, symbols: np.ndarray, lang: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over the letters' places, and its gradients, backwards through time."""
    states, both, kept = forward(model, symbols, keep=True)
    units, places = states.shape[-1], states.shape[1]
    chance = probabilities(model, states)
    weight = np.append(letters(), False)[symbols.T].astype(np.float32)
    weight /= max(1.0, float(weight.sum()))
    right = np.take_along_axis(chance, np.broadcast_to(lang[None, :, None], (*weight.shape, 1)), -1)[..., 0]
    loss = float(-(weight * np.log(right + 1e-9)).sum())
    d_score = chance
    d_score[:, np.arange(len(lang)), lang] -= 1
    d_score *= weight[..., None]
    flat = d_score.reshape(-1, d_score.shape[-1])
    d_out = np.concatenate([s.reshape(-1, units).T @ flat for s in states])
    d_states = np.stack([d_score @ model.out[:units].T, d_score @ model.out[units:].T])
    d_hidden = np.zeros_like(model.hidden)
    d_gates = np.empty((3, places, 2, len(lang), units), np.float32)
    d_state = np.zeros((2, len(lang), units), np.float32)
    for t in range(places - 1, -1, -1):
        before, z, r, q, n = kept[t]
        d = d_state + np.stack([d_states[0, t], d_states[1, places - 1 - t]])
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (before - n) * z * (1 - z)
        dr = dn * q * r * (1 - r)
        d_gates[:, t] = dz, dr, dn
        d_state = d * z
        for gate, into in enumerate((dz, dr, dn * r)):
            d_hidden[gate] += before.transpose(0, 2, 1) @ into
            d_state += into @ model.hidden[gate].transpose(0, 2, 1)
    d_table = np.zeros_like(model.table)
    for gate in range(3):
        np.add.at(d_table[gate], both.reshape(-1), d_gates[gate].reshape(-1, units))
    d_table[:, [PAD, 2 * PAD + 1]] = 0
    return loss, [d_table, d_hidden, d_out, flat.sum(axis=0)]


def train(pieces: list[tuple[str, bytes]], steps: int = STEPS, seed: int = SEED, hidden: int = HIDDEN) -> Model | None:
    """The network learnt from (language, text) pieces; ``None`` without any."""
    pieces = sorted(p for p in pieces if p[1])
    langs = sorted({lang for lang, _ in pieces})
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    out, bias = draw(2 * hidden, len(langs)), np.zeros(len(langs), np.float32)
    model = Model(langs, draw(3, 2 * (PAD + 1), hidden), draw(3, 2, hidden, hidden), out, bias)
    model.table[:, [PAD, 2 * PAD + 1]] = 0
    model.table[0, [PAD, 2 * PAD + 1]] = HELD
    if len(langs) == 1:
        return model
    of = [np.array([i for i, p in enumerate(pieces) if p[0] == lang]) for lang in langs]
    weights = [model.table, model.hidden, model.out, model.bias]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    for step in range(1, steps + 1):
        lang = rng.integers(0, len(langs), BATCH)
        symbols = np.full((BATCH, WINDOW), PAD, np.int64)
        for row, k in enumerate(lang):
            raw = pieces[of[k][rng.integers(len(of[k]))]][1]
            at = int(rng.integers(0, max(1, len(raw) - WINDOW + 1)))
            most = WINDOW if rng.random() < 0.8 else int(rng.integers(4, WINDOW))
            part = np.frombuffer(raw[at : at + most], np.uint8)
            symbols[row, : len(part)] = part
        _, grads = gradients(model, symbols, lang)
        rate = 0.02 * min(1.0, 2 * (1 - (step - 1) / steps))
        for w, g, m, v in zip(weights, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def has_letter(text: bytes) -> bool:
    return bool(ASCII_LETTER.search(text)) or not text.isascii() and any(map(str.isalpha, text.decode("utf-8", "replace")))


def predict(model: Model | None, texts: list[bytes | None]) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    told = [i for i, t in enumerate(texts) if t and has_letter(t)] if model else []
    if not told:
        return lang, score
    whole = np.frombuffer(b"".join(texts[i] for i in told), np.uint8)
    size = np.array([len(texts[i]) for i in told])
    begin = np.cumsum(size) - size
    each = -(-size // WINDOW)
    of = np.repeat(np.arange(len(told)), each)
    at = begin[of] + (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)) * WINDOW
    stop = (begin + size)[of]
    is_letter = np.append(letters(), False)
    sums = np.zeros((len(told), len(model.langs)))
    for a in range(0, len(of), AT_ONCE):
        rows = slice(a, a + AT_ONCE)
        places = at[rows, None] + np.arange(WINDOW)
        symbols = np.where(places < stop[rows, None], whole[np.minimum(places, len(whole) - 1)], PAD)
        # a block without a full window is only as wide as its longest
        symbols = symbols[:, : int((stop[rows] - at[rows]).max())]
        chance = probabilities(model, forward(model, symbols))
        chance *= is_letter[symbols.T][..., None]
        np.add.at(sums, of[rows], chance.sum(axis=0))
    total = np.maximum(sums.sum(axis=1), 1e-30)
    best = sums.argmax(axis=1)
    score[told] = np.clip(sums[np.arange(len(told)), best] / total, 0, 1)
    for i, k in zip(told, best):
        lang[i] = model.langs[k]
    return lang, score


def held_out(doc_id: Column | str) -> Column:
    """Whether ``crc32`` of the id as text is divisible by ``FOLDS``; false for a null id."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_pieces(docs: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[str, bytes]]:
    """The bounded sample: stretches of texts outside the held-out fold."""
    rows = docs.filter(F.col(doc_id).isNotNull() & F.col(lang).isNotNull() & ~held_out(doc_id) & (F.length(text) > 0))
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    # different texts, not rows: copies would press the share down
    texts = rows.select("lang", "key").distinct()
    count = {r["lang"]: r["n"] for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count:
        return []
    # a share of the texts by hash that leaves about twice as many as wanted, then the smallest hashes
    share = F.lit(0.0)
    for name, n in sorted(count.items()):
        share = F.when(F.col("lang") == name, min(1.0, 2 * SAMPLE_TEXTS / n)).otherwise(share)
    some = rows.filter((F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53))) < share)
    room = F.greatest(F.lit(1), F.char_length("text") - PIECE_CHARS)
    starts = [F.pmod(F.xxhash64("text", F.lit(i)), room).cast("int") + 1 for i in range(PIECES)]
    cut = F.array(*[F.substring(F.col("text"), s, F.lit(PIECE_CHARS)) for s in starts])
    some = some.groupBy("lang", "key").agg(F.first(cut).alias("pieces"))
    groups: dict[str, list[tuple[int, list[str]]]] = {}
    for r in some.collect():
        groups.setdefault(r["lang"], []).append((r["key"], r["pieces"]))
    order = lambda key: (key ^ (key >> 31)) * 0x9E3779B97F4A7C15 & ((1 << 64) - 1)
    return [
        (name, piece.encode())
        for name, texts in groups.items()
        for _, pieces in sorted(texts, key=lambda t: order(t[0]))[:SAMPLE_TEXTS]
        for piece in pieces
    ]


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    return train(training_pieces(docs, doc_id, text, lang))


def identify(text: Column | str, model: Model | None) -> Column:
    """``struct<lang_pred string, score double>`` of a text column."""

    @F.arrow_udf("lang_pred string, score double")
    def label(texts: pa.Array) -> pa.Array:
        lang, score = predict(model, texts.cast(pa.binary()).to_pylist())
        give_back()
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"])

    return label(F.col(text) if isinstance(text, str) else text)
