"""Voting, the recurrent pass and the deal of the mixture against plain loops; very long texts."""

import math
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tallymart.llm import langid, licenses, mixing, quality  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def ends_of(texts):
    return np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([len(t.encode()) for t in texts])


# Quality


def plain_terms(text):
    """Hashed runs of three bytes, by shape and by small letters."""
    raw, half = text.encode(), quality.TERMS // 2
    counts = np.zeros(quality.TERMS)
    for start, codes, factor in ((0, quality.SHAPES, 0x9E3779B1), (half, quality.LOWER, 0x85EBCA6B)):
        for i in range(len(raw) - 2):
            a, b, c = (int(codes[x]) for x in raw[i : i + 3])
            mixed = ((a * 65_599 + b) * 65_599 + c) * factor % 2**32
            counts[start + (mixed >> 15) % half] += 1
    return counts


def plain_style(text):
    """Shares of words that repeat, lack letters and digits, shout, or pile up marks."""
    words, found = [], [0, 0, 0, 0]
    for word in "".join(c if ord(c) > 0x20 else " " for c in text).split():
        raw = word.encode()
        found[0] += word in words[-3:]
        found[1] += not any(b >= 0x80 or chr(b).isalnum() for b in raw)
        found[2] += sum(b < 0x80 and chr(b).isupper() for b in raw) > 1
        found[3] += sum(0x20 < b < 0x80 and not chr(b).isalnum() for b in raw) > 1
        words.append(word)
    shares = [f / len(words) for f in found] if words else None
    return np.array([x for s in shares for x in (math.sqrt(s), math.sqrt(1 - s))]) if words else np.zeros(8)


def test_terms_and_styles_equal_plain_counts():
    texts = ["", "a", "ab", "Hello, WORLD!! it it is it", "\x00é ÄB  ..; 12\n12 12", "XX XX yy ?? xx"]
    counts = quality.term_counts(*ends_of(texts))
    for row, text in zip(counts, texts, strict=True):
        assert (row[: quality.TERMS] == plain_terms(text)).all(), text
        assert np.allclose(row[quality.TERMS :], plain_style(text), atol=1e-6), text


def test_votes_equal_plain_loops():
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcde XY!."), rng.integers(0, 60))) for _ in range(80)]
    counts = quality.term_counts(*ends_of(texts))
    labels = rng.integers(0, 2, 60).astype(float)
    model = quality.fit(counts[:60], labels, dimensions=12)
    vectors = model.project(counts)
    for row, score in enumerate(model.scores(counts)):
        votes = sorted(((float(vectors[row] @ model.vectors[j]), labels[j]) for j in range(60)), key=lambda v: -v[0])
        nearest = votes[: quality.NEIGHBOURS]
        weights = [max(c, 0) ** quality.SHARPNESS for c, _ in nearest]
        expected = sum(w * y for w, (_, y) in zip(weights, nearest)) / sum(weights) if sum(weights) else labels.mean()
        # Neighbours at the border of the nearest that are equally near may be any of them.
        ties = votes[quality.NEIGHBOURS][0] == nearest[-1][0]
        assert ties or score == pytest.approx(expected, abs=1e-4)


# Language


def plain_probabilities(network, text):
    """Each byte's probabilities by two gated recurrences a window, one state at a time."""
    raw, units = text.encode(), network.recurrent[0].shape[1]
    total = np.zeros(len(network.languages))
    for begin in range(0, len(raw), langid.WINDOW):
        window = raw[begin : begin + langid.WINDOW]
        states = [[None] * len(window), [None] * len(window)]
        for k in (0, 1):
            state = np.zeros(units)
            for t in reversed(range(len(window))) if k else range(len(window)):
                add, w = network.inputs[k][:, window[t]].astype(float), network.recurrent[k].astype(float)
                update = 1 / (1 + np.exp(-(add[:units] + w[:units] @ state)))
                reset = 1 / (1 + np.exp(-(add[units : 2 * units] + w[units : 2 * units] @ state)))
                candidate = np.tanh(add[2 * units :] + w[2 * units :] @ (reset * state))
                state = (1 - update) * state + update * candidate
                states[k][t] = state
        for t in range(len(window)):
            scores = network.output @ np.concatenate([states[0][t], states[1][t]]) + network.bias[:, 0]
            chances = np.exp(scores - scores.max())
            total += chances / chances.sum()
    return total / len(raw) if raw else total


def test_document_probabilities_equal_plain_loops():
    network = langid.new_network(["a", "b", "c"], seed=9)
    network.bias += np.array([[0.3], [-0.2], [0.1]], np.float32)
    rng = np.random.default_rng(6)
    lengths = [0, 1, 2, 63, 64, 65, 128, 200, 0, 64]
    texts = ["".join(rng.choice(list("abcé xyz"), n)) for n in lengths]
    found = langid.document_probabilities(network, *ends_of(texts))
    for row, text in zip(found, texts, strict=True):
        assert np.allclose(row, plain_probabilities(network, text), atol=1e-5)


# Mixing


def plain_permuted(place, size, seed):
    """One place through a four-round Feistel network, again while it falls outside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    draw = np.random.default_rng([mixing.SEED, seed % 2**32, seed >> 32])
    keys = [int(k) | 1 for k in draw.integers(1, 2**63, 4, dtype=np.uint64)]
    while True:
        high, low = place >> half, place & ((1 << half) - 1)
        for key in keys:
            mixed = (low + key) * 0x9E3779B97F4A7C15 % 2**64
            mixed ^= mixed >> 29
            mixed = mixed * key % 2**64
            high, low = low, high ^ ((mixed >> 32) & ((1 << half) - 1))
        place = (high << half) | low
        if place < size:
            return place


def plain_deal(planned, shard_slots, seed):
    """Shard by shard and slot by slot, with the same draws."""

    def deal(draw, left, slots):
        counts, missing = [0] * len(left), min(slots, sum(left))
        while missing:
            rest = np.array([a - b for a, b in zip(left, counts)])
            drawn = draw.multinomial(missing, rest / rest.sum()).tolist()
            counts = [min(c + d, most) for c, d, most in zip(counts, drawn, left)]
            missing = min(slots, sum(left)) - sum(counts)
        return counts

    left, used, out = [s.quota for s in planned], [0] * len(planned), []
    shards = -(-sum(left) // shard_slots)
    per_group = max(1, -(-shards // mixing.MAX_SHARD_GROUPS))
    rng = np.random.default_rng(seed)
    for group in range(-(-shards // per_group)):
        drawn = deal(rng, left, per_group * shard_slots)
        left = [a - b for a, b in zip(left, drawn)]
        mine, rest, draw = list(used), drawn, np.random.default_rng([seed, group])
        used = [a + b for a, b in zip(used, drawn)]
        shard = group * per_group
        while sum(rest):
            counts = deal(draw, rest, shard_slots)
            numbers = [n for n, c in enumerate(counts) for _ in range(c)]
            slots = draw.permutation(len(numbers)).tolist()
            seen = Counter()
            for slot, n in zip(slots, numbers, strict=True):
                blocks = max(1, planned[n].blocks)
                round_, place = divmod(mine[n] + seen[n], blocks)
                seen[n] += 1
                out.append((shard, slot, n, round_, plain_permuted(place, blocks, n * (mixing.MOST_REPEATS + 1) + round_)))
            mine = [a + b for a, b in zip(mine, counts)]
            rest = [a - b for a, b in zip(rest, counts)]
            shard += 1
    return Counter(out)


@pytest.mark.parametrize("groups", [1024, 3])
def test_deal_equals_plain_loops(spark, monkeypatch, groups):
    monkeypatch.setattr(mixing, "MAX_SHARD_GROUPS", groups)
    planned = [mixing.Source(f"s{n}", 10 * b, 0.0, b, q) for n, (b, q) in enumerate([(7, 21), (40, 25), (1, 3), (0, 0), (90, 31)])]
    found = mixing.dealt_slots(spark, planned, shard_slots=6, seed=5).collect()
    assert Counter(map(tuple, found)) == plain_deal(planned, 6, 5)


def test_spans_are_the_blocks_of_what_was_laid_end_to_end(spark):
    """Every slot holds just the words of its block, whichever documents they are of."""
    texts = ["w " * (n * 7 % 23) for n in range(80)] + ["long " * 3000]
    rows = [(n, t, "en", f"s{n % 3}", 0) for n, t in enumerate(texts)] + [(7, texts[7], "en", "s1", 0)] * 40
    docs = spark.createDataFrame(rows, DOCUMENTS)
    mixture = mixing.mix(docs, block_words=16, shard_slots=8)
    places = mixture.documents.collect()
    assert len(places) == len(rows)
    by_source = {}
    for row in places:
        by_source.setdefault(row["source_number"], []).append((row["first_word"], row["size"]))
    for laid in by_source.values():
        reach = 0
        for first, size in sorted(laid):
            assert first == reach
            reach += size
    held = Counter()
    for row in mixture.spans.collect():
        begin = row["first_word"] + row["from_word"]
        assert row["block"] * 16 <= begin and begin + row["n_words"] <= (row["block"] + 1) * 16
        held[row["shard"], row["slot"], row["source_number"], row["block"]] += row["n_words"]
    sizes = {source: sum(size for _, size in laid) for source, laid in by_source.items()}
    assert all(words == min(16, sizes[source] - 16 * block) for (_, _, source, block), words in held.items())
    # Equal rows have places of their own.
    assert len({row["first_word"] for row in places if row["doc_id"] == 7}) == 41
    spans = Counter(row["doc_id"] for row in mixture.spans.collect())
    assert Counter(row["doc_id"] for row in mixing.mixed_texts(docs, mixture).collect()) == spans


# Very long texts


def test_very_long_texts(spark):
    long = "The quick brown fox. " * 150_000 + "GNU General Public License"
    docs = spark.createDataFrame([(0, long, "en", "a", 0), (1, "short text", "en", "a", 0)], DOCUMENTS)
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == 2
    row = next(r for r in licenses.scan(docs.select("doc_id", "text")).collect() if r["doc_id"] == 0)
    assert row["n_words"] == 600_004 and row["first_word"] == row["last_word"] == 600_000 and "gpl" in row["labels"]
    mixture = mixing.mix(docs)
    taken = {r["doc_id"]: r for r in mixing.taken_words(mixture).collect()}
    assert taken[0]["size"] == 600_004 and 0 < taken[0]["taken"] <= 3 * 600_004
    mixed = mixing.mixed_texts(docs, mixture)
    assert mixed.count() == mixture.spans.count()
