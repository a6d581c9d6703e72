"""Runs of words against a quadratic search."""

import hashlib
import re
import sys
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tallymart.llm import periodic  # noqa: E402

DOCUMENTS = "doc_id long, text string, runs string, collapsed int, h string, words long"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def all_runs(words):
    """Every period is tried; a run counts under the smallest one that holds all of it."""
    numbers = {}
    a = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    found = []
    for period in range(1, len(a) // 4 + 1):
        same = np.diff(np.concatenate([[0], (a[:-period] == a[period:]).astype(int), [0]]))
        for start, stop in zip(np.flatnonzero(same == 1), np.flatnonzero(same == -1), strict=True):
            run = a[start : stop + period]
            smaller = any((run[:-p] == run[p:]).all() for p in range(1, period))
            if len(run) >= max(6, 4 * period) and not smaller:
                found.append((int(start), len(run), period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words, runs):
    dropped = {i for start, length, period in runs for i in range(start + period, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in dropped)


def found_in(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    runs, collapsed = periodic.of_texts(data, np.cumsum([len(text.encode()) for text in texts]))
    return [[tuple(run.values()) for run in each] for each in runs.to_pylist()], collapsed.to_pylist()


def assert_equal_brute_force(texts):
    runs, collapsed = found_in(texts)
    for text, mine, rest in zip(texts, runs, collapsed, strict=True):
        expected = all_runs(words_of(text))
        assert mine == expected, text[:200]
        assert rest == collapse(words_of(text), expected)


@pytest.mark.parametrize("seed", range(8))
def test_random_texts_equal_brute_force(seed):
    rng = np.random.default_rng(seed)

    def text():
        words = []
        for _ in range(rng.integers(0, 6)):
            alphabet = rng.integers(1, 5)
            times = 1 if rng.random() < 0.5 else rng.integers(1, 9)
            words += list(rng.integers(0, alphabet, rng.integers(0, 20))) * int(times)
        return str(rng.choice([" ", "\t", " \n "])).join("abcd"[word] for word in words)

    for _ in range(60):
        assert_equal_brute_force([text() for _ in range(rng.integers(1, 30))])


@pytest.mark.parametrize("letters", ["ab", "abc"])
def test_every_period_at_every_place(letters):
    """Runs of just four periods, and one word less, at all places against the blocks."""
    texts = []
    for period in range(1, 18):
        unit = [f"{letters[i % len(letters)]}{i}" for i in range(period)]
        for shift in range(0, 20, 3):
            for length in (4 * period - 1, 4 * period, 4 * period + 1, 6):
                texts.append(" ".join([f"x{i}" for i in range(shift)] + [unit[i % period] for i in range(length)] + ["end"]))
    assert_equal_brute_force(texts)


def test_texts_that_continue_each_other_share_no_run():
    assert_equal_brute_force(["a b a b a", "b a b a b", "", "b", "a " * 5, "a " * 5])


def test_words_may_hold_any_other_character():
    assert_equal_brute_force(["\x00 " * 7, "\x00\x01  é " * 6, "\x1c\x0b\x0c" * 8, " \n\t "])
    assert found_in(["x\x00  y z \x00"])[1] == ["x\x00 y z \x00"]


def test_very_long_text():
    unit = [f"w{i}" for i in range(50_000)]
    words = ["start", *(unit * 4), *unit[:7], "end", *["a", "b"] * 20_000]
    runs, collapsed = found_in([" ".join(words), "short"])
    assert runs == [[(1, 200_007, 50_000), (200_009, 40_000, 2)], []]
    assert collapsed == [" ".join(["start", *unit, "end", "a", "b"]), "short"]


def test_digests_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["a", "b", "cé"], rng.integers(0, 60))) for _ in range(200)]
    texts += [None, "", " \n", "one", "a " * 500, "a " * 500]
    rows = [(i, text, "r", 1, "h", 2) for i, text in enumerate(texts)] + [(5, "a b " * 9, None, None, None, None)] * 2
    rows += [(None, "x y z " * 20, None, None, None, None)]
    found = periodic.run_digests(spark.createDataFrame(rows, DOCUMENTS)).collect()

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = []
    for doc_id, text, *_ in rows:
        words, h = words_of(text), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = all_runs(words)
        best = max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=(None,) * 3)
        lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
        expected.append(
            (
                doc_id,
                len(runs),
                *best,
                1000 * best[1] // best[2] if runs else None,
                digest(lines),
                digest(collapse(words, runs)),
            )
        )
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    assert periodic.run_digests(spark.createDataFrame([], DOCUMENTS)).count() == 0
    assert periodic.repeats(spark.createDataFrame([], DOCUMENTS)).columns == ["doc_id", "runs", "collapsed"]
