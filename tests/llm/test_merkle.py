"""The Merkle manifest against a plain tree, with blocks of several sizes."""

import hashlib
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tallymart.llm import merkle, sha_states  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, leaf string, root int, pos long, g string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def fold(levels, at, value, siblings):
    for level in levels[:-1]:
        run = level[at // 3 * 3 : at // 3 * 3 + 3]
        siblings += run[: at % 3] + run[at % 3 + 1 :]
        run[at % 3] = value
        value, at = digest("".join(run)), at // 3
    return value


def plain_manifest(rows):
    by_source = {}
    for row in rows:
        number = zlib.crc32(b"" if row[0] is None else str(row[0]).encode())
        tampered = row[1].replace("\n", "") if row[1] is not None and number % 2 == 0 else row[1]
        by_source.setdefault(row[3], []).append((row[0], leaf_of(row, row[1]), leaf_of(row, tampered)))
    order = sorted(by_source, key=lambda source: (source is not None, (source or "").encode()))
    trees = {}
    for source, leaves in by_source.items():
        leaves.sort(key=lambda leaf: (leaf[0] is not None, leaf[0] or 0, leaf[1]))
        trees[source] = tree([leaf[1] for leaf in leaves])
    top = tree([trees[source][-1][0] for source in order])
    out = []
    for number, source in enumerate(order):
        for at, (doc_id, leaf, tampered) in enumerate(by_source[source]):
            siblings = []
            value = fold(top, number, fold(trees[source], at, tampered, siblings), siblings)
            root = top[-1][0]
            out.append((doc_id, leaf, trees[source][-1][0], root, digest("".join(siblings)), value, value == root))
    return sorted(out, key=repr)


def manifest(spark, rows, levels):
    docs = spark.createDataFrame([(*row, "x", 1, 2, "y") for row in rows], DOCUMENTS)
    return sorted(map(tuple, merkle.manifest(docs, levels).collect()), key=repr)


def test_states_resume_to_the_library_digest():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 2**32, (8, 50), np.uint32)
    texts = sha_states.to_hex(digests).to_pylist()
    assert texts == [row.hex() for row in sha_states.to_binary(digests).to_pylist()]
    state = np.repeat(sha_states.START, 50, axis=1)
    for n in range(4):
        ended = sha_states.resume(state, sha_states.endings(n)[:, [n] * 50])
        assert sha_states.to_hex(ended).to_pylist() == [digest(text * n) for text in texts]
        state = sha_states.resume(state, sha_states.hex_block(digests))


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_plain_trees(spark, levels):
    rng = np.random.default_rng(levels)
    sources = [None, "", "a", "é", "z", "Z", "hot"]
    rows = []
    for i in range(120):
        source = "hot" if i % 3 else sources[rng.integers(0, len(sources))]
        rows.append((i, f"text {i}\n{'x' * int(rng.integers(0, 50))}\n", "en" if i % 4 else None, source, i))
    rows += [(200, None, None, "a", None), (201, "", "", "", 0), (None, "a\nb", None, "a", 3), (None, "c", None, "lone", 1)]
    rows += [(7, "again\n", "de", "hot", 7)] * 3 + [(202, "long\n" * 200_000, "en", "z", 1_000_000)]
    assert manifest(spark, rows, levels) == plain_manifest(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10])
def test_few_leaves_and_sources(spark, n):
    one = [(i, f"a\n{i}", "en", "s", 1) for i in range(n)]
    assert manifest(spark, one, 1) == plain_manifest(one)
    many = [(i, f"a\n{i}", "en", f"s{i}", 1) for i in range(n)]
    assert manifest(spark, many, 1) == plain_manifest(many)


def test_empty_table(spark):
    assert manifest(spark, [], 7) == []
