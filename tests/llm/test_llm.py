"""The operators of the llm subpackage against brute force, exact round trips and edge cases."""

import hashlib
import re
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tallymart.llm import (  # noqa: E402
    bpe,
    chat,
    embed_dedup,
    langid,
    licenses,
    minhash,
    mixing,
    quality,
    sharding,
    topk,
)
from tallymart.llm.queries import llm_oracles, llm_queries  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
TABLES = ("documents", "embeddings", "conversations", "labels", "benchmark")


def documents(spark, texts, **other):
    rows = [(i, t, other.get("lang", "en"), other.get("source", "s"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, sf_dir, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = llm_queries()[name](spark, sf_dir)
    names = ", ".join(result.columns)
    expected = Counter(database.sql(f"SELECT {names} FROM ({llm_oracles()[name]})").fetchall())
    assert Counter(map(tuple, result.collect())) == expected


# Sharding


def test_few_slots_move_when_a_shard_goes():
    full = sharding.fill_table(sharding.SHARDS, sharding.TABLE_SIZE)
    counts = Counter(full)
    assert max(counts.values()) - min(counts.values()) <= 1
    less = sharding.fill_table(sharding.SHARDS[:-1], sharding.TABLE_SIZE)
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != len(sharding.SHARDS) - 1)
    assert moved < 0.2 * len(full)


def test_sharding_edge_cases(spark):
    rows = spark.createDataFrame([(None, "x"), (1, "y"), (1, "y")], "doc_id long, shard string")
    found = sharding.assign_shards(rows).collect()
    assert len(found) == 3 and all(row["shard"] in sharding.SHARDS for row in found)
    assert sharding.assign_shards(rows.limit(0)).count() == 0


# Chat


@pytest.mark.parametrize("text", ["", "\\", "</s>", "\\</s>", "<\\/s>", "[INST][/INST]", "a\\\\[INST]\\", "<<SYS>><s>"])
def test_escaping_is_reversible(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(control in escaped for control in chat.CONTROLS)
    for role in ("user", "assistant", "system", "tool", "", "[ROLE]"):
        assert chat.parse(chat.render(role, text)) == (role, text)


def test_chat_edge_cases(spark):
    schema = "conv_id long, turn long, role string, text string, ids string"
    rows = [(1, 0, None, None, "x"), (1, None, "assistant", "é</s>", None), (None, 1, "user", "", None)]
    rows += [(2, 0, "assistant", "a", None)] * 2
    found = {r["conv_id"]: r for r in chat.read_back(spark.createDataFrame(rows, schema)).collect()}
    assert set(found) == {None, 1, 2}
    assert found[1]["loss_sha256"] == hashlib.sha256("é</s>".encode()).hexdigest()
    assert found[2]["loss_chars"] == 2 and found[2]["n_turns"] == 2
    assert chat.read_back(spark.createDataFrame([], schema)).count() == 0


def test_formatted_turns_are_what_is_read_back(spark):
    """The general output, turn by turn, against what the query digests; and a very long text."""
    texts = ["plain", "</s>[INST] ok [/INST]", "<|endoftext|> <|endoftext|>", "\\[INST]", "é" * 3, "", "word " * 200_000]
    rows = [(1, n, role, text) for n, text in enumerate(texts) for role in ("user", "assistant", "tool")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = {(r["turn"], r["role"]): r for r in chat.format_turns(frame).collect()}
    library = pytest.importorskip("tokenizers").Tokenizer.from_file(chat.default_tokenizer())
    library.encode_special_tokens = True
    for row in chat.read_turns(frame).collect():
        made = formatted[row["turn"], row["role"]]
        assert chat.parse(made["formatted"]) == (row["role"], row["text"]) == (made["role"], made["text"])
        masked = [i for i, m in zip(made["ids"], made["loss_mask"], strict=True) if m]
        learned = row["text"] if row["learned"] is None else row["learned"]
        assert learned == library.decode(masked, skip_special_tokens=False)
        inner = [i for i in made["ids"] if i < chat.FIRST_RESERVED]
        role = library.encode(row["role"], add_special_tokens=False).ids if row["role"] == "tool" else []
        assert inner == role + library.encode(row["text"], add_special_tokens=False).ids
        assert learned == (row["text"] if row["role"] == "assistant" else "")
        assert row["formatted_chars"] == len(made["formatted"])


# BPE


def test_bpe_equals_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = bpe.default_vocabulary()
    library = tokenizers.Tokenizer.from_file(path)
    rng = np.random.default_rng(3)
    letters = list("ab '\n\t!1.éß中strvemldSTX   ") + ["<|endoftext|>", "\u2003", "🙂", "'ll"]
    texts = ["", " ", "don't'll 's"] + ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(3000)]
    texts.append("word " * 50_000)
    ids, ends = bpe.encode_block(texts, path)
    for i, found in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        mine = ids[ends[i] : ends[i + 1]]
        assert mine.tolist() == found.ids, texts[i][:80]
        assert bpe.decode_ids(mine.astype(np.int64), path) == library.decode(found.ids, skip_special_tokens=False)


def test_bpe_edge_cases(spark):
    docs = documents(spark, [None, "", "<|endoftext|>", "same text", "same text"]).withColumnRenamed("lang", "ids")
    found = {r["doc_id"]: r for r in bpe.round_trip(docs).collect()}
    assert [found[i]["n_tokens"] for i in range(3)] == [0, 0, 1]
    assert found[3]["ids_sha256"] == found[4]["ids_sha256"]
    back = bpe.decode(bpe.encode(docs)).collect()
    assert {r["doc_id"]: r["text"] for r in back} == {0: "", 1: "", 2: "<|endoftext|>", 3: "same text", 4: "same text"}
    assert bpe.round_trip(docs.limit(0)).count() == 0


# Mixing


def test_targets_are_shared_again():
    assert mixing.share_targets([10, 100, 10], [5, 2, 1]) == [30, 60, 30]
    assert mixing.share_targets([], []) == []
    assert mixing.share_targets([0, 0], [5, 2]) == [0, 0]


def test_permutation_is_one():
    for size in (1, 2, 7, 100, 1000):
        assert sorted(mixing.permuted(np.arange(size), size, 5).tolist()) == list(range(size))


def test_mixture_holds_what_it_counts(spark):
    texts = [f"  w{i} " * (i % 37) + "\n" for i in range(60)] + [None, "", " "]
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, 0) for i, t in enumerate(texts)]
    rows.append(rows[40])
    docs = spark.createDataFrame(rows, DOCUMENTS)
    mixture = mixing.mix(docs, block_words=16, shard_slots=8)
    taken = mixing.taken_words(mixture).collect()
    assert len(taken) == len(rows)
    assert all(row["taken"] <= 3 * row["size"] for row in taken)
    held = Counter()
    for row in mixing.mixed_texts(docs, mixture).collect():
        assert row["text"] in texts[row["doc_id"]]
        held[row["doc_id"]] += len(re.findall(mixing.WORD, row["text"]))
    counted = Counter()
    for row in taken:
        counted[row["doc_id"]] += row["taken"]
    assert +held == +counted
    again = mixing.taken_words(mixing.mix(docs, block_words=16, shard_slots=8)).collect()
    assert Counter(again) == Counter(taken)
    assert mixing.taken_words(mixing.mix(docs.limit(0))).count() == 0


def test_mixture_comes_near_its_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = mixing.taken_words(mixing.mix(docs)).toPandas()
    source = docs.select("doc_id", "source").toPandas().drop_duplicates()
    by_source = found.merge(source, on="doc_id").groupby("source").agg({"taken": "sum", "target": "first"})
    assert (abs(by_source.taken - by_source.target) <= mixing.BLOCK_WORDS + 0.02 * by_source.target).all()


# Licenses


def brute_detections(text):
    words = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(licenses.CAPITALS, licenses.SMALL))))
    words = "".join(f" {w} " for w in words.split(" ")) if words else ""
    spans = []
    for number, rule in enumerate(licenses.RULES):
        for m in re.finditer(licenses.spaced_pattern(rule.pattern), words):
            spans.append((m.start(), -m.end(), -rule.priority, number, rule.label))
    kept, seen = [], []
    for span in sorted(spans):
        if not any(e[1] <= span[1] and e[2] <= span[2] for e in seen):
            kept.append((span[0], -span[1], -span[2], span[4]))
        seen.append(span)
    return kept


def test_license_scan_equals_brute_force(spark):
    texts = [
        None, "", "nothing here", "MIT LICENSE mit license, MIT-License", "Licensed under CC BY-NC 4.0. cc by",
        "the GNU Lesser General Public License version 2.1 and GNU General Public License, version 3",
        "SPDX-License-Identifier: GPL-2.0-or-later", "a_cc_by_b écc by cc", "Apache License, Version 2.0",
        "gnu  general\npublic license " * 50, "the Apache License of the MIT", "Mit License",
    ]
    found = licenses.scan(documents(spark, texts).withColumnRenamed("lang", "labels")).orderBy("doc_id").collect()
    for text, row in zip(texts, found, strict=True):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(licenses.CAPITALS, licenses.SMALL)))
        places = [
            (i, label)
            for phrase, label in licenses.BASE.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        assert row["n_words"] == len(words) and row["n_base"] == len(places)
        starts = [i for i, _ in places]
        assert (row["first_word"], row["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        expected = brute_detections(text or "")
        assert [tuple(d) for d in row["detections"]] == expected, text
        labels = sorted({d[3] for d in expected} | {label for _, label in places})
        assert row["labels"] == ",".join(labels) and (row["score"] > 0) == bool(labels)


def branches(tree):
    """Texts from each branch of a parsed expression; what may repeat occurs as often as it must, and once more."""
    texts = [""]
    for kind, value in tree:
        match str(kind):
            case "LITERAL":
                more = [chr(value)]
            case "NOT_LITERAL":
                more = ["x"]
            case "IN":
                more = [chr(c) for k, v in value for c in ([v] if str(k) == "LITERAL" else range(v[0], v[1] + 1))]
            case "MAX_REPEAT" | "MIN_REPEAT" | "POSSESSIVE_REPEAT":
                least, most, part = value
                more = [text * n for text in branches(part) for n in range(least, min(most, least + 1) + 1)]
            case "SUBPATTERN":
                more = branches(value[-1])
            case "BRANCH":
                more = [text for part in value[1] for text in branches(part)]
        texts = [text + end for text in texts for end in dict.fromkeys(more)]
    return texts


def test_every_branch_of_a_license_rule_passes_its_keywords(spark):
    generated = {
        rule: [" ".join(t.split()) for t in branches(re._parser.parse(licenses.spaced_pattern(rule.pattern)))]
        for rule in licenses.RULES
    }
    assert [(r.label, t) for r, texts in generated.items() for t in texts if not set(t.split()) & set(r.keywords)] == []
    texts = sorted({text for texts in generated.values() for text in texts})
    rows = documents(spark, texts).repartition(8)
    found = {r["text"]: r["detections"] for r in licenses.scan(rows).collect()}
    assert [t for t in texts if list(map(tuple, found[t])) != brute_detections(t)] == []


def test_names_of_licenses_that_were_left_out(spark):
    holder = "the University of California, Lawrence Berkeley National Laboratory, U.S. Dept. of Energy"
    texts = {
        "CreativeML Open RAIL-M": "openrail",
        "for noncommercial use only": "non-commercial",
        "Unicodes Terms of Use": "unicode",
        f"Neither the name of {holder}, nor the names of its contributors may be used to endorse or promote products": "bsd-3",
        "neither the name of " + "a " * 61 + "may be used to endorse or promote products": "",
    }
    found = licenses.scan(documents(spark, texts)).orderBy("doc_id").collect()
    assert [r["labels"] for r in found] == list(texts.values())


# Vectors


def cluster_rows():
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(16).tolist()) for i in range(150)]
    centre = rng.standard_normal(16)
    rows += [(200 + i, (centre + 0.12 * rng.standard_normal(16)).tolist()) for i in range(90)]
    rows += [(300 + i, rows[3][1]) for i in range(5)] + [(310, [2 * x for x in rows[3][1]])]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None] * 16)]
    rows += [(500, [1.0, 2.0]), (None, rows[3][1]), rows[7]]
    return rows


def plain_links(rows):
    """Every row is a vector: its links, and the smallest id that it reaches."""
    sound = [n for n, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {n: np.array(rows[n][1], np.float32).astype(float) for n in sound}
    unit = {n: x / np.linalg.norm(x) for n, x in unit.items()}
    links = {a: [b for b in sound if b != a and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.9] for a in sound}
    out = []
    for n, (i, _) in enumerate(rows):
        seen, todo = {n}, [n]
        while todo:
            for other in set(links.get(todo.pop(), ())) - seen:
                seen.add(other)
                todo.append(other)
        least = None if i is None else min(rows[m][0] for m in seen)
        out.append((i, len(links.get(n, ())), least, i is None or i == least))
    return Counter(out)


REPEATED = [(1, [1.0, 0.0]), (5, [1.0, 0.01]), (5, [0.0, 1.0]), (9, [0.01, 1.0]), (9, [0.0, 1.0]), (2, [-1.0, 0.0]), (2, [-1.0, 0.0])]


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("rows", [cluster_rows(), REPEATED], ids=["clusters", "repeated ids"])
def test_embedding_links_equal_brute_force(spark, rows, kind):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 AS node", "2 AS part")
    found = embed_dedup.near_duplicates(frame, window=8)
    columns = ("vec_id", "n_links", "component_id", "kept")
    assert Counter(tuple(row[c] for c in columns) for row in found.collect()) == plain_links(rows)
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_embedding_query_matches_sql_on_repeated_ids(tmp_path, spark):
    rows = cluster_rows() + [(i, v) for i, v in REPEATED]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    result = embed_dedup.near_duplicates(spark.read.parquet(f"{tmp_path}/embeddings.parquet"))
    expected = Counter(database.sql(f"SELECT {', '.join(result.columns)} FROM ({embed_dedup.ORACLE})").fetchall())
    assert Counter(map(tuple, result.collect())) == expected


def test_windows_pass_on_few_links():
    """A group of near copies gives two links a vector at most, and stays one group."""
    rng = np.random.default_rng(3)
    base = rng.standard_normal(32)
    vectors = [(base + 0.05 * rng.standard_normal(32)).tobytes() for _ in range(200)]
    links = embed_dedup.window_links(np.arange(200), vectors, 0, 32, 0.9)
    assert 199 <= len(links) <= 400 and all(0 < b - a <= 32 for a, b in links)
    assert united_parts(links, {i: i for i in range(200)}) == {frozenset(range(200))}


def brute_vector_results(vectors):
    """Per row its links and the smallest row of its component."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    component = np.full(len(vectors), -1)
    for start in range(len(vectors)):
        todo = [start] if component[start] < 0 else []
        while todo:
            row = todo.pop()
            component[row] = start
            todo += [x for x in np.flatnonzero(near[row]).tolist() if component[x] < 0]
    return list(zip(near.sum(axis=1).tolist(), component.tolist(), strict=True))


@pytest.mark.parametrize("units", [False, True])
def test_links_in_a_dense_topic_equal_brute_force(spark, monkeypatch, units):
    rng = np.random.default_rng(11)

    def around(centre, count, cosine):
        noise = rng.standard_normal((count, 64))
        noise -= (noise @ centre)[:, None] * centre
        noise /= np.linalg.norm(noise, axis=1, keepdims=True)
        return cosine * centre + np.sqrt(1 - cosine**2) * noise

    topics = np.linalg.qr(rng.standard_normal((64, 2)))[0].T
    # Members of a topic are no links, at a mutual cosine of about 0.8; the planted pairs are.
    vectors = np.concatenate([around(topic, count, 0.895) for topic, count in zip(topics, (4000, 500), strict=True)])
    partners = vectors[::10] + 0.45 * rng.standard_normal((450, 64)) / 8
    vectors = np.concatenate([vectors, partners, rng.standard_normal((200, 64))]).astype(np.float32).astype(float)
    if units:
        monkeypatch.setattr(embed_dedup, "LEAST_UNIT", 200)
        monkeypatch.setattr(embed_dedup, "MOST_UNIT", 200)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_duplicates(frame).collect()}
    assert [found[i] for i in range(len(vectors))] == brute_vector_results(vectors)


def test_cells_near_a_vector_hold_all_within_reach():
    rng = np.random.default_rng(12)
    centres = rng.standard_normal((20, 8))
    vectors = centres[rng.integers(0, 20, 2000)] + 0.25 * rng.standard_normal((2000, 8))
    unit = embed_dedup.unit_matrix([v.tobytes() for v in vectors])
    pivots = unit[:25]
    products = unit @ pivots.T
    cell, angle = products.argmax(axis=1), embed_dedup.angles(products.max(axis=1))
    rows = np.bincount(cell, minlength=25)
    low = np.array([angle[cell == c].min(initial=9) for c in range(25)])
    high = np.array([angle[cell == c].max(initial=0) for c in range(25)])
    near = embed_dedup.Cells(pivots, rows, low, high, rows, rows).near(unit, cell, 0.9)
    a, b = np.nonzero(unit @ unit.T >= 0.9)
    assert near[a, cell[b]].all() and near.mean() < 0.9


def test_large_components_are_counted_in_blocks(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal(8)
    members = [(1, i, (base + 0.3 * rng.standard_normal(8)).astype(float).tobytes(), 1) for i in range(40)]
    frame = spark.createDataFrame(
        [(c, n, bytearray(v), k) for c, n, v, k in members], "component long, node long, vector binary, copies long"
    )
    unit = embed_dedup.unit_matrix([v for _, _, v, _ in members])
    expected = ((unit @ unit.T) >= 0.9).sum(axis=1)
    found = {r["node"]: r["reach"] for r in embed_dedup.linked_counts(frame, block=7).collect()}
    assert [found[i] for i in range(40)] == expected.tolist()


def test_top_k_equals_brute_force(spark):
    rows = cluster_rows()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS score")
    found = topk.search(frame, every=50).collect()
    sound = [(i, np.floor(1024 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and i not in (400, 401, 403, 404, 500)]
    for query in {i for i, _ in sound if i % 50 == 0}:
        q = dict(sound)[query]
        expected = sorted(((-int(q @ v), i) for i, v in sound if i != query))[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == query)
        assert mine == [(n + 1, i, -s) for n, (s, i) in enumerate(expected)]
    assert topk.search(frame.limit(0)).count() == 0


def floors(vector):
    return np.floor(1024 * np.array(vector, np.float32).astype(float)).astype(np.int64)


def plain_top_k(rows, every, k=10):
    """Every row with a query's id asks for itself; all other rows of its length are its candidates."""
    sound = [(i, floors(v)) for i, v in rows]
    answers = Counter()
    for at, (query, q) in enumerate(sound):
        if query % every == 0:
            found = sorted((-int(q @ v), i) for n, (i, v) in enumerate(sound) if n != at and len(v) == len(q))[:k]
            answers.update((query, n + 1, i, -s) for n, (s, i) in enumerate(found))
    return answers


def test_every_row_of_a_repeated_id_asks(spark):
    rng = np.random.default_rng(13)
    centres = rng.standard_normal((64, 16))
    rows = [(6 * c + i, (centres[c] + 0.01 * rng.standard_normal(16)).tolist()) for c in range(64) for i in range(6)]
    rows += [(0, (centres[0] + 0.01 * rng.standard_normal(16)).tolist()) for _ in range(19)]
    # Equal rows, other lengths, and numbers that need more than four bytes.
    rows += [rows[0]] * 2 + [(1000, [1.0, 2.0]), (2000, [3.0, 1.0]), (7, [0.5, 0.5])] + [(3000, [2.2e6, *[1.0] * 15]), (1, [-2.2e6, *[2.0] * 15])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = Counter(tuple(r) for r in topk.search(frame, every=1000).collect())
    assert found == plain_top_k(rows, 1000)


def test_top_k_query_matches_sql_on_repeated_ids(tmp_path, spark):
    rng = np.random.default_rng(14)
    rows = [(int(i), rng.standard_normal(n).tolist()) for i in rng.integers(0, 40, 150) for n in (rng.choice([3, 4]),)]
    rows += [(100, None), (200, [float("inf"), 1.0, 2.0]), (None, [1.0, 2.0, 3.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    database = duckdb.connect()
    database.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    result = topk.search(spark.read.parquet(f"{tmp_path}/embeddings.parquet"))
    expected = Counter(database.sql(f"SELECT {', '.join(result.columns)} FROM ({topk.ORACLE})").fetchall())
    assert expected and Counter(map(tuple, result.collect())) == expected


def test_clustered_data_is_searched_in_few_cells(spark, monkeypatch):
    """Of all pairs of queries and cells less than half are searched, and nothing is missed."""
    rng = np.random.default_rng(15)
    centres = 3 * rng.standard_normal((20, 8))
    rows = [(i, (centres[i % 20] + 0.2 * rng.standard_normal(8)).tolist()) for i in range(1500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    kept = {}
    real = topk.kept_table
    monkeypatch.setattr(topk, "kept_table", lambda df, name: kept.setdefault(name, real(df, name)))
    monkeypatch.setattr(topk, "DATA_BLOCK", 20)
    vectors = topk.packed(frame)
    found = topk.top_k(vectors.filter("vec_id % 10 = 0"), vectors, rows_per_pivot=30)
    assert Counter(tuple(r) for r in found.collect()) == plain_top_k(rows, 10)
    cells, queries = kept["topk-sizes"].count(), 150
    searched = kept["topk-first-asks"].count() + kept["topk-asks"].count()
    assert cells > 20 and searched < cells * queries / 2


def test_products_beyond_64_bits_are_an_error(spark):
    for value in (1e300, 1e16):
        frame = spark.createDataFrame([(0, [value] * 4), (1, [value] * 4)], "vec_id long, embedding array<double>")
        with pytest.raises(Exception, match="beyond 64 bits"):
            topk.search(frame).collect()


# Texts


def test_minhash_groups_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choice(vocabulary, 80)) for _ in range(40)]
    texts = list(base)
    for i in range(30):
        words = base[3].split()
        words[i] = "other"
        texts.append(" ".join(words))
    texts += [base[5].upper(), base[5], base[5], None, "", "!!", "a b", "A, b", "a b c", "x " * 3000, "x " * 2990]
    docs = documents(spark, texts).withColumnRenamed("lang", "digest")
    found = {r["doc_id"]: r["group_id"] for r in minhash.near_duplicates(docs).collect()}
    weighed = []
    for text in texts:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        runs = [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []
        weighed.append(Counter(runs))
    parent = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = (weighed[a] & weighed[b]).total()
            if common and common >= 0.8 * (weighed[a] | weighed[b]).total():
                low, high = sorted((parent[a], parent[b]))
                parent = [low if p == high else p for p in parent]
    assert [found[i] for i in range(len(texts))] == parent
    kept = minhash.one_of_each(documents(spark, texts)).select("doc_id").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(parent))
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_an_id_on_different_texts_keeps_the_links_of_each(spark):
    rng = np.random.default_rng(3)
    one, other, third = (rng.choice([f"w{i}" for i in range(500)], 80).tolist() for _ in range(3))
    changed = lambda words: " ".join([*words[:-1], "changed"])
    rows = [
        (5, " ".join(one)), (5, " ".join(other)), (8, changed(one)), (9, changed(other)),
        (2, " ".join(third)), (2, changed(third)), (2, changed(third)), (7, "x " + " ".join(third)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCUMENTS)
    found = sorted(map(tuple, minhash.near_duplicates(docs).select("doc_id", "group_id").collect()))
    assert found == [(2, 2), (2, 2), (2, 2), (5, 5), (5, 5), (7, 2), (8, 5), (9, 5)]
    kept = Counter((r["doc_id"], r["text"]) for r in minhash.one_of_each(docs).collect())
    assert kept[rows[0]] == kept[rows[1]] == 1 and kept[rows[4]] + kept[rows[5]] == 1 and kept.total() == 3


def test_blocks_of_a_bucket_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    sets = {i: np.unique(np.r_[rng.choice(60, rng.integers(38, 55), replace=False), 100 + i // 9]).astype(np.uint64) for i in range(70)}
    sets[70] = np.arange(1000, dtype=np.uint64)
    bucket = {i: (0, 5 if i < 67 else 6) for i in range(70)} | {70: (0, 5)}
    part = {i: i if i % 3 else 0 for i in sets}
    stored = spark.createDataFrame([(i, v.tobytes(), len(v)) for i, v in sets.items()], "node long, elements binary, size long")
    members = spark.createDataFrame([(*bucket[i], i, part[i]) for i in sets], "band int, hash long, node long, part long")
    expected = set()
    for a in (i for i in sets if part[i]):
        for b in sets:
            common = len(np.intersect1d(sets[a], sets[b]))
            if bucket[a] == bucket[b] and part[a] != part[b] and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                expected.add((a, part[b]))
    for elements in (100, 10**6):
        monkeypatch.setattr(minhash, "ELEMENTS_PER_BLOCK", elements)
        links = minhash.compared_blocks(members.filter("part > 0"), members, stored).collect()
        found = {(x, part[y]) for a, b in links for x, y in ((a, b), (b, a)) if part[x]}
        assert expected and found == expected
        fewer = minhash.compared_blocks(members.filter("part > 0"), members, stored, spanning=True)
        few = [(row["a"], row["b"]) for row in fewer.collect()]
        assert len(few) <= len(links)
        # Parts that links unite are the same either way.
        assert united_parts(few, part) == united_parts([(row["a"], row["b"]) for row in links], part)
    assert minhash.compared_blocks(members.limit(0), members, stored).count() == 0


def test_blocks_of_near_copies_give_no_more_links_than_members(spark, monkeypatch):
    base = np.arange(200, dtype=np.uint64)
    sets = {i: np.r_[base, np.uint64(1000 + i)] for i in range(60)}
    stored = spark.createDataFrame([(i, v.tobytes(), len(v)) for i, v in sets.items()], "node long, elements binary, size long")
    members = spark.createDataFrame([(0, 5, i, i) for i in sets], "band int, hash long, node long, part long")
    for elements in (3000, 10**6):
        monkeypatch.setattr(minhash, "ELEMENTS_PER_BLOCK", elements)
        links = minhash.compared_blocks(members, members, stored, spanning=True).collect()
        blocks = -(-60 * 201 // elements)
        # Each of the tasks gives fewer links than the classes it has.
        assert 59 <= len(links) <= 2 * 60 * blocks < 60 * 59 / 2
        assert united_parts([(row["a"], row["b"]) for row in links], {i: i for i in sets}) == {frozenset(sets)}


def united_parts(links, part):
    groups = {p: {p} for p in part.values()}
    for a, b in links:
        one = groups[part[a]] | groups[part[b]]
        groups.update(dict.fromkeys(one, one))
    return {frozenset(group) for group in groups.values()}


def test_darts_estimate_weighted_similarity():
    a, b = "p " * 60 + "q " * 40, "p " * 60 + "r " * 40
    data = np.frombuffer((a + b).encode(), np.uint8)
    elements, owner = minhash.weighted_runs(data, np.array([len(a), len(a) + len(b)]))
    one, other = (set(elements[owner == k].tolist()) for k in (0, 1))
    signed = minhash.signatures(elements, owner, 2, k=2000)
    assert abs((signed[0] == signed[1]).mean() - len(one & other) / len(one | other)) < 0.04


# Classifiers


def test_quality_on_held_out_rows(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = quality.classify(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held = found[found.held_out]
    assert (held.predicted == held.quality).mean() >= 0.93
    assert held.score.between(0, 1).all()


def test_quality_edge_cases(spark):
    docs = documents(spark, [None, "", "good words", "BAD!! BAD!!"]).withColumnRenamed("lang", "score")
    labels = spark.createDataFrame([(2, 1), (3, 0), (3, None), (99, 1), (None, 0)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == 4
    assert {r["score"] for r in quality.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert quality.accepted(documents(spark, ["a"]), labels.limit(0)).columns == DOCUMENTS.replace(" long", "").replace(" string", "").split(", ")


def test_repeated_documents_are_one_row_of_the_training_samples(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 5)
    sizes = []
    for module, name in ((quality, "counted"), (langid, "sampled_windows")):
        whole = getattr(module, name)
        monkeypatch.setattr(module, name, lambda rows, *more, whole=whole: sizes.append(rows.count()) or whole(rows, *more))
    docs = documents(spark, ["good words", "BAD!! BAD!!", "more words"])
    docs = docs.unionByName(documents(spark, ["good words"]).crossJoin(spark.range(200)).drop("id"))
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    quality.train(docs, labels)
    langid.train(docs)
    assert sizes == [3, 3]


def test_gradients_equal_differences():
    network = langid.new_network(["a", "b"], units=3, seed=4)
    rng = np.random.default_rng(1)
    data, labels = rng.integers(97, 110, (5, 4)).astype(np.uint8), np.array([0, 1, 1, 0])
    mask = np.arange(5)[:, None] < np.array([5, 3, 4, 5])
    _, slopes = langid.gradients(network, data, labels, mask)
    for parameter, slope in zip(network.parameters(), slopes, strict=True):
        where = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept = parameter[where]
        losses = []
        for step in (1e-2, -1e-2):
            parameter[where] = kept + step
            losses.append(langid.gradients(network, data, labels, mask)[0])
        parameter[where] = kept
        assert abs((losses[0] - losses[1]) / 2e-2 - slope[where]) < 2e-2 * max(0.05, abs(slope[where]))


def test_languages_of_held_out_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = langid.predict(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = found[found.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.9


def test_language_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 5)
    docs = documents(spark, [None, "", "123 !", "hello there", "hello there", "word " * 20000])
    found = {r["doc_id"]: r for r in langid.predict(docs).collect()}
    assert [found[i]["lang_pred"] for i in range(6)] == ["und"] * 3 + ["en"] * 3
    assert all(found[i]["score"] == 0 for i in range(3))
    unknown = langid.predict(documents(spark, ["hello"], lang=None)).collect()
    assert unknown[0]["lang_pred"] == "und"
    assert langid.predict(docs.limit(0)).count() == 0


# The pipeline


def test_pipeline_runs_and_stages_keep_their_columns(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.kept_table(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        sizes.append(docs.count())
    # Filters reject something, and most documents stay.
    assert sizes[0] > sizes[1] >= sizes[2] > sizes[3] > 0.5 * sizes[0]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    digests = {hashlib.sha256(r["text"].encode()).hexdigest() for r in docs.select("text").collect()}
    assert {r["decoded_sha256"] for r in last.collect()} == digests


def test_no_stage_minds_the_names_of_further_columns(spark, sf_dir):
    """Columns that are called like what operators add, through all stages; on an empty table too."""
    import corpus_pipeline
    from pyspark.sql import functions as F

    names = ["score", "rows", "extra", "_text", "lang_pred", "s_id", "digest", "shard", "others", "row", "Held", "id", "a.b"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("*", *(F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in names))
    for start in (docs, docs.limit(0)):
        now = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            now = corpus_pipeline.kept_table(stage(spark, now, sf_dir), name)
            assert now.columns == docs.columns
        kept = now.select("doc_id", *(F.col(f"`{name}`") for name in names)).collect()
        assert all(row[1 + k] == f"{name} {row['doc_id']}" for row in kept for k, name in enumerate(names))
        last = corpus_pipeline.STAGES[-1][1](spark, now, sf_dir)
        assert last.count() == now.count()
    assert len(kept) == 0
