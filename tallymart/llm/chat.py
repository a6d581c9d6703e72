r"""Chat formatting by token-level assembly.

Turns are encoded one by one and reserved ids are spliced around them, so a
control string that occurs in a text can never become a control id:

    system     <<SYS>> text <</SYS>>
    user       [INST] text [/INST]
    assistant  <s> text </s>
    others     [ROLE] role [/ROLE] text </s>

(without the blanks). In the formatted string the same texts are escaped
reversibly: a backslash is doubled, and a control string gets a backslash after its
first character, ``[\INST]``, so it is no longer found by a search. The loss mask
covers the text of assistant turns. It comes from prefix sums over the ids: an
opening id adds one, a closing id takes it away, and what lies inside is learned.

Defined results: a NULL text is empty; a NULL role is the empty role; rows of a
conversation are ordered by turn (NULL last), then role and text; repeated rows are
repeated turns; rows with a NULL conv_id are one conversation. A very long text is a turn like any
other. An empty table has no conversations. Other columns are ignored.

All work on a turn is done where the turn is read. What is told per conversation is a digest
of its bytes in their order, which nothing but one pass over them gives: the texts of a
conversation, and no more than these, stream through one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.bpe import blocks, decode_ids, encode_block, vocabulary

# The control strings, in the order of their reserved ids, which follow the vocabulary's own.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
FIRST_RESERVED = 50257
RESERVED = {text: FIRST_RESERVED + i for i, text in enumerate(CONTROLS)}
TURN_MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}

_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROLS, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(\\?)")

SEGMENT_SCHEMA = (
    "conv_id long, turn long, role string, text string, ids array<int>, loss_mask array<byte>, formatted string"
)
READ_SCHEMA = "conv_id long, turn long, role string, text string, learned string, formatted_chars long"
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoded(texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of each text by itself; the vocabulary's own special strings are ordinary text inside a turn."""
    if len(vocabulary(path).tokens) > FIRST_RESERVED:
        raise ValueError("the vocabulary reaches into the reserved ids")
    ids, starts = encode_block(texts, path, added=False)
    return [ids[a:b].astype(np.int32) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def loss_mask(ids: np.ndarray) -> np.ndarray:
    """1 for ids between an assistant's opening and closing id, by a prefix sum."""
    opens = ids == RESERVED["<s>"]
    # Only an assistant's turn is open when its closing id comes, so other roles' </s> are kept out by their [ROLE].
    closes = (ids == RESERVED["</s>"]) & (np.cumsum(opens) > 0)
    inside = np.cumsum(opens.astype(np.int64) - closes)
    return ((inside > 0) & ~opens).astype(np.int8)


def assemble(role: str, text_ids: Sequence[int], role_ids: Sequence[int]) -> np.ndarray:
    if role in TURN_MARKS:
        opening, closing = TURN_MARKS[role]
        parts = [[RESERVED[opening]], text_ids, [RESERVED[closing]]]
    else:
        parts = [[RESERVED["[ROLE]"]], role_ids, [RESERVED["[/ROLE]"]], text_ids, [RESERVED["</s>"]]]
    return np.concatenate([np.asarray(part, np.int32) for part in parts])


def render(role: str, text: str) -> str:
    if role in TURN_MARKS:
        opening, closing = TURN_MARKS[role]
        return opening + escape(text) + closing
    return "[ROLE]" + escape(role) + "[/ROLE]" + escape(text) + "</s>"


def assembled_turns(roles: list[str], texts: list[str], path: str) -> list[np.ndarray]:
    """The ids of some turns, with the reserved ones spliced around what was encoded by itself."""
    others = sorted({role for role in roles if role not in TURN_MARKS})
    role_ids = dict(zip(others, encoded(others, path), strict=True))
    return [assemble(role, ids, role_ids.get(role, ())) for role, ids in zip(roles, encoded(texts, path), strict=True)]


def plain_turns(turns: DataFrame) -> DataFrame:
    return turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def format_turns(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One row per turn: its ids with the reserved ones, its loss mask and its formatted string.

    Concatenated in the order of turns these are the conversation. Turns are
    independent, so this is a single pass without a shuffle.
    """
    path = tokenizer or default_tokenizer()

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                roles = part.column("role").to_pylist()
                ids = assembled_turns(roles, texts, path)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(name) for name in ("conv_id", "turn", "role", "text")),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([loss_mask(x) for x in ids], pa.list_(pa.int8())),
                        pa.array([render(*turn) for turn in zip(roles, texts, strict=True)]),
                    ],
                    names=["conv_id", "turn", "role", "text", "ids", "loss_mask", "formatted"],
                )

    return plain_turns(turns).mapInArrow(formatted, SEGMENT_SCHEMA)


def read_turns(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Format every turn and read it back: role and text from its formatted string, and ``learned``
    from the ids under its loss mask, NULL where it is the text of the turn.

    Ids and strings do not leave the task that makes them.
    """
    path = tokenizer or default_tokenizer()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in blocks(batch, "text"):
                roles = part.column("role").to_pylist()
                ids = assembled_turns(roles, texts, path)
                strings = [render(*turn) for turn in zip(roles, texts, strict=True)]
                found = [parse(string) for string in strings]
                learned = [decode_ids(x[loss_mask(x).astype(bool)], path) for x in ids]
                told = [None if text == said else text for text, (_, said) in zip(learned, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("conv_id"),
                        part.column("turn"),
                        pa.array([role for role, _ in found], pa.string()),
                        pa.array([text for _, text in found], pa.string()),
                        pa.array(told, pa.string()),
                        pa.array([len(string) for string in strings], pa.int64()),
                    ],
                    names=["conv_id", "turn", "role", "text", "learned", "formatted_chars"],
                )

    return plain_turns(turns).mapInArrow(read, READ_SCHEMA)


def with_control_case(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    case = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(case)


_MARKED = re.compile(f"({'|'.join(map(re.escape, sorted(CONTROLS, key=len, reverse=True)))})")


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    # ["", opening, text, closing, ""], or ["", "[ROLE]", role, "[/ROLE]", text, "</s>", ""].
    parts = _MARKED.split(formatted)
    if parts[1] == "[ROLE]":
        return unescape(parts[2]), unescape(parts[4])
    role = next(name for name, marks in TURN_MARKS.items() if marks[0] == parts[1])
    return role, unescape(parts[2])


class _Digest:
    """What is read back of one conversation, turn by turn; its size does not grow with the turns."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.n_turns, self.loss_chars, self.formatted_chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, learned: str | None, formatted_chars: int) -> None:
        learned = text if learned is None else learned
        self.n_turns += 1
        self.formatted_chars += formatted_chars
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss_chars += len(learned)
        self.loss.update(learned.encode())

    def row(self) -> tuple:
        return (
            self.conv_id,
            self.n_turns,
            self.turns.hexdigest(),
            self.loss_chars,
            self.loss.hexdigest(),
            self.formatted_chars,
        )


def read_back(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Format all conversations and report, per conversation, what can be read from the output.

    The turns of a conversation stream through one task in order; only digests are
    held, so a long conversation needs no memory.
    """
    # role and text order repeated turn numbers; they are not what is read back.
    ordered = (
        read_turns(turns, tokenizer)
        .repartition("conv_id")
        .sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_last(), F.col("role"), F.col("text"))
    )
    names = [field.split()[0] for field in DIGEST_SCHEMA.split(", ")]

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        current: _Digest | None = None
        for batch in batches:
            done = []
            columns = (batch.column(name).to_pylist() for name in ("conv_id", "role", "text", "learned", "formatted_chars"))
            for conv_id, *turn in zip(*columns, strict=True):
                if current is None or conv_id != current.conv_id:
                    if current is not None:
                        done.append(current.row())
                    current = _Digest(conv_id)
                current.add(*turn)
            if done:
                columns = [pa.array(x, t) for x, t in zip(zip(*done, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if current is not None:
            columns = [pa.array([x], t) for x, t in zip(current.row(), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return ordered.drop("turn").mapInArrow(digests, DIGEST_SCHEMA)


def _escaped_sql(column: str) -> str:
    sql = f"replace({column}, '\\', '\\\\')"
    for control in CONTROLS:
        sql = f"replace({sql}, '{control}', '{control[0]}\\{control[1:]}')"
    return sql


ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length({_escaped_sql("text")}) + CASE role
    WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    ELSE length({_escaped_sql("role")}) + 17 END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
