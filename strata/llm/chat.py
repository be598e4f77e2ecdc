"""Chat formatting by a grammar round trip.

A conversation is rendered by a template, the rendered text is parsed again
by a deterministic parser, and the recovered turns are compared with the
source. The grammar allows no bare control string inside a text, so turns
whose text conflicts are escaped and the conversation is rendered again,
until the recovered turns are identical.

    conversation = "<s>" turn*
    system       = "<<SYS>>\\n" text "\\n<</SYS>>\\n\\n"
    user         = "[INST] " text " [/INST]"
    assistant    = " " text " </s>"
    other role   = "<|" role "|>" text "<|end|>"

Escaping puts one backslash behind the first character of each control
string (which may already hold backslashes); reading takes one away. So it is
reversible for every text. The loss mask covers the assistants' texts.

A turn conflicts by its own text alone, so turns are rendered and read back
one by one. Turns are dealt by conversation and sorted (on disk where they
do not fit); a conversation's turns then stream by, with a running offset and
running digests, so that a task holds a slice of turns however long the
conversation is.

Defined cases: a null text or role is the empty string; turns go by turn
(null first), then role, then text, so repeated turns keep their number; rows
with a null conv_id form one conversation; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import in_slices, table, text_or_empty

START = "<s>"
TEMPLATE = {"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", " </s>")}
ROLE_OPEN, ROLE_CLOSE, OTHER_END = "<|", "|>", "<|end|>"
_REST = r"(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|end\|>)"
BARE = re.compile(r"[<\[]" + _REST)
ESCAPABLE = re.compile(r"([<\[])(\\*)" + _REST)
ESCAPED = re.compile(r"([<\[])\\(\\*)" + _REST)

FORMATTED = "conv_id long, at long, formatted string, loss struct<start:bigint,end:bigint>"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

Turn = tuple[str, str]


class Unreadable(ValueError):
    """The text is not of the grammar."""


def escape(text: str) -> str:
    return ESCAPABLE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def render(turns: list[Turn], escaped: list[bool]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the loss mask's spans."""
    parts, at, loss = [START], len(START), []
    for (role, text), e in zip(turns, escaped):
        text = escape(text) if e else text
        if role in TEMPLATE:
            head, tail = TEMPLATE[role]
        else:
            name = role.replace("\\", "\\\\").replace("|", "\\p").replace("<", "\\l")
            head, tail = ROLE_OPEN + name + ROLE_CLOSE, OTHER_END
        if role == "assistant":
            loss.append((at + len(head), at + len(head) + len(text)))
        parts += [head, text, tail]
        at += len(head) + len(text) + len(tail)
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """role, text as written, and its place, of every turn."""
    if not formatted.startswith(START):
        raise Unreadable("no start")
    at, out = len(START), []
    while at < len(formatted):
        for role, (head, tail) in TEMPLATE.items():
            if formatted.startswith(head, at):
                begin = at + len(head)
                break
        else:
            close = formatted.find(ROLE_CLOSE, at)
            if not formatted.startswith(ROLE_OPEN, at) or close < 0:
                raise Unreadable(f"no turn at {at}")
            name, begin, tail = formatted[at + len(ROLE_OPEN) : close], close + len(ROLE_CLOSE), OTHER_END
            role = re.sub(r"\\(.)", lambda m: {"p": "|", "l": "<"}.get(m[1], m[1]), name)
        end = formatted.find(tail, begin)
        if end < 0:
            raise Unreadable(f"no end of the turn at {at}")
        out.append((role, formatted[begin:end], begin, end))
        at = end + len(tail)
    return out


def read(formatted: str) -> list[Turn]:
    return [(role, unescape(text)) for role, text, _, _ in parse(formatted)]


def format_turns(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """Render, parse, compare; escape what conflicts until identical."""
    escaped = [False] * len(turns)
    while True:
        formatted, loss = render(turns, escaped)
        try:
            got = parse(formatted)
        except Unreadable:
            got = []
        same = len(got) == len(turns)
        bad = [
            i
            for i, (turn, e) in enumerate(zip(turns, escaped))
            if not e and (ESCAPABLE.search(turn[1]) if not same else BARE.search(got[i][1]) or (got[i][0], unescape(got[i][1])) != turn)
        ]
        if not bad:
            if [(r, unescape(t)) for r, t, _, _ in got] == turns:
                return formatted, loss
            bad = [i for i, e in enumerate(escaped) if not e]
            if not bad:
                raise AssertionError("an escaped conversation must read back")
        for i in bad:
            escaped[i] = True


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, at, formatted, loss: one row per turn, the conversations' turns
    in order and together; ``at`` is where the turn begins in its conversation."""
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), text_or_empty().alias("text"))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        last, at = (), 0  # (conv_id,) of the turn before, and where the next one begins
        for batch in in_slices(batches):
            ats, pieces, masks = [], [], []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                piece, loss = format_turns([(role, text)])
                if (conv,) == last:
                    piece, loss = piece[len(START) :], [(a - len(START), b - len(START)) for a, b in loss]
                else:
                    last, at = (conv,), 0
                ats.append(at), pieces.append(piece)
                masks.append({"start": at + loss[0][0], "end": at + loss[0][1]} if loss else None)
                at += len(piece)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ats, pa.int64()), pa.array(pieces, pa.string()), pa.array(masks, spans)], names=["conv_id", "at", "formatted", "loss"])

    return ordered.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts and their masks hold; the rows as
    ``format_conversations`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, n, sha, n_learned, learned_sha, chars = None, 0, hashlib.sha256(), 0, hashlib.sha256(), 0

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = [*zip(*rows)] or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays([*map(pa.array, columns, kinds)], names=names)

        for batch in in_slices(batches):
            done = []
            for conv_id, at, text, mask in zip(*(c.to_pylist() for c in batch.columns)):
                if not at:
                    if n:
                        done.append((conv, n, sha.hexdigest(), n_learned, learned_sha.hexdigest(), chars))
                    conv, n, sha, n_learned, learned_sha, chars = conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0
                for role, turn in read(text if not at else START + text):
                    n += 1
                    sha.update(f"{role}\n{turn}\n".encode())
                if mask is not None:
                    learned = unescape(text[mask["start"] - at : mask["end"] - at])
                    n_learned += len(learned)
                    learned_sha.update(learned.encode())
                chars += len(text)
            yield out(done)
        if n:
            yield out([(conv, n, sha.hexdigest(), n_learned, learned_sha.hexdigest(), chars)])

    return formatted.mapInArrow(run, DIGESTS)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one that holds control strings, read back."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(rows.unionByName(extra)))


#: Lengths of what the template puts around a text, and the escapes' own.
SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (
  SELECT *, len(regexp_extract_all(text, '[<\[]\\*(s>|/s>|INST\]|/INST\]|<SYS>>|</SYS>>|\|end\|>)')) AS escapes,
    CASE role WHEN 'system' THEN 8 + 11 WHEN 'user' THEN 7 + 8 WHEN 'assistant' THEN 1 + 5
      ELSE 4 + 7 + length(replace(replace(replace(role, '\', '\\'), '|', '\p'), '<', '\l')) END AS marks
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(text) + escapes + marks) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
