"""Chat formatting with a grammar round trip.

Template. A turn is OPEN text CLOSE and a line end; OPEN and CLOSE depend on the role: user `[INST] ` and ` [/INST]`,
assistant `<s> ` and `</s>`, system `[SYS] ` and ` [/SYS]`, any other role `[ROLE role] ` and ` [/ROLE]`. A backslash makes the
next character plain where that character is `<`, `[` or a backslash.

Round trip. Each turn is rendered and read again by a deterministic parser; if role and text are not identical to
the source, the conflicting content is escaped (the text, then the role) and the turn is rendered again, until they are.
So most texts are written as they are, and every text, also one that holds control strings, is recovered.

Scale. Turns are rendered row by row. Reading back sorts the rendered turns by conversation and turn and hashes them
as a stream, so a conversation of any length needs no memory; a digest over a conversation's turns is sequential by nature.

Defined cases. Null text: empty. Null role: empty role (an "other" role). Null turn: before the others. Null
conv_id: one conversation of its own. Equal turns are ordered by role, then text. An empty table gives an empty table.
Only the four named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the template's control strings for each role
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s> ", "</s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER = ("[ROLE ", "] ", " [/ROLE]")
CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[/SYS]", "[ROLE", "[/ROLE]"]

_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_ESCAPED = re.compile(r"\\([<\[\\])")

def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def parse(s: str, at: int = 0) -> tuple[str, str, int, int, int] | None:
    """The turn that starts at `at`: role, text, where the escaped text starts and ends, where the turn ends."""
    for role, (opening, _) in MARKS.items():
        if s.startswith(opening, at):
            begin = at + len(opening)
            break
    else:
        if not s.startswith(OTHER[0], at):
            return None
        role, begin = "", at + len(OTHER[0])
    name = role
    if not role:
        end = begin
        while end < len(s) and s[end] != "]":
            end += 1
        if not s.startswith(OTHER[1], end):
            return None
        name, begin = bytes.fromhex(s[begin + 1 : end]).decode() if s[begin : begin + 1] == "#" else s[begin:end], end + len(OTHER[1])
    close = MARKS[role][1] if role else OTHER[2]
    i = begin
    while True:
        # the next control string or escape; everything before it is text
        c, e = s.find(close + "\n", i), s.find("\\", i)
        if c < 0:
            return None
        if 0 <= e < c:
            i = e + 2 if s[e + 1 : e + 2] in ("<", "[", "\\") else e + 1
            continue
        m = _CONTROL.search(s, begin if i == begin else i, c)
        if m:
            return None
        return name, unescape(s[begin:c]), begin, c, c + len(close) + 1


def render(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and the range of the (escaped) text in it."""
    for k in range(3):
        t = escape(text) if k else text
        if role in MARKS:
            opening, close = MARKS[role]
        else:
            opening, close = OTHER[0] + ("#" + role.encode().hex() if k > 1 or role.startswith("#") else role) + OTHER[1], OTHER[2]
        s = opening + t + close + "\n"
        got = parse(s)
        if got and got[:2] == (role, text) and got[4] == len(s):
            return s, got[2], got[3]
    raise ValueError("a turn cannot be formatted")


def _render(batches):
    for batch in batches:
        made = [render(r or "", t or "") for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)]
        s, a, b = zip(*made, strict=True) if made else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("c"), batch.column("turn"), batch.column("k"), pa.array(s, pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
            ["c", "turn", "k", "formatted", "text_from", "text_to"],
        )


def format_turns(conversations: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conv_id, turn, k, formatted, text_from, text_to): k orders equal turns; a conversation is its turns joined."""
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    )
    rows = rows.withColumn("k", F.concat(F.coalesce("role", F.lit("")), F.lit("\n"), F.coalesce("text", F.lit(""))))
    return rows.mapInArrow(_render, "c long, turn long, k string, formatted string, text_from long, text_to long").withColumnRenamed("c", conv_col)


class _Digest:
    def __init__(self):
        self.turns, self.loss, self.n, self.chars, self.loss_chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0

    def add(self, s: str) -> None:
        at = 0
        while at < len(s):
            got = parse(s, at)
            if not got:
                raise ValueError("formatted text does not follow the grammar")
            role, text, _, _, at = got
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == "assistant":
                self.loss.update(text.encode())
                self.loss_chars += len(text)
        self.chars += len(s)

    def row(self, conv):
        return conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ = ["c", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _read(batches):
    none = object()
    conv, d, out = none, None, []

    def rows():
        cols = list(zip(*out, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], READ)

    for batch in batches:
        for c, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if c != conv or conv is none:
                if d:
                    out.append(d.row(conv))
                conv, d = c, _Digest()
            d.add(s)
        if out:
            yield rows()
            out = []
    if d:
        out.append(d.row(conv))
        yield rows()


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Parses formatted turns again: (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)."""
    rows = formatted.repartition(conv_col).sortWithinPartitions(conv_col, "turn", "k").select(conv_col, "formatted")
    return rows.mapInArrow(_read, "c long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumnRenamed("c", conv_col)


def op5_chat_format(spark, sf_dir):
    """Registered query: all conversations, and conversation -1 whose texts hold control strings."""
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return read_back(format_turns(conv.unionByName(extra)))


_CONTROL_SQL = r"\[INST\]|\[/INST\]|<s>|</s>|\[SYS\]|\[/SYS\]|\[ROLE|\[/ROLE\]"
OP5_SQL = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), f AS (
  SELECT *, regexp_matches(text, '{_CONTROL_SQL}|\\[<\[\\]') AS hard,
    length(text) - length(replace(text, '\', '')) AS slashes,
    len(regexp_extract_all(text, '{_CONTROL_SQL}')) AS controls,
    CASE role WHEN 'user' THEN 16 WHEN 'assistant' THEN 9 WHEN 'system' THEN 14 ELSE 17 + length(role) END AS frame
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(text) + frame + CASE WHEN hard THEN slashes + controls ELSE 0 END) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""
