"""Conversation structure repair by a dynamic programme with square-root checkpoints.

A conversation's role initials shall read (s?(ua)+)?. Keep costs 0, Rerole (to user or assistant) 1, Delete 2, Insert
(an empty user or assistant turn) 5; blank and duplicate rows must go, truncated rows that stay cost 5 more. Of the
cheapest edit strings the ASCII-least is taken: walking forward, the least letter that is tight against the backward
costs.

The automaton has four states, so a row's backward costs are four numbers. Rows are numbered in their conversation and
block b holds the rows b*b .. (b+1)*(b+1)-1, so n rows make about sqrt(n) blocks of at most 2*sqrt(n). One stream goes
through the blocks backward and keeps the costs only at block ends (the checkpoints). A second goes forward: at each
block it recomputes the block's costs from its checkpoint, walks, and passes the block's rows on with their edits. So
no task holds more than a block's letters and the rows of one Arrow batch; a conversation is one task's stream, since
its digest is sequential, and windows over it spill.

Faults, first one counts: blank (no character but white space), duplicate (role and text seen earlier in the
conversation), truncated (last such character not one of .!?). White space is x20 and x09-x0D.

Defined cases: nulls in role and text are one space; a null turn comes first; rows of one turn are ordered by role and
text. Rows with a null conv_id are one conversation. Repeated rows are duplicates. Other columns are ignored. Gaps
beyond a long are its largest value. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written

RETYPE, DROP, INSERT, CUT = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
END = (0, 2 * INSERT, INSERT, 0)  # costs after the last row, by state
NEXT = (USER, USER, ASSISTANT, USER)  # what an inserted or retyped turn is in each state
KEEP = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}

_SOLID = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"


def before(letter: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """Backward costs in front of a row, by state. letter: D must go; else the role's initial or x, upper case if truncated."""
    v = [after[q] + DROP for q in range(4)]
    if letter != "D":
        cut, initial = CUT if letter.isupper() else 0, letter.lower()
        for q in range(4):
            v[q] = min(v[q], after[NEXT[q]] + RETYPE + cut)
            to = KEEP.get((initial, q))
            if to is not None:
                v[q] = min(v[q], after[to] + cut)
    u, a = min(v[USER], v[ASSISTANT] + INSERT), min(v[ASSISTANT], v[USER] + INSERT)
    return min(v[START], u + INSERT), min(v[SYSTEM], u + INSERT), u, a


def walk(letters: str, after: tuple[int, ...], q: int) -> tuple[list[tuple[list[str], str, str | None]], int]:
    """The least tight edits of a block entered in state q: per row (roles inserted before, edit, new role), and the state behind it."""
    costs = [after]
    for letter in reversed(letters):
        costs.append(before(letter, costs[-1]))
    costs.reverse()
    out = []
    for i, letter in enumerate(letters):
        here, then, put = costs[i], costs[i + 1], []
        cut, to = (CUT if letter.isupper() else 0), KEEP.get((letter.lower(), q))
        while here[q] != then[q] + DROP and here[q] == here[NEXT[q]] + INSERT:
            q = NEXT[q]
            put.append(ROLE[q])
            to = KEEP.get((letter.lower(), q))
        if here[q] == then[q] + DROP:
            out.append((put, "D", None))
        elif to is not None and letter != "D" and here[q] == then[to] + cut:
            out.append((put, "K", None))
            q = to
        else:
            q = NEXT[q]
            out.append((put, "R", ROLE[q]))
    return out, q


# --- rows in order, with their faults ----------------------------------------------------------------------------------


def judged(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text, place) with position, block, fault and letter; place orders the rows of a conversation."""
    order = Window.partitionBy("conv_id").orderBy("place")
    rows = rows.withColumn("pos", F.row_number().over(order).cast("long")).drop("place")
    same = F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("same", same)
    rows = rows.withColumn("again", F.row_number().over(Window.partitionBy("conv_id", "same").orderBy("pos")) > 1).drop("same")
    fault = F.when(~F.col("text").rlike(_SOLID), "blank").when(F.col("again"), "duplicate").when(~F.col("text").rlike(_ENDED), "truncated")
    rows = rows.withColumn("fault", fault).drop("again")
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    letter = F.when(F.col("fault").isin("blank", "duplicate"), "D").when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    return rows.withColumn("letter", letter).withColumn("block", F.floor(F.sqrt(F.col("pos") - 1)).cast("long"))


def _checkpoints(batches):
    conv, after = object(), END
    for batch in batches:
        kept = []
        for c, letters in zip(batch.column("conv_id").to_pylist(), batch.column("letters").to_pylist(), strict=True):
            if c != conv:
                conv, after = c, END
            kept.append(list(after))
            for letter in reversed(letters):
                after = before(letter, after)
        yield batch.append_column("after", pa.array(kept, pa.list_(pa.int64())))


def checkpoints(rows: DataFrame) -> DataFrame:
    """(conv_id, block, letters, after): each block's letters and the backward costs behind it."""
    blocks = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("pos", "letter"))).alias("l"))
    blocks = blocks.select("conv_id", "block", F.array_join("l.letter", "").alias("letters"))
    blocks = blocks.repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").desc())
    return blocks.mapInArrow(_checkpoints, "conv_id long, block long, letters string, after array<long>")


REPAIRED = "conv_id long, turn long, was string, fault string, edit string, role string, text string"


def _packed(out: list, ddl: str) -> pa.RecordBatch:
    fields = [c.split() for c in ddl.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[k]) for x, (_, k) in zip(zip(*out, strict=True), fields, strict=True)], [n for n, _ in fields])


def _closing(conv, q: int):
    """The turns put in behind the last row."""
    while END[q]:
        q = NEXT[q]
        yield conv, None, None, None, "I", ROLE[q], ""


def _repaired(batches):
    """The rows of each conversation with their edits, and inserted turns; a row without edit opens a conversation."""
    conv, q, edits = None, START, iter(())
    for batch in batches:
        out = []
        for c, pos, turn, role, text, fault, letters, after in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if pos == -1:
                out.extend(_closing(conv, q))
                conv, q = c, START
                out.append((c, None, None, None, None, None, None))
            elif letters is not None:
                done, q = walk(letters, tuple(after), q)
                edits = iter(done)
            else:
                put, edit, new = next(edits)
                out.extend((c, None, None, None, "I", r, "") for r in put)
                out.append((c, turn, role, fault, edit, None if edit == "D" else new or role, None if edit == "D" else text))
        if out:
            yield _packed(out, REPAIRED)
    if END[q]:
        yield _packed(list(_closing(conv, q)), REPAIRED)


def repair(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """REPAIRED for each of conversations(conv_id), whole and in order within a partition.

    rows(conv_id, turn, role, text, place): place is any ordered value. A row with edit D is deleted, I inserted; role
    and text are those after the repair, was and fault those before. Each conversation opens with a row without edit.
    """
    rows = written(judged(rows), "turns")
    heads = checkpoints(rows.select("conv_id", "block", "pos", "letter"))
    none = lambda kind: F.lit(None).cast(kind)
    # the rows of a conversation in order: its opening, then each block's checkpoint before its rows
    stream = rows.select("conv_id", "block", "pos", "turn", "role", "text", "fault", none("string").alias("letters"), none("array<long>").alias("after"))
    stream = stream.unionByName(heads.withColumn("pos", F.lit(0).cast("long")), allowMissingColumns=True)
    opening = conversations.select("conv_id").distinct().withColumns({"block": F.lit(-1).cast("long"), "pos": F.lit(-1).cast("long")})
    stream = stream.unionByName(opening, allowMissingColumns=True)
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "block", "pos")
    return stream.select("conv_id", "pos", "turn", "role", "text", "fault", "letters", "after").mapInArrow(_repaired, REPAIRED)


# --- the report --------------------------------------------------------------------------------------------------------

_LEGAL = {"su", "ua", "au"}
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Report:
    def __init__(self, conv):
        self.conv, self.faults, self.illegal, self.cost, self.last = conv, dict.fromkeys(("blank", "duplicate", "truncated"), 0), 0, 0, None
        self.first_turn, self.last_turn, self.turns = None, None, 0
        self.audit, self.digest, self.joint = [], hashlib.sha256(), b""

    def add(self, turn, was, fault, edit, role, text):
        if edit != "I":
            if turn is not None and turn != self.last_turn:
                self.first_turn = turn if self.first_turn is None else self.first_turn
                self.last_turn, self.turns = turn, self.turns + 1
            if self.last is not None and self.last + was[:1] not in _LEGAL:
                self.illegal += 1
            self.last = was[:1]
            if fault:
                self.faults[fault] += 1
        self.audit.append(edit)
        self.cost += {"K": 0, "R": RETYPE, "D": DROP, "I": INSERT}[edit] + CUT * (fault == "truncated" and edit != "D")
        if edit != "D":
            self.digest.update(self.joint + f"{role}:{text}".encode())
            self.joint = b"\n"

    def row(self):
        gaps = 0 if self.first_turn is None else min(self.last_turn - self.first_turn + 1 - self.turns, (1 << 63) - 1)
        return self.conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest()


def _reports(batches):
    now = None
    for batch in batches:
        out = []
        for conv, *row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if row[3] is None:
                if now:
                    out.append(now.row())
                now = _Report(conv)
            else:
                now.add(*row)
        if out:
            yield _packed(out, REPORT)
    if now:
        yield _packed([now.row()], REPORT)


def report(repaired: DataFrame) -> DataFrame:
    """REPORT, a row per conversation, from what repair() returns (not rewritten in between: its order counts)."""
    return repaired.mapInArrow(_reports, REPORT)


def damaged(conversations: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text, place) damaged by crc32 of conv_id:turn modulo 20; nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        text("role").alias("role"),
        text("text").alias("text"),
        (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20).alias("kind"),
    ).filter("kind <> 0")
    rows = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    place = F.struct("turn", "role", "text", "copy")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), place.alias("place"))


def op13_turn_repair(spark, sf_dir):
    """Registered query: all conversations, damaged by rule and repaired."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return report(repair(damaged(conversations), conversations.select(F.col("conv_id").cast("long").alias("conv_id"))))


_CRC32_SQL = """xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), flatten(list_transform(string_split({key}, ''),
  lambda c: [CAST(unicode(c) AS UBIGINT), 0, 0, 0, 0, 0, 0, 0]))), lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), CAST(4294967295 AS UBIGINT))"""

OP13_SQL = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role0, coalesce(text, ' ') AS text0,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), kinds AS (SELECT *, {_CRC32_SQL.format(key="key")} % 20 AS kind FROM given
), hurt AS (
  SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, role0, text0, copy, CASE WHEN kind = 4 THEN 'user' ELSE role0 END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text0, '[.!?]', '', 'g') ELSE text0 END AS text
  FROM kinds, (VALUES (0), (1)) AS k(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role0, text0, copy) AS pos FROM hurt
), marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY pos) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '-' END AS fault,
    CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'x' END AS r, lag(role[1]) OVER (PARTITION BY c ORDER BY pos) AS r_before
  FROM placed
), size AS (SELECT c, any_value(conv_id) AS conv_id, max(pos) AS n FROM marked GROUP BY c
), back AS (  -- cheapest cost before row pos, by state: start, s, u, a
  SELECT c, n + 1 AS pos, 0 AS b0, 10 AS b1, 5 AS b2, 0 AS b3 FROM size
  UNION ALL
  SELECT c, pos, least(v0, 5 + least(v2, 5 + v3)), least(v1, 5 + least(v2, 5 + v3)), least(v2, 5 + v3), least(v3, 5 + v2)
  FROM (
    SELECT b.c, m.pos,
      least(b0 + 2, CASE WHEN fault IN ('b', 'd') THEN 9e8::BIGINT ELSE CASE fault WHEN 't' THEN 5 ELSE 0 END + least(b2 + 1, CASE r WHEN 's' THEN b1 WHEN 'u' THEN b2 ELSE 900000000 END) END) AS v0,
      least(b1 + 2, CASE WHEN fault IN ('b', 'd') THEN 9e8::BIGINT ELSE CASE fault WHEN 't' THEN 5 ELSE 0 END + least(b2 + 1, CASE r WHEN 'u' THEN b2 ELSE 900000000 END) END) AS v1,
      least(b2 + 2, CASE WHEN fault IN ('b', 'd') THEN 9e8::BIGINT ELSE CASE fault WHEN 't' THEN 5 ELSE 0 END + least(b3 + 1, CASE r WHEN 'a' THEN b3 ELSE 900000000 END) END) AS v2,
      least(b3 + 2, CASE WHEN fault IN ('b', 'd') THEN 9e8::BIGINT ELSE CASE fault WHEN 't' THEN 5 ELSE 0 END + least(b2 + 1, CASE r WHEN 'u' THEN b2 ELSE 900000000 END) END) AS v3
    FROM back b JOIN marked m ON m.c = b.c AND m.pos = b.pos - 1
  )
), ahead AS (  -- per row: costs here and behind it, as lists by state
  SELECT s.c, b.pos, [b.b0, b.b1, b.b2, b.b3] AS here, [t.b0, t.b1, t.b2, t.b3] AS behind, m.role, m.text, m.fault, m.r
  FROM size s JOIN back b ON b.c = s.c LEFT JOIN back t ON t.c = b.c AND t.pos = b.pos + 1 LEFT JOIN marked m ON m.c = b.c AND m.pos = b.pos
), trail AS (
  SELECT c, CAST(1 AS BIGINT) AS pos, 1 AS q, '' AS audit, CAST(NULL AS VARCHAR) AS told, 0 AS spent FROM size
  UNION ALL
  SELECT c, CASE e WHEN 'I' THEN pos ELSE pos + 1 END, CASE e WHEN 'D' THEN q WHEN 'K' THEN kept ELSE nxt END, audit || e,
    CASE e WHEN 'D' THEN told ELSE coalesce(told || chr(10), '') || CASE e WHEN 'K' THEN role || ':' || text WHEN 'R' THEN named || ':' || text ELSE named || ':' END END,
    spent + CASE e WHEN 'D' THEN 2 WHEN 'I' THEN 5 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e IN ('K', 'R') AND fault = 't' THEN 5 ELSE 0 END
  FROM (
    SELECT *, CASE WHEN behind[1] IS NOT NULL AND here[q] = behind[q] + 2 THEN 'D' WHEN here[q] = here[nxt] + 5 THEN 'I'
      WHEN fault NOT IN ('b', 'd') AND kept > 0 AND here[q] = behind[kept] + CASE fault WHEN 't' THEN 5 ELSE 0 END THEN 'K' ELSE 'R' END AS e
    FROM (
      SELECT t.*, a.here, a.behind, a.role, a.text, a.fault, CASE WHEN q = 3 THEN 4 ELSE 3 END AS nxt, CASE WHEN q = 3 THEN 'assistant' ELSE 'user' END AS named,
        CASE WHEN q = 1 AND r = 's' THEN 2 WHEN q <> 3 AND r = 'u' THEN 3 WHEN q = 3 AND r = 'a' THEN 4 ELSE 0 END AS kept
      FROM trail t JOIN ahead a ON a.c = t.c AND a.pos = t.pos WHERE a.role IS NOT NULL OR q IN (2, 3)
    )
  )
), ends AS (SELECT t.c, audit, told, spent FROM trail t JOIN size s ON s.c = t.c AND t.pos = s.n + 1 WHERE q IN (1, 4)
), counts AS (
  SELECT c, any_value(conv_id) AS conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (r_before IS NOT NULL AND r_before || role[1] NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY c
)
SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(spent, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(told, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN ends ON ends.c = counts.c
"""
