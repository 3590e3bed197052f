"""Repair of conversation structure at least cost, by block tables in the way of the Four Russians.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``: perhaps a system turn, then user and assistant
in turns. What may be done with a row: Keep it (0), Rerole it to user or assistant (2), Delete it (3; a must for blank
and repeated rows), Insert an empty user or assistant turn anywhere (2). A truncated row that stays adds 1.

To the edits a row is one of nine symbols: four kinds of initial, truncated or not, and "must go". What the rest of a
conversation costs from each of the four states of the pattern is a vector, and less its minimum there are only a few
vectors, as states differ by a bounded amount. So for every vector and every block of ``BLOCK`` symbols a table holds the
vector before the block and what the block adds to the cost. A conversation goes through the table from its last block
to its first, one look-up a block; only the vectors between blocks are kept. To trace the edits, each block is expanded
backward from the vector behind it, which gives the vectors between its rows; then the letters follow forward: of all
edits that keep the cost least the first by ASCII (Delete, Insert, Keep, Rerole). The states make the letters'
roles plain, so equal audits mean equal repairs. Expanded blocks are kept in a table too, by vector, block and state.

How it runs: repeats are found by grouping narrow keys; rows are dealt by conversation and sorted by turn, and each task
goes through its conversations as a stream. Held in memory is one byte a row and its audit, which is a part of the
result; texts wait in a temporary file from ``SPOOL`` bytes on. One conversation stays with one task whatever
its length, as its digest is one SHA-256 over all of its text, in order.

Null role or text counts as one space, a null conv_id is a conversation, null turns come first. Rows of one turn go by
role and text, so repeated rows stand side by side. A role without s, u or a at its start, or an empty one, cannot be
kept. Other columns are dropped. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from opinia.llm.storage import partitions, written

BLOCK = 4
SPOOL = 8 << 20
# States of the pattern: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
# What an inserted or reroled turn leads to: the only turn that the pattern allows besides system.
NEXT = (USER, USER, ASSISTANT, USER)
NAME = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua"
SYMBOLS = 9
MUST_GO = 8
REROLE, DELETE, INSERT = 2, 3, 2
# What is left to do at the end of a conversation, from each state.
AT_END = (0, 2 * INSERT, INSERT, 0)
LEGAL_PAIRS = frozenset(["su", "ua", "au"])
MOST_LONG = (1 << 63) - 1
VISIBLE = r"[^\x20\x09-\x0D]"
FINISHED = r"[.!?][\x20\x09-\x0D]*\z"
REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
# Rows of one batch that a task hands on.
HANDED_ON = 1000


def symbol(initial: str, truncated: bool) -> int:
    kind = INITIALS.find(initial) if initial else -1
    return 2 * (kind if kind >= 0 else 3) + truncated


def kept_state(state: int, sym: int) -> int | None:
    """Where a kept row leads, if the pattern lets it stay."""
    if sym == MUST_GO:
        return None
    return {(EMPTY, 0): SYSTEM, (EMPTY, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}.get((state, sym // 2))


class BlockTables:
    """Transitions of normalised cost vectors, by symbol and by block of symbols."""

    def __init__(self, length: int = BLOCK) -> None:
        self.length = length
        self.vectors: list[tuple[int, ...]] = [AT_END]
        place = {AT_END: 0}
        # Vector behind a symbol -> vector before it and what the symbol adds; new vectors join the list as they turn up.
        self.step: list[list[tuple[int, int]]] = []
        for vector in self.vectors:
            self.step.append([])
            for sym in range(SYMBOLS):
                before, added = self._before(vector, sym)
                if before not in place:
                    place[before] = len(self.vectors)
                    self.vectors.append(before)
                self.step[-1].append((place[before], added))
        # A block's number has its first symbol as the highest digit.
        self.blocks: list[list[tuple[int, int]]] = [[(v, 0)] for v in range(len(self.vectors))]
        for _ in range(length):
            self.blocks = [self._longer(v) for v in range(len(self.vectors))]
        self.expanded: dict[tuple[int, int, int], tuple[str, int]] = {}

    @staticmethod
    def _before(after: tuple[int, ...], sym: int) -> tuple[tuple[int, ...], int]:
        costs = []
        for state in range(4):
            best = DELETE + after[state]
            if sym != MUST_GO:
                best = min(best, REROLE + sym % 2 + after[NEXT[state]])
                stays = kept_state(state, sym)
                if stays is not None:
                    best = min(best, sym % 2 + after[stays])
            costs.append(best)
        # Insertions before the row: a second one never helps two states on.
        for _ in range(2):
            costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
        least = min(costs)
        return tuple(c - least for c in costs), least

    def _longer(self, vector: int) -> list[tuple[int, int]]:
        """Blocks of one symbol more: the last symbol is met first."""
        lasts = self.step[vector]
        found = []
        for code in range(len(self.blocks[0])):
            for v, added in lasts:
                before, more = self.blocks[v][code]
                found.append((before, added + more))
        return found

    def row_letters(self, after: int, sym: int, state: int) -> tuple[str, int]:
        """The edits up to and with one row, and the state behind it."""
        before, added = self.step[after][sym]
        here, there, letters = self.vectors[before], self.vectors[after], ""
        while True:
            left = here[state] + added
            if DELETE + there[state] == left:
                return letters + "D", state
            if INSERT + here[NEXT[state]] == here[state]:
                letters, state = letters + "I", NEXT[state]
                continue
            stays = kept_state(state, sym)
            if stays is not None and sym % 2 + there[stays] == left:
                return letters + "K", stays
            return letters + "R", NEXT[state]

    def block_letters(self, after: int, symbols: bytes, state: int) -> tuple[str, int]:
        """Expands a block backward from the vector behind it, then reads its edits forward from ``state``."""
        behind = []
        for sym in reversed(symbols):
            behind.append(after)
            after = self.step[after][sym][0]
        letters = ""
        for sym, v in zip(symbols, reversed(behind)):
            more, state = self.row_letters(v, sym, state)
            letters += more
        return letters, state

    def audit(self, symbols: bytes) -> tuple[int, str]:
        """Least cost and the first of the cheapest edits."""
        head = len(symbols) % self.length
        codes = []
        for at in range(head, len(symbols), self.length):
            code = 0
            for sym in symbols[at : at + self.length]:
                code = code * SYMBOLS + sym
            codes.append(code)
        vector, cost, behind = 0, 0, []
        for code in reversed(codes):
            behind.append(vector)
            vector, added = self.blocks[vector][code]
            cost += added
        first = vector
        for sym in reversed(symbols[:head]):
            vector, added = self.step[vector][sym]
            cost += added
        cost += self.vectors[vector][EMPTY]
        letters, state = self.block_letters(first, symbols[:head], EMPTY)
        parts = [letters]
        for number, code in enumerate(codes):
            key = (behind[-1 - number], code, state)
            found = self.expanded.get(key)
            if found is None:
                at = head + number * self.length
                found = self.expanded[key] = self.block_letters(key[0], symbols[at : at + self.length], state)
            parts.append(found[0])
            state = found[1]
        parts.append("I" * (AT_END[state] // INSERT))
        return cost, "".join(parts)


@lru_cache(maxsize=2)
def tables(length: int = BLOCK) -> BlockTables:
    return BlockTables(length)


class Conversation:
    """The rows of one conversation as they come by, in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.symbols = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.least = self.most = None
        self.distinct = 0
        self.last = None
        self.spool = tempfile.SpooledTemporaryFile(max_size=SPOOL)

    def add(self, turn, role: str, text: str, again: bool, blank: bool, truncated: bool) -> None:
        if turn is not None and turn != self.most:
            self.distinct += 1
            self.least, self.most = turn if self.least is None else self.least, turn
        if self.last is not None and self.last[1][:1] + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        again = again or self.last == (turn, role, text)
        if blank:
            self.blank += 1
        elif again:
            self.duplicate += 1
        elif truncated:
            self.truncated += 1
        self.symbols.append(MUST_GO if blank or again else symbol(role[:1], truncated))
        self.last = (turn, role, text)
        pickle.dump(self.last, self.spool, pickle.HIGHEST_PROTOCOL)

    def repaired(self, audit: str) -> Iterator[tuple[str, int | None, str, str]]:
        """(edit, turn, role, text) of the repaired conversation."""
        self.spool.seek(0)
        state = EMPTY
        for letter in audit:
            turn, role, text = (None, "", "") if letter == "I" else pickle.load(self.spool)
            if letter == "D":
                continue
            if letter == "K":
                state = kept_state(state, symbol(role[:1], False))
            else:
                state = NEXT[state]
                role = NAME[state]
            yield letter, turn, role, text

    def report(self) -> tuple:
        cost, audit = tables().audit(bytes(self.symbols))
        digest = hashlib.sha256()
        for k, (_, _, role, text) in enumerate(self.repaired(audit)):
            digest.update(("\n" if k else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.distinct, MOST_LONG)
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, digest.hexdigest()


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """The conversations of sorted rows (conv_id, turn, role, text, gone, again, blank, truncated), each as it ends."""
    held = None
    for batch in batches:
        for conv_id, turn, role, text, gone, *flags in zip(*[c.to_pylist() for c in batch.columns]):
            if held is None or conv_id != held.conv_id:
                if held is not None:
                    yield held
                    held.spool.close()
                held = Conversation(conv_id)
            if not gone:
                held.add(turn, role, text, *flags)
    if held is not None:
        yield held
        held.spool.close()


def marked(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """(conv_id, turn, role, text, gone, again, blank, truncated): ``again`` where role and text were seen in an earlier
    turn. Rows that are ``gone`` only say that their conversation exists."""
    space = F.lit(" ")
    gone = F.lit(False) if gone is None else gone
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), gone.alias("gone"))
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-"))
    key = F.md5(F.concat_ws(":", F.length(conv).cast("string"), conv, F.length("role").cast("string"), "role", "text"))
    rows = rows.select(
        "*", (~F.col("text").rlike(VISIBLE)).alias("blank"), (~F.col("text").rlike(FINISHED)).alias("truncated"), F.when(~F.col("gone"), key).alias("key")
    )
    # A struct's null field is the least, as null turns come first. Repeats within a turn stand side by side later on.
    turn = F.struct("turn")
    seen = rows.where("not gone and not blank").groupBy("key").agg(F.min(turn).alias("first"), F.max(turn).alias("last"))
    # Written, so that the planner knows its size: only few and small keys are broadcast.
    seen = written(seen.where("first != last").select("key", "first"))
    again = F.coalesce(F.col("first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn")), F.lit(False))
    return rows.join(seen, "key", "left").select("conv_id", "turn", "role", "text", "gone", again.alias("again"), "blank", "truncated")


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): the repaired conversations; inserted rows have no turn."""
    kinds = turns.schema
    schema = StructType([
        StructField("conv_id", kinds["conv_id"].dataType), StructField("place", LongType()), StructField("edit", StringType()),
        StructField("turn", kinds["turn"].dataType), StructField("role", StringType()), StructField("text", StringType()),
    ])
    arrow = to_arrow_schema(schema)

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for held in conversations(batches):
            audit = tables().audit(bytes(held.symbols))[1]
            for place, row in enumerate(held.repaired(audit)):
                rows.append((held.conv_id, place, *row))
                if len(rows) == HANDED_ON:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return _in_order(marked(turns)).mapInArrow(repaired, schema)


def reports(turns: DataFrame, gone: Column | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    schema = StructType([StructField("conv_id", turns.schema["conv_id"].dataType), *StructType.fromDDL(REPORT).fields])
    arrow = to_arrow_schema(schema)

    def reported(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for held in conversations(batches):
            rows.append((held.conv_id, *held.report()))
            if len(rows) == HANDED_ON:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return _in_order(marked(turns, gone)).mapInArrow(reported, schema)


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): faults put in by a checksum of conversation and turn; lost rows are ``gone``."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    chance = F.crc32(name) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), chance.alias("chance"))
    text = F.when(F.col("chance") == 1, "").when(F.col("chance") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("chance") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("chance") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("chance") == 0).alias("gone"), F.explode(copies).alias("copy")).drop("copy")


def damage_and_repair(turns: DataFrame) -> DataFrame:
    """``reports`` of the damaged conversations."""
    return reports(damaged(turns), F.col("gone"))
