"""Repair of the structure of conversations, by secondary-sorted streaming.

A sound conversation is empty, or has the roles ``s?(ua)+`` by their initials, no blank and
no repeated message, and messages that end like sentences. The cheapest edits that make
one so are found by dynamic programming over the four states that reading such roles has:
0 at the start, 1 after ``s``, 2 after ``u``, 3 after ``a``; 0 and 3 may end it.

1. ``plan_repairs``: rows are partitioned by conversation and sorted by turn, last first.
   ``mapInPandas`` carries, from row to row and over Arrow batches, the cost from each state
   to the end, and notes one byte a row: the best edit in each state. Every ``BLOCK_ROWS``
   rows, and at the end of a conversation, these bytes leave as a row of the plan, a table
   on shared storage, so that a worker holds no conversation however long it is, and a
   lost executor costs no more than its tasks. No texts are moved here.
2. ``apply_repairs``: the rows again, first turn first, with the blocks of the plan sorted in
   before the rows that they are for. The state walks through the edits; each row leaves
   with its edit, as do rows that are inserted.
3. ``digest_repairs`` streams the repaired rows in the order in which they come.

Of edits of one cost, the first in ASCII order is taken at each step (D, I, K, R), which gives the least
of all cheapest audits, since the costs to the end are known.

One conversation is read in order, as its digest asks, so it is one task's work, in
bounded memory; its sorts spill.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stowage.llm.shared import scratch_root, stored

BLOCK_ROWS = 1 << 16
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: What a row's first fault is. Rows that are gone only show that there is a conversation.
SOUND, BLANK, DUPLICATE, CUT, GONE = range(5)
EDITS = "DIKR"
#: From each state: the state after each role it may take, and the role that an edit gives.
AFTER = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GIVES = ("user", "user", "assistant", "user")
#: The cost from each state to the end, once no row is left: inserts alone.
AT_END = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 40
PAIRS = {"su", "ua", "au"}
#: One row of the plan: ``edits`` has a byte for each row from the one with this key on,
#: ``to_end`` says how many blocks follow; the opening row of a conversation has no key, and
#: the counts of all of it.
PLAN = "conv string, turn_key string, role_key string, text_key string, to_end long, edits binary, stats array<long>"
REPAIRED = "conv string, edit string, role string, text string, stats array<long>"
AUDITS = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(rows: DataFrame) -> DataFrame:
    """``rows`` (``conv_id``, ``turn``, ``role``, ``text``) with faults planted by a hash.

    By the CRC-32 of ``conv_id:turn``, modulo 20: 0 drops a row, 1 empties its text, 2 removes its
    ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the user's. A null id or turn is one
    space there; a null role or text becomes one space. Of a row that is dropped a row
    with only ``conv_id`` stays, and column ``gone`` says so.
    """
    def named(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(named("text"), "[.!?]", "")).otherwise(named("text"))
    hit = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(named("role")).alias("role"), text.alias("text"), (kind == 0).alias("gone"), kind.alias("kind"))
    some = [F.when(~F.col("gone"), F.col(c)).alias(c) for c in ("turn", "role", "text")]
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return hit.select("conv_id", *some, "gone", times.alias("kind")).drop("kind")


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The repaired rows of conversations (``conv_id``, ``turn``, ``role``, ``text``; ``gone`` if there is one).

    Rows of one conversation follow one another, in order: by turn (null first), then
    role, then SHA-256 of the text. Columns: ``conv`` (the id as text; null is a
    conversation too), ``edit`` (K, R, D, I; null for the row that opens a conversation),
    ``role`` and ``text`` (null in rows deleted), ``stats`` (in the opening row: ``STATS``).
    A null role or text is one space; an empty role, like one space, has no initial that fits. Repeated rows are duplicates of the first. A
    conversation whose rows are all gone has its opening row alone. An empty table gives
    no rows. Other columns are not read, so they cannot clash.
    """
    keyed = _keyed(rows)
    plan = stored(plan_repairs(keyed), f"{scratch_root(rows.sparkSession)}/plan")
    return apply_repairs(keyed, plan)


def _keyed(rows: DataFrame) -> DataFrame:
    """The rows with the keys they are sorted by. Keys compare as texts do in Spark, byte by byte."""
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        text.alias("text"), F.sha2(text, 256).alias("text_key"), gone.alias("gone"))


def plan_repairs(keyed: DataFrame) -> DataFrame:
    """Blocks of best edits, and one opening row for each conversation (rows of PLAN)."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ends = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    light = keyed.select(
        "conv", "turn", "role", "text_key", F.substring("role", 1, 1).alias("initial"),
        F.when(F.col("gone"), GONE).when(blank, BLANK).when(~ends, CUT).otherwise(SOUND).alias("fault"))
    same = Window.partitionBy("conv", "role", "text_key").orderBy(F.col("turn").asc_nulls_first())
    # Equal rows of one turn differ in this number alone; the first of them is no duplicate.
    counted = light.repartition("conv").withColumn("nth", F.row_number().over(same))
    again = (F.col("nth") > 1) & F.col("fault").isin(CUT, SOUND)
    last_first = counted.withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault"))).sortWithinPartitions(
        "conv", F.col("turn").desc_nulls_last(), F.desc("role"), F.desc("text_key"), F.desc("nth"))
    return last_first.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text_key", "initial", "fault").mapInPandas(_plan, PLAN)


def _plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    steps, now = Steps(), None
    for batch in batches:
        out: list[tuple] = []
        for conv, turn, role, text_key, initial, fault in _rows(batch):
            if now is None or conv != now.conv:
                if now is not None:
                    out += now.close()
                now = Ahead(conv, steps)
            if fault != GONE:
                out += now.take(turn, role, text_key, initial, fault)
        yield _frame(out, PLAN)
    if now is not None:
        yield _frame(now.close(), PLAN)


class Steps:
    """The recurrence of one row, remembered: costs ahead differ by little, so few cases occur."""

    def __init__(self):
        self._known: dict[tuple, tuple[int, int, tuple]] = {}

    def __call__(self, ahead: tuple, initial: str, fault: int) -> tuple[int, int, tuple]:
        """From the costs after a row, less their least: what the least grows by, the edits (two
        bits for each state), and the costs before the row, less their least."""
        key = ahead, initial, fault
        if key not in self._known:
            self._known[key] = self._step(*key)
        return self._known[key]

    @staticmethod
    def _step(ahead: tuple, initial: str, fault: int) -> tuple[int, int, tuple]:
        ways = []
        extra = TRUNCATED if fault == CUT else 0
        for state in range(4):
            cost = {"D": DELETE + ahead[state]}
            if fault in (SOUND, CUT):
                if initial in AFTER[state]:
                    cost["K"] = extra + ahead[AFTER[state][initial]]
                cost["R"] = REROLE + extra + ahead[_given(state)]
            ways.append(cost)
        direct = [min(w.values()) for w in ways]
        # An insert leads to state 2 or 3; two in a row come back only at a loss.
        best = list(direct)
        for state in (2, 3, 0, 1):
            to = _given(state)
            onward = direct[to] if state in (2, 3) else best[to]
            ways[state]["I"] = INSERT + onward
            best[state] = min(best[state], INSERT + onward)
        edits = 0
        for state in range(4):
            pick = min(e for e, c in ways[state].items() if c == best[state])
            edits |= EDITS.index(pick) << (2 * state)
        least = min(best)
        return least, edits, tuple(c - least for c in best)


def _given(state: int) -> int:
    """The state after the role that an insert or a new role gives."""
    return AFTER[state][GIVES[state][0]]


class Ahead:
    """One conversation, read from its end."""

    def __init__(self, conv: str | None, steps: Steps):
        self.conv, self._steps = conv, steps
        self._least, self._ahead = 0, AT_END
        self._edits, self._key, self._blocks = bytearray(), (None, None, None), 0
        self._faults = [0] * GONE
        self._illegal, self._later = 0, None
        self._most = self._fewest = None
        self._turns = 0

    def take(self, turn: str | None, role: str, text_key: str, initial: str, fault: int) -> list[tuple]:
        """One row more; gives the block that it fills."""
        grown, edits, self._ahead = self._steps(self._ahead, initial, fault)
        self._least += grown
        self._edits.append(edits)
        self._key = turn, role, text_key
        self._faults[fault] += 1
        if self._later is not None:
            self._illegal += initial + self._later not in PAIRS
        self._later = initial
        if turn is not None:
            at = int(turn)
            self._most = at if self._most is None else self._most
            self._turns += at != self._fewest
            self._fewest = at
        return self._block() if len(self._edits) >= BLOCK_ROWS else []

    def _block(self) -> list[tuple]:
        """The edits of the rows since the last block, first row first."""
        if not self._edits:
            return []
        edits = bytes(reversed(self._edits))
        self._edits.clear()
        self._blocks += 1
        return [(self.conv, *self._key, self._blocks - 1, edits, None)]

    def close(self) -> list[tuple]:
        gaps = self._most - self._fewest + 1 - self._turns if self._turns else 0
        faults = (self._faults[k] for k in (BLANK, DUPLICATE, CUT))
        stats = [gaps, *faults, self._illegal, self._least + self._ahead[0]]
        return [*self._block(), (self.conv, None, None, None, None, None, stats)]


def apply_repairs(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with their edits (rows of REPAIRED), by the blocks of ``plan_repairs``."""
    rows = keyed.filter(~F.col("gone")).select(
        "conv", "turn", F.col("role").alias("role_key"), "text_key", F.lit(1).alias("kind"), F.lit(0).alias("place"), "role", "text",
        F.lit(None).cast("binary").alias("edits"), F.lit(None).cast("array<long>").alias("stats"))
    blocks = plan.select(
        "conv", F.col("turn_key").cast("long").alias("turn"), "role_key", "text_key", F.lit(0).alias("kind"), (-F.col("to_end")).alias("place"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "edits", "stats")
    # Equal rows have one key, and so may several blocks of them: these come before the rows, in order.
    in_order = rows.unionByName(blocks).repartition("conv").sortWithinPartitions("conv", "turn", "role_key", "text_key", "kind", "place")
    return in_order.select("conv", "role", "text", "edits", "stats").mapInPandas(_apply, REPAIRED)


def _apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, state, started = None, 0, False
    blocks: list[bytes] = []
    at = 0
    for batch in batches:
        out: list[tuple] = []
        for of, role, text, edits, stats in _rows(batch):
            if stats is not None:
                if started:
                    out += _ending(conv, state)
                conv, state, started, blocks, at = of, 0, True, [], 0
                out.append((conv, None, None, None, list(stats)))
                continue
            if edits is not None:
                blocks.append(edits)
                continue
            edit = "I"
            while edit == "I":
                edit = EDITS[blocks[0][at] >> 2 * state & 3]
                if edit == "D":
                    out.append((conv, edit, None, None, None))
                elif edit == "K":
                    state = AFTER[state][role[:1]]
                    out.append((conv, edit, role, text, None))
                else:
                    out.append((conv, edit, GIVES[state], text if edit == "R" else "", None))
                    state = _given(state)
            at += 1
            if at == len(blocks[0]):
                blocks.pop(0)
                at = 0
        yield _frame(out, REPAIRED)
    if started:
        yield _frame(_ending(conv, state), REPAIRED)


def _ending(conv: str | None, state: int) -> list[tuple]:
    out = []
    while AT_END[state]:
        out.append((conv, "I", GIVES[state], "", None))
        state = _given(state)
    return out


def digest_repairs(repaired: DataFrame) -> DataFrame:
    """One row per conversation: its counts, its audit, and SHA-256 of its repaired rows (rows of AUDITS).

    Repaired rows are written as ``role:text`` and joined by line feeds.
    """
    return repaired.mapInPandas(_digest, AUDITS)


def _digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    conv, stats, audit, total = None, None, bytearray(), hashlib.sha256()
    lines: list[str] = []
    empty = True

    def hashed() -> None:
        nonlocal empty
        if lines:
            total.update((("" if empty else "\n") + "\n".join(lines)).encode())
            empty = False
            lines.clear()

    for batch in batches:
        out: list[tuple] = []
        for of, edit, role, text, opening in _rows(batch):
            if opening is not None:
                if stats is not None:
                    hashed()
                    out.append((conv, *stats, audit.decode(), total.hexdigest()))
                conv, stats, audit, total, empty = of, list(opening), bytearray(), hashlib.sha256(), True
                continue
            audit += edit.encode()
            if edit != "D":
                lines.append(f"{role}:{text}")
        hashed()
        yield _frame(out, AUDITS)
    if stats is not None:
        yield _frame([(conv, *stats, audit.decode(), total.hexdigest())], AUDITS)


def _rows(batch: pd.DataFrame) -> Iterator[tuple]:
    """The rows of a batch, with None for what is missing."""
    return zip(*(batch[c].astype(object).where(batch[c].notna(), None).tolist() for c in batch.columns), strict=True)


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
