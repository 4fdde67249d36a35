"""Structure repair of conversations: the cheapest edits after which the roles alternate.

Rows are repartitioned by conversation and sorted by turn, and a task reads them as one stream. A dynamic program over four
states (nothing yet, after system, after user, after assistant) is carried from Arrow batch to Arrow batch. Only cost
differences and the alphabetical order of the best edits of the states matter, and both are bounded, so the step of a row is
looked up in a small table that fills as steps occur. What is left of a row is four bytes: for each state, where its best path
came from.

A conversation is kept in memory up to ``CHUNK`` rows or ``CHUNK_CHARS`` characters. A longer one spills its rows and back
pointers chunk by chunk as rows of the output; a second stream goes through the back pointers alone, last chunk first, and a
third one through the chunks in order. No task holds more than a chunk of a conversation, but the edits and the digest of its
rows, which are one value each, are made in one stream. A lost executor repeats its tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import small_or_plain, written

#: Rows and characters of a conversation that a task holds at most.
CHUNK, CHUNK_CHARS = 1 << 16, 1 << 23
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"
NAMES = {"u": "user", "a": "assistant"}
#: States: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; where a role's initial leads, and the inserted one.
LEADS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = ("u", "u", "a", "u")
EDITS = "DKR"
#: Every state can stand in for every other at a cost of 7, so a state that is dearer than another by more is given up.
FAR = 7

Config = tuple[tuple[int, int] | None, ...]


def inserted(state: int, times: int) -> int:
    for _ in range(times):
        state = LEADS[state, NEXT[state]]
    return state


def step(config: Config, initial: str, must_go: bool, truncated: bool) -> tuple[Config, int, int]:
    """Costs and order of the states after a row, what all costs rose by, and the back pointers of the four states.

    A state has (cost above the cheapest, rank of its edits among the states). Edits of the same number of rows that end with
    an edit of a row are never prefixes of each other, so ranks and the letters of this row decide the order.
    """
    best: dict[int, tuple[int, int, str, int]] = {}
    for state, known in enumerate(config):
        if known is None:
            continue
        for times in range(3):
            middle = inserted(state, times)
            options = [("D", middle, 3)]
            if not must_go:
                if (middle, initial) in LEADS:
                    options.append(("K", LEADS[middle, initial], int(truncated)))
                options.append(("R", LEADS[middle, NEXT[middle]], 2 + truncated))
            for edit, to, cost in options:
                pointer = state | times << 2 | EDITS.index(edit) << 4
                found = (known[0] + 2 * times + cost, known[1], "I" * times + edit, pointer)
                best[to] = min(best.get(to, found), found)
    least = min(b[0] for b in best.values())
    order = sorted((b[1], b[2]) for b in best.values() if b[0] - least <= FAR)
    after = tuple((best[s][0] - least, order.index(best[s][1:3])) if s in best and best[s][0] - least <= FAR else None for s in range(4))
    pointers = sum(best[s][3] << 8 * s for s in range(4) if s in best)
    return after, least, pointers


def ending(config: Config) -> tuple[int, int, int]:
    """Cheapest way to end: cost above the cheapest state, the state, and how many rows are inserted after the last one."""
    ends = []
    for state, known in enumerate(config):
        for times in range(3):
            if known is not None and inserted(state, times) in (0, 3):
                ends.append((known[0] + 2 * times, known[1], "I" * times, state))
    cost, _, letters, state = min(ends)
    return cost, state, len(letters)


class Steps:
    """The steps met so far, numbered: the configurations and, for each and a class of row, the next one."""

    def __init__(self) -> None:
        self.start: Config = ((0, 0), None, None, None)
        self.known: dict[tuple, tuple[Config, int, int]] = {}

    def __call__(self, config: Config, initial: str, must_go: bool, truncated: bool) -> tuple[Config, int, int]:
        key = (config, initial if initial in "sua" else "", must_go, truncated)
        if key not in self.known:
            self.known[key] = step(*key)
        return self.known[key]


def traced(pointers: np.ndarray, state: int) -> tuple[list[str], int]:
    """The edits of each row, inserts before it included, and the state before the first row."""
    letters = []
    for code in pointers[::-1].tolist():
        code = code >> 8 * state & 255
        letters.append("I" * (code >> 2 & 3) + EDITS[code >> 4])
        state = code & 3
    return letters[::-1], state


class Repaired:
    """Digest of the repaired rows, fed in order."""

    def __init__(self) -> None:
        self.state, self.digest, self.first = 0, hashlib.sha256(), True

    def line(self, role: str, text: str) -> None:
        self.digest.update(("" if self.first else "\n").encode() + f"{role}:{text}".encode())
        self.first = False

    def insert(self, times: int) -> None:
        for _ in range(times):
            self.line(NAMES[NEXT[self.state]], "")
            self.state = inserted(self.state, 1)

    def row(self, letters: str, role: str, text: str) -> None:
        self.insert(len(letters) - 1)
        if letters[-1] == "K":
            self.line(role, text)
            self.state = LEADS[self.state, role[:1]]
        elif letters[-1] == "R":
            self.line(NAMES[NEXT[self.state]], text)
            self.state = inserted(self.state, 1)


@dataclass
class Conversation:
    """What the first stream carries of the conversation it reads."""

    conv_id: int | None
    config: Config
    chunk: int = 0
    cost: int = 0
    faults: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0))
    turns: list[int] = field(default_factory=lambda: [0, 0, 0])  # smallest, largest, distinct ones
    before: tuple | None = None
    rows: list[tuple[str, str]] = field(default_factory=list)
    chars: int = 0
    pointers: list[int] = field(default_factory=list)

    def add(self, steps: Steps, turn: int | None, role: str, text: str, seen: bool) -> None:
        seen = seen or self.before == (turn, role, text)
        core = text.rstrip(SPACES)
        fault = "blank" if not core else "duplicate" if seen else "truncated" if core[-1] not in ENDS else ""
        if fault:
            self.faults[fault] += 1
        if self.before is not None:
            self.faults["illegal"] += self.before[1][:1] + role[:1] not in ("su", "ua", "au")
        if turn is not None and (self.before is None or self.before[0] != turn):
            self.turns = [turn if self.turns[2] == 0 else self.turns[0], turn, self.turns[2] + 1]
        self.before = (turn, role, text)
        self.config, rise, pointers = steps(self.config, role[:1], fault in ("blank", "duplicate"), fault == "truncated")
        self.cost += rise
        self.pointers.append(pointers)
        self.rows.append((role, text))
        self.chars += len(text) + len(role)

    def spilled(self) -> dict:
        out = {
            "conv_id": self.conv_id,
            "chunk": self.chunk,
            "pointers": np.array(self.pointers, dtype=np.uint32).tobytes(),
            "roles": [r for r, _ in self.rows],
            "texts": [t for _, t in self.rows],
        }
        self.chunk += 1
        self.rows, self.chars, self.pointers = [], 0, []
        return out

    def ended(self) -> dict:
        """The figures; with the edits and the digest where no chunk was spilled, else with the last chunk and its ending."""
        low, high, distinct = self.turns
        extra, state, times = ending(self.config)
        out = {**self.faults, "gaps": high - low + 1 - distinct if distinct else 0, "cost": self.cost + extra}
        if self.chunk:
            return {**self.spilled(), **out, "state": state, "times": times}
        letters, _ = traced(np.array(self.pointers, dtype=np.uint32), state)
        repaired = Repaired()
        for edit, (role, text) in zip(letters, self.rows, strict=True):
            repaired.row(edit, role, text)
        repaired.insert(times)
        audit = "".join(letters) + "I" * times
        return {**out, "conv_id": self.conv_id, "audit": audit, "repaired_sha256": repaired.digest.hexdigest()}


FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
STREAMED = (
    "conv_id long, " + ", ".join(f"{name} long" for name in FIGURES) + ", audit string, repaired_sha256 string, "
    "chunk int, pointers binary, roles array<string>, texts array<string>, state int, times int"
)


def framed(rows: list[dict]) -> pd.DataFrame:
    names = [part.split()[0] for part in STREAMED.split(", ")]
    frame = pd.DataFrame({name: pd.Series([row.get(name) for row in rows], dtype=object) for name in names})
    for part in STREAMED.split(", "):
        name, kind = part.split()
        if kind in ("long", "int"):
            frame[name] = frame[name].astype("Int64" if kind == "long" else "Int32")
    return frame


def repaired_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (conv_id, turn, role, text, present, seen) of many conversations to STREAMED."""
    steps, now, out = Steps(), None, []
    for batch in batches:
        columns = [[None if pd.isna(x) else int(x) for x in batch[c]] for c in ("conv_id", "turn")]
        for conv_id, turn, role, text, present, seen in zip(*columns, batch["role"], batch["text"], batch["present"], batch["seen"], strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    out.append(now.ended())
                now = Conversation(conv_id, steps.start)
            if not present:
                continue
            if len(now.rows) >= CHUNK or now.chars >= CHUNK_CHARS:
                yield framed([*out, now.spilled()])
                out = []
            now.add(steps, turn, role, text, seen)
        yield framed(out)
        out = []
    if now is not None:
        yield framed([now.ended()])


def trace_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of spilled conversations, the last one first, to the edits of each chunk."""
    state, at = 0, None
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            key = None if pd.isna(row.conv_id) else int(row.conv_id)
            if not pd.isna(row.state):
                state, at = int(row.state), key
            assert at == key, "the last chunk of a conversation comes first"
            letters, state = traced(np.frombuffer(row.pointers, dtype=np.uint32), state)
            out.append((key, int(row.chunk), letters))
        yield pd.DataFrame(
            {
                "conv_id": pd.array([o[0] for o in out], dtype="Int64"),
                "chunk": pd.array([o[1] for o in out], dtype="Int32"),
                "edits": [" ".join(o[2]) for o in out],
            }
        )


def join_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Chunks of spilled conversations in order, with their edits, to one row per conversation."""
    repaired, audit = Repaired(), []
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            if row.chunk == 0:
                repaired, audit = Repaired(), []
            letters = row.edits.split(" ")
            for edit, role, text in zip(letters, row.roles, row.texts, strict=True):
                repaired.row(edit, role, text)
            audit.append("".join(letters))
            if not pd.isna(row.state):
                repaired.insert(int(row.times))
                figures = {name: int(getattr(row, name)) for name in FIGURES}
                whole = "".join(audit) + "I" * int(row.times)
                conv_id = None if pd.isna(row.conv_id) else int(row.conv_id)
                out.append({"conv_id": conv_id, **figures, "audit": whole, "repaired_sha256": repaired.digest.hexdigest()})
        frame = framed(out)
        yield frame[["conv_id", *FIGURES, "audit", "repaired_sha256"]]


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): the fixed faults that a hash of conversation and turn puts into the rows.

    A NULL is one space in the hashed key, as role and as text; the turn itself stays NULL. A dropped row stays as one that is
    not present, without role and text, so that its conversation is not forgotten.
    """
    blank = F.lit(" ")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("role"),
        F.coalesce(F.col("text").cast("string"), blank).alias("text"),
    )
    key = F.concat(*[F.coalesce(F.col(c).cast("string"), blank) if c != ":" else F.lit(c) for c in ("conv_id", ":", "turn")])
    rows = rows.withColumn("fault", (F.crc32(key.cast("binary")) % 20).cast("int"))
    text = F.when(F.col("fault") < 2, "").when(F.col("fault") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 0, "").when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"), F.explode(times).alias("copy")).drop("copy")


def same(*names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition &= F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    return condition


def with_seen(rows: DataFrame) -> DataFrame:
    """Marks rows whose role and text stand at an earlier turn of their conversation; NULL turns come first.

    Only what repeats at several turns is looked up: one row per such role and text, found with map-side combine.
    """
    mark = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")))
    rows = rows.withColumn("mark", mark)
    groups = rows.where("present").groupBy("conv_id", "mark").agg(
        F.max(F.col("turn").isNull()).alias("undated"), F.min("turn").alias("low"), F.max("turn").alias("high")
    )
    repeated = groups.where("low < high OR (undated AND low IS NOT NULL)").select("conv_id", "mark", F.when(~F.col("undated"), F.col("low")).alias("low"))
    repeated = small_or_plain(written(repeated, "repeated-turns"))
    later = F.col("r.mark").isNotNull() & F.col("turn").isNotNull() & (F.col("r.low").isNull() | (F.col("turn") > F.col("r.low")))
    return rows.alias("l").join(repeated.alias("r"), same("conv_id", "mark"), "left").select(
        "l.conv_id", "turn", "role", "text", "present", F.coalesce(later, F.lit(False)).alias("seen")
    )


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) per conversation.

    ``rows`` has (conv_id, turn, role, text, present), a row not present only names its conversation; NULL roles and texts are
    one space. Rows of a conversation are taken by turn, NULL first, then by role and text, so equal rows are neighbours and
    the later ones duplicates. All rows with a NULL conv_id are one conversation. Empty texts are blank; texts may be of any
    length. A conversation without a present row has zeros, no edits and the digest of the empty text. An empty table gives an
    empty result; other columns are not read.
    """
    blank = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), "present")
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text"]
    sorted_rows = with_seen(rows).repartition("conv_id").sortWithinPartitions(*order)
    streamed = written(sorted_rows.mapInPandas(repaired_stream, STREAMED), "repaired")
    result = ["conv_id", *FIGURES, "audit", "repaired_sha256"]
    whole = streamed.where("chunk IS NULL").select(*result)
    chunks = streamed.where("chunk IS NOT NULL")
    last_first = chunks.select("conv_id", "chunk", "pointers", "state").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"))
    edits = written(last_first.mapInPandas(trace_stream, "conv_id long, chunk int, edits string"), "repair-edits")
    joined = chunks.select("conv_id", "chunk", *FIGURES, "roles", "texts", "state", "times").alias("l").join(
        edits.alias("r"), same("conv_id", "chunk")
    ).select("l.*", "r.edits")
    in_order = joined.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    schema = STREAMED.split(", chunk")[0]
    return whole.union(in_order.mapInPandas(join_stream, schema).select(*result))
