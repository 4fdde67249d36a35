import hashlib
import random
import zlib
from functools import cache

import pytest

from tarifa.llm import repair
from tests.llm.tables import SF_DIR, needs_tables

SCHEMA = "conv_id long, turn long, role string, text string"
CLASH = "'x' AS chunk, 1 AS cost, 2 AS mark, 'y' AS audit, false AS present, true AS seen, 3 AS low, 4 AS copy, 5 AS state"


def damaged(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        some = out.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        some += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for k, v in out.items()}


def brute(rows):
    """All edits, from the end of the conversation; the least (cost, letters) of each place and state."""
    n, seen, faults, must, cut = len(rows), set(), {"blank": 0, "duplicate": 0, "truncated": 0}, [], []
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        must.append(fault in ("blank", "duplicate"))
        cut.append(fault == "truncated")

    def after(state, letter):  # the last kept initial is the state
        return letter if (state, letter) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")} else None

    @cache
    def best(i, state, inserts):
        options = []
        if i == n and state in ("", "a"):
            options.append((0, "", ()))
        if inserts < 3:
            for letter, name in (("u", "user"), ("a", "assistant")):
                if after(state, letter):
                    cost, audit, lines = best(i, letter, inserts + 1)
                    options.append((cost + 2, "I" + audit, (f"{name}:", *lines)))
        if i < n:
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 3, "D" + audit, lines))
            if not must[i]:
                if after(state, role[:1]):
                    cost, audit, lines = best(i + 1, role[:1], 0)
                    options.append((cost + cut[i], "K" + audit, (f"{role}:{text}", *lines)))
                for letter, name in (("u", "user"), ("a", "assistant")):
                    if after(state, letter):
                        cost, audit, lines = best(i + 1, letter, 0)
                        options.append((cost + 2 + cut[i], "R" + audit, (f"{name}:{text}", *lines)))
        return min(options, key=lambda o: o[:2]) if options else (10**9, "", ())

    for i in range(n, 0, -1):  # fills the cache from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    cost, audit, lines = best(0, "", 0)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest)


def found(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *CLASH.split(", "))
    out = {tuple(r)[0]: tuple(r)[1:] for r in repair.repair(repair.damage(frame)).collect()}
    return out


def expected(rows):
    return {k: brute(v) for k, v in damaged(rows).items()}


def random_rows(seed, conversations=300):
    draw, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "Why?", "cut", "cut ", "", " \n", None, "Ja. \t", "é…", "Yes."]
    roles = ["user", "assistant", "system", "tool", "user", "assistant", "", None, "us", "User"]
    for conv in range(conversations):
        for _ in range(draw.randrange(0, 11)):
            rows.append((None if conv == 7 else conv, None if draw.random() < 0.1 else draw.randrange(9), draw.choice(roles), draw.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rows = random_rows(seed)
    assert found(spark, rows) == expected(rows)


@needs_tables
def test_whole_table_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table.collect()]
    assert found(spark, rows) == expected(rows)


def test_spilled_conversations_equal_whole_ones(spark, monkeypatch):
    """Chunks of five rows or a few characters; set inside the task, where the stream runs."""
    rows = random_rows(5, 60) + [(500, i, random.Random(i).choice(["user", "assistant"]), f"t{i % 700}.") for i in range(2000)]

    def short(batches):
        repair.CHUNK, repair.CHUNK_CHARS = 5, 40
        yield from repair_stream(batches)

    repair_stream = repair.repaired_stream
    monkeypatch.setattr(repair, "repaired_stream", short)
    assert found(spark, rows) == expected(rows)


def test_empty_table_and_long_text(spark):
    assert found(spark, []) == {}
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y " * 1_000_000), (1, 2, "assistant", "z.")]
    assert found(spark, rows) == expected(rows)


def test_all_rows_dropped(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"3:{t}".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert found(spark, [(3, gone, "user", "Yes.")]) == {3: (0, 0, 0, 0, 0, 0, "", empty)}
