import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tarifa.llm import divergence, transducer

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = "'x' AS term, 1 AS n, 2 AS place, 'y' AS part, 3 AS value, 4 AS rank, 5 AS number, 6 AS total, 7 AS low"


def brute(rows, least, top=10):
    rows = [(a or "", s or "", TERM.findall((t or "").translate(LOWER))) for a, s, t in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df = Counter(t for _, _, ts in own for t in set(ts))
        kept = sorted(t for t in df if df[t] >= least)
        counts = {s: Counter() for _, s, _ in own}
        for _, s, ts in own:
            counts[s].update(t for t in ts if df[t] >= least)
        everything = sum(counts.values(), Counter())

        def shares(count, kept=kept):
            total = sum(count.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        q = shares(everything)
        p = {s: shares(c) for s, c in counts.items()}
        for s in counts:
            pairs = [(-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s]
            terms = [(-gap(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode(), -value, rank + 1) for rank, (value, item) in enumerate(found)}
    return out


def found(spark, rows, **kw):
    frame = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", *CLASH.split(", "))
    result = [tuple(r) for r in divergence.audit(frame, **kw).collect()]
    assert len(result) == len(set(result))
    return set(result)


def random_rows(seed, n=300):
    draw = random.Random(seed)
    words = [w + e for w in ["Ab", "é", "日本", "zz", "𝒳y", "the", "thereafter", "prefix", "prefixes", "prefixed"] for e in ["", "a", "b", "ab", "ü"]]
    rows = []
    for _ in range(n):
        lang = draw.choice(["en", "en", "fr", None, ""])
        source = draw.choice(["a", "a", "b", "c", None, "", "é"])
        bag = words if source != "b" else words[:9]
        text = None if draw.random() < 0.05 else draw.choice([" ", "1", "\x00", "-", "\n"]).join(draw.choices(bag, k=draw.randrange(0, 12)))
        rows.append((lang, source, text))
    # a language without kept terms, a source without terms, and repeated rows
    return [*rows, ("xx", "a", "one"), ("xx", "b", None), ("xx", "c", ""), ("en", "bare", "1 2 3"), *rows[:40]]


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(spark, seed):
    rows = random_rows(seed)
    assert found(spark, rows, least=5, top=4) == brute(rows, 5, 4)


def test_large_vocabulary_and_many_blocks(spark, monkeypatch):
    """Ranges of seven terms, none of which a task may hold for good."""
    for name, value in (("TABLE_BYTES", 0), ("PART_TERMS", 7)):
        monkeypatch.setattr(divergence, name, value)
    rows = random_rows(3)
    assert found(spark, rows, least=2) == brute(rows, 2)


def test_many_sources_meet_in_blocks(spark):
    draw = random.Random(4)
    rows = [("en", f"s{i % 150}", " ".join(draw.choices(["a", "b", "c", "d"], k=5))) for i in range(450)]
    assert found(spark, rows) == brute(rows, 10)


def test_empty_table_and_long_text(spark):
    assert found(spark, []) == set()
    rows = [("en", "a", "word " * 700_000), ("en", "b", "x" * 3_000_000 + " word")] + [("en", "b", "word other")] * 9
    assert found(spark, rows, least=9) == brute(rows, 9)


def places(words, tokens, part=10**9):
    words = sorted(words)
    parts = [("en", words[i].decode(), i, transducer.built(words[i : i + part])) for i in range(0, len(words), part)]
    table = transducer.Transducers(parts)
    data, starts, sizes, _ = transducer.tokens(pa.array([" ".join(t.decode() for t in tokens)]))
    return table.places("en", data, starts, sizes).tolist(), table


@pytest.mark.parametrize("part", [3, 10**9])
def test_transducer_gives_places(part):
    draw = random.Random(1)
    words = {"".join(draw.choices("abé", k=draw.randrange(1, 14))).encode() for _ in range(4000)}
    kept = set(draw.sample(sorted(words), 2000))
    order = {w: i for i, w in enumerate(sorted(kept))}
    tokens = sorted(words)
    assert places(kept, tokens, part)[0] == [order.get(w, -1) for w in tokens]


def test_transducer_is_minimal():
    words = sorted(a + b for a in (b"do", b"re", b"mi") for b in (b"ing", b"ed", b"s"))
    n_states = np.frombuffer(transducer.built(words), dtype=np.int32)[0]
    # start, three first letters, the shared state before the endings, i, n, e, the end
    assert n_states == 1 + 3 + 1 + 3 + 1
