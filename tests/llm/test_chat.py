import hashlib

from tarifa.llm import chat
from tests.llm.tables import SF_DIR, needs_tables

SCHEMA = "conv_id long, turn long, role string, text string"


def frame_of(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS window", "2 AS use", "3 AS place", "4 AS s", "5 AS c", "6 AS block", "7 AS tokens", "8 AS items")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    out = {}
    for conv, _, role, text in sorted(rows, key=order):
        turns = out.setdefault(conv, [])
        turns.append((role or "", text or ""))
    loss = {c: "".join(t for r, t in turns if r == "assistant") for c, turns in out.items()}
    return {c: (len(x), sha("".join(f"{r}\n{t}\n" for r, t in x)), len(loss[c]), sha(loss[c])) for c, x in out.items()}


def check(spark, rows, **options):
    made = chat.windows(frame_of(spark, rows), **options).persist()
    result = {r["conv_id"]: tuple(r[k] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256")) for r in chat.read_back(made).collect()}
    assert result == expected(rows)
    return sorted((r for r in made.collect()), key=lambda r: (r["conv_id"] or 0, r["window"]))


@needs_tables
def test_whole_table_read_back(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_marks_inside_texts(spark):
    marks = ["<s>", "</s>", "[INST]", "[/INST]", "<\\s>", "[\\\\/INST]", "<", "[", "\\", "</", "<<s>s>", "[[INST]/INST]", "</s>[INST] ok [/INST]", "🙂</s>é", "$1\\2"]
    rows = [(i, k, role, m) for i, m in enumerate(marks) for k, role in enumerate(["user", "assistant", m])]
    check(spark, rows)


def test_windows(spark):
    rows = [(1, 0, "system", "s" * 40)] + [(1, i, ["assistant", "user"][i % 2], f"{i:03d}" * 20) for i in range(1, 200)]
    found = check(spark, rows, budget=128, history=32)
    assert len(found) > 20 and not any(r["over_budget"] for r in found)
    assert all(r["tokens"] <= 128 for r in found)
    # the system turn leads each window, and all but the first repeat some history
    assert all(r["formatted"].startswith("<s>[INST]system[/INST]sss") for r in found)
    assert found[0]["repeated"] == 0 and all(r["repeated"] >= 2 for r in found[1:])
    masked = [r["formatted"][a:b] for r in found for a, b in r["loss"]]
    assert masked == [f"{i:03d}" * 20 for i in range(2, 200, 2)]


def test_edge_cases(spark):
    rows = [(None, 1, "user", "a"), (None, None, None, None), (2, 0, "assistant", None), (3, 5, "assistant", "x" * 9000), (3, 5, "assistant", "x" * 9000), (3, -1, "user", "")]
    rows += [(4, 1, "user", "late system"), (4, 2, "system", "be kind"), (4, 3, "system", "twice"), (4, 10**15, "assistant", "far")]
    found = check(spark, rows)
    assert [r["over_budget"] for r in found if r["conv_id"] == 3].count(True) == 2
    assert chat.windows(frame_of(spark, rows).limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.read_back(chat.windows(frame_of(spark, [(1, 1, "user", "a")])))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
