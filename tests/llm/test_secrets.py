import hashlib
import random
import re
import string

from pyspark.sql import functions as F

from tarifa.llm import secrets
from tests.llm.tables import docs_of, needs_tables, texts

RANDOM = "q7Zp0LmX4vKd93TsWb1RyHc8"


def brute(text):
    text = text or ""
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(found)


def check(spark, rows):
    result = {r["doc_id"]: r for r in secrets.digests(secrets.secrets(docs_of(spark, rows))).collect()}
    kinds = ["assign", "access", "hex"]
    for doc, text in rows:
        base = brute(text)
        line = ",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in base)
        assert result[doc]["base_sha256"] == hashlib.sha256(line.encode()).hexdigest(), text
        assert [result[doc][f"n_{k}"] for k in kinds] == [sum(x[1] == i for x in base) for i in range(3)]
        kept = [s for s in result[doc]["spans"].split(",") if s and not s.startswith("novel")]
        assert ",".join(kept) == line


@needs_tables
def test_whole_table_equals_brute_force(spark):
    check(spark, texts(spark))


def test_edge_cases(spark):
    cases = [
        None, "", "password = 'short'", "PassWord: token: abcdefghijklmn", "é token=abcdefghijkl.", "api_key=ABCDEFGHIJKLMNOP apikey='0123456789abcdef'",
        "ſecret=abcdefghijklmnop", "toKen=abcdefghijklmnop", "AKIAAKIAAKIAAKIA12 AKIA1", "0123456789abcdefg0123456789abcdef", "🙂 secret : \"deadbeefdeadbeef\"",
        "x" * 100_000 + " password=abcdefghijklmnop", "token==abcdefghijklmn token=a token=abcdefghijklmnop",
    ]
    check(spark, [*enumerate(cases)])


def test_novel_strings(spark):
    assert [s[2] for s in secrets.all_spans(f"the bearer {RANDOM} was sent")] == ["novel"]
    assert secrets.all_spans(f"the value {RANDOM} was sent") == []
    # explained by what stands around it, and by the identifiers
    assert secrets.all_spans(f"{RANDOM} is the bearer {RANDOM} here {RANDOM}") == []
    assert secrets.all_spans("the private configuration_connection2 of it") == []
    assert secrets.marginal_bytes(RANDOM, "", "") > secrets.marginal_bytes(RANDOM, RANDOM, "") + 10


def test_novel_strings_in_a_wider_context(spark):
    chance = random.Random(1)
    key = lambda n: "".join(chance.choices(string.ascii_letters + string.digits, k=n))
    lines = [key(64) for _ in range(25)] + ["Zk3q9=="]
    token = [key(n) for n in (36, 900, 43)]
    other = key(24)
    cases = [
        ("-----BEGIN RSA PRIVATE KEY-----\n" + "\n".join(lines) + "\n-----END RSA PRIVATE KEY-----\n", lines),
        ("-----BEGIN PRIVATE KEY-----\\n" + lines[0] + "\\n-----END PRIVATE KEY-----", [lines[0]]),
        (f"credential:\n    {RANDOM}\n", [RANDOM]),
        (f"Authorization: Bearer {'.'.join(token)} sent", token),
        (f"the bearer {RANDOM} {other} was sent", [RANDOM]),
        (f"the bearer first_thing_of_them {other} was sent", [other]),
        (f"the bearer {RANDOM} and the bearer {RANDOM} were sent", [RANDOM]),
        (f"token={RANDOM} and the bearer {RANDOM} were sent", [RANDOM]),
    ]
    for text, parts in cases:
        cleaned, at = [], 0
        for start, end, _ in secrets.all_spans(text):
            cleaned.append(text[at:start])
            at = max(at, end)
        left = "".join([*cleaned, text[at:]])
        assert not any(p in left for p in parts), text
    frame = docs_of(spark, [(1, cases[0][0])])
    assert lines[3] not in frame.select(secrets.redacted(F.col("text"))).first()[0]
    assert secrets.all_spans("the public words after the private\nkey of a long_identifier_name_here.\n") == []


def test_redaction_and_rows(spark):
    rows = [(None, "a password=abcdefghijklmnop b"), (1, None), (1, "no"), (2, "key 0123456789abcdef0 end")]
    frame = docs_of(spark, rows)
    cleaned = {r[0] for r in frame.select(secrets.redacted(F.col("text"))).collect()}
    assert cleaned == {"a [assign removed] b", None, "no", "key [hex removed] end"}
    assert secrets.secrets(frame).count() == 4
    assert secrets.secrets(frame.limit(0)).count() == 0
