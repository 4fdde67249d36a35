"""Secrets in texts: fixed patterns, and strings in a sensitive context that zstandard cannot explain.

A candidate is a long string of key characters soon after a sensitive word, on its line or the next ones, one that goes on from
such a string after a dot or a line break, or one in the body of a private key block. Zstandard is primed with a dictionary of the
text around it, without other sensitive copies of it, and of common identifiers; the bytes that it still needs for the candidate, beyond those of
an empty frame, are the candidate's marginal bytes. A string that the surroundings or the identifiers explain costs little; a
random one costs about a byte per character and is reported.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["assign", "access", "hex", "novel"]

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_HINTS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

SENSITIVE = re.compile(r"(?ai)(?:pass|secret|token|credential|auth|bearer|private|api|access|key|signature)[a-z_]*")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}")
#: A private key block: its body goes up to the END line, or to the end of a text that is cut off; its last line may be short.
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----(.*?)(?:-----END|\Z)", re.DOTALL)
LAST_LINE = re.compile(r"(?:\s|\\[nr])*([A-Za-z0-9+/]{1,15}={0,2})(?:\s|\\[nr])*(?:=[A-Za-z0-9+/]{4}\s*)?-----END")
#: What may stand between the parts of one secret: a dot, or a line break with spaces, quotes and signs of continuation.
JOINT = re.compile(r"""\.|["'\\+,\x20\t]*\r?\n["'+>|\x20\t]*""")
#: Characters between a sensitive word and a candidate, white space not counted; characters of context on each side, least marginal bytes per character.
REACH, CONTEXT, NOVELTY = 24, 512, 0.8
WITHIN = re.compile(rf"(?:\s*\S){{0,{REACH}}}\s*")
#: Characters measured at a time: a long string of random key characters would be packed to six bits each.
PIECE = 64

IDENTIFIERS = " ".join(
    """abstract access account action address admin algorithm application argument array assert async attribute authenticate
    authorization await backend base binary boolean buffer builder bytes cache callback certificate channel class client
    collection column command config configuration connection constant constructor container content context controller cookie
    count create credential cursor custom data database datetime debug decode default define delete description destination
    dictionary directory document domain element email enabled encode encrypted endpoint engine environment error event example
    exception execute expires export extension factory false field filename filter float folder format function gateway generate
    handler hash header hostname identifier implement import include index instance integer interface internal iterator
    javascript keyword language length library listener local location logger manager message metadata method middleware model
    module namespace network number object offset operator option organization output package parameter parser password path
    pattern payload permission pipeline placeholder platform plugin pointer port prefix private process production profile
    project property protected protocol provider proxy public python query random record reference register request resource
    response result return route sample schema scope secret security select sequence server service session settings signature
    source static status storage string structure subject suffix system table target template temporary thread timeout
    timestamp token transaction transform undefined update upload username validate value variable version virtual window
    workspace 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ""".split()
)


def marginal_bytes(candidate: str, before: str, after: str) -> int:
    """Bytes that the candidate adds to a frame primed with its surroundings and the identifiers."""
    primer = (IDENTIFIERS + "\n" + after + "\n" + before).encode("utf-8", "replace")
    primed = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compressor = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False, write_dict_id=False)
    return len(compressor.compress(candidate.encode())) - len(compressor.compress(b""))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    lowered = text.lower()
    if any(hint in lowered for hint in ASSIGN_HINTS):
        # matched first and measured afterwards: a match that is too short still takes up its text
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def candidates(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, whether in a private key block) of the strings in a sensitive context, by start."""
    blocks = [m.span(1) for m in KEY_BLOCK.finditer(text)] if "PRIVATE KEY" in text else []
    words = [(m.end(), WITHIN.match(text, m.end()).end()) for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    found, word, block, upto, joined = [], 0, 0, -1, -1
    for m in CANDIDATE.finditer(text, words[0][0]):
        while word < len(words) and words[word][0] <= m.start():  # reaches end in the order of their words
            upto = words[word][1]
            word += 1
        while block < len(blocks) and blocks[block][1] <= m.start():
            block += 1
        inside = block < len(blocks) and blocks[block][0] <= m.start()
        if inside or m.start() <= upto or m.start() == joined:
            found.append((m.start(), m.end(), inside))
            joint = JOINT.match(text, m.end())
            joined = joint.end() if joint else -1
    return found


def without_copies(text: str, low: int, high: int, candidate: str, secret: list[tuple[int, int]], starts: list[int]) -> str:
    """A part of the text without those copies of the candidate that lie in a sensitive string themselves."""
    out, upto, at = [], low, text.find(candidate, low, high)
    while at >= 0:
        k = bisect_right(starts, at) - 1
        if k >= 0 and at + len(candidate) <= secret[k][1]:
            out.append(text[upto:at])
            upto = at + len(candidate)
        at = text.find(candidate, at + len(candidate), high)
    return "".join([*out, text[upto:high]])


def novel_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Incompressible strings in a sensitive context that no other span touches; key blocks count whatever else touches them."""
    found, measured = [], candidates(text)
    if not measured:
        return found
    secret = []  # sensitive strings, and for each the furthest end up to it
    for start, end in sorted([(s, e) for s, e, _ in measured] + [(s, e) for s, e, _ in taken]):
        secret.append((start, max(end, secret[-1][1] if secret else 0)))
    starts = [s for s, _ in secret]
    for start, end, inside in measured:
        own = text[start:end]
        mixed = any(c.isdigit() for c in own) and any(c.isalpha() for c in own)
        if not inside and (not mixed or any(s < end and start < e for s, e, _ in taken)):
            continue
        before = without_copies(text, max(0, start - CONTEXT), start, own, secret, starts)
        after = without_copies(text, end, min(len(text), end + CONTEXT), own, secret, starts)
        pieces = [own] if len(own) < 2 * PIECE else [own[i : i + PIECE] for i in range(0, len(own), PIECE)]
        if sum(marginal_bytes(p, before, after) for p in pieces) >= NOVELTY * len(own):
            found.append((start, end, "novel"))
            last = LAST_LINE.match(text, end) if inside else None
            if last:
                found.append((*last.span(1), "novel"))
    return found


def all_spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then in the order of the kinds."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, base), key=lambda s: (s[0], KINDS.index(s[2])))


def spans_of(text: Column) -> Column:
    """The spans of a text column as an array of (kind, start, end), in code points, end exclusive."""

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: [{"kind": k, "start": s, "end": e} for s, e, k in all_spans(t)])

    return found(F.coalesce(text, F.lit("")))


def redacted(text: Column) -> Column:
    """A text column with each run of overlapping spans replaced by a mark; NULL stays NULL."""

    def clean(t: str | None) -> str | None:
        if t is None:
            return None
        out, upto = [], 0
        for start, end, kind in all_spans(t):
            if start >= upto:
                out += [t[upto:start], f"[{kind} removed]"]
            upto = max(upto, end)
        return "".join([*out, t[upto:]])

    @F.pandas_udf("string")
    def cleaned(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(clean)

    return cleaned(text)


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) per row of ``docs``: the patterns ``assign``, ``access``, ``hex`` and the ``novel`` strings.

    NULL and empty texts have no spans. Spans of different kinds may overlap. Repeated rows and rows without id each give their
    row; an empty table gives an empty result; other columns are not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), spans_of(F.col(text_col)).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of the spans, as text and counts."""
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(span_text(F.filter(spans, lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )
