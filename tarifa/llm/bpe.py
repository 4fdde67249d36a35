"""BPE encoding and decoding by a deterministic automaton over tokens.

The automaton accepts exactly the token sequences that BPE yields. It is compiled by one gadget per merge, in merge order:
at first one state has an arc to itself for each base symbol. The gadget of a merge ``u v`` splits the state ``p`` that
``u`` leads to: a copy of it without the arc ``v`` becomes the new target of ``u``, and wherever ``u`` may be read there is
a new arc ``uv`` to the state that ``v`` led to from ``p``. So every token has one target state, and a state is told by what
its gadgets removed: its owner ``u``, the merge that made it, and the state that ``u`` led to at first. Arcs are entered in
the transition table when they are first used; the table stays bounded.

Words are read symbol by symbol. For each prefix exactly one token ends it that the state before the token has an arc for.
A reading is all that matters for the rest: the state here, and where tokens have begun, how far each has been read and from
which state. Readings are numbered, and a second table leads from (reading, symbol) to the next reading and the token that
ends there, so that a known word costs a look-up per symbol. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarifa.llm.common import text_groups

#: Entries of the tables of arcs and of readings, and words held by a task; each is emptied when it is full.
#: Texts of 25 MB have some 400,000 readings; a smaller table is filled again and again.
ARCS, READINGS, WORDS = 200_000, 400_000, 200_000


SEPARATOR = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: visible ones for themselves, others from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class Automaton:
    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str) -> None:
        self.size = max(vocab.values(), default=0) + 1
        self.merge_of: dict[int, int] = {}  # u * size + v: number of the merge
        self.left: dict[int, int] = {}
        self.made: dict[int, int] = {}  # token: number of the merge that makes it
        self.owner, self.born = [-1], [-1]
        made = {u + v for u, v in merges}
        self.target = {i: 0 for t, i in vocab.items() if t not in made}
        self.first = dict(self.target)
        for number, (left, right) in enumerate(merges):
            self._gadget(number, vocab[left], vocab[right], vocab[left + right])
        self.arcs: dict[int, int] = {}
        self._spell(vocab, suffix)
        self._forget()

    def _gadget(self, number: int, u: int, v: int, uv: int) -> None:
        if uv in self.target:
            raise ValueError(f"two merges make token {uv}")
        self.target[uv] = self.first[uv] = self.target[v]
        self.left[uv], self.made[uv] = u, number
        self.merge_of[u * self.size + v] = number
        self.owner.append(u)
        self.born.append(number)
        self.target[u] = len(self.owner) - 1

    def _has_arc(self, state: int, token: int) -> bool:
        """Whether no gadget has removed the arc: neither itself nor, before it was made, one that it was built on."""
        while state:
            u, born = self.owner[state], self.born[state]
            part, until = token, born
            while part is not None:
                removed = self.merge_of.get(u * self.size + part)
                if removed is not None and removed <= until:
                    return False
                until, part = min(born, self.made.get(part, born)), self.left.get(part)
            state = self.first[u]
        return True

    def step(self, state: int, token: int) -> int:
        """The state after an arc, or -1."""
        key = state * self.size + token
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) >= ARCS:
                self.arcs.clear()
            found = self.arcs[key] = self.target[token] if self._has_arc(state, token) else -1
        return found

    def _spell(self, vocab: dict[str, int], suffix: str) -> None:
        """A trie of all tokens over symbols: bytes, and from 256 on bytes that end a word."""
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        self.child: dict[int, int] = {}  # node * 512 + symbol
        self.token_at, self.length = [-1], {}
        for text, token in vocab.items():
            ends = bool(suffix) and text.endswith(suffix) and len(text) > len(suffix)
            symbols = [byte_of[c] for c in (text[: -len(suffix)] if ends else text) if c in byte_of]
            symbols[-1] += 256 * ends
            node = 0
            for symbol in symbols:
                node = self.child.setdefault(node * 512 + symbol, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
            if token in self.target:
                self.token_at[node] = token
            self.length[token] = len(symbols)
        self.inner = [False] * len(self.token_at)
        for key in self.child:
            self.inner[key // 512] = True

    def _forget(self) -> None:
        """A reading is a dictionary from symbols to (next reading, token), with its definition under -1."""
        self.start: dict = {-1: ((), 0)}
        self.readings, self.entries = {self.start[-1]: self.start}, 0

    def _read(self, reading: dict, symbol: int) -> tuple[dict, int]:
        """The next reading and the token that ends here; entered in the table."""
        begun, state = reading[-1]
        going, after, found = [], -1, -1
        for node, origin in (*begun, (0, state)):
            child = self.child.get(node * 512 + symbol)
            if child is None:
                continue
            if self.inner[child]:
                going.append((child, origin))
            token = self.token_at[child]
            if found < 0 <= token:
                after = self.step(origin, token)
                found = token if after >= 0 else -1
        if found < 0:
            raise ValueError(f"symbol {symbol} is not in the vocabulary")
        definition = (tuple(going), after)
        following = self.readings.get(definition)
        if following is None:
            following = self.readings[definition] = {-1: definition}
        self.entries += 1
        entry = reading[symbol] = (following, found)
        return entry

    def encode(self, symbols: list[int]) -> list[int]:
        """The tokens of a word."""
        if self.entries >= READINGS:
            self._forget()
        reading, ended = self.start, []
        for symbol in symbols:
            reading, token = reading.get(symbol) or self._read(reading, symbol)
            ended.append(token)
        out, at, length = [], len(symbols), self.length
        while at:
            token = ended[at - 1]
            out.append(token)
            at -= length[token]
        out.reverse()
        return out


class Words(dict):
    """Packed ids of stretches of normalized text without white space; those of one piece are kept once they are met."""

    def __init__(self, automaton: Automaton, marks_end: bool, pieces: Callable[[str], list[str]]) -> None:
        super().__init__()
        self.automaton, self.end, self.pieces = automaton, 256 * marks_end, pieces

    def __missing__(self, stretch: str) -> bytes:
        if not stretch.isalpha():
            if stretch[-1] in ".,;:!?" and stretch[:-1].isalpha():
                return self[stretch[:-1]] + self[stretch[-1]]
            pieces = self.pieces(stretch)
            if pieces != [stretch]:
                return b"".join([self[p] for p in pieces])
        symbols = [*stretch.encode("utf-8", "replace")]
        symbols[-1] += self.end
        ids = self.automaton.encode(symbols)
        packed = struct.pack(f"{len(ids)}i", *ids)
        if len(self) >= WORDS:
            self.clear()
        self[stretch] = packed
        return packed


class Tokenizer:
    """Encoder and decoder for a tokenizer file (JSON) of a byte-level BPE with or without word ends."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        suffix = model.get("end_of_word_suffix") or ""
        pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.words = Words(Automaton(model["vocab"], merges, suffix), bool(suffix), pieces.findall)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.markers = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    @staticmethod
    def normalized(text: str) -> str:
        """NFC and lower case. White space stays as it is: the pre-split drops it."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # lower() of a whole text treats a final sigma apart
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def pack(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit integers."""
        if not text:
            return b""
        parts = self.markers.split(text) if self.markers else [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(np.int32(self.special[part]).tobytes())
            elif part:
                part = self.normalized(part)
                # str.split also parts at four control characters that are no white space
                apart = self.words.pieces(part) if SEPARATOR.search(part) else part.split()
                out.append(b"".join(map(self.words.__getitem__, apart)))
        return b"".join(out)


def labels_of(spec: dict) -> pa.Array:
    """The label of each id."""
    names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return pa.array([names.get(i) for i in range(max(names, default=-1) + 1)], pa.string())


def read_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) per row: the ids of the whole text. ``path`` is read on the driver and its content sent to the tasks.

    Texts are split at the special tokens, normalized (NFC, white space, lower case) and pre-split as the file says. NULL and
    empty texts have no ids. Repeated rows and rows without id each give their row; an empty table gives an empty result.
    Other columns are not read. A surrogate that is not half of a pair cannot occur in Spark's strings.
    """
    with open(path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())  # a worker keeps it: as bytes it is small

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(json.loads(content.value))  # compiled for the task and gone with it
        for batch in batches:
            for start, texts in text_groups(batch.column(1)):
                packed = [tokenizer.pack(t) for t in texts]
                offsets = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(texts)), ids], names=["doc_id", "ids"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(rows, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the labels of the ids, special tokens included, joined by spaces."""
    known = encoded.sparkSession.sparkContext.broadcast(labels_of(read_spec(path)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = known.value
        for batch in batches:
            ids = batch.column(1)
            step = max(1, batch.num_rows * (1 << 18) // max(1, len(ids.values)))  # about 2^18 ids at once
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                own = part.column(1)
                offsets = own.offsets.to_numpy()
                values = own.values.slice(offsets[0], offsets[-1] - offsets[0])
                emitted = pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), labels.take(values))
                yield pa.RecordBatch.from_arrays([*part.columns, pc.binary_join(emitted, " ")], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(
        rows, "doc_id long, ids array<int>, decoded string"
    )


def digests(decoded: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of encoded and decoded rows."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
