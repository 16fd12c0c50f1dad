"""Operator 8, SentencePiece encoding and decoding for merge-type vocabularies.

A text's characters are the first symbols.  Adjacent symbols whose
concatenation is a piece wait in an agenda ordered by the piece's score, then
by place; the best pair is merged, its new neighbours join the agenda, and
stale pairs are skipped when they come up.  Symbols left over that are no
piece fall back to byte pieces.

No piece of such a vocabulary holds a word mark after another character, so
no merge crosses the start of a word and words can be encoded one by one and
remembered.  The vocabulary is checked for this when it is loaded; one that
lacks the property is encoded text by text.

Defined cases: NULL and empty texts have no ids and decode to an empty text;
very long words cost O(n log n); repeated rows are encoded again from memory;
an empty table gives an empty result.  Only ids and texts are read, so extra
columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from offerlake.llm.common import kept, read, sliced

MARK = "▁"

#: Texts of up to so many characters keep their agenda as a flat list.
SHORT = 32
NEVER = float("inf")

#: Words whose encoding a worker remembers; memory is bounded, results do not depend on it.
REMEMBERED = 200_000


class Vocabulary:
    """A merge-type vocabulary: pieces, scores and byte pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.cost: dict[str, float] = {}  # of a piece: its score, negated
        self.ids: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.unknown = -1
        self.text: list[str | int | None] = []  # what an id stands for: text, a byte, or nothing
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_unused(i):
                raise ValueError("vocabularies with unused pieces are not supported")
            if sp.is_byte(i):
                byte = int(piece[3:5], 16)
                self.bytes[byte] = i
                self.text.append(byte)
            elif sp.is_control(i):
                self.text.append(None)
            elif sp.is_unknown(i):
                self.unknown = i
                self.text.append(" ⁇ ")
            else:
                self.cost[piece], self.ids[piece] = -sp.get_score(i), i
                self.text.append(piece.replace(MARK, " "))
        if len(self.bytes) != 256:
            raise ValueError("the vocabulary has no byte fallback")
        if sp.encode("a  b ") == sp.encode("a b"):
            raise ValueError("vocabularies that squeeze white space are not supported")
        #: The same, with byte pieces of ASCII (line ends, mostly) as the characters that they stand for in any run.
        self.plain = [chr(t) if isinstance(t, int) and t < 128 else t for t in self.text]
        self.names = [str(i) for i in range(len(self.text))]
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids)
        #: Two characters that some piece holds side by side.
        self.side_by_side = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # Two generations: frequent words move on to the new one, the rest is forgotten.  Ids alone: a word's
        # decimal list and its text would take more than twice as much again, in every worker of an executor.
        self.memory: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def merge_short(self, text: str) -> list[str]:
        """``merge`` for a short text: the agenda is a flat list, one entry for each pair."""
        get = self.cost.get
        sym = list(text)
        agenda = [get(text[i : i + 2], NEVER) for i in range(len(text) - 1)]
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)  # the first of equal ones
            sym[i] += sym.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = get(sym[i - 1] + sym[i], NEVER)
            if i < len(agenda):
                agenda[i] = get(sym[i] + sym[i + 1], NEVER)
        return sym

    def merge(self, text: str) -> list[str]:
        """Symbols of a text after all merges, by the agenda."""
        if len(text) <= SHORT:
            return self.merge_short(text)
        cost = self.cost
        n = len(text)
        sym: list[str] = list(text)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            if (c := cost.get(text[i : i + 2])) is not None:
                agenda.append((c, i, i + 1, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = sym[left], sym[right]
            if not a or not b or len(a) + len(b) != size:
                continue  # one of the two was merged meanwhile
            sym[left] = a = a + b
            sym[right] = ""
            after = nxt[left] = nxt[right]
            if after < n:
                prv[after] = left
                if (c := cost.get(a + sym[after])) is not None:
                    heapq.heappush(agenda, (c, left, after, size + len(sym[after])))
            before = prv[left]
            if before >= 0 and (c := cost.get(sym[before] + a)) is not None:
                heapq.heappush(agenda, (c, before, left, size + len(sym[before])))
        return [s for s in sym if s]

    def ids_of(self, marked: str) -> list[int]:
        """Ids of a text whose spaces are word marks already."""
        out: list[int] = []
        for s in self.merge(marked):
            i = self.ids.get(s)
            if i is None:
                out.extend(self.bytes[b] for b in s.encode())
            else:
                out.append(i)
        return out

    def parts(self, text: str) -> list[str]:
        """The marked text, cut where no merge can cross."""
        if not text:
            return []
        if self.by_word and not (text[0] == " " or text[-1] == " " or "  " in text or MARK in text):
            return [MARK + w for w in text.split(" ")]  # as below, faster
        marked = MARK + text.replace(" ", MARK)
        return WORDS.findall(marked) if self.by_word else [marked]

    def encode(self, text: str) -> list[int]:
        get, make = self.memory.get, self.remembered
        out: list[int] = []
        for p in self.parts(text):
            out.extend(get(p) or make(p))
        return out

    def raw(self, ids: Iterable[int], first: bool = False) -> str:
        """Text of ids.  ``first``: the word mark that opens the text is dropped.

        It is one of a piece's own; byte pieces and the unknown piece keep their spaces.
        """
        out: list[str] = []
        run = bytearray()
        for i in ids:
            t = self.text[i]
            if isinstance(t, int):
                run.append(t)
                continue
            if run:
                out.append(from_bytes(run))
                run = bytearray()
            if first and t and i != self.unknown and not out:
                first = not t.startswith(" ")
                t = t.removeprefix(" ")
            if t:
                out.append(t)
        if run:
            out.append(from_bytes(run))
        return "".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        return self.raw(ids, first=True)

    def text_of(self, ids: Iterable[int]) -> str:
        """``raw`` for a part's ids, which mostly hold no byte pieces beyond ASCII."""
        try:
            return "".join(map(self.plain.__getitem__, ids))
        except TypeError:
            return self.raw(ids)

    def runs(self, part: str) -> list[str]:
        """A part cut where no merge can cross: between characters that no piece holds side by side."""
        held = self.side_by_side
        cuts = [i for i in range(1, len(part)) if part[i - 1 : i + 1] not in held]
        return [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)])] if cuts else [part]

    def made(self, run: str) -> tuple[int, ...]:
        """``remembered`` for a run, by its merges."""
        return tuple(self.ids_of(run))  # tuples of numbers are no work for the garbage collector, lists are

    def remembered(self, part: str) -> tuple[int, ...]:
        """Ids of one part."""
        out = self.memory.get(part) or self.older.get(part)
        if out is None:
            runs = self.runs(part)
            if len(runs) == 1:
                out = self.made(part)
            else:
                get, make = self.memory.get, self.remembered
                out = tuple([i for r in runs for i in get(r) or make(r)])
        if len(part) <= 64:
            if len(self.memory) >= REMEMBERED:
                self.older, self.memory = self.memory, {}
            self.memory[part] = out
        return out

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded text.

        A part's bytes are whole characters, so parts can be decoded apart.
        """
        get, make = self.memory.get, self.remembered
        done = [get(p) or make(p) for p in self.parts(text or "")]
        ids = list(chain.from_iterable(done))
        try:
            decoded = "".join(map(self.plain.__getitem__, ids))
        except TypeError:  # byte pieces beyond ASCII
            decoded = "".join(map(self.text_of, done))
        return len(ids), sha256(",".join(map(self.names.__getitem__, ids))), sha256(decoded.removeprefix(" "))


WORDS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def from_bytes(run: bytes) -> str:
    """Byte pieces as text; each byte that is no part of a character becomes U+FFFD."""
    out: list[str] = []
    rest = bytes(run)
    while rest:
        try:
            out.append(rest.decode())
            break
        except UnicodeDecodeError as e:
            out.append(rest[: e.start].decode() + "�")
            rest = rest[e.start + 1 :]
    return "".join(out)


def sha256(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def load(model) -> Vocabulary:
    """The vocabulary of a broadcast model file, built once in each worker."""
    return kept(("pieces", model.id), lambda: Vocabulary(model.value))


class _Shipped:
    """A model file as a Spark broadcast with an id that workers can key on."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.id = hashlib.sha256(data).hexdigest()
        self._b = spark.sparkContext.broadcast(data)

    @property
    def value(self) -> bytes:
        return self._b.value


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every row: id, ids, decoded."""
    kind = docs.schema[id_col].dataType
    model = _Shipped(docs.sparkSession, path)
    at = pa.schema([("id", _arrow(kind)), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(model)
        for b in sliced(batches, 256):
            ids = [v.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([v.decode(x) for x in ids], pa.string())],
                schema=at,
            )

    out = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, ids array<int>, decoded string")
    return out


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def differences(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows on which the agenda and the sentencepiece library differ, checked in Arrow batches.

    Returns id, ids, library_ids; empty when they agree on ids and on decoding.
    """
    model = _Shipped(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType
    ints = pa.list_(pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(model)
        for b in sliced(batches, 256):
            texts = [t or "" for t in b.column(1).to_pylist()]
            theirs = v.library.encode(texts, num_threads=1)
            ours = [v.encode(t) for t in texts]
            bad = [k for k, (x, y) in enumerate(zip(ours, theirs)) if x != y or v.decode(x) != v.library.decode(y)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(bad, pa.int64())), pa.array([ours[k] for k in bad], ints), pa.array([theirs[k] for k in bad], ints)],
                names=["id", "ids", "library_ids"],
            )

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind.simpleString()}, ids array<int>, library_ids array<int>"
    )


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_tokens, ids_sha256 and decoded_sha256 of every row."""
    model = _Shipped(docs.sparkSession, path)
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = load(model)
        for b in sliced(batches, 256):
            done = [v.digest(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([d[0] for d in done], pa.int64()),
                    pa.array([d[1] for d in done], pa.string()),
                    pa.array([d[2] for d in done], pa.string()),
                ],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def vocabulary_path() -> str:
    """The production vocabulary; its place is a parameter of every function here."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return digests(read(spark, sf_dir, "documents"), vocabulary_path())
