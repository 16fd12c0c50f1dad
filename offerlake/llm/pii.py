"""Operator 3, PII: base rules, and a bidirectional LSTM with CRF transitions for what they miss.

The tagger is trained in numpy from labelled spans: windows around the base
rules' own finds in at most SAMPLE documents, and the same finds rewritten as
people write them to be read by people only ("name (at) host dot org", card
numbers with dots, phone numbers without a plus sign), with their spans.

Every character that could belong to a find lies near a trigger: a digit, an
at sign, or a spelled-out one.  The text around triggers is cut into windows
that overlap by half; each is decoded by Viterbi.  The spans of all windows of a
text are then reconciled together: equal ones add their scores, those cut by
a window's edge yield to whole ones or, where no window holds the whole, are
joined with their like in the next window, finds that fail their kind's test
are dropped, and of the rest the non-overlapping set of the largest total score
is kept, beside the base spans, which always stay.  The triggers come from the
tests' own patterns and windows cover all that may belong to an address around
them, so no text that passes the tests goes undecoded.

Defined cases: NULL texts are empty and hold nothing; very long texts take
time in proportion to their length; repeated rows get the same spans; an
empty table gives an empty result; without any base find the tagger learns
from its fixed examples alone.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from offerlake.llm import pii_tagger
from offerlake.llm.common import read, sliced
from offerlake.llm.pii_rules import KINDS, LOCAL, Span, base_spans, digits, luhn, ordered, small_parts

#: Documents that the tagger may learn from, and windows of them that come to the driver.
SAMPLE = 2_000
SAMPLE_WINDOWS = 800
#: Characters of a window; windows overlap by half.
WIDTH = 96

_IN, _OPEN, _SHUT = r"[A-Za-z0-9_%+-]", r"[(\[{<]", r"[)\]}>]"
_WORD = f"{_IN}++"
_DOT = rf"(?: ?{_OPEN} ?[Dd][Oo][Tt] ?{_SHUT} ?| [Dd][Oo][Tt] |\.)"
_AT = f"(?: ?{_OPEN} ?[Aa][Tt] ?{_SHUT} ?| [Aa][Tt] | ?@ ?)"
_SPELLED = re.compile(f"{_WORD}(?:{_DOT}{_WORD})*{_AT}{_WORD}(?:{_DOT}{_WORD})+")

#: What every find holds: a digit, or the middle of ``_SPELLED``.
TRIGGER = re.compile(
    f"[0-9@]|{_OPEN} ?(?:[Aa][Tt]|[Dd][Oo][Tt]) ?{_SHUT}|[Aa](?<={_IN} [Aa])[Tt](?= {_WORD}{_DOT}{_IN})"
)
_AFTER = re.compile(f" ?(?:{_SHUT} ?)?{_WORD}(?:{_DOT}{_WORD})++")
_WORDS = re.compile(f"{_IN}*+")
_LETTERS = LOCAL - {"."}
#: What stands before the middle, read backwards.
_BEFORE = re.compile(rf" ?{_WORD}(?:(?: ?{_SHUT} ?[Tt][Oo][Dd] ?{_OPEN} ?| [Tt][Oo][Dd] |\.){_WORD})*+")

#: Fixed examples, so that the kinds are known whatever the sample holds.
EXAMPLES = {
    "email": ("jane.roe@example.org", "sales-team42@mail.example.com", "info@shop.example.co.uk", "x_y+z@a-b.net"),
    "ip": ("10.0.0.1", "192.168.17.254", "8.8.4.4", "172.16.0.33"),
    "card": ("4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "6011000990139424"),
    "phone": ("+1 (555) 123-4567", "+44 20 7946 0958", "+49.30.901820", "+33 1 23 45 67 89"),
}


def rewrite(kind: str, value: str, rng: random.Random) -> str:
    """A find as people write it to be read by people only."""
    if kind == "email":
        at, dot = rng.choice(((" at ", " dot "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" @ ", ".")))
        return value.replace("@", at).replace(".", dot)
    if kind == "ip":
        return value.replace(".", rng.choice(("[.]", "(.)", " . ")))
    if kind == "card":
        d = digits(value)
        return rng.choice((".", " . ", "/", "_")).join(d[i : i + 4] for i in range(0, len(d), 4))
    d = digits(value)
    return rng.choice(("({}) {}-{}", "00{} {} {}", "{}-{}-{}", "{}.{}.{}", "({}){}.{}")).format(d[:3], d[3:6], d[6:])


def decoy(rng: random.Random) -> str:
    """Characters with digits that are no find."""
    n = rng.randint
    return rng.choice((
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(n(16, 40))),
        lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(16)),
        lambda: str(n(1, 99999)), lambda: f"{n(1900, 2030)}-{n(1, 12):02}-{n(1, 28):02}", lambda: f"{n(0, 23)}:{n(0, 59):02}",
        lambda: f"{n(0, 20)}.{n(0, 30)}.{n(0, 99)}", lambda: f"{n(1, 999)},{n(0, 999):03}.{n(0, 99):02}",
        lambda: "".join(rng.choice("0123456789") for _ in range(n(16, 24))),
    ))()


def examples(windows: list[str], seed: int = 3) -> list[tuple[str, list[Span]]]:
    """Labelled windows: the given ones with their base spans, rewritten ones, and decoys."""
    rng = random.Random(seed)
    contexts = [w for w in windows if w.strip()] or ["the house on the hill is for sale, see below"]
    found = {k: list(v) for k, v in EXAMPLES.items()}
    out = []
    for w in windows:
        spans = base_spans(w)
        out.append((w, spans))
        for a, b, kind in spans:
            found[kind].append(w[a:b])
    # Words that hold a trigger go; where that leaves nothing, only their triggers do.
    clean = [c if (c := re.sub(r"\S*[0-9@+]\S*", "", w)).strip() else re.sub(r"[0-9@+]", "", w) for w in contexts]
    for i in range(150 * len(KINDS)):
        kind = KINDS[i % len(KINDS)]
        value = rng.choice(found[kind])
        if rng.random() < 0.75:
            value = rewrite(kind, value, rng)
        c = rng.choice(clean)[: WIDTH - 1 - len(value)]
        cut = rng.randint(0, len(c))
        left, right = c[:cut].rstrip(" "), c[cut:].lstrip(" ")
        left = left + " " if left else left
        end = rng.choice(("", "", ".", ",", "###", "!!"))
        text = left + value + end + (" " + right if right else "")
        out.append((text[:WIDTH], [(len(left), min(len(left) + len(value), WIDTH), kind)] if len(left) < WIDTH else []))
        c = rng.choice(clean)[: WIDTH // 2]
        out.append(((c + " " + decoy(rng) + " " + c)[:WIDTH], []))
    return out + long_examples(clean, rng)


def long_examples(clean: list[str], rng: random.Random) -> list[tuple[str, list[Span]]]:
    """Windows somewhere over spelled-out addresses of up to twice their width, some in capitals."""
    out = []
    for _ in range(600):
        words = ["".join(rng.choice("aeioulnrstdmkbcgph") for _ in range(rng.randint(2, 11))) for _ in range(rng.randint(3, 16))]
        at = rng.randint(1, min(4, len(words) - 2))
        value = rewrite("email", ".".join(words[:at]) + "@" + ".".join(words[at:]), rng)
        c, d = (rng.choice(clean)[:WIDTH] for _ in "ab")
        if rng.random() < 0.25:
            c, value, d = c.upper(), value.upper(), d.upper()
        text, start, end = f"{c} {value} {d}", len(c) + 1, len(c) + 1 + len(value)
        lo = rng.randint(max(0, start - WIDTH // 2), max(0, end - WIDTH // 2))
        out.append((text[lo : lo + WIDTH], [(max(start - lo, 0), min(end - lo, WIDTH, len(text) - lo), "email")]))
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Triggers, each with all that may belong to a spelled-out address around it, by start.

    A run of words and dots ends at every sign that stands for "at", so no run
    is walked by more than the two signs around it.  A spelled-out dot is part
    of the run: one that the last run holds has no larger run of its own.
    """
    out, back, reach = [], None, 0
    for m in TRIGGER.finditer(text):
        lo, hi = m.span()
        if lo < reach and m.group().lstrip("([{< ")[0] in "dD":
            continue
        if not text[lo].isdigit() and (after := _AFTER.match(text, hi)):
            back = text[::-1] if back is None else back
            if before := _BEFORE.match(back, len(text) - lo):
                lo, hi = len(text) - before.end(), after.end()
                reach = max(reach, hi)
        out.append((lo, hi))
    return sorted(out)


def windows_of(text: str) -> list[tuple[int, str]]:
    """Windows (start, text) that overlap by half and cover the surroundings of every trigger."""
    half, out, done = WIDTH // 2, [], -1
    for lo, hi in regions(text):
        # Window k starts at k * half; a trigger at t lies in windows t // half - 1 and t // half.
        for k in range(max(done + 1, lo // half - 1, 0), (hi - 1) // half + 1):
            out.append((k * half, text[k * half : k * half + WIDTH]))
            done = k
    return out


def joined(text: str, decoded: list[tuple[int, int, list[Span]]]) -> list[tuple[int, int, str, float]]:
    """Spans that no window holds whole, from fragments of a kind that meet in the overlap of neighbouring windows.

    At least one of two fragments must be cut by its window's edge there.
    """
    half, out = WIDTH // 2, []
    chains: list[list] = []  # [start, end, kind, score, whether cut at the end], all of the last window

    def close(chain: list) -> None:
        lo, hi, kind, score, _ = chain
        k = max(0, (lo - 1) // half)  # the last window that has the start inside
        if hi >= k * half + WIDTH and k * half + WIDTH < len(text):
            out.append((lo, hi, kind, score))

    last = -WIDTH
    for at, length, spans in decoded:
        if at != last + half:
            for c in chains:
                close(c)
            chains = []
        now = []
        for a, b, kind, score in spans:
            lo, hi, cut = at + a, at + b, b == length and at + length < len(text)
            # Of a window's spans only its last can reach the next one's edge, so few are looked through.
            for i, c in enumerate(chains):
                if c[2] == kind and c[0] < lo <= c[1] and hi >= c[1] and (c[4] or a == 0):
                    lo, score = c[0], score + c[3]
                    del chains[i]
                    break
            now.append([lo, hi, kind, score, cut])
        for c in chains:
            close(c)
        chains, last = now, at
    for c in chains:
        close(c)
    return out


def passes(kind: str, value: str) -> bool:
    """The tests that an added find must pass, whatever its spelling."""
    d = digits(value)
    if kind == "card":
        return 14 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 10 <= len(d) <= 15 and not re.search(r"[^0-9 ().+/-]", value) and bool(re.search(r"[^0-9]", value))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", value)
        return len(parts) == 4 and small_parts(".".join(parts)) and "." in value
    return bool(_SPELLED.fullmatch(value))


def word_before(text: str, at: int) -> int:
    """Length of the run of an address's characters that ends at a place."""
    lo = at
    while lo and text[lo - 1] in _LETTERS:
        lo -= 1
    return at - lo


def reconcile(text: str, base: list[Span], decoded: list[tuple[int, int, list[tuple[int, int, str, float]]]]) -> list[Span]:
    """Base spans and the best non-overlapping set of added ones, over all windows of a text.

    ``decoded``: (start, length, spans) of each window.
    """
    votes: dict[Span, float] = {}
    starts = [a for a, _, _ in base]  # base spans come by start
    ends = list(accumulate((b for _, b, _ in base), max))

    def meets_base(lo: int, hi: int) -> bool:
        i = bisect_left(starts, hi)  # of those that begin before the end, one ends after the start
        return i > 0 and ends[i - 1] > lo

    for at, length, spans in decoded:
        for a, b, kind, score in spans:
            cut = (a == 0 and at > 0) or (b == length and at + length < len(text))
            if cut or score <= 0:
                continue  # another window holds it whole, or its parts are joined
            while a < b and text[at + a] in " .,;:!?#$%&*":
                a += 1
            while b > a and text[at + b - 1] in " .,;:!?#$%&*":
                b -= 1
            lo, hi = at + a, at + b
            if kind == "email" and passes(kind, text[lo:hi]):  # an address begins and ends with whole words
                lo, hi = lo - word_before(text, lo), _WORDS.match(text, hi).end()
            if hi - lo < 4 or text[lo - 1 : lo].isalnum() and lo or text[hi : hi + 1].isalnum():
                continue
            if passes(kind, text[lo:hi]) and not meets_base(lo, hi):
                votes[lo, hi, kind] = votes.get((lo, hi, kind), 0.0) + score
    # Weighted interval scheduling over the candidates, by their ends.
    spans = sorted(votes, key=lambda s: (s[1], s[0], s[2]))
    shut, best = [s[1] for s in spans], [(0.0, ())]
    for i, s in enumerate(spans):
        before = best[bisect_right(shut, s[0], 0, i)]
        take = (before[0] + votes[s], (before[1], s))
        best.append(max(best[-1], take, key=lambda x: x[0]))
    chain, added = best[-1][1], []
    while chain:
        added.append(chain[1])
        chain = chain[0]
    return ordered(base + added)


def find(texts: list[str], model: dict[str, np.ndarray]) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    cuts = [windows_of(t) for t in texts]
    decoded = pii_tagger.decode(model, [w for ws in cuts for _, w in ws])
    out, at = [], 0
    for t, b, ws in zip(texts, base, cuts):
        got = [(lo, len(w), decoded[at + i]) for i, (lo, w) in enumerate(ws)]
        got.append((0, len(t), joined(t, got)))
        at += len(ws)
        out.append((b, reconcile(t, b, got)))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, np.ndarray]:
    """A tagger from at most SAMPLE documents, the ones with the smallest hash of their id."""
    ids = docs.select(F.col(id_col).alias("__id")).filter("__id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("__id"), "__id").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 512):
            got = {w for t in b.column(0).to_pylist() for _, w in windows_of(t or "")}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(got), pa.string())], names=["w"])

    picked = docs.select(id_col, text_col).join(F.broadcast(ids), F.col(id_col) == F.col("__id"))  # at most SAMPLE ids
    rows = picked.select(text_col).mapInArrow(run, "w string").distinct()
    rows = rows.orderBy(F.xxhash64("w"), "w").limit(SAMPLE_WINDOWS).collect()
    return pii_tagger.train(examples([r["w"] for r in rows]), WIDTH)


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])


def detect(docs: DataFrame, model: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, base (spans of the base rules) and spans (all), as arrays of (start, end, kind)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("id", to_arrow_type(kind)), ("base", pa.list_(SPAN)), ("spans", pa.list_(SPAN))])

    def rows(spans: list[Span]) -> list[dict]:
        return [{"start": a, "end": b, "kind": k} for a, b, k in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 512):
            got = find([t or "" for t in b.column(1).to_pylist()], shipped.value)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([rows(x) for x, _ in got], pa.list_(SPAN)), pa.array([rows(y) for _, y in got], pa.list_(SPAN))],
                schema=schema,
            )

    span = "array<struct<start: long, end: long, kind: string>>"
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind.simpleString()}, base {span}, spans {span}")


def redact(text: str, spans: list[Span]) -> str:
    """A text with every find replaced by its kind; finds that overlap become one, of the first one's kind."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """The input's rows and columns with the text redacted; NULL texts stay NULL."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 512):
            texts = b.column(at).to_pylist()
            got = find([t or "" for t in texts], shipped.value)
            new = [t and redact(t, s) for t, (_, s) in zip(texts, got)]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and digest, and all spans, of every document."""
    docs = read(spark, sf_dir, "documents")
    found = detect(docs, train(docs))

    def n(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(col: str):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", *[n(k) for k in KINDS], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )
