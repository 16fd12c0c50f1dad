"""Operator 6, suffix-array dedup: bytes of strings that occurred earlier.

A byte goes if it lies in a string of ``length`` bytes that also starts
earlier, in a row of a smaller id or earlier in the same text.

1. Each text gives its sparse suffix array (``suffix_index``).  Suffixes are
   dealt by gram, copies within a slice of the input having been set aside, and reach
   their task in the order of ids.
2. A task reads them batch by batch: a batch becomes a suffix array, is scanned
   against the levels of a logarithmic family and joins it; levels of equal
   size merge.  Segments seen before are copies as a whole.  Segments that
   share their gram with others are opened.
3. Opened segments fetch their bytes, meet again by gram, and each of their
   strings is looked up by its fingerprint: all but the first go.  A gram with
   very many opened segments deals its strings by their fingerprints instead.
4. Each text loses the union of these ranges.

Texts travel compressed.  Strings are compared by 64-bit fingerprints, within
one gram.  Defined cases: NULL texts are empty; texts shorter than ``length``
lose nothing; rows without an id have no place in the order, lose nothing and
cause no loss; rows that share an id share their places, so a repeated row
does not remove its twin; an empty table gives an empty result; very long
texts are indexed in pieces.  Ids must be whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import batches_of_bytes, lookup, read, sliced, whole_groups
from offerlake.llm.suffix_index import Family, anchors, fingerprint, found_in, mix, running
from offerlake.session import materialize, scratch_path

#: Bytes of texts whose suffixes a task makes, and searches for copies, at once; a longer text comes alone.
SLICE_BYTES = 4 << 20
#: Compressed bytes of texts that a task opens at once.
PACKED_BYTES = 1 << 20
#: Rows that a task hands on at once.
ROWS = 8_192
#: Suffixes of one batch of the index.
BATCH = 65_536
#: Text bytes whose suffixes one task indexes.
TASK_BYTES = 64 << 20
#: Opened segments of one gram from which their strings are dealt one by one.
HOT_SEGMENTS = 2_000
#: Bytes of opened segments that a task compares at once.
OPEN_BYTES = 1 << 20


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, z): texts as compressed UTF-8."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=3)
        for b in batches_of_bytes(batches, 1, SLICE_BYTES):
            z = [c.compress((t or "").encode()) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(z, pa.binary())], names=["doc", "z"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "doc long, z binary")


def unpacked(column: pa.Array) -> list[bytes]:
    d = zstandard.ZstdDecompressor()
    return [d.decompress(z) for z in column.to_pylist()]


def batch(names: list[str], *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=names)


def suffixes(docs: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """Sampled suffixes: gram, segment, doc, at (start << 7 | number of starts), copy.

    Rows marked ``copy`` follow an equal segment of their own batch; they need no
    look-up and carry a spread key instead of their gram.
    """
    names = ["gram", "segment", "doc", "at", "copy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of_bytes(batches, 1, SLICE_BYTES):
            rows = sorted(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), key=lambda r: r[0])
            parts = []
            for doc, t in rows:
                g, s, start, n = anchors(np.frombuffer((t or "").encode(), np.uint8), length)
                parts.append((g, s, np.full(len(g), doc, np.int64), (start << 7) | n))
            if not parts:
                continue
            g, s, doc, at = (np.concatenate(x) for x in zip(*parts))
            _, first, inv = np.unique(mix(g + mix(s)), return_index=True, return_inverse=True)
            head = first[inv]
            again = (g == g[head]) & (s == s[head]) & ((doc != doc[head]) | (at != at[head]))
            g = np.where(again, mix(mix(doc.view(np.uint64)) + at.view(np.uint64)), g)
            yield batch(names, g.view(np.int64), s.view(np.int64), doc, at, again)

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), text_col).filter("doc is not null")
    return rows.mapInArrow(run, "gram long, segment long, doc long, at long, copy boolean")


def scanned(rows: DataFrame, n_tasks: int, batch_rows: int) -> DataFrame:
    """Copies (open = false) and opened segments (open = true): gram, doc, at, open."""
    names = ["gram", "doc", "at", "open"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family()
        waiting: list[np.ndarray] = []

        def settle():
            g, s, doc, at = np.concatenate(waiting, axis=1)
            (cd, ca), (og, od, oa) = family.add(g.view(np.uint64), s.view(np.uint64), doc, at)
            yield batch(names, np.zeros(len(cd), np.int64), cd, ca, np.zeros(len(cd), bool))
            yield batch(names, og.view(np.int64), od, oa, np.ones(len(od), bool))

        for b in batches:
            m = np.stack([b.column(i).to_numpy() for i in range(4)])
            copy = b.column(4).to_numpy(zero_copy_only=False)
            if copy.any():
                c = m[:, copy]
                yield batch(names, np.zeros(c.shape[1], np.int64), c[2], c[3], np.zeros(c.shape[1], bool))
                m = m[:, ~copy]
            waiting.append(m)
            if sum(w.shape[1] for w in waiting) >= batch_rows:
                yield from settle()
                waiting = []
        if waiting:
            yield from settle()

    dealt = rows.repartition(n_tasks, "gram").sortWithinPartitions("doc", "at")
    return dealt.mapInArrow(run, "gram long, doc long, at long, open boolean")


def marked(opened: DataFrame) -> DataFrame:
    """Opened segments with ``hot``: whether their gram has more than HOT_SEGMENTS of them."""
    hot = opened.groupBy("gram").count().filter(F.col("count") > HOT_SEGMENTS).select("gram", F.lit(True).alias("hot"))
    return lookup(opened, materialize(hot), ["gram"])


def opened_bytes(opened: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """What opened segments hold: gram, doc, start, bytes, string.

    A segment of a hot gram gives a row for each of its strings, with the
    string's fingerprint and no bytes; others give one row with their bytes.
    """
    columns = ("gram", "at", "hot")
    lists = opened.groupBy("doc").agg(*[F.collect_list(F.coalesce(c, F.lit(False)) if c == "hot" else c).alias(c) for c in columns])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
    names = ["gram", "doc", "start", "bytes", "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[tuple] = []
        dealt: list[list[np.ndarray]] = []  # strings of hot grams

        def told() -> Iterator[pa.RecordBatch]:
            if whole:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*whole), kinds)], names=names)
            if dealt:
                gram, doc, start, h = (pa.array(np.concatenate(x)) for x in zip(*dealt))
                yield pa.RecordBatch.from_arrays([gram, doc, start, pa.nulls(len(gram), pa.binary()), h], names=names)
            whole.clear()
            dealt.clear()

        n = 0
        for b in batches_of_bytes(batches, 1, PACKED_BYTES):
            for i in range(b.num_rows):
                doc, text = b.column(0)[i].as_py(), unpacked(b.column(1).slice(i, 1))[0]
                for gram, at, hot in zip(*(b.column(c)[i].as_py() for c in (2, 3, 4))):
                    lo, count = at >> 7, at & 127
                    piece = text[lo : lo + count - 1 + length]
                    if len(piece) < length:  # another row of the same id holds the segment
                        continue
                    if hot:
                        h = strings(np.array([gram]), [piece], length)[0].view(np.int64)
                        dealt.append([np.full(len(h), gram), np.full(len(h), doc), lo + np.arange(len(h)), h])
                    else:
                        whole.append((gram, doc, lo, piece, None))
                    n += count if hot else 1
                    if n >= ROWS:
                        yield from told()
                        n = 0
        yield from told()

    return texts.join(lists, "doc").select("doc", "z", *columns).mapInArrow(
        run, "gram long, doc long, start long, bytes binary, string long"
    )


def strings(gram: np.ndarray, parts: list[bytes], length: int):
    """Fingerprints of the strings of segments, with the segment and the place in it of each."""
    sizes = np.array([len(p) for p in parts])
    n = sizes - length + 1
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(sizes) - sizes, n) + inside
    row = np.repeat(np.arange(len(parts)), n)
    sums = running(np.frombuffer(b"".join(parts), np.uint8))
    return mix(fingerprint(sums, at, at + length) + mix(gram[row].view(np.uint64))), row, inside


def later_strings(rows: DataFrame, length: int) -> DataFrame:
    """Ranges (doc, lo, hi) of the hot grams' strings (string, doc, start) that occurred before.

    The first place is a minimum that is combined before the shuffle; the join
    to it is one that adaptive execution splits at a string of very many places.
    """
    place = F.struct("doc", "start")
    first = rows.groupBy("string").agg(F.min(place).alias("first"))
    later = rows.join(first, "string").filter(place != F.col("first"))
    return later.select("doc", F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))


class Seen:
    """First places of one gram's strings, for the batches that follow."""

    def __init__(self):
        none = np.empty(0, np.int64)
        self.gram, self.h, self.doc, self.start = None, none.astype(np.uint64), none, none

    def repeated(self, gram: np.ndarray, doc: np.ndarray, start: np.ndarray, parts: list[bytes], length: int):
        """Ranges (doc, lo, hi) of the strings that an earlier one equals.

        Segments come by gram, then in the order of texts; what is kept between
        calls is the distinct strings of the last gram.
        """
        h, row, inside = strings(gram, parts, length)
        d, s = doc[row], start[row] + inside
        values, first, inv = np.unique(h, return_index=True, return_inverse=True)
        first_d, first_s = d[first], s[first]
        if len(self.h):
            old = np.minimum(np.searchsorted(self.h, values), len(self.h) - 1)
            hit = self.h[old] == values
            first_d, first_s = np.where(hit, self.doc[old], first_d), np.where(hit, self.start[old], first_s)
        # A string at the very place of the first one is that of a repeated row.
        later = (d != first_d[inv]) | (s != first_s[inv])
        last = gram[-1]
        here = gram[row[first]] == last
        keep = [values[here], first_d[here], first_s[here]]
        if self.gram == last:
            new = ~found_in(keep[0], self.h)
            keep = [np.concatenate([x, y[new]]) for x, y in zip((self.h, self.doc, self.start), keep)]
        order = np.argsort(keep[0], kind="stable")
        self.gram, self.h, self.doc, self.start = last, *(x[order] for x in keep)
        return d[later], s[later], s[later] + length


def merged(d: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Ranges with those of a text that touch made one."""
    order = np.lexsort((hi, lo, d))
    d, lo, hi = d[order], lo[order], hi[order]
    if not len(d):
        return d, lo, hi
    # Ends grow within a text once they are made a running maximum.
    group = np.cumsum(np.r_[0, d[1:] != d[:-1]])
    reach = np.maximum.accumulate(hi + group * (1 << 40)) - group * (1 << 40)
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (lo[1:] > reach[:-1])])
    last = np.r_[first[1:], len(d)] - 1
    return d[first], lo[first], reach[last]


def compared(opened: DataFrame, length: int) -> DataFrame:
    """Ranges (doc, lo, hi) of opened strings that occurred before."""
    names = ["doc", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows, size = Seen(), [], 0

        def settle():
            g, d, s, p = zip(*rows)
            out = seen.repeated(np.array(g, np.int64), np.array(d, np.int64), np.array(s, np.int64), list(p), length)
            return batch(names, *merged(*out))

        for b in sliced(batches, 1_000):
            for r in zip(*(c.to_pylist() for c in b.columns)):
                rows.append(r)
                size += len(r[3])
                if size >= OPEN_BYTES:
                    yield settle()
                    rows, size = [], 0
        if rows:
            yield settle()

    dealt = opened.repartition("gram").sortWithinPartitions("gram", "doc", "start")
    return dealt.mapInArrow(run, "doc long, lo long, hi long")


def removals(
    docs: DataFrame,
    length: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    task_bytes: int = TASK_BYTES,
    batch_rows: int = BATCH,
) -> DataFrame:
    """Per id the byte ranges to remove, apart and in order: doc, lo and hi (arrays)."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // task_bytes))
    path = scratch_path(spark, "suffix-scan")
    # The tasks' results are a part of the input; as many files as its size asks for hold them.
    files = max(spark.sparkContext.defaultParallelism, -(-total // task_bytes))
    scanned(suffixes(docs, length, id_col, text_col), tasks, batch_rows).coalesce(files).write.parquet(path)
    found = spark.read.parquet(path)
    texts = packed(docs.filter(F.col(id_col).isNotNull()), id_col, text_col)
    held = scratch_path(spark, "suffix-open")
    opened_bytes(marked(found.filter("open")), texts, length).coalesce(files).write.parquet(held)
    held = spark.read.parquet(held)
    cold = compared(held.filter("string is null").select("gram", "doc", "start", "bytes"), length)
    hot = later_strings(held.filter("string is not null").select("string", "doc", "start"), length)
    lo = F.shiftright("at", 7)
    whole = found.filter("not open").select("doc", lo.alias("lo"), (lo + F.col("at").bitwiseAND(127) - 1 + length).alias("hi"))
    return per_text(whole.unionAll(cold).unionAll(hot))


def per_text(ranges: DataFrame) -> DataFrame:
    """All ranges (doc, lo, hi) of each text made one row, touching ones merged."""
    names = ["doc", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, names):
            d, lo, hi = merged(*(t.column(c).to_numpy() for c in names))
            cuts = np.flatnonzero(np.r_[True, d[1:] != d[:-1], True]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (lo, hi)]
            yield pa.RecordBatch.from_arrays([pa.array(d[cuts[:-1]]), *lists], names=names)

    dealt = ranges.repartition("doc").sortWithinPartitions("doc")
    return dealt.mapInArrow(run, "doc long, lo array<long>, hi array<long>")


def cut(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, int]:
    """A text without the ranges, and the number of maximal removed runs."""
    hi = np.minimum(hi, len(text))
    _, lo, hi = merged(np.zeros(len(lo), np.int64), lo, hi)
    kept = b"".join([text[a:b] for a, b in zip(np.r_[0, hi], np.r_[lo, len(text)])])
    return kept, len(lo)


def dedup(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans and ``kept``, the remaining bytes."""
    ranges = removals(docs, length, id_col, text_col, **sizes)
    joined = packed(docs, id_col, text_col).join(ranges, "doc", "left").select("doc", "z", "lo", "hi")
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of_bytes(batches, 1, PACKED_BYTES):
            rows = []
            for t, lo, hi in zip(unpacked(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist()):
                kept, n = cut(t, np.array(lo, np.int64), np.array(hi, np.int64)) if lo else (t, 0)
                rows.append((len(t), len(t) - len(kept), n, kept))
            cols = list(zip(*rows)) or [[]] * 4
            kinds = [pa.int64()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    out = joined.mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("doc", id_col)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to strings of 100 bytes that occurred before, and the digest of the rest."""
    out = dedup(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
