"""Operator 11, benchmark decontamination by suffix arrays of the training texts.

1. Documents are taken in shards of a bounded number of bytes; each shard gets
   the suffix array of its words by prefix doubling.  A shard's documents end in
   separators of their own, so no suffix runs into the next document.
2. Every suffix of every benchmark item is looked up in every shard by binary
   search.  Its neighbours there give the longest verbatim match; where that
   reaches a whole window, two more searches give the range of all places.
3. A document's places make its hit words and items; words of a hit are
   compared byte by byte, so equal fingerprints of different words do no harm.
   Affected documents are removed (``decontaminated``).

Documents are whole within a task (long ones are cut into pieces that overlap
by a window), so their rows need no shuffle.  The items go to the tasks in
blocks of at most BLOCK_BYTES, however many there are; a task holds one block
at a time.

Defined cases: NULL, empty and wordless texts have no words, no hits and no
items, and such items have no windows; an item of fewer words than a window is
one window; rows are judged one by one, so repeated rows, repeated ids and rows
without an id each get their verdict; an item id that occurs with several texts
counts once; an item without an id marks words but is neither counted nor
listed; without items nothing is hit; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from offerlake.llm.common import batches_of_bytes, read
from offerlake.llm.suffix_index import fingerprint, found_in, running

#: Words of a window.
WINDOW = 10
#: Text bytes of a shard, for which one suffix array is made.
SHARD_BYTES = 2 << 20
#: Benchmark bytes that a task holds at once.
BLOCK_BYTES = 8 << 20
#: Pairs of a document and an item that are expanded at once.
PAIRS = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


class Words(NamedTuple):
    """Words of some texts: lower-cased bytes, start and end of each word, number of words per text, fingerprints."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    count: np.ndarray
    print: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """The words of texts; NULL has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, values = texts.buffers()
    cut = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = _LOWER[np.frombuffer(values, np.uint8)[cut[0] : cut[-1]]] if values else np.empty(0, np.uint8)
    cut = cut - cut[0]
    inside = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[cut] = True
    before, after = np.r_[False, inside[:-1]], np.r_[inside[1:], False]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    count = np.diff(np.searchsorted(start, cut))
    return Words(data, start, end, count, fingerprint(running(data), start, end))


def suffix_array(x: np.ndarray) -> np.ndarray:
    """Places of all suffixes of ``x`` in order.

    The last value of every text must occur once in ``x``.  Prefix doubling;
    each round sorts only the suffixes that are still tied.
    """
    n = len(x)
    order = np.argsort(x, kind="stable")
    value = x[order]
    first = np.r_[True, value[1:] != value[:-1]][:n]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    tied = np.flatnonzero(~(first & np.r_[first[1:], True]))
    step = 1
    while len(tied):
        at = order[tied]
        key = rank[at] * n + rank[at + step]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        first = np.r_[True, key[1:] != key[:-1]]
        order[tied] = at
        rank[at] = np.maximum.accumulate(np.where(first, tied, 0))
        tied = tied[~(first & np.r_[first[1:], True])]
        step *= 2
    return order


class Block(NamedTuple):
    """Benchmark items: the word fingerprints of all of them, one after the other, and the words' bytes.

    Suffix i starts at word i and ends before ``end[i]``; it has a window of
    ``width[i]`` words, or none (0) where fewer are left.  ``item`` is an index of ``ids``.
    """

    print: np.ndarray
    end: np.ndarray
    width: np.ndarray
    item: np.ndarray
    ids: list
    known: np.ndarray
    spelt: list


def block(ids: list, texts: pa.Array, window: int) -> Block:
    """The items as a block; raises where two different words share a fingerprint."""
    w = words_of(texts)
    total = int(w.count.sum())
    item = np.repeat(np.arange(len(ids)), w.count)
    end = np.repeat(np.cumsum(w.count), w.count)
    width = np.minimum(np.repeat(w.count, w.count), window)
    width[np.arange(total) + width > end] = 0
    known, first, group = np.unique(w.print, return_index=True, return_inverse=True)
    raw = w.data.tobytes()
    spelt = [raw[a:b] for a, b in zip(w.start[first].tolist(), w.end[first].tolist())]
    if any(raw[a:b] != spelt[g] for a, b, g in zip(w.start.tolist(), w.end.tolist(), group.tolist())):
        raise ValueError("two different words of the items share a 64-bit fingerprint")
    return Block(w.print, end, width, item, list(ids), known, spelt)


class Shard:
    """The suffix array of some texts' words.

    Words are numbered by the order of their fingerprints, doubled and odd, so
    that a word that a shard lacks has an even place between two of its numbers.
    """

    def __init__(self, words: Words):
        n_texts = len(words.count)
        self.words = words
        self.vocabulary, number = np.unique(words.print, return_inverse=True)
        stop = np.cumsum(words.count + 1) - 1  # where each text's separator stands
        self.place = np.delete(np.arange(len(number) + n_texts), stop)
        self.text = np.repeat(np.arange(n_texts), words.count + 1)
        x = np.empty(len(number) + n_texts, np.int64)
        x[self.place], x[stop] = number + n_texts, np.arange(n_texts)
        self.array = suffix_array(x)[n_texts:]
        self.value = 2 * (x - n_texts) + 1
        self.value[stop] = -1
        self.word_at = np.full(len(x), -1)
        self.word_at[self.place] = np.arange(len(number))

    def values(self, prints: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, prints)
        return 2 * at + found_in(prints, self.vocabulary)

    def common(self, query: np.ndarray, q: np.ndarray, limit: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Words that the query suffixes ``q`` share with the suffixes at ``at``, at most ``limit``; ``n`` are known to agree."""
        n = n.copy()
        go = np.flatnonzero(n < limit)
        while len(go):
            go = go[self.value[at[go] + n[go]] == query[q[go] + n[go]]]
            n[go] += 1
            go = go[n[go] < limit[go]]
        return n

    def bound(self, query: np.ndarray, q: np.ndarray, limit: np.ndarray, right: bool) -> np.ndarray:
        """Binary search: suffixes before (and, if ``right``, equal to) the first ``limit`` words of each query suffix."""
        lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(self.array))
        low, high = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)  # words shared with what lies at either end
        go = np.flatnonzero(lo < hi)
        while len(go):
            mid = (lo[go] + hi[go]) // 2
            at = self.array[mid]
            n = self.common(query, q[go], limit[go], at, np.minimum(low[go], high[go]))
            whole = n >= limit[go]
            last = np.minimum(q[go] + n, len(query) - 1)
            less = np.where(whole, right, self.value[at + n] < query[last])
            up, down = go[less], go[~less]
            lo[up], low[up] = mid[less] + 1, n[less]
            hi[down], high[down] = mid[~less], n[~less]
            go = go[lo[go] < hi[go]]
        return lo

    def longest(self, b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each suffix of a block: the words of its longest match here, and where in the array its place and bound are."""
        query = self.values(b.print)
        q = np.flatnonzero(query & 1)
        length, where = np.zeros(len(query), np.int64), np.zeros(len(query), np.int64)
        if len(q) and len(self.array):
            limit = b.end[q] - q
            at = self.bound(query, q, limit, False)
            for near in (at - 1, at):
                ok = np.flatnonzero((near >= 0) & (near < len(self.array)))
                n = self.common(query, q[ok], limit[ok], self.array[near[ok]], np.zeros(len(ok), np.int64))
                more = n > length[q[ok]]
                length[q[ok][more]], where[q[ok][more]] = n[more], near[ok][more]
        return query, length, where

    def windows(self, b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows of a block that occur here: suffix, and the range of the array that starts with its window."""
        query, length, _ = self.longest(b)
        q = np.flatnonzero((b.width > 0) & (length >= b.width))
        return q, self.bound(query, q, b.width[q], False), self.bound(query, q, b.width[q], True)

    def best(self, b: Block, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes of a block whose longest match here has at least ``least`` words: suffix, words, the first place of it."""
        query, length, _ = self.longest(b)
        q = np.flatnonzero(length >= max(least, 1))
        lo, hi = (self.bound(query, q, length[q], right) for right in (False, True))
        place = np.array([self.array[a:e].min() for a, e in zip(lo, hi)], np.int64)
        return q, length[q], place

    def same_words(self, b: Block, at: np.ndarray) -> np.ndarray:
        """Whether the words at the given places have the bytes of the block's word with their fingerprint."""
        w = self.word_at[at]
        known = np.searchsorted(b.known, self.words.print[w]).tolist()
        spans = zip(self.words.start[w].tolist(), self.words.end[w].tolist(), known)
        data = self.words.data
        return np.array([data[a:e].tobytes() == b.spelt[k] for a, e, k in spans], bool)

    def hits(self, b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hit words as a mask over places, and the pairs (text, item) of which a window occurs."""
        hit = np.zeros(len(self.value) + 1, np.int64)
        none = np.empty(0, np.int64)
        q, lo, hi = self.windows(b)
        if not len(q):
            return hit[:-1] > 0, none, none
        # Different windows of one width have ranges apart, so these sums are a few times the shard at most.
        n, top = len(self.array) + 1, int(b.width.max()) + 1
        _, head, group = np.unique((lo * n + hi) * top + b.width[q], return_index=True, return_inverse=True)
        first, size = lo[head], (hi - lo)[head]
        of = np.repeat(np.arange(len(size)), size)
        at = self.array[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + first[of]]
        wide = b.width[q][head][of]
        np.add.at(hit, at, 1)
        np.add.at(hit, at + wide, -1)
        touched = np.flatnonzero(np.cumsum(hit[:-1]))
        wrong = np.zeros(len(hit), np.int64)
        wrong[touched + 1] = ~self.same_words(b, touched)
        if wrong.any():  # another word of the same fingerprint
            wrong = np.cumsum(wrong)
            ok = wrong[at + wide] == wrong[at]
            at, wide, of = at[ok], wide[ok], of[ok]
            hit[:] = 0
            np.add.at(hit, at, 1)
            np.add.at(hit, at + wide, -1)
        text, of = np.divmod(np.unique(self.text[at] * len(size) + of), len(size))
        # Items of each window, and with them the pairs of texts and items, some at a time.
        n_items = len(b.ids)
        window, item = np.divmod(np.unique(group * n_items + b.item[q]), n_items)
        edge = np.searchsorted(window, np.arange(len(size) + 1))
        many = np.diff(edge)[of]
        pairs = none
        for a, e in _spans(np.cumsum(many), PAIRS):
            k = many[a:e]
            place = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(edge[of[a:e]], k)
            pairs = np.unique(np.concatenate([pairs, np.repeat(text[a:e], k) * n_items + item[place]]))
        return np.cumsum(hit[:-1]) > 0, *np.divmod(pairs, n_items)


def _spans(ends: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes, given by their running sums, add up to about ``size``."""
    a = 0
    while a < len(ends):
        e = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
        yield a, e
        a = e


def pieces(words: Words, size: int, window: int) -> Iterator[tuple[Words, int]]:
    """A text's words in parts of at most ``size``, each overlapping the last by a window less a word; and where they start."""
    n = len(words.start)
    for lo in range(0, max(n - window + 1, 1), size):
        part = slice(lo, min(n, lo + size + window - 1))
        yield Words(words.data, words.start[part], words.end[part], np.array([part.stop - lo]), words.print[part]), lo


def blocks(items: DataFrame, window: int, id_col: str, text_col: str, block_bytes: int) -> list[Broadcast]:
    """The items in broadcast blocks of about ``block_bytes`` of text; the driver holds one at a time."""
    rows = items.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).filter("text is not null").distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes)
    out = []
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i) if n > 1 else rows
        t = part.toArrow().combine_chunks()
        texts = pa.chunked_array(t.column("text")).combine_chunks() if t.num_rows else pa.array([], pa.string())
        out.append(items.sparkSession.sparkContext.broadcast(block(t.column("id").to_pylist(), texts, window)))
    return out


def leaks(texts: pa.Array, held: list[Broadcast], window: int) -> list[dict]:
    """n_words, n_hit and items of each text of a shard."""
    words = words_of(texts)
    n = len(words.count)
    mask, items = np.zeros(len(words.start), bool), [set() for _ in range(n)]
    size = SHARD_BYTES // 4
    for part, lo in [(words, 0)] if n > 1 else pieces(words, size, window):
        if not len(part.start):
            continue
        shard = Shard(part)
        for broadcast in held:
            b = broadcast.value
            marks, text, item = shard.hits(b)
            mask[lo : lo + len(part.start)] |= marks[shard.place]
            for t, i in zip(text.tolist(), item.tolist()):
                if b.ids[i] is not None:
                    items[t].add(b.ids[i])
            if len(held) > 1:
                vars(broadcast).pop("_value", None)  # a worker keeps one block, and loads it again for the next shard
    hit = np.diff(np.r_[0, np.cumsum(mask)][np.r_[0, np.cumsum(words.count)]])
    return [{"n_words": w, "n_hit": h, "items": sorted(i)} for w, h, i in zip(words.count.tolist(), hit.tolist(), items)]


#: The column that ``judge`` adds.
LEAK = "__leak"
_KIND = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))])
_TYPE = StructType(
    [StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("items", ArrayType(StringType()))]
)


def judge(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``__leak``: n_words, n_hit and the sorted ids of the items with an occurring window."""
    held = blocks(items, window, item_id, item_text, block_bytes)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of_bytes(batches, at, SHARD_BYTES):
            found = pa.array(leaks(b.column(at), held, window), _KIND)
            yield pa.RecordBatch.from_arrays([*b.columns, found], names=[*b.schema.names, LEAK])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(LEAK, _TYPE)]))


def decontaminated(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """``docs`` without the documents that hold a window of an item."""
    return judge(docs, items, **params).filter(F.col(f"{LEAK}.n_hit") == 0).select(*docs.columns)


def longest_matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least: int = 2,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The longest verbatim match of every item suffix: item_id, start (word), length (words), doc_id, place (word).

    Of equal lengths the one of the smallest document id and place; suffixes whose longest match
    is under ``least`` words give no row.  A text of over SHARD_BYTES / 4 words is cut into parts that overlap
    by the longest item, so that no match is cut.
    """
    held = blocks(items, WINDOW, item_id, item_text, block_bytes)
    names = ["item", "start", "length", "doc", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches_of_bytes(batches, 1, SHARD_BYTES):
            words, doc = words_of(b.column(1)), b.column(0).to_pylist()
            begin = np.r_[0, np.cumsum(words.count)]
            for broadcast in held:
                blk = broadcast.value
                reach = int((blk.end - np.arange(len(blk.end))).max(initial=1))
                for part, lo in [(words, 0)] if len(doc) > 1 else pieces(words, SHARD_BYTES // 4, reach):
                    shard = Shard(part)
                    rows = shard.best(blk, least)
                    first = begin[shard.text[rows[2]]] if len(doc) > 1 else -lo
                    kept = [
                        (blk.ids[blk.item[q]], int(q - np.searchsorted(blk.end, blk.end[q])), n, doc[t], w)
                        for q, n, t, w in zip(rows[0].tolist(), rows[1].tolist(), shard.text[rows[2]].tolist(), (shard.word_at[rows[2]] - first).tolist())
                    ]
                    cols = list(zip(*kept)) or [[]] * 5
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
                if len(held) > 1:
                    vars(broadcast).pop("_value", None)

    found = docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "item string, start long, length long, doc long, place long")
    best = found.groupBy("item", "start").agg(F.min(F.struct((-F.col("length")).alias("less"), "doc", "place")).alias("m"))
    return best.select(
        F.col("item").alias(item_id), "start", (-F.col("m.less")).alias("length"), F.col("m.doc").alias(id_col), "m.place"
    )


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item, and the items concerned."""
    judged = judge(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    hit = F.col(f"{LEAK}.n_hit")
    return judged.select(
        "doc_id",
        f"{LEAK}.n_words",
        hit,
        F.size(f"{LEAK}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{LEAK}.items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


#: Windows of each length that occurs, joined to the documents' word runs of the same length.
OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS k, list_slice(w, i, i + least(len(w), 10) - 1) AS g
        FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
firsts AS (SELECT DISTINCT k, g[1] AS f FROM win),
pos AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
occ AS (SELECT DISTINCT p.r, p.i, k.k, list_slice(p.w, p.i, p.i + k.k - 1) AS g
        FROM pos p JOIN firsts k ON k.f = p.w[p.i] WHERE p.i + k.k - 1 <= len(p.w)),
m AS (SELECT o.r, o.i, o.k, win.item FROM occ o JOIN win ON win.k = o.k AND win.g = o.g),
hit AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, i, k FROM m)) GROUP BY r),
it AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM m GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, sha256(coalesce(it.s, '')) AS items_sha256,
       coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""
