"""Substring deduplication over difference-cover anchors.

A window of `window` words that occurs twice also has its inner runs of words twice. With a
difference cover D of period v, any two places i and j have a shift k < v with i + k and j + k both
in D modulo v, so it is enough to hash the runs (of window - v + 1 words) that start at cover
places: two equal windows share an aligned anchor. Anchors with a hash of their own are dropped;
around each of the others the match is extended to all windows that hold the anchor, whose whole
words are hashed with 96 bits; of equal windows only the first one, by document and place, is kept.

Skew: within a portion of a task, all but the first of equal anchors (or windows) are settled on
the spot and travel under a key of their own; only the first one meets those of other portions. So
a passage that a third of all documents share makes a group no larger than the number of portions.

A document is a pair of id and text: rows that repeat both count as one and get the same result;
rows with one id and different texts are ordered by a hash of the text (one with an equal hash would
count as equal). Null ids come first (as the
least long, which no id may be). Null texts have no words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.llm.common import as_bytes, cut, portions

#: Perfect difference covers by period: each difference modulo the period is one of two members.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
NO_ID = -(1 << 63)


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The period with the thinnest cover that leaves anchors of at least 4 words (1 in short windows)."""
    fit = [v for v in COVERS if window - v + 1 >= min(4, window - 2)]
    if not fit:
        raise ValueError("windows need at least 3 words")
    return max(fit), COVERS[max(fit)]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """128 bits of each word, as two columns of 64."""
    from xxhash import xxh3_128_digest as digest

    return np.frombuffer(b"".join(map(digest, words)), "<u8").reshape(-1, 2)


def run_hashes(hashes: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """Polynomial hash of each run of `length` words, by doubling."""
    out, have, power, at = None, 0, factor, hashes.copy()
    size, n = 1, length
    while n:
        if n & 1:
            if out is None:
                out, have = at, size
            else:
                m = max(0, len(hashes) - have - size + 1)
                scale = np.uint64(pow(int(factor), size, 1 << 64))
                out = out[:m] * scale + at[have : have + m]
                have += size
        n >>= 1
        if n:
            m = max(0, len(at) - size)
            at = at[:m] * power + at[size : size + m]
            power = np.uint64(int(power) * int(power) % (1 << 64))
            size *= 2
    return out


class _Portion:
    """Words of several documents in a row: hashes of all, with the place of each in its document."""

    def __init__(self, texts: list[bytes]):
        words = [text.split() for text in texts]
        self.count = np.array([len(w) for w in words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        self.hashes = word_hashes([x for w in words for x in w])
        self.doc = np.repeat(np.arange(len(texts)), self.count)
        self.place = np.arange(len(self.doc)) - self.first[self.doc]
        self.left = self.count[self.doc] - self.place


def firsts(keys: tuple[np.ndarray, ...], order: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have the least order among those with equal keys (several, if that is equal too), and whether others have more."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, bool), np.zeros(0, bool)
    at = np.lexsort((*order[::-1], *keys[::-1]))
    new = np.concatenate([[True], np.any([k[at][1:] != k[at][:-1] for k in keys], axis=0)])
    starts = np.flatnonzero(new)
    head = np.empty(n, np.int64)
    head[at] = np.repeat(at[starts], np.diff(np.append(starts, n)))
    first = np.all([x[head] == x for x in order], axis=0)
    shared = np.zeros(n, bool)
    shared[head[~first]] = True
    return first, shared[head]


def _anchors(batches: Iterator[pa.RecordBatch], window: int, rows: int) -> Iterator[pa.RecordBatch]:
    """key, spot and row of all anchors; the spot's last two bits: 1 if the portion has no equal one, 2 for the first of equal ones, 3 for the others."""
    period, cover = cover_for(window)
    length, member = window - period + 1, np.zeros(period, bool)
    member[list(cover)] = True
    for batch in portions(batches, rows, most_bytes=4 << 20):
        p = _Portion(as_bytes(batch.column("text")))
        own = batch.column("row").to_numpy()
        runs = run_hashes(p.hashes[:, 0], length, FACTORS[0])
        at = np.flatnonzero(member[p.place[: len(runs)] % period] & (p.left[: len(runs)] >= length) & (p.count[p.doc[: len(runs)]] >= window))
        key, doc, place = runs[at].view(np.int64), p.doc[at], p.place[at]
        first, shared = firsts((key,), (doc, place))
        columns = (np.where(first, key, own[doc]), place << 2 | np.where(first, np.where(shared, 2, 1), 3), own[doc])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "spot", "row"])


def _windows(batches: Iterator[pa.RecordBatch], window: int, rows: int) -> Iterator[pa.RecordBatch]:
    period, _ = cover_for(window)
    length = window - period + 1
    for batch in portions(batches, rows, most_bytes=4 << 20):
        p = _Portion(as_bytes(batch.column("text")))
        ids, own = batch.column("id").to_numpy(), batch.column("row").to_numpy()
        marks = batch.column("places")
        ends = np.asarray(marks.offsets)
        flat = marks.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
        doc_of = np.repeat(np.arange(batch.num_rows), np.diff(ends))
        inside = flat < p.count[doc_of]  # rows with an equal key would share their places
        flat, doc_of = flat[inside], doc_of[inside]
        # A window is a candidate if any marked anchor starts within its first window - length + 1 words.
        step = np.zeros(len(p.doc) + 1, np.int64)
        at = p.first[doc_of] + flat
        low = np.maximum(p.first[doc_of], at - (window - length))
        np.add.at(step, low, 1)
        np.add.at(step, at + 1, -1)
        a, b = (run_hashes(p.hashes[:, k], window, FACTORS[k]) for k in (0, 1))
        at = np.flatnonzero((np.cumsum(step)[: len(a)] > 0) & (p.left[: len(a)] >= window))
        doc, place = p.doc[at], p.place[at]
        a, b = a[at].view(np.int64), (b[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
        first, _ = firsts((a, b), (ids[doc], place))
        # Later ones are settled; they have no need of a key or an order.
        row, id_ = own[doc], ids[doc]
        columns = (np.where(first, a, row), np.where(first, b, 0), id_, place.astype(np.int32), row, ~first)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["key", "more", "id", "place", "row", "later"])


def _kept(batches: Iterator[pa.RecordBatch], window: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, rows, most_bytes=4 << 20):
        n_words, n_removed, shas, texts = [], [], [], []
        for text, spots in zip(as_bytes(batch.column("text")), batch.column("spots"), strict=True):
            words = text.split()
            starts = spots.values.to_numpy(zero_copy_only=False) if spots.is_valid else np.zeros(0, np.int32)
            starts = starts[starts + window <= len(words)]
            if len(starts):
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, starts, 1)
                np.add.at(step, starts + window, -1)
                gone = np.cumsum(step)[: len(words)] > 0
                kept = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x)
                n_removed.append(int(gone.sum()))
            else:
                kept = b" ".join(words)
                n_removed.append(0)
            n_words.append(len(words))
            shas.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept)
        out = {"doc_id": batch.column("doc_id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string())}
        if "keep" in batch.schema.names:
            out["kept"] = pa.array(texts, pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_pydict(out)


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id, text, id (a long in the order of the ids) and row (a key of the id and the text)."""
    kind = docs.schema["doc_id"].dataType
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    row = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text").alias("row")
    if isinstance(kind, T.IntegralType):  # the id is made where it is used, so that both uses move the same columns
        return texts.select("doc_id", "text", row).withColumn("id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    known = texts.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    ranks = cut(known.repartitionByRange("doc_id").sortWithinPartitions("doc_id").withColumn("id", F.monotonically_increasing_id()))
    return texts.select("doc_id", "text", row).join(ranks, "doc_id", "left").withColumn("id", F.coalesce("id", F.lit(NO_ID)))


def drop_repeats(docs: DataFrame, window: int = 20, rows: int = 4000, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by a space) of each row.

    A word goes if a window over it also starts earlier: in a document with a smaller id, or earlier
    in the same one. Windows are judged on the input. `keep_text` adds the kept words as `kept`.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = ordered(docs)
    marked = cut(_marked(texts, window, rows))
    # Both joins read the texts from one exchange on the row's key.
    plain = isinstance(docs.schema["doc_id"].dataType, T.IntegralType)
    moved = texts.drop("id") if plain else texts
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id") if plain else F.col("id")
    candidates = moved.join(marked.hint("shuffle_hash"), "row").select(order, "row", "text", "places")
    windows = candidates.mapInArrow(lambda b: _windows(b, window, rows), "key long, more int, id long, place int, row long, later boolean")
    # Of windows that meet others, those after the first one go; those at the same id and place are all first.
    ranked = windows.withColumn("rank", F.rank().over(Window.partitionBy("key", "more", "later").orderBy("id", "place")))
    gone = ranked.where(F.col("later") | (F.col("rank") > 1)).groupBy("row").agg(F.collect_set("place").alias("spots"))
    final = moved.join(gone.hint("shuffle_hash"), "row", "left").select("doc_id", "text", "spots", *([F.lit(True).alias("keep")] if keep_text else []))
    return final.mapInArrow(lambda b: _kept(b, window, rows), f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)


def _marked(texts: DataFrame, window: int, rows: int) -> DataFrame:
    """By row, the places of the anchors that occur elsewhere too."""
    anchors = texts.select("row", "text").mapInArrow(lambda b: _anchors(b, window, rows), "key long, spot long, row long")
    kind = F.col("spot").bitwiseAND(3)
    others = F.sum(F.when(kind < 3, 1).otherwise(0)).over(Window.partitionBy("key"))
    meeting = anchors.withColumn("n", others).where((kind > 1) | (F.col("n") > 1))
    return meeting.groupBy("row").agg(F.collect_set(F.shiftright("spot", 2).cast("int")).alias("places"))


#: The same rows in DuckDB, by all windows of 20 words.
ORACLE = r"""
with d as (
  select doc_id, row_number() over () as rid, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
win as (
  select rid, doc_id, a, array_to_string(w[a + 1:a + 20], ' ') as t
  from (select rid, doc_id, w, unnest(range(0, len(w) - 19)) as a from d where len(w) >= 20)),
later as (select rid, a from (select rid, a, rank() over (partition by t order by coalesce(doc_id, -9223372036854775808), a) as r from win) where r > 1),
gone as (select distinct rid, p from (select rid, unnest(range(a, a + 20)) as p from later)),
words as (select rid, i - 1 as p, w[i] as x from (select rid, w, unnest(range(1, len(w) + 1)) as i from d)),
kept as (select rid, string_agg(x, ' ' order by p) as t from words anti join gone using (rid, p) group by rid),
lost as (select rid, count(*) as n from gone group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (rid) left join lost using (rid)
"""
