"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Each window of a benchmark item (`window` words, or a shorter item whole) is a set of shingles.
To contain the window, a document must contain every one of them, so it is enough to look for
one: the necessary prefix for exact containment is the window's rarest shingle. Shingles are
ordered by their counts over all documents (a first pass, which counts benchmark shingles only);
a window with a shingle that no document has is dropped from the index. The second pass joins
the shingles of the documents with the prefix shingles, keeps a meeting only if the window fits
between the text's first and last word at that position, and then compares the words exactly.

The index is broadcast in blocks of at most `block_windows` distinct windows; a larger benchmark
takes several passes over the documents, each against one block.

Words: A-Z lower-cased, runs of characters other than ASCII non-alphanumerics. Null texts have no
words; items without words have no windows. The windows of an item with null id count for n_hit, and
it isn't listed. Each row of documents is judged for itself, repeated rows and ids too.

Windows carry the hash of their set of items, never the list: a line that very many items share costs
as much as any other, and lists are put together once for each set that a document has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of word characters before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHINGLE = 3


def words_of(text: Column) -> Column:
    """The words of a text in their own case."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def folded(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    return F.translate(text, UPPER, LOWER)


def shingle_key(words: Column, at: Column, size: int) -> Column:
    """Hash of `size` words from the 0-based position; null where the text ends before.

    It uses the full lower-casing, which is cheap and puts together all that `folded` does.
    """
    parts = [F.lower(F.get(words, at + j)) for j in range(size)]
    return F.when(F.get(words, at + (size - 1)).isNotNull(), F.xxhash64(F.lit(size), *parts))


def item_windows(benchmark: DataFrame, window: int = 10) -> DataFrame:
    """(want, n, item): each window of each item, its words joined by a space, and how many they are; items without an id have windows too."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words_of(folded(F.col("text"))).alias("w"))
    n = F.size("w")
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(F.lit(1), n - (window - 1))))
    part = items.select("item", "w", F.explode(starts).alias("s")).select("item", F.slice("w", F.col("s"), F.lit(window)).alias("w"))
    return part.select(F.array_join("w", " ").alias("want"), F.size("w").alias("n"), "item").distinct()


def benchmark_windows(windows: DataFrame) -> DataFrame:
    """Distinct windows: want, n, and a group that those with the same items share (a hash of their ids; 0 for none)."""
    sums = [F.bit_xor(F.when(F.col("item").isNotNull(), F.xxhash64(F.lit(i), "item"))) for i in (1, 2)]
    group = F.when(F.count("item") > 0, F.xxhash64(F.count("item"), *sums)).otherwise(F.lit(0).cast("long"))
    return windows.groupBy("want", "n").agg(group.alias("items"))


def _shingled(docs: DataFrame, sizes: list[int], last: bool) -> DataFrame:
    """A row for each word position and shingle size, and one for the end of each text if `last`."""
    end = F.size("w") if last else F.size("w") - 1
    rows = docs.select("*", F.explode(F.when(end >= 0, F.sequence(F.lit(0), end))).alias("pos"))
    keys = [shingle_key(F.col("w"), F.col("pos"), size) for size in sizes]
    if len(keys) == 1:
        return rows.withColumn("key", keys[0])
    return rows.withColumn("key", F.explode(F.when(F.col("pos") == F.size("w"), F.array(F.lit(None).cast("long"))).otherwise(F.array(*keys))))


def _prepared(docs: DataFrame, benchmark: DataFrame, window: int, block_windows: int) -> tuple[DataFrame, DataFrame, list[int], int]:
    """(item, window) rows, the index (key, want, want_n, offset, items), sizes of its shingles and the number of its blocks."""
    listed = cut(item_windows(benchmark, window))
    windows = cut(benchmark_windows(listed))
    parts = windows.select("want", "n", "items", F.split("want", " ").alias("w"))
    by_size = []
    for size in range(1, SHINGLE + 1):
        chosen = parts.where(F.col("n") >= SHINGLE if size == SHINGLE else F.col("n") == size)
        by_size.append(chosen.select("want", "n", "items", F.lit(size).alias("size"), F.explode(F.sequence(F.lit(0), F.col("n") - size)).alias("offset"), "w").withColumn("key", shingle_key(F.col("w"), F.col("offset"), size)).drop("w"))
    shingles = cut(reduce(DataFrame.unionByName, by_size))
    facts = shingles.agg(F.collect_set("size").alias("sizes")).first()
    sizes, blocks = sorted(facts["sizes"]) or [SHINGLE], max(1, -(-windows.count() // block_windows))

    words, counts = docs.select(words_of(F.col("text")).alias("w")), []
    for block in range(blocks):
        wanted = shingles.where(_block(blocks) == block).select("key").distinct()
        seen = _shingled(words, sizes, False).select("key").join(F.broadcast(wanted), "key")
        counts.append(seen.groupBy("key").agg(F.count("*").alias("seen")))
    rare = reduce(DataFrame.unionByName, counts)
    ranked = shingles.join(rare, "key", "left").groupBy("want", "n", "items").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "key")).alias("p"))
    index = cut(ranked.where("p.seen > 0").select(F.col("p.key").alias("key"), "want", F.col("n").alias("want_n"), F.col("p.offset").alias("offset"), "items"))
    return listed.join(windows, ["want", "n"]), index, sizes, blocks


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("key", F.lit(3)), F.lit(blocks))


def _met(read: DataFrame, index: DataFrame, sizes: list[int], blocks: int, kept: list[str], ends: bool) -> DataFrame:
    """Rows (kept, span, items) for each occurrence of a window and, if `ends`, one for each text with n_words, its number of words."""
    found, n = [], F.size("w")
    for block in range(blocks):
        own, last = index.where(_block(blocks) == block), ends and block == 0
        dealt = _shingled(read, sizes, last)
        if last:
            # The end of each text meets this row, so that texts without a window stay.
            end = own.sparkSession.range(1).select(F.lit(0).cast("long").alias("key"), F.lit(None).cast("string").alias("want"), F.lit(0).alias("want_n"), F.lit(0).alias("offset"), F.lit(0).cast("long").alias("items"))
            own = own.unionByName(end)
            dealt = dealt.withColumn("key", F.when(F.col("pos") == n, F.lit(0).cast("long")).otherwise(F.col("key")))
        at = F.col("pos") - F.col("offset")
        met = dealt.join(F.broadcast(own), "key")
        inside = (F.col("pos") < n) & (at >= 0) & (at + F.col("want_n") <= n)
        same = folded(F.array_join(F.slice("w", F.greatest(at, F.lit(0)) + 1, F.col("want_n")), " ")) == F.col("want")
        is_end = (F.col("pos") == n) & F.col("want").isNull()
        met = met.where(is_end | (inside & F.col("want").isNotNull() & same))
        span = F.when(~is_end, F.struct(at.alias("a"), (at + F.col("want_n")).alias("b")))
        found.append(met.select(*kept, F.when(is_end, F.col("pos").cast("long")).alias("n_words"), span.alias("span"), F.when(~is_end & (F.col("items") != 0), F.col("items")).alias("items")))
    return reduce(DataFrame.unionByName, found)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_windows: int = 100_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each row of docs.

    n_hit counts the words inside any occurrence of a window, n_items the items with such windows.
    """
    listed, index, sizes, blocks = _prepared(docs, benchmark, window, block_windows)
    # Rows are told apart by what they hold, which is the same in every run of a task; equal rows are counted.
    keys = [F.xxhash64(F.lit(i), F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text").alias(k) for i, k in enumerate(("r1", "r2"))]
    read = docs.select(words_of(F.col("text")).alias("w"), "doc_id", *keys)
    merged = _met(read, index, sizes, blocks, ["r1", "r2", "doc_id"], True)
    per_doc = merged.groupBy("r1", "r2").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.count("n_words").alias("rows"),
        F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("items")).alias("groups"),
    )
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    step = lambda s, x: F.struct(F.greatest(s["upto"], x["b"]).alias("upto"), (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], s["upto"]))).alias("n"))
    n_hit = F.aggregate("spans", start, step, lambda s: s["n"].cast("long"))
    told = cut(per_doc.select("doc_id", "n_words", "rows", n_hit.alias("n_hit"), (F.size("spans") > 0).alias("contaminated"), "groups"))
    # Lists of items are put together once for each set of groups that some row has.
    sets = told.where(F.size("groups") > 0).select("groups").distinct()
    members = listed.where(F.col("items") != 0).groupBy("items").agg(F.min(F.struct("want", "n")).alias("w")).select(F.col("w.want").alias("want"), F.col("w.n").alias("n"), "items").join(listed.drop("items"), ["want", "n"]).where(F.col("item").isNotNull()).select("items", "item")
    lists = (
        sets.select("groups", F.explode("groups").alias("items")).join(members, "items").groupBy("groups").agg(F.array_sort(F.collect_set("item")).alias("list"))
        .select("groups", F.size("list").cast("long").alias("n_items"), F.sha2(F.array_join("list", ",").cast("binary"), 256).alias("items_sha256"))
    )
    found = told.where(F.size("groups") > 0).join(lists, "groups").unionByName(told.where(F.size("groups") == 0).select("*", F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit("").cast("binary"), 256).alias("items_sha256")))
    again = found.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return again.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def contaminated_keys(docs: DataFrame, benchmark: DataFrame, keys: list[str], window: int = 10, block_windows: int = 100_000) -> DataFrame:
    """The distinct keys of rows with any word inside a window; no other row moves."""
    _, index, sizes, blocks = _prepared(docs, benchmark, window, block_windows)
    return _met(docs.select(words_of(F.col("text")).alias("w"), *keys), index, sizes, blocks, keys, False).select(*keys).distinct()


#: The same rows in DuckDB: every window is looked up among all runs of as many words of the documents.
ORACLE = r"""
with d as (
  select doc_id, row_number() over () as rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
i as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
win as (
  select distinct item, array_to_string(w[s:s + 9], ' ') as want, least(10, len(w)) as n
  from (select item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as s from i where len(w) > 0)),
sizes as (select distinct n from win),
runs as (
  select rid, a, n, array_to_string(w[a + 1:a + n], ' ') as got
  from (select rid, w, n, unnest(range(0, len(w) - n + 1)) as a from d, sizes where len(w) >= n)),
hit as (select rid, a, runs.n, item from runs join win on got = want and runs.n = win.n),
words as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(a, a + n)) as p from hit) group by rid),
items as (select rid, count(item) as n_items, string_agg(item, ',' order by item) as list from (select distinct rid, item from hit) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)
"""
