"""Near copies: SimHash candidates within a wide limit, then an exact check of the shingles.

Texts are near copies if their sets of shingles have a Jaccard similarity of p / q or more. Each
set has a SimHash of its own (64 bits, by majority of the hashes of its distinct shingles). Sets
with the wanted similarity s differ in about 64 acos(2 s / (1 + s)) / pi bits, 9.7 for 0.8; the
default limit of 14 bits leaves out some 5 % of the pairs right at the border and hardly any
above 0.85. Candidates are all pairs within the limit, found by the generalised pigeonhole of
`simhash`, and of sizes that allow the similarity. They are verified: first by parities of the
sets (a lower bound of their symmetric difference), then by the sets themselves. So no link is
wrong, and all links within the limit are found.

Equal sets are one node from the start. A first look pairs each row with one that follows it in a part's
value, a second one with a few rows before it; what they link is one component from then on, so the members of a large
group need not meet all with all in the third look, which compares whatever is left in different components.

Words are what white space parts, A-Z lower-cased; a text with fewer words than a shingle is one
shingle, texts without words (null ones too) are equal. Repeated rows are equal sets. Shingles and
sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import as_bytes, cut, portions
from postmill.llm.components import components
from postmill.llm.simhash import PARITY, allocate, candidate_pairs

ROW_KEY = ("row_key_1", "row_key_2")
#: Up to so many keys (24 bytes each) are broadcast.
FEW = 200_000


def with_row_key(docs: DataFrame) -> DataFrame:
    """docs with a key of 128 bits over all columns: the same in every run, equal for equal rows only."""
    columns = [F.struct(F.col(c).isNull(), F.col(c)) for c in docs.columns]
    return docs.withColumns({k: F.xxhash64(F.lit(i), *columns) for i, k in enumerate(ROW_KEY)})


def shingle_set(text: bytes, words_in_shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()
    k = min(words_in_shingle, len(words))
    if not k:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    n = len(words) - k + 1
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = (out ^ hashes[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def node_of(hashes: np.ndarray) -> int:
    """What stands for a set of shingles, as a signed long."""
    from xxhash import xxh3_64_intdigest as digest

    value = digest(hashes.tobytes())
    return value - (1 << 64) if value >> 63 else value


def set_fingerprint(hashes: np.ndarray) -> int:
    """The SimHash of a set of shingles, as a signed long: a bit is 1 if set in over half of the hashes."""
    ones, mixed = np.zeros(64, np.int64), hashes * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    for at in range(0, len(mixed), 16_384):
        ones += np.unpackbits(mixed[at : at + 16_384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def parity(hashes: np.ndarray, size: int) -> bytes:
    """`size` bits (a power of two), each the parity of the number of hashes that fall on it."""
    return np.packbits((np.bincount((hashes >> np.uint64(17)).astype(np.int64) & (size - 1), minlength=size) & 1).astype(np.uint8)).tobytes()


def wide_parity(hashes: np.ndarray) -> bytes:
    """Parity bits for a set of this size, two for each shingle at least."""
    return parity(hashes, max(64, 1 << (2 * len(hashes)).bit_length()))


def least_apart(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets from their wide parities; the longer one is folded."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    size = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(v.reshape(-1, size), 0) for v in (a, b))
    return int(np.bitwise_count(a ^ b).sum(dtype=np.int64))


def _possible(batches: Iterator[pa.RecordBatch], p: int, q: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose parities allow the similarity."""
    for batch in batches:
        a, b, n, m = (batch.column(c).to_pylist() for c in ("x", "y", "n", "m"))
        keep = [(q + p) * least_apart(s, t) <= (q - p) * (i + j) for s, t, i, j in zip(a, b, n, m, strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, one: DataFrame, texts: DataFrame, words_in_shingle: int, p: int, q: int) -> DataFrame:
    """The pairs (a, b) whose sets have a similarity of p / q or more."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 200, most_bytes=2 << 20):
            hashes = [shingle_set(x, words_in_shingle).view(np.int64) for x in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(hashes, pa.list_(pa.int64()))], names=["node", "hashes"])

    facts = lambda node, own, size: one.select(F.col("node").alias(node), F.col("wide").alias(own), F.col("n").alias(size))
    met = pairs.join(facts("a", "x", "n"), "a").join(facts("b", "y", "m"), "b")
    open_pairs = cut(met.mapInArrow(lambda batches: _possible(batches, p, q), "a long, b long"))
    ends = open_pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = cut(one.join(ends, "node", "left_semi").select(*ROW_KEY, "node"))
    if wanted.count() <= FEW:  # then the texts of the others need not move
        wanted = F.broadcast(wanted)
    wanted = texts.join(wanted, list(ROW_KEY)).dropDuplicates(["node"])
    found = cut(wanted.select("node", "text").mapInArrow(sets, "node long, hashes array<long>"))
    both = open_pairs.join(found.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(found.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    return both.where((q + p) * F.size(F.array_intersect("x", "y")) >= p * (F.size("x") + F.size("y"))).select("a", "b")


def near_copies(docs: DataFrame, words_in_shingle: int = 5, p: int = 4, q: int = 5, limit: int = 14, near: int = 8, thin: int = 2, sample_rows: int = 20_000, block_rows: int = 1 << 20) -> DataFrame:
    """Row key, doc_id and root of each row of docs (see `with_row_key`); rows with one root are linked by near copies.

    The sample of `sample_rows` sets steers how the bits are grouped, and so the cost only.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select(*ROW_KEY, "doc_id", "text")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 2000):
            found = [shingle_set(x, words_in_shingle) for x in as_bytes(batch.column("text"))]
            made = [pa.array(list(map(node_of, found)), pa.int64()), pa.array(list(map(len, found)), pa.int32()), pa.array(list(map(set_fingerprint, found)), pa.int64()), pa.array(list(map(wide_parity, found)), pa.binary())]
            bits = np.frombuffer(b"".join(parity(x, 256) for x in found), "<i8").reshape(-1, 4)
            made += [pa.array(np.ascontiguousarray(bits[:, k])) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*ROW_KEY, "doc_id")), *made], names=[*ROW_KEY, "doc_id", "node", "n", "fp", "wide", *PARITY])

    named = cut(texts.mapInArrow(name, f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, doc_id {kind}, node long, n int, fp long, wide binary, p0 long, p1 long, p2 long, p3 long"))
    # Sets too small to resemble another one, whatever it is, have no links.
    one = cut(named.where(F.col("n") * q >= (F.col("n") + 1) * p).groupBy("node").agg(F.min(F.struct(*ROW_KEY, "n", "fp", "wide", *PARITY)).alias("r")).select("node", "r.*"))
    alone = named.select(*ROW_KEY, "doc_id", F.col("node").alias("root"))
    total = one.count()
    if total < 2:
        return alone
    got = one.orderBy(F.xxhash64("node"), "node").limit(sample_rows).select("fp", "n").toArrow()
    sizes = np.sort(got.column("n").to_numpy().astype(np.int64))
    fit = np.searchsorted(sizes, sizes * q // p, side="right") - np.searchsorted(sizes, -(-sizes * p // q))
    # A row is some 100 bytes on disk here, which counts for more than its time.
    parts = allocate(got.column("fp").to_numpy().view("<u8"), total, limit, row_cost=500.0, share=float(fit.mean()) / len(sizes))
    links = roots = None
    for look in ({"near": near}, {"thin": thin}, {}):
        nodes = one.withColumn("root", F.col("node")) if roots is None else one.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        pairs = candidate_pairs(nodes, parts, limit, p, q, block_rows=block_rows, **look)
        new = _verified(pairs, one, texts, words_in_shingle, p, q)
        links = new if roots is None else roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(new)
        roots = cut(components(links))
    return named.join(roots, "node", "left").select(*ROW_KEY, "doc_id", F.coalesce("root", "node").alias("root"))
