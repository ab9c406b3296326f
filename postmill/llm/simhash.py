"""SimHash near-duplicates: fingerprints within a few bits of each other, and their components.

Links are found by the generalised pigeonhole principle. The 64 bits are grouped into parts so
that bits which vary together share a part; part i gets a threshold t_i (-1: never looked at)
with sum t_i = limit - parts + 1. Two fingerprints within the limit then differ in at most t_i
bits of some part i. How many parts, and which thresholds, is chosen by dynamic programming over
the rows to be dealt and the candidates to be compared, estimated for the number of distinct
fingerprints at hand; the choice changes the cost only, never the links.

Equal texts share one fingerprint and are grouped before any comparison. Fingerprints that meet in
a part are compared within blocks of bounded size: a crowded value is split into blocks, each pair
of blocks is a task of its own, and a task gives out one tree for each set of linked fingerprints
instead of all its pairs. No candidate is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import as_bytes, cut, portions, spread_join
from postmill.llm.components import components, trees

BITS = 64


def fingerprint(text: bytes, words_in_shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a whole text, unsigned; 0 for a text without words."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(words_in_shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - k + 1
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n].tolist(), ends[k - 1 :].tolist())), "<u8", n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 16_384):
        part = np.unpackbits(hashes[at : at + 16_384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """(id, fp) for each row, fp as a signed long. Null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 2000):
            found = np.array([fingerprint(x, **options) for x in as_bytes(batch.column("text"))], "<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found)], names=["id", "fp"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def correlated_parts(sample: np.ndarray, parts: int) -> list[int]:
    """Masks of `parts` groups of bits of near-equal size; bits that vary together come together."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64) if len(sample) else np.zeros((1, BITS))
    bits -= bits.mean(0)
    scale = np.sqrt((bits * bits).sum(0))
    tied = np.abs(bits.T @ bits) / np.maximum(np.outer(scale, scale), 1e-9)
    np.fill_diagonal(tied, 0)
    left, masks = list(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(int.bit_count, masks))) // (parts - k)
        group = [max(left, key=lambda b: (tied[b, left].sum(), -b))]
        left.remove(group[0])
        while len(group) < size:
            group.append(max(left, key=lambda b: (tied[b, group].sum(), -b)))
            left.remove(group[-1])
        masks.append(sum(1 << b for b in group))
    return masks


def flips(mask: int, most: int) -> list[int]:
    """All ways to flip 1 to `most` (at most 2) bits of a mask, as values to XOR."""
    bits = [1 << b for b in range(BITS) if mask >> b & 1]
    out = list(bits) if most >= 1 else []
    if most >= 2:
        out += [a | b for i, a in enumerate(bits) for b in bits[i + 1 :]]
    return out


def allocate(sample: np.ndarray, total: int, limit: int = 3, row_cost: float = 100.0, share: float = 1.0) -> list[tuple[int, int]]:
    """(mask, threshold) by part, with least estimated cost for `total` distinct fingerprints.

    A row dealt out costs `row_cost` comparisons. Candidates are estimated by how many pairs of
    the sample differ in at most t bits of the part; `share` of them are compared (other bounds
    leave out the rest).
    """
    best: tuple[float, list[tuple[int, int]]] = (float("inf"), [])
    for parts in range(2, limit + 2):
        budget = limit - parts + 1
        if budget > 2 * parts:  # more than two flips a part would be needed
            continue
        masks = correlated_parts(sample, parts)
        costs = []
        for mask in masks:
            values, counts = np.unique(sample & np.uint64(mask), return_counts=True)
            width, row = mask.bit_count(), {-1: 0.0}
            pairs = float((counts * (counts - 1.0)).sum())
            for t in range(min(2, budget + parts - 1) + 1):
                if t:
                    for f in (x for x in flips(mask, t) if x.bit_count() == t):
                        at = np.minimum(np.searchsorted(values, values ^ np.uint64(f)), len(values) - 1)
                        pairs += float((counts * counts[at])[values[at] == values ^ np.uint64(f)].sum())
                seen = max(1.0, len(sample) * (len(sample) - 1.0))
                row[t] = row_cost * total * sum(comb(width, j) for j in range(t + 1)) + max(pairs / seen, 0.5 / seen if len(sample) < total else 0) * total * total / 2 * share
            costs.append(row)
        states: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in costs:
            after: dict[int, tuple[float, list[int]]] = {}
            for spent, (cost, chosen) in states.items():
                for t, more in row.items():
                    if (key := spent + t) not in after or cost + more < after[key][0]:
                        after[key] = (cost + more, [*chosen, t])
            states = after
        if budget in states and states[budget][0] < best[0]:
            best = (states[budget][0], list(zip(masks, states[budget][1], strict=True)))
    return best[1]


def runs_of(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], keys: int) -> Iterator[list[np.ndarray]]:
    """The columns of sorted batches, dealt anew so that rows equal in the first `keys` of them come together."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        now = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now, strict=True)]
        changed = np.flatnonzero(np.any([x[1:] != x[:-1] for x in now[:keys]], axis=0))
        at = int(changed[-1]) + 1 if len(changed) else 0
        if at:
            yield [x[:at] for x in now]
        held = [x[at:] for x in now]
    if held is not None and len(held[0]):
        yield held


def ranges(left: np.ndarray, lo: np.ndarray, hi: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (left[i], j) with lo[i] <= j < hi[i], about `most` at a time."""
    counts = np.maximum(hi - lo, 0)
    some = np.flatnonzero(counts)
    left, lo, counts = left[some], lo[some], counts[some]
    ends, at = np.cumsum(counts), 0
    while at < len(left):
        base = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, side="right")))
        n = counts[at:to]
        first = np.repeat(lo[at:to] - (np.cumsum(n) - n), n)
        yield np.repeat(left[at:to], n), first + np.arange(len(first))
        at = to


#: Columns of a set's parity bits: 256 of them, each the parity of the number of hashes that fall on it.
PARITY = ("p0", "p1", "p2", "p3")


def _turns(keys: np.ndarray) -> np.ndarray:
    """How many rows before each row have an equal key."""
    at = np.argsort(keys, kind="stable")
    new = np.concatenate([[True], keys[at][1:] != keys[at][:-1]]) if len(keys) else np.zeros(0, bool)
    out = np.empty(len(keys), np.int64)
    out[at] = np.arange(len(keys)) - np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0)) if len(keys) else 0
    return out


def _candidates(batches: Iterator[pa.RecordBatch], limit: int, p: int, q: int, near: int, thin: int, most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes in different components that their fingerprints, sizes and parities allow to be similar.

    Rows come sorted by (part, value, r1, r2, probe, n). With `near` each row is paired with the first fit among the
    next `near` rows of its run. With `thin` a row has at most that many partners before it in a run, and two components
    twice as many pairs at a time.
    """
    names = ("part", "value", "r1", "r2", "probe", "n", "block", "fp", "node", "root", *PARITY)
    pairs: list[np.ndarray] = []

    def out() -> pa.RecordBatch:
        got = np.unique(np.concatenate(pairs), axis=0)
        pairs.clear()
        return pa.RecordBatch.from_arrays([pa.array(got[:, 0].copy()), pa.array(got[:, 1].copy())], names=["a", "b"])

    def all_pairs(c: list[np.ndarray], run: np.ndarray, n: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        place = run << 33 | c[4].astype(np.int64) << 32 | n
        # Pairs within a component are no news, so rows of the run's largest one meet the others only.
        at = np.lexsort((c[9], run))
        heads = np.flatnonzero(np.concatenate([[True], (run[at][1:] != run[at][:-1]) | (c[9][at][1:] != c[9][at][:-1])]))
        sizes = np.diff(np.append(heads, len(run)))
        by_size = np.lexsort((sizes, run[at][heads]))
        last = by_size[np.concatenate([run[at][heads][by_size][1:] != run[at][heads][by_size][:-1], [True]])]
        inner = c[9] == c[9][at][heads][last][run]
        least, largest = -(-p * n // q), n * q // p
        for left, right in ((~inner, np.arange(len(run))), (inner, np.flatnonzero(~inner))):
            own = np.flatnonzero(left & (c[4] == 0))
            there = place[right]
            for probe in (0, 1):
                key = run[own] << 33 | probe << 32
                lo = np.searchsorted(there, key | least[own]) if probe else np.searchsorted(right, own + 1)
                for x, y in ranges(own, lo, np.searchsorted(there, key | largest[own], side="right")):
                    yield x, right[y]

    for c in runs_of(batches, names, 4):
        run, n = np.concatenate([[0], np.cumsum(np.any([x[1:] != x[:-1] for x in c[:4]], axis=0))]), c[5].astype(np.int64)
        fp, node, root, apart = c[7].view("<u8"), c[8], c[9], c[2] != c[3]
        parity = np.stack([x.view("<u8") for x in c[10:]], 1)

        def fit(x, y, n=n, fp=fp, node=node, root=root, apart=apart, block=c[6], parity=parity):  # noqa: ANN001, ANN202
            ok = np.flatnonzero(np.bitwise_count(fp[x] ^ fp[y]) <= limit)
            x, y = x[ok], y[ok]
            ok = np.flatnonzero((root[x] != root[y]) & (node[x] != node[y]) & (~apart[x] | (block[x] != block[y])))
            x, y = x[ok], y[ok]
            # A Hamming distance of parities is never more than the symmetric difference.
            ok = (q + p) * np.bitwise_count(parity[x] ^ parity[y]).sum(1, dtype=np.int64) <= (q - p) * (n[x] + n[y])
            return x[ok], y[ok]

        found: list[tuple[np.ndarray, np.ndarray]] = []
        if near:
            free = np.ones(len(run), bool)
            for shift in range(1, near + 1):
                left = np.flatnonzero(free[: max(0, len(run) - shift)])
                left = left[(run[left] == run[left + shift]) & (q * n[left] >= p * n[left + shift])]
                x, y = fit(left, left + shift)
                free[x] = False
                found.append((x, y))
        else:
            met = np.zeros(len(run), np.int64)
            for x, y in all_pairs(c, run, n):
                x, y = fit(x, y)
                if thin and len(x):
                    turn = _turns(y) + met[y]
                    np.add.at(met, y, 1)
                    of = np.unique(np.stack([np.minimum(root[x], root[y]), np.maximum(root[x], root[y])]), axis=1, return_inverse=True)[1].ravel()
                    ok = (turn < thin) & (_turns(of) < 2 * thin)
                    x, y = x[ok], y[ok]
                if len(x):
                    found.append((x, y))
        for x, y in found:
            if len(x):
                pairs.append(np.stack([np.minimum(node[x], node[y]), np.maximum(node[x], node[y])], 1))
                if sum(map(len, pairs)) > most:
                    yield out()
    if pairs:
        yield out()


def _compare(batches: Iterator[pa.RecordBatch], limit: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal (part, value, r1, r2), whose rows come sorted with probes last."""
    names = ("part", "value", "r1", "r2", "probe", "block", "fp")

    def linked(c: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in c[:4]], axis=0)])
        starts = np.flatnonzero(new)
        ends = np.repeat(np.append(starts[1:], len(new)), np.diff(np.append(starts, len(new))))
        fp, block, apart = c[6].view("<u8"), c[5], c[2] != c[3]
        left = np.flatnonzero((c[4] == 0) | apart)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size, shift = 0, 1
        while len(left := left[left + shift < ends[left]]):
            right = left + shift
            hit = np.bitwise_count(fp[left] ^ fp[right]) <= limit
            hit &= ~apart[left] | (block[left] != block[right])
            hit &= fp[left] != fp[right]
            if hit.any():
                found.append((c[6][left[hit]], c[6][right[hit]]))
                size += int(hit.sum())
                if size > most:
                    found = [trees(*map(np.concatenate, zip(*found, strict=True)))]
                    size = len(found[0][0])
            shift += 1
        if found:
            a, b = trees(*map(np.concatenate, zip(*found, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for c in runs_of(batches, names, 4):
        yield from linked(c)


def dealt(rows: DataFrame, parts: list[tuple[int, int]], block_rows: int, broadcast_rows: int = 50_000, probing: bool = True) -> DataFrame:
    """rows (with `fp`) by (part, value, r1, r2): under the value of each part and, unless `probing` is off, under those within its threshold.

    Values with more than `block_rows` rows are split into blocks, and each pair of blocks (r1, r2) meets apart
    (without probing, blocks don't meet).
    """
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    struct = lambda part, value, probe: F.struct(F.lit(part).alias("part"), value.alias("value"), F.lit(probe).alias("probe"))

    def under(part: int, mask: int, t: int) -> list:
        value = F.col("fp").bitwiseAND(F.lit(signed(mask)))
        around = [F.transform(F.lit([signed(f) for f in flips(mask, t)]), lambda f: struct(part, value.bitwiseXOR(f), 1))] if t and probing else []
        return [F.array(struct(part, value, 0)), *around]

    probes = [x for part, (mask, t) in enumerate(parts) if t >= 0 for x in under(part, mask, t)]
    own = rows.columns
    rows = rows.select(*own, F.explode(F.concat(*probes)).alias("p")).select(*own, "p.*")
    crowded = rows.groupBy("part", "value").agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > block_rows)
    crowded = cut(crowded.select("part", "value", F.ceil(F.col("n_rows") / F.lit(block_rows)).cast("int").alias("blocks")))
    n = crowded.count()
    if n:
        rows = rows.join(F.broadcast(crowded) if n <= broadcast_rows else crowded, ["part", "value"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    else:
        rows = rows.withColumn("blocks", F.lit(1))
    return (
        rows.withColumn("block", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if probing else F.col("block"))
        .select("part", "value", F.least("block", "other").alias("r1"), F.greatest("block", "other").alias("r2"), "probe", "block", *own)
        .repartition("part", "value", "r1", "r2")
    )


def candidate_pairs(nodes: DataFrame, parts: list[tuple[int, int]], limit: int, p: int, q: int, near: int = 0, thin: int = 0, block_rows: int = 1 << 20) -> DataFrame:
    """Distinct pairs (a, b) of nodes (node, fp, n, root, PARITY) to be verified: within `limit` bits, with sizes n and parities that allow a similarity of p / q, roots apart.

    All of them, unless `near` or `thin` is given for a cheaper look that links large groups before the others are compared
    (see `_candidates`); `near` looks at every third part only.
    """
    some = [(mask, t if i % 3 == 0 or not near else -1) for i, (mask, t) in enumerate(parts)]
    rows = dealt(nodes.select("node", "fp", "n", "root", *PARITY), some, block_rows, probing=not near).sortWithinPartitions("part", "value", "r1", "r2", "probe", "n")
    return rows.mapInArrow(lambda batches: _candidates(batches, limit, p, q, near, thin), "a long, b long").distinct()


def hamming_links(distinct: DataFrame, limit: int = 3, sample_rows: int = 20_000, block_rows: int = 4096, broadcast_rows: int = 50_000) -> DataFrame:
    """Links (a, b) that connect the distinct fingerprints `fp` just as all pairs within `limit` bits would.

    The sample (the first `sample_rows` by a hash) only steers how the bits are grouped.
    """
    total = distinct.count()
    if total < 2 or limit < 1:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    sample = np.array(distinct.orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).toArrow().column("fp").to_numpy(), "<i8").view("<u8")
    rows = dealt(distinct.select("fp"), allocate(sample, total, limit), block_rows, broadcast_rows).sortWithinPartitions("part", "value", "r1", "r2", "probe")
    return rows.mapInArrow(lambda batches: _compare(batches, limit), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, limit: int = 3, id_column: str = "doc_id", text_column: str = "text", hot_rows: int = 1_000_000, **options) -> DataFrame:
    """One row for each row of docs: its id, fingerprint (16 hex digits) and component_id.

    component_id is the smallest id reachable over links of at most `limit` bits, the row's own
    among them; repeated ids count once for that, so there are no ties. Null ids get a component but
    never name one (it is null only if all ids in it are). Null and empty texts have fingerprint zero
    and are linked like any other. Rows of a fingerprint that over `hot_rows` share are dealt to
    several tasks.
    """
    found = cut(fingerprints(docs, id_column, text_column, **options))
    groups = cut(found.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n_rows")))
    roots = components(hamming_links(groups.select("fp"), limit))
    rooted = cut(groups.join(roots, groups.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least", "n_rows"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("fps"), F.max("n_rows").alias("n_rows"))
    largest = named.agg(F.max("fps").alias("fps"), F.max("n_rows").alias("n_rows")).first()
    wide = lambda frame, key, n, name: frame.where(F.col(n) > hot_rows).select(key, F.ceil(F.col(n) / F.lit(hot_rows)).alias("salts")) if (largest[name] or 0) > hot_rows else None
    by_fp = spread_join(rooted.select("fp", "root"), named.select("root", "component_id"), "root", wide(named, "root", "fps", "fps")).select("fp", "component_id")
    out = spread_join(found, by_fp, "fp", wide(groups, "fp", "n_rows", "n_rows"))
    return out.select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
