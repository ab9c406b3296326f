"""Language-model scores by Brown classes: class transitions and word emissions, for all words of the corpus.

1. All words are counted (portions of a task first, then a grouped sum). The `head` most frequent ones
   have numbers; texts are written once as numbers of head words and their other words as they are.
2. The `seeds` most frequent words get classes by exchange clustering on the driver: from a round robin by
   rank, each word in turn moves to the class where the bigram likelihood is highest.
3. Every other word of the head goes to the class that its neighbours make likeliest, by distributed sums of
   (word, class before or after). Then come rounds of exchange over the whole head: half of its words at a
   time move to their best class, all at once; classes are recounted, and a round after which the likelihood
   isn't higher is taken back.
4. Each rarer word goes to the class that its own neighbours of the head make likeliest. Its occurrences are
   dealt by word, so a word is judged by all of them, however many words there are.
5. All transitions are counted, the rarer words' among them, and each text is scored:
   log10 P(class | class before) + log10 P(word | class) over its words and one end.

P(b | a) = (1 - u) (N(a, b) + 5 share(b)) / (N(a) + 5), P(word | class) is the word's share of its class. Words
that training never saw are a class of their own that has the probability u anywhere (words seen once over
all tokens) and 1 / (V + 1) for each of its words.

What the driver works on is bounded by the head and the classes, not by the input. A word outside
the head has at most all words / `head` occurrences, so none is hot; the head is chosen over all rows.

Rows whose crc32(doc_id as text, null: empty) mod 10 is 0 are held out from training. Null texts are empty and
have the end only. Without training rows each word has the base score 0. Repeated rows are counted, and
scored, each for itself. Ties: words of equal count come in byte order, classes of equal gain by number.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import as_bytes, cut, portions, remove, shared_folder, text_crc
from postmill.llm.simhash import runs_of

ALPHA, MU = 0.1, 5.0
#: Words of the head whose sums travel together.
BUCKET = 16
#: Writers hold a row group in memory.
SMALL_GROUPS = {"parquet.block.size": 16 << 20}


def tokens_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def log_sum(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def likelihood(table: np.ndarray) -> float:
    """The part of the bigram likelihood that depends on the classes, from counts of class pairs."""
    return float(log_sum(table).sum() - log_sum(table.sum(0)).sum() - log_sum(table.sum(1)).sum())


def word_counts(docs: DataFrame, most: int = 300_000) -> DataFrame:
    """(word, c, seen): how often a word (bytes) is in the training rows, and in all. A task's partial counts hold `most` words or little more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def out() -> Iterator[pa.RecordBatch]:
            for trained, own in sums.items():
                if own:
                    n = pa.array(list(own.values()), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), n if trained else pa.array(np.zeros(len(own), np.int64)), n], names=["word", "n", "all"])
                    own.clear()

        for batch in portions(batches, 500):
            for text, i in zip(as_bytes(batch.column("text")), batch.column("doc_id").to_pylist(), strict=True):
                sums[text_crc(i) % 10 != 0].update(tokens_of(text))
            if sum(map(len, sums.values())) > most:
                yield from out()
        yield from out()

    return docs.select("doc_id", "text").mapInArrow(run, "word binary, n long, all long").groupBy("word").agg(F.sum("n").alias("c"), F.sum("all").alias("seen"))


def exchange(bigrams: np.ndarray, words: int, classes: int, rounds: int = 6) -> np.ndarray:
    """Class of each symbol: the first `words` ones are clustered into `classes`, every other one is a class of its own.

    bigrams[a, b] counts symbol a before b. Moves are made only if they raise the likelihood
    sum f(class bigrams) - sum f(left margins) - sum f(right margins) with f(x) = x log x.
    """
    size, f = len(bigrams), log_sum
    classes = max(1, min(classes, words)) if words else 0
    of = np.concatenate([np.arange(words) % max(1, classes), classes + np.arange(size - words)])
    total = classes + size - words
    member = np.zeros((size, total))
    member[np.arange(size), of] = 1
    after, before = bigrams @ member, bigrams.T @ member
    table = member.T @ after
    for _ in range(rounds):
        moved = 0
        for w in range(words):
            old, out, inn, own = of[w], after[w].copy(), before[w].copy(), bigrams[w, w]
            table[old] -= out
            table[:, old] -= inn
            table[old, old] += own
            out[old] -= own
            inn[old] -= own
            rows, columns = table[:classes], table[:, :classes]
            corner = np.arange(classes)
            new_rows, new_columns = rows + out, columns + inn[:, None]
            gain = (f(new_rows) - f(rows)).sum(1) + (f(new_columns) - f(columns)).sum(0)
            was = table[corner, corner]
            gain += f(was + out[corner] + inn[corner] + own) - f(new_rows[corner, corner]) - f(new_columns[corner, corner]) + f(was)
            left, right = rows.sum(1), columns.sum(0)
            gain -= f(left + out.sum() + own) - f(left) + f(right + inn.sum() + own) - f(right)
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            table[new] += out
            table[:, new] += inn
            table[new, new] += own
            if new != old:
                moved += 1
                of[w] = new
                after[:, old] -= bigrams[:, w]
                after[:, new] += bigrams[:, w]
                before[:, old] -= bigrams[w]
                before[:, new] += bigrams[w]
        if not moved:
            break
    return of


def best_classes(word: np.ndarray, code: np.ndarray, n: np.ndarray, old: np.ndarray, table: np.ndarray, chunk: int = 50_000) -> np.ndarray:
    """The class where each word adds most to the likelihood, all other words staying where they are.

    Entries (word, code, n) are sorted by word (0 .. len(old) - 1); code is the class before the word, or
    `size` + the class after it. old is the word's class, or -1 if the table doesn't count it yet. The
    last class of the table is the end of texts, where no word goes.
    """
    classes = len(table) - 1
    around = np.concatenate([table[:, :classes], table.T[:, :classes]])
    margins = table.sum(0)[:classes], table.sum(1)[:classes]  # of what has something before it, or after
    now, often = log_sum(around), [log_sum(around + k) for k in range(1, 5)]
    margins_now = [log_sum(x) for x in margins]
    out = np.maximum(old, 0)
    starts = np.searchsorted(word, np.arange(len(old) + 1))
    low = 0
    while low < len(old):
        high = min(max(low + 1, int(np.searchsorted(starts, starts[low] + chunk, side="right")) - 1), low + chunk, len(old))
        part = slice(starts[low], starts[high])
        w, c, k, was = word[part] - low, code[part], n[part].astype(np.float64), old[low:high]
        rise = np.empty((len(w), classes))
        for times, table_then in enumerate(often, 1):
            rise[k == times] = table_then[c[k == times]]
        many = k > len(often)
        rise[many] = log_sum(around[c[many]] + k[many, None])
        rise -= now[c]
        own = np.flatnonzero(was[w] >= 0)
        at = was[w[own]]
        less = np.maximum(around[c[own], at] - k[own], 0)
        rise[own, at] = log_sum(less + k[own]) - log_sum(less)
        gain, rows = np.zeros((high - low, classes)), np.flatnonzero(was >= 0)
        if len(w):
            heads = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            gain[w[heads]] = np.add.reduceat(rise, heads)
        for side in (0, 1):
            total = np.bincount(w, np.where((c >= len(table)) == side, k, 0), high - low)
            kinds, which = np.unique(total, return_inverse=True)
            gain -= (log_sum(margins[side] + kinds[:, None]) - margins_now[side])[which]
            have = margins[side][was[rows]]
            less = np.maximum(have - total[rows], 0)
            gain[rows, was[rows]] += log_sum(have + total[rows]) - log_sum(have) - log_sum(less + total[rows]) + log_sum(less)
        best = gain.argmax(1)
        stay = np.zeros(high - low, bool)
        stay[rows] = gain[rows, best[rows]] <= gain[rows, was[rows]] + 1e-9
        out[low:high] = np.where(stay, was, best)
        low = high
    return out


@dataclass
class ClassModel:
    """Classes of the head (the last one is of words that training never saw), transitions and sizes."""

    words: list[bytes]
    counts: np.ndarray
    classes: np.ndarray
    size: int  #: classes of words and, the last one, of ends
    table: np.ndarray
    tokens: int
    kinds: int
    once: int
    ends: int
    likelihoods: list[float] = field(default_factory=list)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + ALPHA) / (self.tokens + ALPHA * (self.kinds + 1)))

    @property
    def unknown(self) -> float:
        """The probability of a word that training never saw."""
        return min(0.5, (self.once + ALPHA) / (self.tokens + 1))

    def transitions(self) -> np.ndarray:
        """log10 P(b | a), classes by classes with that of unknown words at the end."""
        k = self.size
        share = (self.table.sum(0) + 1) / (self.table.sum() + k)
        out = np.full((k + 1, k + 1), np.log10(self.unknown))
        out[:k, :k] = np.log10((1 - self.unknown) * (self.table + MU * share) / (self.table.sum(1, keepdims=True) + MU))
        out[k, :k] = np.log10((1 - self.unknown) * share)
        return out

    def scales(self) -> np.ndarray:
        """What the logarithm of a word's count is lessened by, for each class."""
        return np.append(np.log10(np.maximum(self.table.sum(0), 1)), np.log10(self.kinds + 1))


def _codes(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int32) for x in column.to_pylist()]


def _sums(total: np.ndarray) -> Iterator[pa.RecordBatch]:
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some].astype(np.int64))], names=["pair", "n"])


def _coded(docs: DataFrame, words: list[bytes], seeds: int, path: str) -> None:
    """Write the texts as numbers: rid, doc_id, held, codes (int32, -1 for other words) and rare (those words).

    Rows without rid have, as codes, (pair, n) of the pairs of seeds, others (seeds) and ends (seeds + 1) of a task's training rows.
    """
    sent, size = docs.sparkSession.sparkContext.broadcast(words), seeds + 2
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["rid", "doc_id", "held", "codes", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {w: i for i, w in enumerate(sent.value)}
        total, of_id = np.zeros(size * size, np.int64), None
        for batch in portions(batches, 2000, most_bytes=2 << 20):
            of_id = batch.column("doc_id").type
            held = [text_crc(i) % 10 == 0 for i in batch.column("doc_id").to_pylist()]
            codes, rare = [], []
            for text, out in zip(as_bytes(batch.column("text")), held, strict=True):
                own = tokens_of(text)
                got = np.fromiter((number.get(w, -1) for w in own), np.int32, len(own))
                codes.append(got.tobytes())
                rare.append([own[i] for i in np.flatnonzero(got < 0).tolist()])
                if not out:
                    chain = np.full(len(got) + 2, size - 1, np.int64)
                    chain[1:-1] = np.where((got >= 0) & (got < seeds), got, seeds)
                    np.add.at(total, chain[:-1] * size + chain[1:], 1)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(held), pa.array(codes, pa.binary()), pa.array(rare, pa.list_(pa.binary()))], names=names)
        if of_id is not None:
            some = np.flatnonzero(total)
            pairs = np.stack([some, total[some]]).astype("<i4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, of_id), pa.array([False]), pa.array([pairs], pa.binary()), pa.array([[]], pa.list_(pa.binary()))], names=names)

    rows = docs.select("doc_id", "text").withColumn("rid", F.monotonically_increasing_id())
    rows.mapInArrow(run, f"rid long, doc_id {kind}, held boolean, codes binary, rare array<binary>").write.options(**SMALL_GROUPS).parquet(path)


def _chains(codes: list[np.ndarray], classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in a row, each between two ends: head numbers (-1: other words, -2: ends), classes (-1: other words, or none yet) and where each opens."""
    sizes = np.array([len(c) + 2 for c in codes], np.int64)
    opens = np.cumsum(sizes) - sizes
    index = np.full(int(sizes.sum()), -2, np.int64)
    inner = np.ones(len(index), bool)
    inner[opens], inner[opens + sizes - 1] = False, False
    index[inner] = np.concatenate(codes)
    return index, np.append(classes, [end, -1]).astype(np.int64)[index], opens


def _contexts(coded: DataFrame, classes: np.ndarray, size: int, wanted: bool) -> DataFrame:
    """Of the training rows: sums by bucket of the head's words and, under bucket -1, counts of class pairs; only those unless `wanted`."""
    sent, heads = coded.sparkSession.sparkContext.broadcast(classes), len(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        total = np.zeros(heads * 2 * size if wanted else 0, np.int32)
        table = np.zeros(size * size, np.int64)
        for batch in portions(batches, 2000, "codes", 1 << 20):
            index, chain, opens = _chains(_codes(batch.column("codes")), of, size - 1)
            a, b = chain[:-1].copy(), chain[1:]
            a[opens[1:] - 1] = -1  # the end of a text is not before the next one
            both = (a >= 0) & (b >= 0)
            table += np.bincount(a[both] * size + b[both], minlength=size * size)
            if wanted:
                before, after = np.flatnonzero((index[1:] >= 0) & (a >= 0)), np.flatnonzero((index[:-1] >= 0) & (b >= 0))
                np.add.at(total, index[1:][before] * (2 * size) + a[before], 1)
                np.add.at(total, index[:-1][after] * (2 * size) + size + b[after], 1)
        some = np.flatnonzero(table)
        yield _payload([-1], [np.stack([some, table[some]]).astype("<i8").tobytes()])
        some = np.flatnonzero(total)
        bucket = some // (2 * size * BUCKET)
        heads_at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(some) else np.zeros(0, np.int64)
        both = np.stack([some - bucket * (2 * size * BUCKET), total[some]]).astype("<i4")
        ends = np.append(heads_at[1:], len(some))
        for at in range(0, len(heads_at), 2000):
            yield _payload(bucket[heads_at[at : at + 2000]], [both[:, x:y].tobytes() for x, y in zip(heads_at[at : at + 2000].tolist(), ends[at : at + 2000].tolist(), strict=True)])

    return coded.where("rid is not null and not held").select("codes").mapInArrow(run, "bucket int, sums binary")


def _payload(buckets, sums: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(buckets, np.int32)), pa.array(sums, pa.binary())], names=["bucket", "sums"])


def _recount(found: DataFrame, size: int) -> np.ndarray:
    """The class pairs of all tasks."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for x in batch.column("sums").to_pylist():
                at, n = np.frombuffer(x, "<i8").reshape(2, -1)
                total[at] += n
        yield from _sums(total)

    got = found.where("bucket = -1").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(size * size)
    table[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    return table.reshape(size, size)


def _moves(found: DataFrame, classes: np.ndarray, table: np.ndarray, free: np.ndarray) -> np.ndarray:
    """The classes of the head after each word that is `free` went to its best one."""
    size = len(table)
    sent = found.sparkSession.sparkContext.broadcast((classes, table, free))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table, free = sent.value
        width = 2 * size * BUCKET
        for bucket, sums in runs_of(batches, ("bucket", "sums"), 1):
            ids, at = np.unique(bucket, return_inverse=True)
            total = np.zeros((len(ids), width))
            for k, x in zip(at.tolist(), sums.tolist()):
                place, n = np.frombuffer(x, "<i4").reshape(2, -1)
                total[k, place] += n
            words = (ids[:, None].astype(np.int64) * BUCKET + np.arange(BUCKET)).ravel()
            sums_of = total.reshape(-1, 2 * size)
            real = words < len(of)
            real[real] = free[words[real]]
            words, sums_of = words[real], sums_of[real]
            w, code = np.nonzero(sums_of)
            new = best_classes(w, code, sums_of[w, code], of[words].astype(np.int64), table)
            yield pa.RecordBatch.from_arrays([pa.array(words.astype(np.int32)), pa.array(new.astype(np.int32))], names=["word", "class"])

    got = found.where("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "word int, class int").toArrow()
    out = classes.copy()
    out[got.column("word").to_numpy()] = got.column("class").to_numpy()
    return out


def cluster(coded: DataFrame, heads: int, known: np.ndarray, seeds: int, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """Classes of the head's words (-1: not in training), counts of class pairs, and the likelihood after each round."""
    size_seeds = seeds + 2
    bigrams = np.zeros(size_seeds * size_seeds)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size_seeds * size_seeds, np.int64)
        for batch in batches:
            for x in batch.column("codes").to_pylist():
                at, n = np.frombuffer(x, "<i4").reshape(2, -1)
                total[at] += n
        yield from _sums(total)

    got = coded.where("rid is null").select("codes").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    bigrams[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    size = max(1, min(classes, seeds)) + 1
    of = np.full(heads, -1, np.int32)
    if seeds:
        of[:seeds] = exchange(bigrams.reshape(size_seeds, size_seeds), seeds, classes)[:seeds]
    found = cut(_contexts(coded, of, size, True))
    of = _moves(found, of, _recount(found, size), known & (of < 0))
    of[known & (of < 0)] = 0  # without any neighbour that has a class
    found = cut(_contexts(coded, of, size, rounds > 0))
    table = _recount(found, size)
    told = [likelihood(table)]
    for turn in range(rounds):
        new = _moves(found, of, table, known & (np.arange(heads) % 2 == turn % 2))
        after = cut(_contexts(coded, new, size, turn + 1 < rounds))
        now = _recount(after, size)
        if likelihood(now) > told[-1]:
            of, table, found = new, now, after
            told.append(likelihood(now))
    return of, table, told


def _rare_rows(coded: DataFrame, classes: np.ndarray, size: int) -> DataFrame:
    """A row for each word outside the head: word, rid, pos, held and the classes l and r beside it (-1: another such word)."""
    sent = coded.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = sent.value
        for batch in portions(batches, 2000, "codes", 1 << 20):
            codes = _codes(batch.column("codes"))
            index, chain, opens = _chains(codes, np.where(of < 0, size, of), size - 1)
            at = np.flatnonzero(index == -1)
            doc = np.searchsorted(opens, at, side="right") - 1
            pos, take = at - opens[doc], pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rare").flatten(), batch.column("rid").take(take), pa.array(pos.astype(np.int32)), batch.column("held").take(take), pa.array(chain[at - 1].astype(np.int16)), pa.array(chain[at + 1].astype(np.int16))],
                names=["word", "rid", "pos", "held", "l", "r"],
            )

    return coded.where("rid is not null").mapInArrow(run, "word binary, rid long, pos int, held boolean, l short, r short")


def _placed(batches: Iterator[pa.RecordBatch], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """rid, pos, held, l, r, class and training count of rows that come sorted by word; classes by all of a word's training rows."""
    size = len(table)

    def placed(rows: pa.RecordBatch) -> pa.RecordBatch:
        word = rows.column("word")
        new = np.append(True, pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False))
        w = np.cumsum(new) - 1
        trained = ~rows.column("held").to_numpy(zero_copy_only=False)
        l, r = (rows.column(c).to_numpy().astype(np.int64) for c in ("l", "r"))  # noqa: E741
        c = np.bincount(w[trained], minlength=int(w[-1]) + 1)
        # Words that training never saw have the class `size` where they stand beside others, and tell nothing.
        left, right = trained & (l >= 0) & (l < size), trained & (r >= 0) & (r < size)
        keys, n = np.unique(np.concatenate([w[left] * 2 * size + l[left], w[right] * 2 * size + size + r[right]]), return_counts=True)
        of = best_classes(keys // (2 * size), keys % (2 * size), n, np.full(len(c), -1), table)
        of[c == 0] = size
        return pa.RecordBatch.from_arrays([*(rows.column(x) for x in ("rid", "pos", "held", "l", "r")), pa.array(of[w].astype(np.int16)), pa.array(c[w])], names=["rid", "pos", "held", "l", "r", "class", "c"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        word = batch.column("word")
        cuts = np.flatnonzero(pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy(zero_copy_only=False)) + 1
        if held and held[-1].column("word")[-1] != word[0]:
            yield placed(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
            held = []
        if not len(cuts):
            held.append(batch)
            continue
        yield placed(pa.Table.from_batches([*held, batch.slice(0, int(cuts[-1]))]).combine_chunks().to_batches()[0])
        held = [batch.slice(int(cuts[-1]))]
    if held:
        yield placed(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By text (rid): the transitions (a, b) beside words outside the head, and those words' classes (own), as bytes in a row, with their counts (c)."""
    for rid, _, held, left, right, own, c in runs_of(batches, ("rid", "pos", "held", "l", "r", "class", "c"), 1):
        left, right, own = (x.astype(np.int64) for x in (left, right, own))
        a = np.where(left >= 0, left, np.append(-1, own[:-1]))
        heads = np.flatnonzero(np.append(True, rid[1:] != rid[:-1]))
        out = {"rid": pa.array(rid[heads]), "held": pa.array(held[heads])}
        ends = np.append(heads[1:], len(rid)).tolist()
        last = right >= 0
        texts = lambda x: pa.array([x[i:j].tobytes() for i, j in zip(heads.tolist(), ends, strict=True)], pa.binary())  # noqa: E731, B023
        out["a"], out["own"], out["c"] = texts(a.astype("<i2")), texts(own.astype("<i2")), texts(c.astype("<i8"))
        # Transitions to the word after, where that one is in the head or the end: class and what follows.
        out["after"] = texts(np.where(last, right, -1).astype("<i2"))
        yield pa.RecordBatch.from_pydict(out)


def _link_pairs(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Row, class before and class after of each transition, then row, class and count of each word, of a batch of `_linked`."""
    raw = {k: [np.frombuffer(x, kind) for x in batch.column(k).to_pylist()] for k, kind in (("a", "<i2"), ("own", "<i2"), ("after", "<i2"), ("c", "<i8"))}
    row = np.repeat(np.arange(batch.num_rows), [len(x) for x in raw["a"]])
    a, own, after, c = (np.concatenate(raw[k]).astype(np.int64) if len(row) else np.zeros(0, np.int64) for k in ("a", "own", "after", "c"))
    more = np.flatnonzero(after >= 0)
    return np.concatenate([row, row[more]]), np.concatenate([a, own[more]]), np.concatenate([own, after[more]]), row, own, c


def learn(docs: DataFrame, folder: str, head: int = 200_000, seeds: int = 1000, classes: int = 48, rounds: int = 2) -> ClassModel:
    """The model; leaves the coded texts and the transitions beside words outside the head in the folder."""
    spark = docs.sparkSession
    counts = cut(word_counts(docs))
    ids = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary").alias("i"))
    ends = ids.where(F.pmod(F.crc32("i"), F.lit(10)) != 0).count()
    facts = counts.agg(F.sum("c"), F.sum((F.col("c") > 0).cast("long")), F.sum((F.col("c") == 1).cast("long"))).first()
    tokens, kinds, once = (int(x or 0) for x in facts)
    step = F.floor(F.log2("seen") * 16).cast("int")
    bands = sorted(((r.b, r.n) for r in counts.groupBy(step.alias("b")).agg(F.count("*").alias("n")).collect()), reverse=True)
    room, least = head, 1 << 30
    for band, n in bands:
        if n > room:
            break
        room, least = room - n, band
    got = counts.where(step >= least).toArrow()
    rows = sorted(zip(got.column("word").to_pylist(), got.column("c").to_pylist()), key=lambda x: (-x[1], x[0]))
    words, c = [w for w, _ in rows], np.array([n for _, n in rows], np.int64)
    k = int(min(seeds, (c > 0).sum()))
    _coded(docs, words, k, f"{folder}/coded")
    coded = spark.read.parquet(f"{folder}/coded")
    of, table, told = cluster(coded, len(words), c > 0, k, classes, rounds)
    size = len(table)
    near = spark.sparkContext.broadcast(table)
    resolved = _rare_rows(coded, of, size).repartition("word").sortWithinPartitions("word").mapInArrow(lambda b: _placed(b, near.value), "rid long, pos int, held boolean, l short, r short, class short, c long")
    resolved.repartition("rid").sortWithinPartitions("rid", "pos").mapInArrow(_linked, "rid long, held boolean, a binary, own binary, c binary, after binary").write.options(**SMALL_GROUPS).parquet(f"{folder}/links")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1) ** 2, np.int64)
        for batch in portions(batches, 2000, "c", 1 << 20):
            _, a, b, *_ = _link_pairs(batch)
            total += np.bincount(a * (size + 1) + b, minlength=len(total))
        yield from _sums(total)

    got = spark.read.parquet(f"{folder}/links").where("not held").mapInArrow(pairs, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    more = np.zeros((size + 1) ** 2)
    more[got.column("pair").to_numpy()] = got.column("n").to_numpy()
    table = table + more.reshape(size + 1, size + 1)[:size, :size]
    return ClassModel(words, c, np.where(of < 0, size, of), size, table, tokens + ends, kinds + (ends > 0), once, ends, told)


def score_texts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and perplexity of each row."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/class-lm-{uuid.uuid4().hex}"
    model = learn(docs, folder, **options)
    words = model.words
    model.words = []
    sent, size = spark.sparkContext.broadcast(model), model.size
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["rid", "doc_id", "n_tokens", "n_known", "base", "score"]

    def of_head(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        moves, scales = m.transitions(), m.scales()
        word_score = np.log10(np.maximum(m.counts, 1)) - scales[m.classes] if len(m.counts) else np.zeros(0)
        # By head number, then for other words (nothing here) and ends.
        each = np.append(word_score, [0.0, 0.0])
        base = np.append(m.base(m.counts), [float(m.base(np.array(m.ends))), 0.0])
        known = np.append(m.counts > 0, [m.ends > 0, False]).astype(np.int64)
        for batch in portions(batches, 2000, "codes", 1 << 20):
            codes = _codes(batch.column("codes"))
            index, chain, starts = _chains(codes, m.classes, size - 1)
            a, b = np.append(-1, chain[:-1]), chain
            a[starts] = -1  # nothing comes before the opening end
            moved = np.where((a >= 0) & (b >= 0), moves[a, b], 0.0) + each[index]
            its_base, its_known = base[index], known[index]
            for x in (moved, its_base, its_known):
                x[starts] = 0
            add = lambda x: np.add.reduceat(x, starts)  # noqa: E731, B023
            n = pa.array(np.array([len(c) + 1 for c in codes], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), n, pa.array(add(its_known)), pa.array(add(its_base)), pa.array(add(moved))], names=names)

    def of_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        moves, scales = m.transitions(), m.scales()
        for batch in portions(batches, 2000, "c", 1 << 20):
            row, a, b, at, own, c = _link_pairs(batch)
            n = batch.num_rows
            score = np.bincount(row, moves[a, b], n) + np.bincount(at, np.log10(np.maximum(c, 1)) - scales[own], n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rid"), pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.array(np.bincount(at, c > 0, n).astype(np.int64)), pa.array(np.bincount(at, m.base(c), n)), pa.array(score)], names=names,
            )

    shape = f"rid long, doc_id {kind}, n_tokens long, n_known long, base double, score double"
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    both = spark.read.parquet(f"{folder}/coded").where("rid is not null").mapInArrow(of_head, shape).unionByName(spark.read.parquet(f"{folder}/links").mapInArrow(of_others, shape))
    summed = cut(both.groupBy("rid").agg(F.max("doc_id").alias("doc_id"), *(F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base", "score"))))
    remove(spark, folder)
    model.words = words
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0
    return summed.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
