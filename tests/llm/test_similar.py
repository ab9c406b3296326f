"""Near copies of the pipeline against all pairs."""

import itertools
import random

import corpus_pipeline
from postmill.llm import similar


def shingles(text, k=5):
    words = (text or "").lower().split()
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def pairs_of(texts):
    """Pairs of rows with a Jaccard similarity of 0.8 or more, and how many bits their fingerprints differ in."""
    sets = [shingles(t) for t in texts]
    fps = [similar.set_fingerprint(similar.shingle_set((t or "").encode(), 5)) for t in texts]
    near = lambda i, j: 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))
    return [(i, j, ((fps[i] ^ fps[j]) & (1 << 64) - 1).bit_count()) for i, j in itertools.combinations(range(len(texts)), 2) if near(i, j)]


def groups(texts, limit=14):
    """The least place of each row's component over all pairs with a similarity of 0.8 or more and at most `limit` bits apart."""
    of = list(range(len(texts)))
    for i, j, bits in pairs_of(texts):
        if bits <= limit and of[i] != of[j]:
            low, high = sorted((of[i], of[j]))
            of = [low if x == high else x for x in of]
    return of


def made():
    """Texts with copies of many degrees, a large group of near copies and a common passage."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(3000)}"
    out, passage = [], [word() for _ in range(40)]
    for _ in range(25):
        base = [word() for _ in range(rng.choice([8, 30, 120, 400]))]
        out.append(base)
        for _ in range(4):
            copy = list(base)
            for _ in range(max(1, int(len(base) * rng.choice([0.005, 0.01, 0.015, 0.02, 0.04])))):
                copy[rng.randrange(len(copy))] = word()
            out.append(copy)
    base = [word() for _ in range(200)]
    for _ in range(150):
        copy = list(base)
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(200)] = word()
        out.append(copy)
    out += [[word() for _ in range(20)] + passage + [word() for _ in range(20)] for _ in range(80)]
    return [" ".join(x) for x in out] + ["", None, " \n", "one two", "One  two", "one two three"]


def test_near_copies_are_all_found(spark):
    texts = made()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want, all_pairs = groups(texts), pairs_of(texts)
    assert len(set(want)) < len(want) - 100
    assert sum(bits <= 14 for _, _, bits in all_pairs) >= 0.9 * len(all_pairs)
    for options in ({}, {"near": 1, "thin": 1, "block_rows": 30}):
        roots, least = {}, {}
        for r in similar.near_copies(similar.with_row_key(docs), **options).collect():
            roots[r.doc_id] = r.root
            least[r.root] = min(r.doc_id, least.get(r.root, r.doc_id))
        assert [least[roots[i]] for i in range(len(texts))] == want
    kept = corpus_pipeline.one_of_each(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want))
    assert similar.near_copies(similar.with_row_key(docs.limit(0))).count() == 0


def test_one_row_of_each_group_whatever_its_id(spark):
    text = lambda start: " ".join(f"w{start + i}" for i in range(40))
    rows = [(1, text(0)), (2, text(0)), (2, text(100)), (2, text(100)), (None, text(200)), (None, text(200)), (None, text(0)), (None, text(300)), (3, text(300)), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r.doc_id, r.text or "") for r in corpus_pipeline.one_of_each(spark, docs, "").collect()]
    assert sorted(map(repr, kept)) == sorted(map(repr, [(1, text(0)), (2, text(100)), (None, text(200)), (3, text(300)), (None, "")]))


def test_set_fingerprint_is_the_majority_of_its_hashes():
    hashes = similar.shingle_set(b"a b c d e f g h a b c d e f", 5)
    mixed = [(int(x) * 0xD6E8FEB86659FD93) % (1 << 64) for x in hashes]
    mixed = [x ^ x >> 32 for x in mixed]
    want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in mixed) > len(mixed))
    assert similar.set_fingerprint(hashes) % (1 << 64) == want and similar.set_fingerprint(hashes[:0]) == 0


def test_recall_over_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    all_pairs = pairs_of([r.text for r in rows])
    roots = {r.doc_id: r.root for r in similar.near_copies(similar.with_row_key(docs)).collect()}
    found = sum(roots[rows[i].doc_id] == roots[rows[j].doc_id] for i, j, _ in all_pairs)
    assert all_pairs and found >= 0.9 * len(all_pairs)
