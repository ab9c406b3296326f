"""Language identification of web pages by Bayesian fusion of evidence.

A page's log posterior of a language is the sum of

* text: log likelihood of the visible text by a naive Bayes model of byte trigrams, learned from labelled
  documents (at most `per_language` of each language). It is scaled down, for trigrams of one text are
  far from independent;
* declared: the language that the markup declares (html lang), trusted with a fixed probability;
* suffix: how much likelier the language is among all other pages whose host ends in the same label;
* path: the same for other pages whose path begins with the same language code;
* host prior: the language's share among all other pages of the host, smoothed towards that of its
  domain, and that one towards that of all pages.

Shares are grouped sums of the text model's own posteriors over all pages. A page's own part is taken out
of each sum that judges it, so its text counts once. Sums are partial aggregations first, and a page is
joined to its host's single row; pages of a host with over `hot_pages` of them are dealt to several tasks.

A page without text or declaration lacks those terms; one without a host has the share among all pages as its prior
and no suffix. Null url and html count as empty. Each row is judged for itself, repeated rows too; of languages that are
equally likely the first by name is given. No training rows give `und` for all pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.common import as_bytes, cut, portions, spread_join
from postmill.llm.url_filter import host_of, path_of

SLOTS = 1 << 14
HIDDEN = re.compile(rb"<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-zA-Z#0-9]+;", re.S | re.I)
DECLARED = re.compile(rb"<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", re.I)
#: How strongly the sum over trigrams counts, and how far a declaration is trusted.
TEXT_WEIGHT, DECLARED_TRUST = 0.25, 0.9
#: Pages' worth of what is smoothed towards.
SMOOTHING = 10.0
#: Labels that stand before a country's label without naming a domain.
BEFORE_COUNTRY = "co|com|org|net|gov|edu|ac"
HASHES = 1 << 30


def slots_of(text: bytes) -> np.ndarray:
    """Hashed trigrams of a text, A-Z lower-cased and white space squeezed."""
    b = np.frombuffer(b" " + b" ".join(text.lower().split()) + b" ", np.uint8).astype(np.uint32)
    return ((b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA6B + b[2:] * 0xC2B2AE35) >> np.uint32(18)) & np.uint32(SLOTS - 1)


def learn(docs: DataFrame, per_language: int = 1000) -> tuple[list[str], np.ndarray]:
    """All languages of labelled documents and, by language, log probabilities of the trigram slots, from at most `per_language` rows of each.

    Those are the first by a hash of their id. A language's share of hashes is chosen by its count, so that only
    a bounded number of rows are ranked.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "lang")
    counts = cut(known.groupBy("lang").agg(F.count("*").alias("n")))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(HASHES))
    some = known.join(F.broadcast(counts), "lang").withColumn("place", place).where(F.col("place") < F.ceil(F.lit(HASHES * 2.0 * per_language) / F.col("n"))).select("doc_id", "lang", "place").distinct()
    picked = some.withColumn("turn", F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id"))).where(F.col("turn") <= per_language)
    rows = docs.select("doc_id", "lang", "text").join(F.broadcast(picked.select("doc_id", "lang")), ["doc_id", "lang"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in portions(batches, 500):
            for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text")), strict=True):
                own = seen.setdefault(lang, np.zeros(SLOTS, np.int64))
                own += np.bincount(slots_of(text), minlength=SLOTS)
        for lang, own in seen.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(own[some])], names=["lang", "slot", "n"])

    got = rows.mapInArrow(count, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(r.lang for r in counts.collect())
    counts = np.full((len(names), SLOTS), 0.5)
    if names:
        at = np.searchsorted(np.array(names), np.array(got.column("lang").to_pylist()))
        counts[at, got.column("slot").to_numpy()] += got.column("n").to_numpy()
    return names, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def visible(html: bytes) -> bytes:
    return HIDDEN.sub(b" ", html)


def domain_of(host: Column) -> Column:
    """The last two labels of a host, three where the one before a country's names no domain."""
    return F.regexp_extract(host, rf"(?:[^.]+\.(?:{BEFORE_COUNTRY})\.[a-z]{{2}}|[^.]+\.[^.]+|[^.]+)$", 0)


def page_evidence(pages: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """page_id, host, first (a language code that begins the path), text (log likelihoods, the best 0; all 0 without text) and declared of each row."""
    sent, n = pages.sparkSession.sparkContext.broadcast(table), len(names)
    kind = pages.schema["page_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, codes = sent.value, {x.encode(): x for x in names}
        for batch in portions(batches, 500, "html"):
            out, declared = np.zeros((batch.num_rows, n)), []
            for row, html in enumerate(as_bytes(batch.column("html"))):
                text = visible(html)
                if text.strip():
                    out[row] = logs[:, slots_of(text)].sum(1, dtype=np.float64)
                found = DECLARED.search(html)
                declared.append(codes.get(found[1].lower()[:2]) if found else None)
            out -= out.max(1, keepdims=True)
            lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, n, dtype=np.int32), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("host"), batch.column("first"), lists, pa.array(declared, pa.string())], names=["page_id", "host", "first", "text", "declared"])

    url = F.col("url")
    first = F.lower(F.regexp_extract(path_of(url), r"^/([A-Za-z]{2,3})(?:[/.-]|$)", 1))
    shown = pages.select("page_id", host_of(url).alias("host"), F.when(first.isin(names), first).alias("first"), "html")
    return shown.mapInArrow(read, f"page_id {kind}, host string, first string, text array<double>, declared string")


def identify(pages: DataFrame, docs: DataFrame, per_language: int = 1000, hot_pages: int = 100_000, few_hosts: int = 20_000) -> DataFrame:
    """page_id, host, lang (und if nothing was learned), probability, text_lang, declared and address of each row."""
    names, table = learn(docs, per_language)
    if not names:
        return pages.select("page_id", host_of(F.col("url")).alias("host"), F.lit("und").alias("lang"), F.lit(0.0).alias("probability"), *(F.lit(None).cast("string").alias(c) for c in ("text_lang", "declared", "address")))
    n = len(names)
    each = lambda made: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), made)
    total = lambda logs: F.aggregate(logs, F.lit(0.0), lambda a, x: a + F.exp(x))
    soft = F.transform("text", lambda x: F.exp(x * TEXT_WEIGHT) / total(F.transform("text", lambda y: y * TEXT_WEIGHT)))
    rows = cut(page_evidence(pages, names, table).withColumn("soft", soft))

    sums = [F.sum(F.get("soft", F.lit(i))).alias(f"s{i}") for i in range(n)]
    again = [F.sum(f"s{i}").alias(f"s{i}") for i in range(n)]
    packed = lambda name: F.array(*(F.col(f"s{i}") for i in range(n))).alias(name)
    hosts = cut(rows.groupBy("host", "first").agg(*sums, F.count("*").alias("pages")).withColumns({"domain": domain_of(F.col("host")), "suffix": F.element_at(F.split("host", r"\."), -1)}))
    of_all = [float(x or 0) for x in hosts.agg(*again).first()]
    of_path = {r["first"]: [float(r[f"s{i}"]) for i in range(n)] for r in hosts.where("first is not null").groupBy("first").agg(*again).collect()}
    by = lambda key, name: hosts.groupBy(key).agg(*again).select(key, packed(name))
    own = hosts.groupBy("host", "domain", "suffix").agg(*again, F.sum("pages").alias("pages")).select("host", "domain", "suffix", "pages", packed("by_host"))
    facts = cut(own.join(by("domain", "by_domain"), "domain").join(by("suffix", "by_suffix"), "suffix").select("host", "pages", "by_host", "by_domain", "by_suffix"))
    # Few hosts are broadcast; more of them are joined on their names.
    if facts.limit(few_hosts + 1).count() <= few_hosts:
        joined = rows.join(F.broadcast(facts), "host")
    else:
        hot = cut(facts.where(F.col("pages") > hot_pages).select("host", F.ceil(F.col("pages") / hot_pages).alias("salts")))
        joined = spread_join(rows, facts, "host", None if hot.isEmpty() else hot)

    # Shares without the page's own part: the sums of its host (domain, suffix, path) less its own posterior.
    sum_of = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    share = lambda sums, i, above: (F.greatest(F.lit(0.0), F.get(sums, i) - F.get("soft", i)) + SMOOTHING * above) / (F.greatest(F.lit(0.0), sum_of(sums) - 1) + SMOOTHING)
    overall = each(lambda i: (F.greatest(F.lit(0.0), F.get(F.lit(of_all), i) - F.get("soft", i)) + 1) / F.lit(max(0.0, sum(of_all) - 1) + n))
    joined = joined.withColumn("overall", overall)
    domain = each(lambda i: share("by_domain", i, F.get("overall", i)))
    with_host = F.col("host") != ""
    joined = joined.withColumn("domain", domain).withColumn("prior", F.when(with_host, each(lambda i: share("by_host", i, F.get("domain", i)))).otherwise(F.col("overall")))
    code = F.lit(None).cast("array<double>")
    for name, values in sorted(of_path.items()):
        code = F.when(F.col("first") == name, F.lit(values)).otherwise(code)
    joined = joined.withColumn("by_path", code)
    far = float(np.log((1 - DECLARED_TRUST) / max(1, n - 1)))
    terms = {
        "text": lambda i: F.get("text", i) * TEXT_WEIGHT,
        "prior": lambda i: F.log(F.get("prior", i)),
        "declared": lambda i: F.when(F.col("declared").isNull(), 0.0).when(F.get(F.lit(names), i) == F.col("declared"), float(np.log(DECLARED_TRUST))).otherwise(far),
        "suffix": lambda i: F.when(with_host, F.log(share("by_suffix", i, F.get("overall", i)) / F.get("overall", i))).otherwise(0.0),
        "path": lambda i: F.when(F.col("by_path").isNotNull(), F.log(share("by_path", i, F.get("overall", i)) / F.get("overall", i))).otherwise(0.0),
    }
    joined = joined.withColumn("logs", each(lambda i: sum((t(i) for t in list(terms.values())[1:]), terms["text"](i)))).withColumn("most", F.array_max("logs"))
    shifted = F.transform("logs", lambda x: x - F.col("most"))
    best = F.array_position("logs", F.col("most")).cast("int")
    heard = F.when(F.exists("text", lambda x: x != 0), F.element_at(F.lit(names), F.array_position("text", F.lit(0.0).cast("double")).cast("int")))
    return joined.select(
        "page_id", "host", F.element_at(F.lit(names), best).alias("lang"), (1 / total(shifted)).alias("probability"), heard.alias("text_lang"), "declared", F.col("first").alias("address"),
    )
