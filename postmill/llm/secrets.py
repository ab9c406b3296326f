r"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong kinds stand for themselves: `assign` (a secret given to a telling name), `access` (an access
key's identifier) and `hex` (a long run of hexadecimal digits). Weak kinds mean nothing alone:
`opaque` (a mixed run of 40 letters, digits, + and /), `login` (a user or client named) and
`endpoint` (an address with a scheme). Parts of one row are joined by interval: a weak candidate is
reported only if complementary parts begin or end within `reach` code points of it: an opaque run
needs an identifier (access or login), a login needs a secret (assign, hex or an opaque run) and
an endpoint needs both. The join is a sweep over the row's own parts, in order of place: each gets the
nearest part of every role before and after it, so its work doesn't grow with pairs, and no row moves.

Offsets are code points, ends exclusive. Null texts are empty; a text without parts has empty
lists. U+0001 and U+0002 serve as marks inside and count as U+0003 while matching, which no kind
matches either. Each row is scanned for itself, repeated rows and ids too.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Kinds in the order of their listing; `ok` says which matches stay.
KINDS = {
    "assign": (ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8),
    "access": (r"AKIA[A-Z0-9]+", lambda m: F.length(m) >= 16),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{32,}", lambda m: F.lit(True)),
    "opaque": (r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])", lambda m: m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]")),
    "login": (r"""(?i)(?<![A-Za-z0-9_])(?:user(?:_?name)?|login|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}""", lambda m: F.lit(True)),
    "endpoint": (r"(?i)(?<![A-Za-z0-9_])(?:https?|s3|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis)://[^\s\"'<>]{3,}", lambda m: F.lit(True)),
}
STRONG = ("assign", "access", "hex")
NAMES = list(KINDS)
#: Words of which each match of the kind has one, in lower case: a cheap test before the expression.
HINTS = {"assign": ("passw", "secret", "token", "api"), "access": ("akia",), "login": ("user", "login", "client"), "endpoint": ("://",)}


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where the value is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scanned(items: Column, zero: Column, step: Callable[[Column, Column], Column], shown: Callable[[Column, Column], Column], kind: str) -> Column:
    """shown(state before x, x) for each x of an array, where step moves the state on; `kind` is the type of what is shown.

    It goes by runs of about sqrt(n) items, for appending to an array copies it: n ** 1.5 steps and not n ** 2.
    """
    def cut_up(v: Column) -> Column:
        run = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(v)))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(v) / run) - 1).cast("int")), lambda i: F.slice(v, i * run + 1, run))

    def begins(runs: Column) -> Column:
        first = F.struct(F.array(zero).alias("all"), zero.alias("now"))
        return F.aggregate(runs, first, lambda s, r: bound(F.aggregate(r, s["now"], step), lambda after: F.struct(F.array_append(s["all"], after).alias("all"), after.alias("now"))), lambda s: s["all"])

    def show(r: Column, state: Column) -> Column:
        first = F.struct(state.alias("now"), F.array().cast(f"array<{kind}>").alias("all"))
        return F.aggregate(r, first, lambda s, x: F.struct(step(s["now"], x).alias("now"), F.array_append(s["all"], shown(s["now"], x)).alias("all")), lambda s: s["all"])

    return bound(items, lambda v: bound(cut_up(v), lambda runs: bound(begins(runs), lambda states: F.flatten(F.transform(runs, lambda r, i: show(r, F.get(states, i)))))))


SPAN = "struct<a:int,kind:int,b:int,ok:boolean>"


def _matches(text: Column, low: Column, number: int) -> Column:
    """(a, kind, b, ok) of what lies outside and inside of the matches, in turn; null where nothing matches."""
    pattern, ok = KINDS[NAMES[number]]
    split = F.split(F.regexp_replace(text, F.lit(pattern), F.lit("\u0001$0\u0002")), "[\u0001\u0002]")
    # Every second piece is a match.
    pieces = F.transform(split, lambda x, i: F.struct(F.length(x).alias("len"), ((i % 2 == 1) & ok(x)).alias("ok")))
    spans = scanned(pieces, F.lit(0), lambda s, x: s + x["len"], lambda s, x: F.struct(s.alias("a"), F.lit(number).alias("kind"), (s + x["len"]).alias("b"), x["ok"].alias("ok")), SPAN)
    found = text.rlike(pattern)
    if NAMES[number] in HINTS:
        found = reduce(Column.__or__, (low.contains(x) for x in HINTS[NAMES[number]])) & found
    return F.when(found, F.filter(spans, lambda x: x["ok"]))


def find_secrets(docs: DataFrame, reach: int = 200, carry: list[str] = ()) -> DataFrame:
    """doc_id and spans (array of kind, a, b) of each row, ordered by a, the kinds' listing and b.

    Columns named in `carry` come back as a struct `row`.
    """
    plain = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("\u0001"), F.lit("\u0003")), F.lit("\u0002"), F.lit("\u0003"))
    rows = docs.select("doc_id", plain.alias("t"), *([F.struct(*carry).alias("row")] if carry else [])).withColumn("low", F.lower("t"))
    none = F.array().cast(f"array<{SPAN}>")
    parts = F.array_sort(F.concat(*(F.coalesce(_matches(F.col("t"), F.col("low"), k), none) for k in range(len(NAMES)))))
    kept = ["doc_id", *(["row"] if carry else [])]
    # Generators keep what stands before them from being computed again for each use.
    placed = rows.select(*kept, F.explode(F.array(parts)).alias("s"))

    roles = {"identifier": ("access", "login"), "secret": ("assign", "hex", "opaque")}
    is_role = lambda x, role: x["kind"].isin(*(NAMES.index(k) for k in roles[role]))
    far = F.struct(*(F.lit(None).cast("int").alias(role) for role in roles))
    last = lambda side: lambda s, x: F.struct(*(F.when(is_role(x, role), x[side]).otherwise(s[role]).alias(role) for role in roles))
    widest = lambda s, x: F.struct(*(F.when(is_role(x, role), F.greatest(s[role], x["b"])).otherwise(s[role]).alias(role) for role in roles))
    near = lambda distance: F.struct(*(F.coalesce(distance(role) <= reach, F.lit(False)).alias(role) for role in roles))
    flags = "struct<identifier:boolean,secret:boolean>"
    before = scanned(F.col("s"), far, widest, lambda s, x: near(lambda role: x["a"] - s[role]), flags)
    after = F.reverse(scanned(F.reverse("s"), far, last("a"), lambda s, x: near(lambda role: s[role] - x["b"]), flags))
    linked = F.transform(F.arrays_zip(F.col("s").alias("s"), before.alias("p"), after.alias("n")), lambda z: F.struct(z["s"].alias("s"), *((z["p"][role] | z["n"][role]).alias(role) for role in roles)))

    def stays(z: Column) -> Column:
        weak = [F.when(z["s"]["kind"] == NAMES.index(k), needed) for k, needed in (("opaque", z["identifier"]), ("login", z["secret"]))]
        return z["s"]["kind"].isin(*(NAMES.index(k) for k in STRONG)) | F.coalesce(*weak, z["identifier"] & z["secret"])

    named = lambda z: F.struct(F.element_at(F.lit(NAMES), z["s"]["kind"] + 1).alias("kind"), z["s"]["a"].alias("a"), z["s"]["b"].alias("b"))
    empty = F.array().cast("array<struct<kind:string,a:int,b:int>>")
    spans = F.when(F.size("s") > 0, F.transform(F.filter(linked, stays), named)).otherwise(empty)
    return placed.select("doc_id", F.explode(F.array(spans)).alias("spans"), *(["row"] if carry else []))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["a"], x["b"])), ",")


def scan_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (of the strong spans) and spans (all) of each row."""
    found = find_secrets(docs, **options)
    strong = F.filter("spans", lambda x: x["kind"].isin(*STRONG))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(k) for k in STRONG), F.sha2(written(strong).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with each span, or run of overlapping spans, replaced by the mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("upto"))

    def step(s: Column, x: Column) -> Column:
        fresh = x["a"] >= s["upto"]
        out = F.when(fresh, F.concat(s["out"], F.substring(text, s["upto"] + 1, x["a"] - s["upto"]), F.lit(mark))).otherwise(s["out"])
        return F.struct(out.alias("out"), F.greatest(s["upto"], x["b"]).alias("upto"))

    rest = lambda s: F.concat(s["out"], F.substring(text, s["upto"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def _either_case(pattern: str) -> str:
    """The same pattern without (?i), which in SQL also matches a few letters beyond A-Z."""
    out, inside, at = [], False, pattern.index(")") + 1
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            n = 4 if pattern[at + 1] == "x" else 2
            out.append(pattern[at : at + n])
            at += n
            continue
        inside = (inside or c == "[") and c != "]"
        out.append(f"[{c.lower()}{c.upper()}]" if c.isalpha() and not inside else c)
        at += 1
    return "".join(out).replace("[a-z]", "[A-Za-z]")


def _oracle(reach: int = 200) -> str:
    """DuckDB SQL for `scan_report`; the engine there has no look-around, so opaque runs are told by their whole run."""
    assign, login, endpoint = (_either_case(x).replace("(?<![A-Za-z0-9_])", r"\b").replace("'", "''").replace(r"\"", '"') for x in (ASSIGN, KINDS["login"][0], KINDS["endpoint"][0]))
    kinds = (
        (assign, f"length(regexp_extract(m, '{assign}', 2)) >= 8"), ("AKIA[A-Z0-9]+", "length(m) >= 16"), ("[0-9a-f]+", "length(m) >= 32"),
        ("[A-Za-z0-9+/]+=?", "length(m) = 40 and m not like '%=' and regexp_matches(m, '[a-z]') and regexp_matches(m, '[A-Z]') and regexp_matches(m, '[0-9]')"),
        (login, "true"), (endpoint, "true"),
    )
    scans = " union all ".join(
        f"select rid, {k} as kind, a, a + length(m) as b from (select rid, p[i] as m, cast(coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x))), 0) as bigint) as a from"
        f" (select rid, p, unnest(range(2, len(p) + 1, 2)) as i from (select rid, string_split(replace(regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(2), 'g'), chr(2), chr(1)), chr(1)) as p from d))) where {ok}"
        for k, (pattern, ok) in enumerate(kinds)
    )
    near = lambda kinds: f"exists (select 1 from part o where o.rid = s.rid and o.kind in ({kinds}) and (o.a, o.kind, o.b) <> (s.a, s.kind, s.b) and (case when (o.a, o.kind, o.b) < (s.a, s.kind, s.b) then s.a - o.b <= {reach} else o.a - s.b <= {reach} end))"
    names = f"['{"', '".join(NAMES)}'][kind + 1]"
    written_in_order = lambda only: f"coalesce(string_agg(concat({names}, ':', a, ':', b), ',' order by a, kind){only}, '')"
    return rf"""
with d as (select doc_id, row_number() over () as rid, replace(replace(coalesce(text, ''), chr(1), chr(3)), chr(2), chr(3)) as t from documents),
part as ({scans}),
kept as (select s.* from part s where kind < 3 or (kind = 3 and {near('1, 4')}) or (kind = 4 and {near('0, 2, 3')}) or (kind = 5 and {near('1, 4')} and {near('0, 2, 3')})),
said as (
  select rid, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
    {written_in_order(' filter (kind < 3)')} as base, {written_in_order('')} as spans
  from kept group by rid)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join said using (rid)
"""


ORACLE = _oracle()
