"""Secrets in texts: rules found through a trigram inverted index, natively in Spark SQL."""

from __future__ import annotations

import re._constants as kinds
import re._parser as parser
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A choice of more strings than this is not followed while trigrams are derived.
MOST_CHOICES = 64


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The formats looked for.  The first three are the base kinds.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,255}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,255}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)
RULES = BASE + ADDED

Query = tuple  # ("all", *queries), ("any", *queries) or ("has", trigram); ("all",) is true


def both(*parts: Query) -> Query:
    flat: list[Query] = []
    for p in parts:
        flat += [q for q in (p[1:] if p[0] == "all" else (p,)) if q not in flat]
    return flat[0] if len(flat) == 1 else ("all", *flat)


def literal_query(strings: set[str]) -> Query:
    """One of the strings occurs: all trigrams of it do.  True if one is too short to have any."""
    if not strings or min(map(len, strings)) < 3:
        return ("all",)
    options = sorted({both(*[("has", s[i : i + 3]) for i in range(len(s) - 2)]) for s in strings}, key=str)
    return options[0] if len(options) == 1 else ("any", *options)


def trigram_query(pattern: str) -> Query:
    """A condition on lower-cased trigrams that every text with a match meets, read off the parsed pattern."""
    strings, query = read(parser.parse(pattern))
    return both(query, literal_query(strings) if strings is not None else ("all",))


def read(items) -> tuple[set[str] | None, Query]:
    """(all strings that the items can match, or None if those can't be listed; condition)."""
    current: set[str] = {""}
    query: Query = ("all",)
    exact = True
    for op, arg in items:
        strings, inner = choices(op, arg)
        query = both(query, inner)
        joined = {a + b for a in current for b in strings} if strings is not None and len(current) * len(strings) <= MOST_CHOICES else None
        if joined is None:
            query = both(query, literal_query(current))
            current, exact = strings if strings is not None else {""}, False
        else:
            current = joined
    return (current, query) if exact else (None, both(query, literal_query(current)))


def choices(op, arg) -> tuple[set[str] | None, Query]:
    true: Query = ("all",)
    if op is kinds.LITERAL:
        return {chr(arg).lower()}, true
    if op is kinds.IN:
        found: set[str] = set()
        for kind, value in arg:
            if kind is kinds.LITERAL:
                found.add(chr(value).lower())
            elif kind is kinds.RANGE and value[1] - value[0] < MOST_CHOICES:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, true
        return (found if len(found) <= 8 else None), true
    if op is kinds.SUBPATTERN:
        return read(arg[-1])
    if op is kinds.BRANCH:
        branches = [read(b) for b in arg[1]]
        if all(s is not None and q == true for s, q in branches):
            return set().union(*[s for s, _ in branches]), true
        options = [both(q, literal_query(s) if s is not None else true) for s, q in branches]
        return None, (true if true in options else ("any", *options))
    if op in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        least, most, inner = arg
        strings, query = read(inner)
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, true
        if least == most == 1:
            return strings, query
        return None, both(query, literal_query(strings) if strings is not None else true) if least else true
    if op in (kinds.ASSERT, kinds.ASSERT_NOT, kinds.AT):
        return {""}, true
    return None, true


def trigrams(query: Query) -> set[str]:
    return {query[1]} if query[0] == "has" else set().union(*map(trigrams, query[1:]))


def meets(query: Query, present: Column) -> Column:
    """The condition over an array of the trigrams a text has."""
    if query[0] == "has":
        return F.array_contains(present, query[1])
    out = F.lit(query[0] == "all")
    for q in query[1:]:
        out = out & meets(q, present) if query[0] == "all" else out | meets(q, present)
    return out


def postings(docs: DataFrame, id_col: str, text: str, vocabulary: list[str]) -> DataFrame:
    """(trigram, id): the inverted index of all texts over the trigrams that some rule asks for."""
    lower = docs.select(F.col(id_col).alias("_id"), F.lower(text).alias("_lower"))
    present = F.array_compact(F.array(*[F.when(F.contains("_lower", F.lit(t)), F.lit(t)) for t in vocabulary]))
    return lower.select(F.explode(present).alias("trigram"), "_id")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, kinds): the rules whose condition the intersected postings of an id meet; ids without any are left out."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != ("all",)}
    joined = index.groupBy("_id").agg(F.collect_set("trigram").alias("_present"))
    met = F.array_compact(F.array(*[F.when(meets(q, F.col("_present")), F.lit(k)) for k, q in queries.items()]))
    return joined.select(F.col("_id").alias("__secret_id"), met.alias("__secret_kinds")).where(F.size("__secret_kinds") > 0)


SPAN = "struct<start:int,place:int,kind:string,end:int>"


#: Numbers that one step of a running total, or one cut of a text, takes together: an array in an
#: expression grows by copying, so long ones are made of short ones.
CHUNK = 256


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value) with value computed once, also where `then` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def chunks(values: Column) -> Column:
    """An array cut into arrays of at most CHUNK elements."""
    n = F.ceil(F.size(values) / CHUNK).cast("int")
    cut = F.transform(F.sequence(F.lit(1), n), lambda c: F.slice(values, (c - 1) * CHUNK + 1, F.lit(CHUNK)))
    return F.when(n > 0, cut).otherwise(F.slice(F.array(values), 1, 0))


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For an array of int: `step` over all elements before each one, from 0.  step is associative and 0 its neutral element."""

    def over(part: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), F.slice(F.array(F.lit(0)), 1, 0).alias("out"))
        return F.aggregate(part, first, lambda acc, v: F.struct(step(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))

    def joined(parts: Column) -> Column:
        before = over(F.transform(parts, lambda p: p["at"]))["out"]
        return F.flatten(F.zip_with(parts, before, lambda p, b: F.transform(p["out"], lambda v: step(b, v))))

    return bound(values, lambda v: bound(F.transform(chunks(v), over), joined))


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """Spans of a rule's matches in order, leftmost and without overlap; those with too short a group are dropped.

    Where the matches stand follows from the lengths of the pieces between them.
    """
    pattern = F.lit(rule.pattern)
    whole, pieces = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, rule.pattern, -1)
    sizes = F.transform(whole, F.length)
    counted = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length) if rule.group else sizes
    # A piece stands before each match, and one more behind the last.
    gaps = F.transform(F.slice(pieces, 1, F.size(sizes)), F.length)
    matches = F.arrays_zip(gaps.alias("gap"), sizes.alias("n"), counted.alias("c"))

    def spans(found: Column) -> Column:
        before = running(F.transform(found, lambda m: m["gap"] + m["n"]), lambda x, y: x + y)
        placed = F.zip_with(found, before, lambda m, b: F.struct((b + m["gap"]).alias("start"), m["n"].alias("n"), m["c"].alias("c")))
        good = F.filter(placed, lambda m: m["c"] >= rule.least)
        return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), (m["start"] + m["n"]).alias("end")))

    return F.when(text.rlike(rule.pattern), bound(matches, spans)).otherwise(F.array().cast(f"array<{SPAN}>"))


def find(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, spans: str = "secret_spans") -> DataFrame:
    """Adds an array of (start, place, kind, end) with the secrets of every text, by start and then by rule.

    Positions are code points, ends exclusive; NULL texts have none.  A
    column named like `spans` is replaced, all others stay whatever their
    names.  An inverted index over the trigrams that rules demand is built
    from all texts, its postings are intersected by id, and a rule is
    verified on the rows of its candidate ids only; rules without a mandatory
    trigram, and rows without an id, are scanned fully.  Rows that share an
    id share candidates, which costs time but changes nothing.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    vocabulary = sorted(set().union(*map(trigrams, queries.values())))
    source = docs.drop(spans)
    found = source
    indexed = {k for k, q in queries.items() if q != ("all",)}
    if indexed:
        hits = candidates(postings(source.where(F.col(id_col).isNotNull()), id_col, text, vocabulary), rules)
        found = source.join(hits.hint("shuffle_hash"), F.col(id_col) == F.col("__secret_id"), "left")
    read_text = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    parts = []
    for place, rule in enumerate(rules):
        each = spans_of(read_text, rule, place)
        if rule.kind in indexed:
            asked = F.coalesce(F.array_contains("__secret_kinds", rule.kind), F.lit(False)) | F.col(id_col).isNull()
            each = F.when(asked, each).otherwise(none)
        parts.append(each)
    return found.withColumn(spans, F.array_sort(F.concat(*parts))).drop("__secret_id", "__secret_kinds")


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans (by start) replaced by the mask; spans that touch get a mask each.

    A cut from a text reads it up to there, so texts with many spans are cut
    into stretches of CHUNK spans first.
    """

    def masked(found: Column) -> Column:
        before = running(F.transform(found, lambda s: s["end"]), F.greatest)
        pieces = F.zip_with(found, before, lambda s, b: F.struct(b.alias("lo"), s["start"].alias("hi")))
        kept = F.transform(chunks_of(F.filter(pieces, lambda p: p["hi"] >= p["lo"])), stretch)
        rest = F.substring(text, F.array_max(F.transform(found, lambda s: s["end"])) + 1, F.length(text))
        return F.concat(F.array_join(kept, ""), rest)

    def chunks_of(pieces: Column) -> Column:
        return bound(pieces, chunks)

    def stretch(part: Column) -> Column:
        lo, hi = F.get(part, F.lit(0))["lo"], F.element_at(part, -1)["hi"]
        cut = F.substring(text, lo + 1, hi - lo)
        return bound(cut, lambda x: F.array_join(F.transform(part, lambda p: F.concat(F.substring(x, p["lo"] - lo + 1, p["hi"] - p["lo"]), F.lit(mask))), ""))

    return F.when(F.size(spans) > 0, bound(spans, masked)).otherwise(text)
