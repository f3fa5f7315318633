"""Secrets by a trigram inverted index: Boolean queries from each rule's pattern choose the texts its pattern is run on.

Only DataFrame functions. From a rule's pattern the driver derives which trigrams every match must hold, as alternatives
of sets. The index has a posting list of text keys for each such trigram and block of keys; lists are intersected within a
set and united over the alternatives. A key is a hash of the whole text, so copies have one posting, and two texts that
share a key only add candidates. Patterns then run on candidates alone; those without mandatory trigrams on every text.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from re import _constants as kinds
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import common
from sluice.llm.pii import once


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, the least length of a match and of its group 2, and whether it is one of the base.

    Matches are leftmost and apart; one that is too short is dropped and the search goes on behind it.
    """

    kind: str
    pattern: str
    least: int = 1
    least_value: int = 0
    base: bool = False

    def passes(self, hit: Column) -> Column:
        long = F.length(hit) >= self.least
        return long & (F.length(F.regexp_extract(hit, self.pattern, 2)) >= self.least_value) if self.least_value else long


# The base rules, then public forms of tokens that name themselves.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", least_value=12, base=True),
    # A run that is too short is dropped whole, and no shorter run begins inside it: the least length may stand in the pattern.
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("github", r"gh[opusr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

#: Strings that a part of a pattern may stand for, at most; a part with more is left out of the query.
STRINGS = 64
#: Texts of one block of the index, about.
BLOCK_TEXTS = 1 << 16
#: A text with more than this share of all rows is hot. Fewer than 1 / HOT texts can be.
HOT = 1 / 1000


def lowered(text: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in text)


def minimal(query: frozenset[frozenset[str]]) -> frozenset[frozenset[str]]:
    """Alternatives that no other alternative makes needless."""
    return frozenset(q for q in query if not any(other < q for other in query))


def both(a: frozenset, b: frozenset) -> frozenset:
    return minimal(frozenset(x | y for x in a for y in b))


#: One alternative that asks for nothing: every text fits.
ANY = frozenset({frozenset()})


def of_strings(strings: set[str]) -> frozenset[frozenset[str]]:
    """The query for a text that holds one of the strings."""
    return minimal(frozenset(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings))


def members(items) -> set[str] | None:
    """The characters of a class, or None where they are many or not listed."""
    found = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            found.add(lowered(chr(value)))
        elif kind is kinds.RANGE and value[1] - value[0] < 8:
            found |= {lowered(chr(c)) for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found


def exact(tree) -> set[str] | None:
    """All strings that a part can stand for, folded, or None where they are too many."""
    strings = {""}
    for kind, value in tree:
        if kind is kinds.LITERAL:
            more = {lowered(chr(value))}
        elif kind is kinds.IN:
            more = members(value)
        elif kind is kinds.SUBPATTERN:
            more = exact(value[3])
        elif kind is kinds.BRANCH:
            each = [exact(branch) for branch in value[1]]
            more = None if None in each else set().union(*each)
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[1] is not kinds.MAXREPEAT and value[1] <= 8:
            one = exact(value[2])
            more = None if one is None else set()
            for n in range(value[0], value[1] + 1) if one is not None and len(one) ** value[1] <= STRINGS else ():
                more |= {"".join(p) for p in itertools.product(one, repeat=n)}
            more = more or None
        else:
            more = None
        if more is None or len(strings) * len(more) > STRINGS:
            return None
        strings = {s + m for s in strings for m in more}
    return strings


def derived(tree) -> frozenset[frozenset[str]]:
    """Which trigrams, A-Z lower-cased, a text must hold for the pattern to match: alternatives of sets."""
    query, strings = ANY, {""}
    for item in tree:
        kind, value = item
        more = exact([item])
        if more is not None and len(strings) * len(more) <= STRINGS:
            strings = {s + m for s in strings for m in more}
            continue
        # What has come so far ends here; what a part in between must hold counts for itself.
        query, strings = both(query, of_strings(strings)), {""}
        if more is not None:
            strings = more
        elif kind is kinds.SUBPATTERN:
            query = both(query, derived(value[3]))
        elif kind is kinds.BRANCH:
            query = both(query, minimal(frozenset().union(*[derived(branch) for branch in value[1]])))
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT) and value[0]:
            query = both(query, derived(value[2]))
    return both(query, of_strings(strings))


def trigram_query(pattern: str) -> frozenset[frozenset[str]]:
    return derived(parser.parse(pattern))


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def index(documents: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index (block, trigram, postings) of the trigrams that some query asks for; the number is their place.

    Postings are distinct keys in ascending order. Copies collapse before the exchange.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.inline(F.array(F.struct(text_key(text).alias("key"), F.lower(text).alias("folded")))))
    held = F.array_compact(F.array(*[F.when(F.contains(F.col("folded"), F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]))
    blocks = common.parts(documents, BLOCK_TEXTS * 2048)
    found = rows.select("key", F.explode(held).alias("trigram")).distinct()
    block = F.pmod("key", F.lit(blocks)).alias("block")
    return found.groupBy(block, "trigram").agg(F.array_sort(F.collect_list("key")).alias("postings"))


def candidates(postings: DataFrame, queries: list[frozenset[frozenset[str]]], trigrams: list[str]) -> DataFrame:
    """(key, rules): texts that the Boolean query of a rule lets through, with the set of those rules as bits."""
    none = F.array().cast("array<bigint>")
    place = {t: i for i, t in enumerate(trigrams)}
    lists = [F.coalesce(F.first(F.when(F.col("trigram") == i, F.col("postings")), ignorenulls=True), none).alias(f"t{i}") for i in range(len(trigrams))]
    blocks = postings.groupBy("block").agg(*lists)

    def holding(query: frozenset[frozenset[str]]) -> Column:
        alternatives = [reduce(F.array_intersect, [F.col(f"t{place[t]}") for t in sorted(every)]) for every in sorted(query, key=sorted)]
        return reduce(F.array_union, alternatives)

    def of_rule(n: int) -> Callable[[Column], Column]:
        return lambda k: F.struct(k.alias("key"), F.lit(1 << n).cast("bigint").alias("rule"))

    each = [F.transform(holding(q), of_rule(n)) for n, q in enumerate(queries) if q != ANY]
    return blocks.select(F.inline(F.concat(*each))).groupBy("key").agg(F.bit_or("rule").alias("rules"))


def running(values: Column, zero: int, step: Callable[[Column, Column], Column]) -> Column:
    """For each value, `step` over `zero` and all values before it. Made in runs of 256, so a text with very many matches costs little more."""
    width = 256

    def over(some: Column) -> Column:
        begin = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(some, begin, lambda s, v: F.struct(step(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    first = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(width))
    runs = F.transform(first, lambda i: F.slice(values, i + 1, F.lit(width)))
    ahead = over(F.transform(runs, lambda run: F.aggregate(run, F.lit(zero), lambda a, b: step(a, b))))
    return F.flatten(F.zip_with(runs, ahead, lambda run, base: F.transform(over(run), lambda at: step(at, base))))


def matched(text: Column, rule: Rule, wanted: Column) -> Column:
    """All matches of a rule, where `wanted`, as (hit, gap): the match and the characters between the match before and it."""
    none = F.array().cast("array<struct<hit:string,gap:int>>")
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g))
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    pairs = F.filter(F.zip_with(hits, gaps, lambda h, g: F.struct(h.alias("hit"), g.alias("gap"))), lambda p: p["hit"].isNotNull())
    return F.when(wanted & text.rlike(rule.pattern), pairs).otherwise(none)


def spans_of(pairs: Column, rule: Rule) -> Column:
    """From `matched`, the matches that pass, as (first, last) in code points, end exclusive."""
    sizes = F.transform(pairs, lambda p: p["gap"] + F.length(p["hit"]))
    spans = F.zip_with(pairs, running(sizes, 0, lambda a, b: a + b), lambda p, at: F.struct((at + p["gap"]).alias("first"), (at + p["gap"] + F.length(p["hit"])).alias("last"), rule.passes(p["hit"]).alias("passes")))
    return F.transform(F.filter(spans, lambda s: s["passes"]), lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))


def flagged(documents: DataFrame, chosen: DataFrame) -> DataFrame:
    """The documents (with `key`) and the bits of the rules to run on each.

    Hot texts, fewer than 1 / HOT, are told by a broadcast, so no task has to hold the copies of one; all others meet
    their bits by key.
    """
    least = max(64, int(HOT * documents.count()))
    hot = documents.groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") > least).select("key")
    hot = common.keep(hot.join(chosen, "key", "left").select("key", F.coalesce("rules", F.lit(0)).alias("rules")), "secret-hot")
    few = F.broadcast(hot)
    rest = documents.join(few.select("key"), "key", "left_anti").join(chosen, "key", "left")
    return documents.join(few, "key").unionByName(rest.withColumn("rules", F.coalesce("rules", F.lit(0))))


def scanned(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and, for each rule, the array of its spans, found where the index lets the rule through."""
    queries = [trigram_query(rule.pattern) for rule in rules]
    trigrams = sorted({t for q in queries for every in q for t in every})
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), text_key(text).alias("key"))
    if trigrams:
        postings = common.keep(index(documents, trigrams), "secret-index")
        docs = flagged(docs, common.keep(candidates(postings, queries, trigrams), "secret-candidates"))
    else:
        docs = docs.withColumn("rules", F.lit(0).cast("bigint"))
    pairs = {}
    for n, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        wanted = F.lit(True) if query == ANY else F.col("rules").bitwiseAND(F.lit(1 << n).cast("bigint")) != 0
        pairs[f"pairs{n}"] = matched(F.col("text"), rule, wanted)
    found = once(docs.select("doc_id", "text", "rules"), **pairs)
    return once(found, **{f"found{n}": spans_of(F.col(f"pairs{n}"), rule) for n, rule in enumerate(rules)}).select("doc_id", *[f"found{n}" for n in range(len(rules))])


def merged(rules: tuple[Rule, ...], base: bool) -> Column:
    """Spans of all base rules, or of all others, as (first, kind, last) in the order of first, then kind."""

    def of_kind(n: int) -> Callable[[Column], Column]:
        return lambda s: F.struct(s["first"].alias("first"), F.lit(n).alias("kind"), s["last"].alias("last"))

    each = [F.transform(F.col(f"found{n}"), of_kind(n)) for n, r in enumerate(rules) if r.base == base]
    none = F.array().cast("array<struct<first:int,kind:int,last:int>>")
    return F.array_sort(F.concat(none, *each))


def joined(base: Column, more: Column, bases: int) -> Column:
    """All of `base` (the first `bases` kinds), and of `more` the spans that touch none of it, in order.

    A span touches a base span that begins no later where the furthest end so far is behind its first character, and a
    later one where the next base begins before its end.
    """
    everything = F.array_sort(F.concat(base, more))
    far = 2**31 - 1
    reach = running(F.transform(everything, lambda s: F.when(s["kind"] < bases, s["last"]).otherwise(0)), 0, F.greatest)
    coming = F.reverse(running(F.reverse(F.transform(everything, lambda s: F.when(s["kind"] < bases, s["first"]).otherwise(far))), far, F.least))
    near = F.zip_with(reach, coming, lambda r, c: F.struct(r.alias("reach"), c.alias("coming")))
    judged = F.zip_with(everything, near, lambda s, n: F.struct(s.alias("span"), ((s["kind"] < bases) | ((n["reach"] <= s["first"]) & (n["coming"] >= s["last"]))).alias("stays")))
    kept = F.transform(F.filter(judged, lambda j: j["stays"]), lambda j: j["span"])
    return F.when(F.size(more) > 0, kept).otherwise(base)


def written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["first"].cast("string"), s["last"].cast("string"))), ",")


def find_secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, n_<kind> of each base rule, base_sha256 and spans of each row of `documents` (doc_id, text).

    Counts and base_sha256 are of the base rules; `spans` also has those of the other rules that touch no base span. A
    null or empty text has no spans: counts 0, spans empty. Repeated rows, and rows without doc_id, are judged like any
    other. An empty table gives an empty result. Other columns are not read. Base rules come first in `rules`.
    """
    found = once(scanned(documents, rules), base=merged(rules, True), more=merged(rules, False), **{f"n_{r.kind}": F.size(f"found{n}").cast("bigint") for n, r in enumerate(rules) if r.base})
    spans = joined(F.col("base"), F.col("more"), sum(r.base for r in rules))
    counts = [f"n_{r.kind}" for r in rules if r.base]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base"), rules).cast("binary"), 256).alias("base_sha256"), written(spans, rules).alias("spans"))
