"""Personal data by weak supervision: labelers vote, expectation-maximisation weighs them, a span classifier decides.

Only DataFrame functions. Regular expressions give the base spans, and looser ones the doubtful candidates. Six
labelers (pattern, checksum, context words, gazetteer, counter-evidence, grouping) vote on every candidate. Votes and span
features take few values, so the corpus reduces to one table of counts, whose size these values bound; from it the
driver estimates how reliable each labeler is and fits the classifier that judges candidates in a second pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The base patterns, written so that no text makes the matcher go back (a start inside a run that failed
# fails as well, and possessive parts never had to give anything back).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}"
CARD = r"[0-9](?<![0-9]{2})(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: In every ip, card and loose phone.
NUMERIC = r"[0-9][\x20().-]?[0-9][\x20().-]?[0-9][\x20().-]?[0-9]"

LOOSE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\(dot\)|\[dot\]|\.)\x20?[A-Za-z0-9-]++)++"
LOOSE_PHONE = r"[(0-9](?<![0-9+.-][(0-9])(?<![0-9+][\x20-][(0-9])(?:(?<=\()[0-9]{3}\)[\x20-]?|(?<=[0-9])[0-9]{2}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![\x20.-]?[0-9])"

CONTEXT = (r"e-?mail|contact|write to|correo|courriel", r"\bip\b|server|host|address|adresse", r"card|visa|karte|carte|tarjeta|credit", r"phone|\btel|call|mobil|fax|telef")
ENDINGS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "eu", "info")
COUNTER = r"(?:[$#=]|\bv|version|no\.|isbn|doi)\x20?$"

LENGTHS, CLASSES, VOTES = 8, 4, 3
ABSTAIN = 2


def once(documents: DataFrame, **columns: Column) -> DataFrame:
    """The documents with more columns, each computed once: later expressions are not merged with a generator's."""
    kept = [c for c in documents.columns if c not in columns]
    return documents.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def located(text: Column, pattern: str, passes, sign: Column) -> Column:
    """Matches that pass, as (first, last, hit, lead): code points, end exclusive, and up to 40 characters before. Every text with a match has `sign`."""
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    none = F.array().cast("array<struct<first:int,last:int,hit:string,lead:string>>")

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + F.length(pair["gap"])
        last = first + F.coalesce(F.length(pair["hit"]), F.lit(0))
        found = F.struct(first.alias("first"), last.alias("last"), pair["hit"].alias("hit"), F.lower(F.right(pair["gap"], F.lit(40))).alias("lead"))
        out = F.when(pair["hit"].isNotNull() & passes(pair["hit"]), F.concat(state["out"], F.array(found))).otherwise(state["out"])
        return F.struct(last.alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.when(sign & text.rlike(pattern), F.aggregate(pairs, start, step, lambda s: s["out"])).otherwise(none)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether the digits of a hit pass the checksum: from the right, every second digit counts double, its digits summed."""
    each = F.split(F.reverse(digits(hit)), "")
    each = F.transform(F.filter(each, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda s, d: s + d) % 10 == 0


def parts_fit(hit: Column) -> Column:
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))


def dialled(hit: Column) -> Column:
    return F.length(digits(hit)).between(9, 15)


def always(hit: Column) -> Column:
    return hit.isNotNull()


def base_spans(text: Column) -> list[Column]:
    """Spans of each kind by pattern and check alone."""
    return [located(text, EMAIL, always, text.contains("@")), located(text, IP, parts_fit, F.col("numeric")), located(text, CARD, luhn, F.col("numeric")), located(text, PHONE, dialled, text.contains("+"))]


def doubtful(text: Column) -> list[Column]:
    """Spans of each kind that the base does not have."""
    return [
        located(text, LOOSE_EMAIL, always, text.contains("(at)") | text.contains("[at]")),
        located(text, IP, lambda h: ~parts_fit(h), F.col("numeric")),
        located(text, CARD, lambda h: ~luhn(h), F.col("numeric")),
        F.concat(located(text, PHONE, lambda h: ~dialled(h), text.contains("+")), located(text, LOOSE_PHONE, always, F.col("numeric"))),
    ]


def scanned(documents: DataFrame) -> DataFrame:
    """`base` and `more`: arrays of (kind, first, last, hit, lead) of each text, `more` apart from every base span."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def of_kind(kind: int):
        return lambda s: F.struct(F.lit(kind).alias("kind"), *[s[c].alias(c) for c in ("first", "last", "hit", "lead")])

    def tagged(found: list[Column]) -> Column:
        return F.concat(*[F.transform(spans, of_kind(k)) for k, spans in enumerate(found)])

    out = once(documents.withColumn("text", text), numeric=text.rlike(NUMERIC))
    out = once(out, base=tagged(base_spans(F.col("text"))), more=tagged(doubtful(F.col("text"))))
    apart = F.filter("more", lambda m: ~F.exists("base", lambda b: (m["first"] < b["last"]) & (b["first"] < m["last"])))
    return out.withColumn("more", apart).drop("numeric")


def by_kind(kind: Column, *of: Column) -> Column:
    return F.when(kind == 0, of[0]).when(kind == 1, of[1]).when(kind == 2, of[2]).otherwise(of[3])


def votes(span: Column, strict: bool) -> list[Column]:
    """Votes of the labelers: 0 against, 1 for, 2 none."""
    kind, hit, lead = span["kind"], span["hit"], span["lead"]
    one, against, none = F.lit(1), F.lit(0), F.lit(ABSTAIN)
    plain = digits(hit)
    ending = F.lower(F.regexp_extract(hit, r"([A-Za-z0-9-]+)$", 1))
    known = by_kind(kind, ending.isin(*ENDINGS), F.substring_index(hit, ".", 1).rlike(r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])$"), F.substring(plain, 1, 1).isin("3", "4", "5", "6"), hit.rlike(r"^[+(]"))
    checked = by_kind(kind, ending.rlike("^[a-z]{2,}$"), parts_fit(hit), luhn(hit), dialled(hit))
    near = by_kind(kind, *[lead.rlike(c) for c in CONTEXT])
    grouped = by_kind(kind, hit.contains("@"), F.lit(False), hit.rlike(r"^(?:[0-9]{4}[\x20-]){3}[0-9]{1,7}$|^[0-9]+$"), hit.rlike(r"[0-9)][\x20.-][0-9]{3}[\x20.-][0-9]{4}$"))
    return [
        one if strict else against,
        F.when(checked, one).otherwise(against),
        F.when(near, one).otherwise(none),
        F.when(known, one).otherwise(against),
        F.when(lead.rlike(COUNTER) | plain.rlike(r"^(.)\1{8,}$"), against).otherwise(none),
        F.when(grouped, one).otherwise(none),
    ]


def features(span: Column) -> list[Column]:
    """What the classifier sees: kind, length, the character before, checksum, context words, grouping."""
    strict = votes(span, False)
    lead = span["lead"]
    before = F.when(lead == "", F.lit(0)).when(lead.rlike(r"[\x20\n\t]$"), F.lit(1)).when(lead.rlike(r"[\p{L}\p{N}]$"), F.lit(2)).otherwise(F.lit(3))
    length = F.least(F.floor(F.length(span["hit"]) / 4).cast("int"), F.lit(LENGTHS - 1))
    return [span["kind"], length, before, strict[1], strict[2], strict[5]]


@dataclass(frozen=True)
class SpanModel:
    """Weights of each value of each feature, for each kind: `weights[feature][kind * values + value]`."""

    weights: tuple[tuple[float, ...], ...]
    reliabilities: tuple
    threshold: float = 0.5

    def accepts(self, span: Column) -> Column:
        kind, *rest = features(span)
        total = F.lit(0.0)
        for table, value in zip(self.weights, [F.lit(0), *rest], strict=True):
            size = len(table) // len(KINDS)
            total = total + F.element_at(F.array(*[F.lit(w) for w in table]), kind * size + value + 1)
        return total >= math.log(self.threshold / (1 - self.threshold))


SIZES = (1, LENGTHS, CLASSES, VOTES, VOTES, VOTES)


def estimate(table: list[tuple[int, tuple[int, ...], float]], rounds: int = 30):
    """Expectation-maximisation over (kind, votes, count): for each kind a rate, for each labeler its votes by truth."""
    labelers = 6
    share = {k: 0.5 for k in range(len(KINDS))}
    belief = {}
    for kind, vote, _ in table:
        yes, no = vote.count(1), vote.count(0)
        belief[kind, vote] = (yes + 0.5) / (yes + no + 1)
    chance: dict = {}
    for _ in range(rounds):
        seen = {(j, y, v): 0.1 for j in range(labelers) for y in (0, 1) for v in range(VOTES)}
        total = dict.fromkeys(share, 2.0)
        true = dict.fromkeys(share, 1.0)
        for kind, vote, n in table:
            p = belief[kind, vote]
            total[kind] += n
            true[kind] += n * p
            for j, v in enumerate(vote):
                seen[j, 1, v] += n * p
                seen[j, 0, v] += n * (1 - p)
        chance = {(j, y, v): c / sum(seen[j, y, u] for u in range(VOTES)) for (j, y, v), c in seen.items()}
        share = {k: true[k] / total[k] for k in share}
        for kind, vote, _ in table:
            odds = math.log(share[kind] / (1 - share[kind]))
            odds += sum(math.log(chance[j, 1, v] / chance[j, 0, v]) for j, v in enumerate(vote))
            belief[kind, vote] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief, chance


def train(table: list[tuple[tuple[int, ...], float, float]], rounds: int = 200, rate: float = 1.0, shrink: float = 0.01):
    """Logistic regression on (features, belief, count) by gradient descent; each feature is one of few values."""
    weights = [[0.0] * (size * len(KINDS)) for size in SIZES]
    for _ in range(rounds):
        slope = [[0.0] * len(w) for w in weights]
        mass = [[1.0] * len(w) for w in weights]
        for (kind, *rest), belief, n in table:
            cells = [kind * size + value for size, value in zip(SIZES, [0, *rest], strict=True)]
            odds = sum(w[c] for w, c in zip(weights, cells, strict=True))
            gap = n * (belief - 1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
            for s, m, c in zip(slope, mass, cells, strict=True):
                s[c] += gap
                m[c] += n
        weights = [[x + rate * (g / m - shrink * x) for x, g, m in zip(w, s, v, strict=True)] for w, s, v in zip(weights, slope, mass, strict=True)]
    return tuple(tuple(w) for w in weights)


def fit(documents: DataFrame) -> SpanModel:
    """Reliabilities and span classifier from all candidates of all documents."""
    found = scanned(documents.select("text"))
    each = []
    for column, strict in (("base", True), ("more", False)):
        span = F.col("span")
        rows = found.select(F.explode(column).alias("span"))
        each.append(rows.select(F.array(*features(span)).alias("features"), F.array(*votes(span, strict)).alias("votes")))
    counts = each[0].union(each[1]).groupBy("features", "votes").count().collect()
    rows = sorted((tuple(r["features"]), tuple(r["votes"]), float(r["count"])) for r in counts)
    pooled: dict = {}
    for f, v, n in rows:
        pooled[f[0], v] = pooled.get((f[0], v), 0.0) + n
    belief, chance = estimate([(k, v, n) for (k, v), n in sorted(pooled.items())])
    return SpanModel(train([(f, belief[f[0], v], n) for f, v, n in rows]), tuple(sorted(chance.items())))


def find(documents: DataFrame, model: SpanModel) -> DataFrame:
    """The documents with `base` and `spans`: arrays of (kind, first, last) in the order of kind and place."""
    out = once(scanned(documents), accepted=F.filter("more", model.accepts))
    accepted = F.col("accepted")
    accepted = F.filter(accepted, lambda m: ~F.exists("accepted", lambda o: ((o["kind"] < m["kind"]) | ((o["kind"] == m["kind"]) & (o["first"] < m["first"]))) & (m["first"] < o["last"]) & (o["first"] < m["last"])))

    def bare(spans: Column) -> Column:
        return F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["first"].alias("first"), s["last"].alias("last"))))

    return once(out, spans=bare(F.concat("base", accepted)), base=bare(F.col("base"))).drop("more", "accepted")


def is_kind(kind: int):
    return lambda span: span["kind"] == kind


def written(spans: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["first"].cast("string"), s["last"].cast("string"))), ",")


def find_pii(documents: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each row of `documents` (doc_id, text).

    The counts and base_sha256 are of the base spans; `spans` also has those the classifier adds, none of which touches a
    base span. A null or empty text has no spans: counts 0, spans empty. Repeated rows, and rows without doc_id, are
    judged like any other. An empty table gives an empty result. Other columns are not read.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = find(docs, model or fit(docs))
    counts = [F.size(F.filter("base", is_kind(k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written("base").cast("binary"), 256).alias("base_sha256"), written("spans").alias("spans"))


def redact(documents: DataFrame, model: SpanModel | None = None) -> DataFrame:
    """The documents with each span of personal data replaced by its kind in angle brackets; other columns as they are.

    n_chars, where it exists, becomes the new length. A null text becomes an empty one.
    """
    columns = documents.columns
    found = find(documents, model or fit(documents))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        new = F.concat(state["out"], F.substring(F.col("text"), state["at"] + 1, s["first"] - state["at"]), F.element_at(names, s["kind"] + 1))
        out = F.when(s["first"] >= state["at"], new).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["last"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.aggregate(ordered, start, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    out = found.withColumn("text", F.when(F.size("spans") > 0, text).otherwise(F.col("text")))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(*columns)
