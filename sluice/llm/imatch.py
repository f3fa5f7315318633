"""I-Match fingerprints: terms of a band of inverse document frequency, hashed through randomised lexicon subsets.

Only DataFrame functions. The lexicon holds the terms whose share of the different texts is not below the band; its size is at most the mean
number of distinct terms of a text divided by the lower end of the band, whatever the number of documents, so
it may be broadcast. A term that it lacks is rare. A seeded hash deals each term to one of `SUBSETS` subsets. In each subset the
distinct terms of a document that lie in the band are sorted and hashed; the hashes together are its fingerprint, and the share of equal
hashes among the subsets that either document uses is the likeness of two. A document without a term of the band has the
fingerprint of its `RAREST` rarest terms; where one of two has none, these are compared in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm import common

SUBSETS = 48
#: Least and largest share of documents that hold a term of the lexicon, and least number of documents.
BAND, LEAST = (0.0005, 0.004), 2
#: Terms of a document, the rarest first, that stand in for those of the band.
RAREST = 48
SEED = "imatch-1"
BUCKET_BYTES, BUCKETS = 16 << 20, 4096


def words(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits; one may be empty."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def subset_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term, F.lit(SEED)), F.lit(SUBSETS)).cast("int")


def lexicon(documents: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """Hash of each term in the band or above it, the number of different texts that hold it, and whether it is in the band."""
    texts = documents.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Copies count once, so that the terms of a text with many copies are as rare as they are without.
    count = texts.select(F.xxhash64("text").alias("name")).distinct().agg(F.count("*").alias("rows"))
    each = texts.distinct().select(F.explode(words(F.col("text"))).alias("word")).where("word <> ''")
    df = each.groupBy(F.xxhash64("word").alias("term")).agg(F.count("*").alias("df"))
    share = F.col("df") / F.col("rows")
    # One row, so each side of this join is as long as the other table.
    kept = df.join(F.broadcast(count), F.lit(True)).where((share >= band[0]) & (F.col("df") >= LEAST))
    return kept.select("term", "df", (share <= band[1]).alias("inside"))


def borders(ids: DataFrame, buckets: int) -> list[int]:
    """Quantiles that cut the ids into that many buckets."""
    if buckets < 2:
        return []
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    found = ids.agg(F.percentile_approx("doc_id", shares, 100 * buckets).alias("q")).first()["q"]
    return sorted(set(found or []))


def bucket_of(doc_id: Column, edges: list[int]) -> Column:
    """Number of borders up to an id, by binary search; a null id comes before all."""
    if not edges:
        return F.lit(0)
    at = F.array(*[F.lit(e).cast("bigint") for e in edges])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])

    def step(low: Column, size: Column) -> Column:
        inside = low + size <= len(edges)
        return F.when(inside & (F.element_at(at, F.least(low + size, F.lit(len(edges)))) <= doc_id), low + size).otherwise(low)

    return F.coalesce(F.when(doc_id.isNotNull(), F.aggregate(steps, F.lit(0), step)), F.lit(0))


def with_next(documents: DataFrame) -> DataFrame:
    """Each row with the text of the next one in descending doc_id, the last with that of the first.

    Rows of a range of ids are ordered within their range. The first row of the following range comes along as a copy
    after the last of each, so no range needs another.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    edges = borders(docs, min(BUCKETS, common.parts(docs, BUCKET_BYTES)))
    own = bucket_of(F.col("doc_id"), edges)
    docs = docs.withColumn("bucket", own)
    # One row a bucket; a null id is below all others.
    heads = docs.groupBy("bucket").agg(F.max("doc_id").alias("head"))
    order = sorted((tuple(r) for r in heads.collect()), reverse=True)
    if not order:
        order = [(0, None)]
    before = {bucket: order[i - 1][0] for i, (bucket, _) in enumerate(order)}
    heads_at = documents.sparkSession.createDataFrame([(b, h, before[b]) for b, h in order], "b int, h bigint, target int")
    joined = docs.join(F.broadcast(heads_at), (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("h")), "left")
    places = F.array(F.struct(F.col("bucket").alias("at"), F.lit(0).alias("copy")), F.struct(F.col("target").alias("at"), F.lit(1).alias("copy")))
    spread = joined.select("doc_id", "text", "bucket", F.explode(F.filter(places, lambda p: p["at"].isNotNull())).alias("place"))
    spread = spread.select("doc_id", "text", "bucket", F.col("place.at").alias("at"), F.col("place.copy").alias("copy"))
    window = Window.partitionBy("at").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    rank = F.row_number().over(window)
    out = spread.withColumn("rank", rank).withColumn("next_text", F.lead("text").over(window))
    out = out.withColumn("next_copy", F.lead("copy").over(window)).withColumn("next_bucket", F.lead("bucket").over(window))
    out = out.where("copy = 0")
    last = F.col("next_copy") == 1
    next_rank = F.when(last, F.lit(1)).otherwise(F.col("rank") + 1)
    return out.select("doc_id", "text", "next_text", "at", "rank", F.when(last, F.col("next_bucket")).otherwise(F.col("at")).alias("next_at"), next_rank.alias("next_rank"))


def hashed(pairs: Column) -> Column:
    """(version, subset, hash) of each subset in use: its terms, in order, hashed one after another."""
    none = F.array().cast("array<struct<version:int,subset:int,hash:bigint>>")
    empty = F.lit(None)
    start = F.struct(none.alias("out"), empty.cast("int").alias("version"), empty.cast("int").alias("subset"), empty.cast("bigint").alias("hash"))

    def closed(s: Column) -> Column:
        mark = F.struct(s["version"].alias("version"), s["subset"].alias("subset"), s["hash"].alias("hash"))
        return F.when(s["hash"].isNull(), s["out"]).otherwise(F.concat(s["out"], F.array(mark)))

    def step(s: Column, p: Column) -> Column:
        same = s["hash"].isNotNull() & (s["version"] == p["version"]) & (s["subset"] == p["subset"])
        out = F.when(same, s["out"]).otherwise(closed(s))
        value = F.xxhash64(F.when(same, s["hash"]).otherwise(F.lit(0).cast("bigint")), p["term"])
        return F.struct(out.alias("out"), p["version"].alias("version"), p["subset"].alias("subset"), value.alias("hash"))

    return F.aggregate(pairs, start, step, closed)


def of_version(marks: Column, version: int) -> Column:
    """The fingerprint of one version: subset and hash, as text, for each subset in use."""
    own = F.filter(marks, lambda m: m["version"] == version)
    return F.transform(own, lambda m: F.concat_ws(":", m["subset"].cast("string"), F.hex(m["hash"])))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either uses; two empty fingerprints are alike, an empty and another not."""
    same = F.size(F.array_intersect(a, b))
    subset = lambda x: F.substring_index(x, ":", 1)
    either = F.size(F.array_union(F.transform(a, subset), F.transform(b, subset)))
    return F.when(either == 0, F.lit(1.0)).otherwise(same / F.greatest(either, F.lit(1)))


def half_replaced(text: Column, following: Column) -> Column:
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def by_rarest(documents: DataFrame, rows: DataFrame, known: DataFrame) -> DataFrame:
    """Fingerprints by their rarest terms of some rows, of their edited texts and of the texts after them.

    `rows` has at, rank and the hashes of a row's text and of the next one; only the texts they name are read into words.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Written, so that its size is known and the texts need not be exchanged to meet a small table.
    rows = common.keep(rows, "imatch-lacking")
    wanted = rows.select(F.explode(F.array("text_name", "next_text_name")).alias("name")).distinct()
    found = documents.select(text.alias("text")).withColumn("name", F.xxhash64("text")).join(wanted, "name").dropDuplicates(["name"])
    pairs = rows.join(found.select(F.col("name").alias("text_name"), "text"), "text_name")
    pairs = pairs.join(found.select(F.col("name").alias("next_text_name"), F.col("text").alias("next_text")), "next_text_name")
    versions = [F.col("text"), half_replaced(F.col("text"), F.col("next_text")), F.col("next_text")]
    # The empty word stays, so that a row without words has its place.
    each = pairs.select("at", "rank", F.posexplode(F.array(*[F.array_union(F.array(F.lit("")), words(v)) for v in versions])).alias("version", "words"))
    each = each.select("at", "rank", "version", F.explode("words").alias("word")).withColumn("term", F.xxhash64("word"))
    each = each.join(F.broadcast(known), "term", "left").where("inside is null or not inside")
    # A term that the lexicon lacks is rarer than all that it holds.
    term = F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term")
    sets = [F.collect_set(F.when((F.col("version") == v) & (F.col("word") != ""), term)).alias(f"outside_{v}") for v in range(3)]
    each = each.groupBy("at", "rank").agg(*sets)

    def rarest(v: int) -> Column:
        first = F.slice(F.sort_array(F.col(f"outside_{v}")), 1, RAREST)
        return F.sort_array(F.transform(first, lambda r: F.struct(F.lit(v).alias("version"), subset_of(r["term"]).alias("subset"), r["term"].alias("term"))))

    marks = [of_version(hashed(rarest(v)), v).alias(f"{c}_rare") for v, c in enumerate(("own", "changed", "following"))]
    return common.keep(each.select("at", "rank", *marks), "imatch-rarest")


def fingerprints(documents: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each row.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many of the next row's text, in
    descending doc_id; after the last row comes the first. A row without doc_id comes after all others, equal ids in the order of
    their texts; a null text is empty. A text without a term of the band has the fingerprint of its rarest terms, and only one
    without words has an empty fingerprint: its likeness to another empty one is 1, to any other 0. Repeated rows are returned as often as they came. An
    empty table gives an empty result.
    """
    rows = with_next(documents)
    n = F.length("text")
    rows = rows.withColumn("edited", half_replaced(F.col("text"), F.col("next_text")))
    key = ["at", "rank"]
    has = [F.col(c).rlike(r"[\p{L}\p{N}]").alias(f"{c}_has") for c in ("text", "edited")]
    names = [F.xxhash64(c).alias(f"{c}_name") for c in ("text", "next_text")]
    info = F.struct("doc_id", "next_at", "next_rank", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), *has, *names)

    def version(number: int, found: Column, more: Column) -> Column:
        return F.struct(F.lit(number).alias("version"), found.alias("words"), more.alias("info"))

    nothing = F.when(F.lit(False), info)
    both = [version(-1, F.array(F.lit("")), info), version(0, words(F.col("text")), nothing), version(1, words(F.col("edited")), nothing)]
    each = rows.select(*key, F.inline(F.array(*both))).select(*key, "version", "info", F.explode("words").alias("word"))
    each = each.where("version = -1 or word <> ''").withColumn("term", F.xxhash64("word")).drop("word")
    known = common.keep(lexicon(documents, band), "imatch-lexicon")
    inside = known.where("inside").select("term", subset_of(F.col("term")).alias("subset"))
    each = each.join(F.broadcast(inside), "term", "left").where("version = -1 or subset is not null")
    pairs = F.sort_array(F.collect_set(F.when(F.col("version") >= 0, F.struct("version", "subset", "term")))).alias("pairs")
    # Rows are dealt by `at` already, so this needs no exchange.
    docs = each.groupBy(*key).agg(F.first("info", ignorenulls=True).alias("info"), pairs)
    docs = docs.select(*key, "info.*", hashed(F.col("pairs")).alias("marks"))
    docs = common.keep(docs, "imatch")
    docs = docs.select("*", of_version(F.col("marks"), 0).alias("own"), of_version(F.col("marks"), 1).alias("changed")).drop("marks")
    following = docs.select(F.col("at").alias("next_at"), F.col("rank").alias("next_rank"), F.col("own").alias("following"), F.col("text_has").alias("following_has"))
    out = docs.join(following, ["next_at", "next_rank"], "left")
    lacks = [(F.size(a) == 0) & F.col(b) for a, b in (("own", "text_has"), ("changed", "edited_has"), ("following", "following_has"))]
    rare = by_rarest(documents, out.where(lacks[0] | lacks[1] | lacks[2]).select(*key, "text_name", "next_text_name"), known)
    out = out.join(rare, key, "left")

    def printed(name: str) -> Column:
        return F.array_join(F.when((F.size(name) == 0) & F.col(f"{name}_rare").isNotNull(), F.col(f"{name}_rare")).otherwise(F.col(name)), ",")

    def alike(a: str, b: str) -> Column:
        rarest = F.col("own_rare").isNotNull() & ((F.size(a) == 0) | (F.size(b) == 0))
        # A text of terms of the band alone is not like one without words.
        unlike = (F.size(f"{a}_rare") + F.size(f"{b}_rare") == 0) & (F.size(a) + F.size(b) > 0)
        of_rare = F.when(unlike, F.lit(0.0)).otherwise(likeness(F.col(f"{a}_rare"), F.col(f"{b}_rare")))
        return F.when(rarest, of_rare).otherwise(likeness(F.col(a), F.col(b)))

    return out.select(
        "doc_id", "n_chars", "edited_sha256", printed("own").alias("fingerprint"), printed("changed").alias("edited_fingerprint"),
        alike("own", "changed").alias("near_edited"), alike("own", "following").alias("near_next"),
    )
