"""One query for each operator, over its whole table, and SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import fp_search, imatch, merkle, mixing, ngram_join, packing, pii, quality_fm, secrets, suffix_dedup, toxicity, url_filter, vp_search
from sluice.llm.common import documents

#: Pruning as in exact search: on vectors of many even dimensions, larger factors lose answers and save nothing.
FACTOR = 1.0


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(documents(spark, sf_dir))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vp_search.nearest(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20, FACTOR)


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_fm.quality(docs, quality_fm.fit(docs, documents(spark, sf_dir, "labels")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.toxicity(docs, toxicity.fit(docs, documents(spark, sf_dir, "labels")))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filtered(documents(spark, sf_dir, "pages")).drop("score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_search.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir)).drop("copied")


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_join, op2_suffix_dedup, op3_pii, op4_nearest, op5_imatch, op6_quality, op7_packing, op8_toxicity, op9_url_filter, op10_mixing,
        op11_ranked_search, op12_secrets, op13_merkle,
    )
}


def _mixing_sql() -> str:
    text = "coalesce(text, '')"
    steps = [
        f"""rows_ AS (SELECT doc_id, coalesce(source, 'unknown') AS source, coalesce(lang, 'unknown') AS lang,
          CASE WHEN contains({text}, ' | ') THEN 'table' WHEN contains({text}, '!!') THEN 'shouting'
               WHEN contains({text}, chr(10) || '- ') OR contains({text}, chr(10) || '* ') THEN 'list'
               WHEN contains({text}, '?') THEN 'question' WHEN length({text}) < 600 THEN 'note' ELSE 'article' END AS topic,
          greatest(len(regexp_extract_all({text}, '[^\\x20\\t\\n\\x0b\\f\\r]+')), 1)::BIGINT AS tokens FROM documents)""",
        "cells AS (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM rows_ GROUP BY ALL)",
        "everything AS (SELECT sum(tokens)::DOUBLE AS all_tokens FROM cells)",
    ]
    for side in mixing.SIDES:
        steps.append(f"p_{side} AS (SELECT {side}, pow(sum(tokens)::DOUBLE, {mixing.FLATTEN}) AS weight FROM cells GROUP BY {side})")
        steps.append(f"t_{side} AS (SELECT {side}, weight / sum(weight) OVER () AS target FROM p_{side})")
        # As in the code: pulls, and what their room lets through.
        steps.append(
            f"u_{side}_0 AS MATERIALIZED (SELECT {side}, target AS pull, sum(tokens)::DOUBLE / (sum(sum(tokens)) OVER ()::DOUBLE * {mixing.BUDGET}) AS room"
            f" FROM cells JOIN t_{side} USING ({side}) GROUP BY {side}, target)"
        )
        for turn in range(mixing.ROUNDS):
            steps.append(f"u_{side}_{turn + 1} AS MATERIALIZED (SELECT {side}, pull / sum(least(pull, room)) OVER () AS pull, room FROM u_{side}_{turn})")
    targets = ", ".join(f"least(u_{s}_{mixing.ROUNDS}.pull, u_{s}_{mixing.ROUNDS}.room) AS to_{s}" for s in mixing.SIDES)
    joins = " ".join(f"JOIN u_{s}_{mixing.ROUNDS} USING ({s})" for s in mixing.SIDES)
    steps.append(
        f"r0 AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens / all_tokens AS pull, tokens / (all_tokens * {mixing.BUDGET}) AS cell_room, {targets}"
        f" FROM cells {joins}, everything)"
    )
    now = 0
    for _ in range(mixing.ROUNDS):
        for side in mixing.SIDES:
            steps.append(
                f"r{now + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(least(pull, cell_room)) OVER (PARTITION BY {side}) > 0"
                f" THEN pull * to_{side} / sum(least(pull, cell_room)) OVER (PARTITION BY {side}) ELSE 0.0 END AS pull) FROM r{now})"
            )
            now += 1
    steps.append(
        f"final AS (SELECT source, lang, topic, round(least(pull, cell_room), 9) AS weight,"
        f" round(least(pull, cell_room) * {mixing.BUDGET} * all_tokens / tokens, 6) AS probability FROM r{now}, everything)"
    )
    draw = "('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 8))::UBIGINT::DOUBLE / 4294967296"
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, source, lang, topic, tokens, weight, probability,"
        f" coalesce({draw}, 0.0) < probability AS kept FROM rows_ JOIN final USING (source, lang, topic)"
    )


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SEARCH = f"""
    WITH terms AS (SELECT doc_id, unnest(regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
    asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_FOLDED}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
    sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM terms GROUP BY doc_id),
    totals AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM sizes),
    counts AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM terms SEMI JOIN asked USING (term) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term),
    gains AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms))) AS gain
      FROM counts JOIN sizes USING (doc_id) JOIN weights USING (term), totals),
    scores AS (SELECT item_id, doc_id, sum(gain)::BIGINT AS score FROM asked JOIN gains USING (term) GROUP BY ALL HAVING sum(gain) > 0),
    ranks AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores)
    SELECT item_id, rank, doc_id, score FROM ranks WHERE rank <= 10"""


def _secrets_sql() -> str:
    """Positions are sums of the lengths of the pieces between matches and of the matches before."""
    letters = "([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    patterns = {"assign": letters + """["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+"}
    least = {"access": 18, "hex": 16}
    patterns |= {r.kind: r.pattern for r in secrets.RULES if not r.base}
    least |= {r.kind: r.least for r in secrets.RULES if not r.base}
    steps = ["texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents)"]
    for n, (kind, pattern) in enumerate(patterns.items()):
        passes = f"length(regexp_extract(hit, '{pattern}', 2)) >= 12" if kind == "assign" else f"length(hit) >= {least[kind]}"
        steps.append(
            f"m{n} AS (SELECT r, unnest(h) AS hit, unnest(p) AS gap, generate_subscripts(h, 1) AS i FROM (SELECT r, regexp_extract_all(text, '{pattern}') AS h,"
            f" regexp_split_to_array(text, '{pattern}') AS p FROM texts WHERE regexp_matches(text, '{pattern}')) WHERE true),\n"
            f"e{n} AS (SELECT r, hit, sum(length(gap) + coalesce(length(hit), 0)) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING)::BIGINT AS last FROM m{n}),\n"
            f"s{n} AS (SELECT r, {n} AS k, '{kind}' AS kind, last - length(hit) AS first, last FROM e{n} WHERE hit IS NOT NULL AND {passes})"
        )
    base, more = (" UNION ALL ".join(f"SELECT * FROM s{n}" for n in some) for some in (range(3), range(3, len(patterns))))
    steps.append(f"base AS ({base})")
    steps.append(f"more AS (SELECT * FROM ({more}) m WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = m.r AND b.first < m.last AND m.first < b.last))")
    word = "string_agg(kind || ':' || first || ':' || last, ',' ORDER BY first, k)"
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind in ("assign", "access", "hex"))
    steps.append(f"b AS (SELECT r, {counts}, {word} AS w FROM base GROUP BY r)")
    steps.append(f"a AS (SELECT r, {word} AS w FROM (SELECT * FROM base UNION ALL SELECT * FROM more) GROUP BY r)")
    found = ", ".join(f"coalesce(n_{kind}, 0)::BIGINT AS n_{kind}" for kind in ("assign", "access", "hex"))
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, {found}, sha256(coalesce(b.w, '')) AS base_sha256, coalesce(a.w, '') AS spans"
        " FROM texts LEFT JOIN b USING (r) LEFT JOIN a USING (r)"
    )


def _merkle_sql(levels: int = 6) -> str:
    """Enough levels for 16 ** levels rows of a source, and as many sources; a key that has one node left keeps it."""
    value = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    head = " || ".join(value(c) for c in merkle.FIELDS[:-1])
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]), lambda x, y: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))"
    codes = "list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::UBIGINT)"
    crc = f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda a, b: {bits}), 4294967295::UBIGINT)"
    steps = [
        f"l AS MATERIALIZED (SELECT doc_id, coalesce('+' || source, '') AS key, sha256({head} || {value('text')}) AS leaf,"
        f" CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {value(low)}) END AS bad FROM documents)",
        "a0 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM l)",
        "n0 AS MATERIALIZED (SELECT key, place, leaf AS d FROM a0)",
    ]

    def level(now: str, new: str) -> None:
        run = "PARTITION BY key, place // 16 ORDER BY place ROWS BETWEEN"
        steps.append(
            f"s{now} AS MATERIALIZED (SELECT key, place, d, count(*) OVER (PARTITION BY key) AS n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS le,"
            f" coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS ri FROM n{now})"
        )
        steps.append(f"n{new} AS MATERIALIZED (SELECT key, place // 16 AS place, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY place)) ELSE any_value(d) END AS d FROM s{now} GROUP BY key, place // 16)")

    for i in range(levels):
        level(str(i), str(i + 1))
    steps.append(f"nt0 AS MATERIALIZED (SELECT '' AS key, row_number() OVER (ORDER BY key) - 1 AS place, d, key AS source_key FROM n{levels})")
    for i in range(levels):
        level(f"t{i}", f"t{i + 1}")
    steps.append(f"f0 AS MATERIALIZED (SELECT a0.*, nt0.place AS source_place, nt0.d AS subroot, coalesce(bad, leaf) AS fold, '' AS proof FROM a0 JOIN nt0 ON nt0.source_key = a0.key)")
    for i in range(2 * levels):
        of, place, key = (f"s{i}", f"f.place // {16 ** i}", "f.key") if i < levels else (f"st{i - levels}", f"f.source_place // {16 ** (i - levels)}", "''")
        steps.append(
            f"f{i + 1} AS MATERIALIZED (SELECT f.* REPLACE (CASE WHEN s.n > 1 THEN sha256(s.le || f.fold || s.ri) ELSE f.fold END AS fold, f.proof || s.le || s.ri AS proof)"
            f" FROM f{i} f JOIN {of} s ON s.key = {key} AND s.place = {place})"
        )
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT doc_id, leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = r.d AS verified"
        f" FROM f{2 * levels}, nt{levels} r"
    )


STATEMENTS = {
    "op1_ngram_join": """
        WITH RECURSIVE split AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        sets AS (
          SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split),
        sizes AS (SELECT doc_id, len(s) AS n FROM sets),
        grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
        common_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM common_ JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
        sides_ AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach AS (SELECT doc_id AS d, doc_id AS r FROM sizes UNION SELECT reach.d, sides_.b FROM reach JOIN sides_ ON reach.r = sides_.a)
        SELECT d AS doc_id, any_value(n)::BIGINT AS n_shingles, min(r) AS component_id FROM reach JOIN sizes ON sizes.doc_id = d GROUP BY d""",
    "op4_nearest": """
        WITH good AS (
          SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        pairs AS (
          SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
            list_reduce(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]), lambda x, y: x + y) AS score
          FROM good q JOIN good c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM pairs)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op10_mixing": _mixing_sql(),
    "op11_ranked_search": _SEARCH,
    "op12_secrets": _secrets_sql(),
    "op13_merkle": _merkle_sql(),
}
