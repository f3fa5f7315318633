"""Operators of the training-data pipeline against brute force on small fixtures with every awkward case."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import common, imatch, mixing, ngram_join, packing, pii, quality_fm, run_index, suffix_dedup, toxicity, url_filter, vp_search

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, rid string, kind string"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéü") for _ in range(r.randint(2, 8))) for _ in range(words))


def texts() -> list[str | None]:
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    return [
        None, "", "   \n", "one two", "One TWO", base, base, " ".join(near), base + " " + prose(2, 300), prose(3, 4000),
        "la la " * 400, prose(4, 50) + base[:400], "x" * 5000, prose(5, 9) + " mail a@b.co +1 555 123 4567 8.8.8.8",
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, len(t or ""), "k", "r", "z") for i, t in enumerate(texts())]
    rows.append(rows[5])  # a repeated row
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def word_sets(found):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for t in found:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        yield {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} - {()}


def test_ngram_join(docs, empty):
    got = {tuple(r) for r in ngram_join.ngram_join(docs).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sets = list(word_sets(t for _, t in rows))
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root = [root[j] if x == root[i] else x for x in root]
    least = {}
    for r, (i, _) in zip(root, rows, strict=True):
        least[r] = min(least.get(r, i), i)
    assert got == {(i, len(s), least[r]) for (i, _), s, r in zip(rows, sets, root, strict=True)}
    assert ngram_join.ngram_join(empty).count() == 0
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))


def test_row_without_id_is_returned(spark):
    rows = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, "")], "doc_id bigint, text string")
    assert Counter(map(tuple, ngram_join.ngram_join(rows).collect())) == Counter([(None, 2, 3), (3, 2, 3), (None, 0, None)])


@pytest.mark.parametrize("mode", [ngram_join.TREE, ngram_join.NEAREST, ngram_join.ALL])
def test_pairs_of_a_block(mode):
    """A tree connects what all pairs connect; each set has its nearest one."""
    grams = [np.sort(np.random.default_rng(k // 4).integers(0, 2**63, 100, dtype=np.uint64)) for k in range(12)]
    import pyarrow as pa

    sets = pa.record_batch({"key": list(range(12)), "n": [100] * 12, "grams": [g.tobytes() for g in grams]})
    drawn = next(ngram_join.sketches(2)(iter([sets])))
    same = {"mark": [1] * 12, "low": [0] * 12, "high": [0] * 12, "root": list(range(12)), "side": [0] * 12}
    batch = pa.record_batch(same | {"key": drawn["key"], "n": drawn["n"], "sketch": drawn["sketch"]})
    given = {p for b in ngram_join.block_pairs(75, mode)(iter([batch])) for p in zip(*b.to_pydict().values(), strict=True)}
    pairs = {p[1:] for p in given if not p[0]}
    assert {p[1:] for p in given if p[0]} == ({(1, k) for k in range(12)} if mode == ngram_join.TREE else set())
    every = {(a, b) for a in range(12) for b in range(a + 1, 12) if a // 4 == b // 4}
    assert pairs == every if mode == ngram_join.ALL else pairs <= every
    assert mode != ngram_join.TREE or len(pairs) == 9
    assert mode != ngram_join.NEAREST or {k for p in pairs for k in p} == set(range(12))


def test_split_by_a_bitmap(spark):
    """No key is missed, few others pass, and the rows are not exchanged."""
    rows = spark.range(40_000).select(F.when(F.col("id") > 0, F.col("id") * 7919 - 50_000_000).alias("x"), F.lit("text").alias("text"))
    wanted = rows.where("x % 50 = 0 OR x IS NULL").select(F.col("x").alias("y"))
    asked, others = common.split(rows, "x", wanted)
    keys, found = {r["y"] for r in wanted.collect()}, Counter(r["x"] for r in asked.collect())
    assert None in keys and keys <= set(found) and len(found) < len(keys) + 100
    assert Counter(r["x"] for r in others.collect()) + found == Counter(r["x"] for r in rows.collect())
    assert asked.columns == rows.columns and "Join LeftSemi" in asked._jdf.queryExecution().optimizedPlan().toString()
    assert "SortMergeJoin" not in asked._jdf.queryExecution().executedPlan().toString()
    none, every = common.split(rows, "x", wanted.limit(0))
    assert none.count() == 0 and every.count() == 40_000


@pytest.mark.parametrize("owners", [1 << 24, 1])
def test_counts_of_a_block(owners, monkeypatch):
    """How many n-grams of a class another class has, in whichever way they are sorted, within 32 bytes an n-gram."""
    import tracemalloc

    monkeypatch.setattr(ngram_join, "OWNERS", owners)
    r = np.random.default_rng(5)
    grams = {k: r.integers(0, 2**40, 400, dtype=np.uint64) for k in range(2000)}
    for k in range(0, 2000, 4):
        grams[k + 1][:100] = grams[k][:100]
    low = lambda g: np.ascontiguousarray(g).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
    parts = [list(grams)[k : k + 100] for k in range(0, 2000, 100)] + [[0, 7]]  # two classes come twice
    rows = {"kind": [ngram_join.POSTED] * len(parts) + [ngram_join.REPEATED], "block": [1] * (len(parts) + 1)}
    rows["grams"] = [b"".join(low(grams[k]) for k in part) for part in parts] + [low(grams[3][:5])]
    rows["owners"] = [np.array(part, np.uint64).tobytes() for part in parts] + [None]
    rows["counts"] = [np.full(len(part), 400, np.uint32).tobytes() for part in parts] + [None]
    batch = common.record(ngram_join.INCIDENCE, **{f.name: rows.get(f.name, [None] * (len(parts) + 1)) for f in ngram_join.INCIDENCE})
    tracemalloc.start()
    found = {row["key"]: row["shared"] for b in ngram_join.accumulate(iter([batch])) for row in b.to_pylist()}
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {k: 5 if k == 3 else 100 for k in range(2000) if k % 4 < 2 or k == 3}
    assert owners == 1 or most < 32 * 800_000, most / 800_000


def test_lone_texts_are_not_exchanged(spark, monkeypatch):
    """Of 200 texts, 4 are near copies: no join meets more than their texts and sets, and a few that share a bit with one."""
    words = prose(7, 200).split()
    near = [" ".join([*words[:k], "changed", *words[k + 1 :]]) for k in (60, 80, 100, 120)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([*near, *(prose(100 + k, 40) for k in range(196)), "", None])], "doc_id bigint, text string")
    met, split = [], common.split

    def counted(frame, column, keys):
        asked, others = split(frame, column, keys)
        met.append((column, asked.count()))
        return asked, others

    monkeypatch.setattr(ngram_join.common, "split", counted)
    kept = ngram_join.one_of_each(rows).collect()
    assert Counter(r["doc_id"] for r in kept) == Counter([0, *range(4, 202)])
    assert {column for column, _ in met} == {"name", "key"} and max(n for _, n in met) < 10


def test_pairs_of_two_ranges(spark, monkeypatch):
    """Where an n-gram has several ranges of members, similar sets meet whatever the sizes of their sketches."""
    monkeypatch.setattr(ngram_join, "MEMBERS", 4)
    r = np.random.default_rng(3)
    base = r.integers(0, 2**63, 60, dtype=np.uint64)
    grams = {k: np.sort(np.concatenate([base, r.integers(0, 2**63, k % 10, dtype=np.uint64)])) for k in range(24)}
    sets = spark.createDataFrame([(k, len(g), bytearray(g.tobytes())) for k, g in grams.items()], "key bigint, n bigint, grams binary")
    rows = ngram_join.open_marks(sets.mapInArrow(ngram_join.prefix_rows(75, np.zeros(ngram_join.FREQUENCIES, np.uint8)), "mark bigint, key bigint, n bigint"), spark.createDataFrame([], "id bigint, root bigint"))
    drawn = sets.mapInArrow(ngram_join.sketches(2), "key bigint, n bigint, sketch binary")
    got = {tuple(p)[1:] for p in ngram_join.candidates_of(rows, drawn, 75, ngram_join.ALL).collect()}
    assert {len(g) > 64 for g in grams.values()} == {True, False}
    links = {(a, b) for a in grams for b in grams if a < b and 175 * len(np.intersect1d(grams[a], grams[b])) >= 75 * (len(grams[a]) + len(grams[b]))}
    assert len(links) == 276 and links <= got


def test_rows_without_id_link_their_neighbours(spark):
    """A and B are similar to C alone, whose row has no id."""
    words = [f"w{k}" for k in range(104)]
    a, c, b = (" ".join(words[k : k + 84]) for k in (0, 8, 16))
    sets = list(word_sets([a, c, b]))
    near = lambda x, y: len(x & y) / len(x | y) >= 0.75
    assert near(sets[0], sets[1]) and near(sets[1], sets[2]) and not near(sets[0], sets[2])
    rows = spark.createDataFrame([(1, a), (None, c), (2, b)], "doc_id bigint, text string")
    assert {r["component_id"] for r in ngram_join.ngram_join(rows).collect()} == {1}
    alone = spark.createDataFrame([(None, a), (None, c)], "doc_id bigint, text string")
    assert {r["component_id"] for r in ngram_join.ngram_join(alone).collect()} == {None}
    assert ngram_join.one_of_each(alone).count() == 1 and ngram_join.one_of_each(rows).first()["doc_id"] == 1


def test_one_id_on_all_rows(spark):
    """Near copies and other texts of one id: each row is judged by its own text, and joins its class only."""
    words = prose(7, 200).split()
    near = [" ".join([*words[:k], "changed", *words[k + 1 :]]) for k in range(60, 140)]
    other = [prose(100 + k, 40) for k in range(20)]
    rows = spark.createDataFrame([(5, t, k % 3, "x") for k, t in enumerate([*near, *other])], "doc_id bigint, text string, kept_id bigint, row string")
    found = ngram_join.ngram_join(rows).collect()
    assert len(found) == 100 and {r["component_id"] for r in found} == {5}
    kept = ngram_join.one_of_each(rows)
    assert kept.columns == rows.columns and kept.count() == 21
    assert {r["text"] for r in kept.collect()} >= set(other)


def brute_cut(found, length):
    raw = [(t or "").encode() for t in found]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        yield len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("fine", [8192, 0])
def test_suffix_dedup(docs, empty, fine, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "FORMS", fine)
    got = Counter(tuple(r) for r in suffix_dedup.suffix_dedup(docs).collect())
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got == Counter((i, *x) for (i, _), x in zip(rows, brute_cut([t for _, t in rows], 200), strict=True))
    assert suffix_dedup.suffix_dedup(empty).count() == 0


@pytest.mark.parametrize("forms", [3, 20])
def test_frequent_passage_is_bounded(spark, forms, monkeypatch):
    """A passage in many documents with different neighbours is never one large group of an index."""
    monkeypatch.setattr(suffix_dedup, "FORMS", forms)
    index = suffix_dedup.marked

    def bounded(length):
        def work(batches):
            def checked():
                deals = Counter()
                for batch in batches:
                    deals.update(batch.column("deal").to_pylist())
                    assert max(deals.values(), default=0) <= forms
                    yield batch

            yield from index(length)(checked())

        return work

    monkeypatch.setattr(suffix_dedup, "marked", bounded)
    middle = prose(70, 80)
    found = [prose(100 + i, 30) + middle + prose(300 + i, 30) for i in range(60)] + [middle[:230] + prose(500 + i, 40) for i in range(8)]
    rows = spark.createDataFrame(list(enumerate(found)), "doc_id bigint, text string")
    got = Counter(tuple(r) for r in suffix_dedup.suffix_dedup(rows).collect())
    assert got == Counter((i, *x) for i, x in enumerate(brute_cut(found, 200)))


def test_matching_statistics():
    r = random.Random(4)
    passages = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 60))) for _ in range(12)]
    best, begin = run_index.matching_statistics(passages)
    for k, p in enumerate(passages):
        for i in range(len(p)):
            want = max(n for n in range(len(p) - i + 1) if n == 0 or sum(q[j : j + n] == p[i : i + n] for q in passages for j in range(len(q) - n + 1)) > 1)
            assert best[begin[k] + i] == want


def base_spans(text):
    rules = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
    for kind, rule in rules:
        for m in re.finditer(rule, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            if kind == "email" or (kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))) or (kind == "card" and 13 <= len(d) <= 19 and luhn) or (kind == "phone" and 9 <= len(d) <= 15):
                yield kind, m.start(), m.end()


def test_pii(spark, docs, empty):
    hard = ["a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.1.1 0001.2.3.255", "4111 1111 1111 1111 2 4111111111111111 5", "é +1 (555) 123-4567 +12", "9" * 3000 + " " + "a." * 3000, "4111-1111-1111-1111\n"]
    rows = docs.unionByName(spark.createDataFrame([(100 + i, t, None, None, 0, "", "", "") for i, t in enumerate(hard)], DOCUMENTS))
    source = {r["doc_id"]: r["text"] for r in rows.collect()}
    for r in pii.find_pii(rows).collect():
        spans = list(base_spans(source[r["doc_id"]]))
        assert hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest() == r["base_sha256"]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in spans} <= set(r["spans"].split(",")) | {""}
    assert pii.find_pii(empty).count() == 0
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs).collect()}
    assert clean[13].endswith("mail <EMAIL> <PHONE> <IP>") or "<EMAIL>" in clean[13]
    assert clean[0] == "" and clean[3] == "one two"


def test_nearest(spark):
    r = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in r.normal(size=8)]) for i in range(700)]
    rows += [(1000, rows[20][1]), (1001, rows[20][1]), (1002, None), (1003, [0.0] * 8), (1004, [float("nan")] * 8), (1005, [None] * 8), (1020, []), rows[40]]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = vp_search.nearest(table, F.col("vec_id") % 20 == 0).collect()
    good = {i: np.array(v) for i, v in rows if v and i not in (1003, 1004, 1005)}
    want = set()
    for q in (i for i in good if i % 20 == 0):
        near = sorted((-float(sum(a * b for a, b in zip(good[q], v, strict=True))), i) for i, v in good.items() if i != q)[:20]
        want |= {(q, k + 1, i) for k, (_, i) in enumerate(near)}
    assert {(x["query_id"], x["rank"], x["vec_id"]) for x in got} == want and len(got) == len(want)
    relaxed = vp_search.nearest(table, F.col("vec_id") % 20 == 0, factor=2.0).collect()
    assert len({(x["query_id"], x["vec_id"]) for x in relaxed} & {(q, i) for q, _, i in want}) >= 0.9 * len(want)
    assert vp_search.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_imatch(docs, empty, monkeypatch):
    monkeypatch.setattr(imatch, "BUCKET_BYTES", 200)
    got = sorted(map(tuple, imatch.fingerprints(docs).select("doc_id", "n_chars", "edited_sha256").collect()))
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (-r[0], r[1]))
    want = []
    for k, (i, t) in enumerate(rows):
        half, after = len(t) // 2, rows[(k + 1) % len(rows)][1]
        want.append((i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    assert got == sorted(want)
    prints = imatch.fingerprints(docs).collect()
    by_text = {}
    for r in prints:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text.setdefault(dict(rows)[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert imatch.fingerprints(empty).count() == 0


def test_imatch_tells_copies_from_unrelated_texts(spark):
    """Many copies, or terms that are all common or all rare, leave no text with words without a fingerprint of its own."""
    group, other, common_words = prose(600, 60), prose(601, 60), [prose(602, 40), prose(603, 40)]
    filler = [prose(1000 + i, 12) for i in range(300)]
    found = [group] * 200 + [group + " extra"] + [other, *common_words, "", "  "] + filler
    rows = spark.createDataFrame(list(enumerate(found)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in imatch.fingerprints(rows).collect()}
    assert all((r["fingerprint"] == "") == (not found[i].strip()) for i, r in got.items())
    assert got[0]["fingerprint"] not in {got[201]["fingerprint"], got[202]["fingerprint"]}
    # descending ids: the next row of i is i - 1
    assert got[5]["near_next"] == 1 and got[201]["near_next"] < 0.2 and got[203]["near_next"] < 0.2
    assert got[200]["near_next"] > 0.5 and got[5]["near_edited"] > 0
    distinct = len(set(found))
    lexicon = {r["term"]: r["df"] for r in imatch.lexicon(rows).collect()}
    assert max(lexicon.values()) <= distinct


def test_classifiers(spark, docs, empty):
    many = [(i, prose(i, 60) + (" BAD!! WORDS!!" * 20 if i % 2 else ""), None, None, 0, "", "", "") for i in range(300)]
    table = spark.createDataFrame(many, DOCUMENTS)
    labels = spark.createDataFrame([(i, 1 - i % 2, i % 2) for i in range(300)] + [(None, 1, 1), (5, None, None)], "doc_id bigint, quality int, toxic int")
    for fit, run, label, fold in ((quality_fm.fit, quality_fm.quality, 0, lambda i: zlib.crc32(str(i).encode()) % 5 == 0), (toxicity.fit, toxicity.toxicity, 1, lambda i: zlib.crc32(str(i).encode()) % 3 == 1)):
        model = fit(table, labels)
        rows = run(table, model).collect()
        assert all(r["held_out"] == fold(r["doc_id"]) for r in rows)
        held = [r for r in rows if r["held_out"]]
        assert np.mean([(r["predicted"] == 1) == (r["doc_id"] % 2 == label) for r in held]) > 0.95
        assert run(docs, model).count() == docs.count() and run(empty, model).count() == 0
        assert run(docs, fit(docs, labels.limit(0))).count() == docs.count()


def test_sum_of_squares_identity():
    r = np.random.default_rng(1)
    machine = quality_fm.Machine(0.1, r.normal(size=quality_fm.CELLS).astype(np.float32) * 0.01, r.normal(size=(quality_fm.CELLS, 8)).astype(np.float32) * 0.1)
    raw = b"Alpha beta beta GAMMA | 12"
    data, at = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    cells, values, _ = quality_fm.features(data, at)
    v = machine.factors[cells].astype(float) * values[:, None]
    pairs = sum(v[i] @ v[j] for i in range(len(v)) for j in range(i))
    want = 1 / (1 + np.exp(-(machine.bias + machine.linear[cells].astype(float) @ values + pairs)))
    assert abs(machine.score(data, at)[0] - want) < 1e-6


def test_nearest_with_many_ties(spark, monkeypatch):
    """Different vectors with equal scores: the smaller id comes first, in every shard."""
    monkeypatch.setattr(vp_search, "SHARD", 300)
    r = np.random.default_rng(2)
    vectors = [v for v in r.integers(-1, 2, (1200, 8)).astype(float) if v.any()]
    ids = r.permutation(len(vectors)).tolist()
    table = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id bigint, embedding array<double>")
    got = {(row["query_id"], row["rank"]): (row["vec_id"], row["score"]) for row in vp_search.nearest(table, F.col("vec_id") % 20 == 0, 20, 1.0).collect()}
    matrix, order = np.array(vectors), np.array(ids)
    for i in np.flatnonzero(order % 20 == 0):
        score = matrix @ matrix[i]
        best = [j for j in np.lexsort((order, -score)) if j != i][:20]
        assert [got[order[i], k + 1] for k in range(20)] == [(order[j], score[j]) for j in best]


def test_packing(docs, empty, spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    more = docs.unionByName(spark.createDataFrame([(50, "a<|endoftext|>b 日本 \U0001f600", "", "", 0, "", "", ""), (None, "x", "", "", 0, "", "", "")], DOCUMENTS))
    rows = packing.packed(more, with_ids=True).collect()
    ids = {r["doc_id"]: [*whole.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in more.collect()}
    taken = Counter()
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        raw = np.array(part, "<u4").tobytes()
        assert len(part) == r["length"] and zlib.crc32(raw) == r["ids_crc32"] and raw == bytes(r["ids"])
        assert r["length"] == 1024 or r["piece"] == 0
        taken[r["doc_id"]] += r["length"]
    assert all(taken[i] == len(x) * (2 if i == 5 else 1) for i, x in ids.items())
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    fill = Counter()
    for sequence, offset, length in places:
        assert fill[sequence] == offset
        fill[sequence] += length
    assert max(fill.values()) <= 1024 and packing.packed(empty).count() == 0


def test_plan_is_best_fit():
    r = random.Random(9)
    lengths = [r.randint(1, 100) for _ in range(400)]
    places = packing.plan(Counter(lengths), 100)
    room = []
    for n in sorted(lengths, reverse=True):
        fit = min((x for x in room if x >= n), default=None)
        if fit is None:
            room.append(100 - n)
        else:
            room[room.index(fit)] -= n
    used = {s + k for _, _, n, s, _ in places for k in range(n)}
    assert len(used) <= len(room)


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://A.Org/x?y", "https://sub.example.org/es/1", "http://example.org/en/12#x", "http://x.com/fr/", "http://x.com/de", "http://com/fr/?q", "http://notorg/x", "http://b.net", "ftp://x.com?a/fr/", "http://org", "http://x.com/de/a", "http://com/dental"]
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(urls)], "page_id bigint, url string, html string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filtered(pages).collect()}
    want = {3: ("a.org", "/x", "org/", "allow"), 4: ("sub.example.org", "/es/1", "example.org/es/", "block"), 5: ("example.org", "/en/12", "example.org/en/1", "block"), 6: ("x.com", "/fr/", "com/fr/", "allow"), 8: ("com", "/fr/", "com/fr/", "allow"), 13: ("x.com", "/de/a", "com/de/", "block")}
    assert {i: got[i] for i in want} == want
    assert got[7][:3] == ("x.com", "/de", None) and got[14][:3] == ("com", "/dental", None)
    assert all(got[i][:3] == ("", "", None) for i in (0, 1, 2))
    assert got[9][2] is None and got[10][:3] == ("b.net", "", None) and got[11][:3] == ("x.com", "", None) and got[12][2] is None
    assert all(v[3] in ("allow", "block") for v in got.values())
    assert url_filter.filtered(pages.limit(0)).count() == 0


def test_mixing(docs, empty):
    rows = mixing.mixed(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["probability"] <= 1 for r in rows)
    assert {r["source"] for r in rows} == {"s", mixing.UNKNOWN}
    cells = docs.transform(mixing.described).groupBy(*mixing.SIDES).agg(F.sum("tokens").alias("tokens"))
    targets = {s: mixing.flattened(cells, s) for s in mixing.SIDES}
    raked = mixing.raked(cells, targets, 64).groupBy("source").agg(F.sum("weight").alias("w")).collect()
    want = {r["source"]: r["target"] for r in targets["source"].collect()}
    assert all(abs(r["w"] - want[r["source"]]) < 0.05 for r in raked)
    assert mixing.mixed(empty).count() == 0 and mixing.sampled(docs).columns == docs.columns


def test_mixing_reaches_what_the_cells_can_give(spark, docs):
    """Probabilities before any rounding are 1 at most; the marginals of tokens times probability are the reachable targets."""
    rows = [(s, l, t, 1 + (i * 7919) % 500 * (60 if s == "hot" else 1)) for i, (s, l, t) in enumerate((s, l, t) for s in ("hot", "a", "b", "c") for l in ("en", "de", "fr") for t in ("x", "y"))]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens bigint")
    whole = sum(r[3] for r in rows)
    aims = {side: common.keep(mixing.reachable(cells, side, mixing.flattened(cells, side), 0.6), "test-aims") for side in mixing.SIDES}
    kept = mixing.raked(cells, aims, 32, 0.6).collect()
    assert all(r["weight"] * 0.6 * whole <= r["tokens"] * (1 + 1e-12) for r in kept)
    assert any(r["weight"] * 0.6 * whole > r["tokens"] * 0.999 for r in kept)
    assert abs(sum(r["weight"] for r in kept) - 1) < 1e-6
    for side in mixing.SIDES:
        for aim in aims[side].collect():
            assert abs(sum(r["weight"] for r in kept if r[side] == aim[side]) - aim["target"]) < 0.01 * aim["target"], (side, aim)
    # Water filling by hand: full values give all, the others keep their proportions.
    wish = {r["source"]: r["target"] for r in mixing.flattened(cells, "source").collect()}
    room = {s: sum(r[3] for r in rows if r[0] == s) / (0.6 * whole) for s in wish}
    full: set[str] = set()
    while True:
        factor = (1 - sum(room[s] for s in full)) / sum(wish[s] for s in wish if s not in full)
        more = {s for s in wish if s not in full and wish[s] * factor > room[s]}
        if not more:
            break
        full |= more
    for aim in aims["source"].collect():
        assert abs(aim["target"] - (room[aim["source"]] if aim["source"] in full else wish[aim["source"]] * factor)) < 1e-6
    assert full


def test_rounds_of_mixing_exchange_nothing(spark, docs):
    cells = docs.transform(mixing.described).groupBy(*mixing.SIDES).agg(F.sum("tokens").alias("tokens"))
    cells = common.keep(cells.repartition(3), "test-cells")
    aims = {side: common.keep(mixing.reachable(cells, side, mixing.flattened(cells.coalesce(1), side)), "test-aims") for side in mixing.SIDES}
    for frame in (mixing.raked(cells, aims, 3, 0.6), mixing.reachable(cells, "lang", aims["lang"])):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Window" in plan and "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan


def test_open_ngrams_are_looked_up_again_only_after_a_change(spark, monkeypatch):
    found, looked, modes = ngram_join.open_marks, [], []

    def all_open(rows, drawn, percent, mode):
        modes.append(mode)
        return rows.select(F.lit(True).alias("open"), F.col("mark").alias("a"), F.col("key").alias("b"))

    monkeypatch.setattr(ngram_join, "open_marks", lambda *a: looked.append(a) or found(*a))
    monkeypatch.setattr(ngram_join, "candidates_of", all_open)
    # Two sets with four n-grams in common of sixteen: a block of open ones in which no round finds a link.
    grams = [np.array([*range(4), *range(own, own + 12)], np.uint64).tobytes() for own in (100, 200)]
    sets = spark.createDataFrame([(k + 1, 16, g) for k, g in enumerate(grams)], "key bigint, n bigint, grams binary")
    assert ngram_join.connected(sets, 75).count() == 0
    assert modes == [ngram_join.TREE, ngram_join.NEAREST, ngram_join.ALL] and len(looked) == 2


def test_components_count_rows_as_they_write_them(spark, monkeypatch):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 5), (5, 5), (7, 5)], "a bigint, b bigint")
    monkeypatch.setattr(type(edges), "first", lambda *a: pytest.fail("a job that only counts"))
    assert {tuple(r) for r in common.components(edges, "test-links").collect()} == {(1, 1), (2, 1), (3, 1), (7, 5), (5, 5)}
    assert common.components(edges.where("a = b"), "test-links").count() == 0
