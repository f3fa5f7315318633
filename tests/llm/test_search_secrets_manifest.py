"""Ranked search, secrets and the Merkle manifest against plain Python, with every awkward case."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sluice.llm import fp_search, merkle, secrets

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, place string, rules string, base string"
AWS = "AKIA" + "Q7" * 9


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéü") for _ in range(r.randint(1, 3))) for _ in range(words))


@pytest.fixture(scope="module")
def rows():
    texts = [
        None, "", " \n", "A b a", "a B a", prose(1, 400), prose(1, 400), prose(2, 4000), "ÀB éa 12", "--- !!",
        f"password = 'abcdefghijklmnop' {AWS} 0123456789abcdef00 ghp_{'Zq' * 20}", "token=password: abcdefghijklmnop",
        "Api_Key:\"short\" secret=token=abcdefgh12345", f"é \U0001f600 TOKEN := x PASSWD:{'Z' * 12}", "AKIA123 " + "ab12" * 5 + "g",
    ]
    out = [(i, t, "en" if i % 2 else None, ("s", None, "", "t é")[i % 4], None if i == 3 else len(t or ""), "k", "p", "r", "b") for i, t in enumerate(texts)]
    out += [out[5], (5, "other text of one id", "en", "t é", 3, *"kprb"), (None, "a b", None, None, None, *"kprb"), (None, None, None, None, None, *"kprb")]
    return out + [(100 + i, prose(50 + i % 17, 6 + i % 9), "de", "big", i, *"kprb") for i in range(300)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def terms_of(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def ranked_plainly(rows, items, most=10):
    bags = [(doc_id, Counter(terms_of(text))) for doc_id, text in rows]
    bags = [(doc_id, bag) for doc_id, bag in bags if bag]
    count, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, bag in bags:
            m = 10 + (90 * sum(bag.values()) * count) // total
            gains = (math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in set(terms_of(text)) if bag[t])
            scores.append((-sum(gains), doc_id is None, doc_id or 0))
        best = sorted(s for s in scores if s[0] < 0)[:most]
        out += [(item_id, rank, None if none else doc_id, -score) for rank, (score, none, doc_id) in enumerate(best, 1)]
    return sorted(out, key=repr)


def test_search(spark, docs, rows, empty, monkeypatch):
    items = [(1, "a b éa"), (2, prose(1, 40)), (3, None), (4, "!!"), (5, "nowhere"), (6, prose(60, 8) + " ÀB"), (6, "12 a"), (None, "b b B"), (7, "a b a")]
    table = spark.createDataFrame([(*i, "clash") for i in items], "item_id bigint, text string, doc_id string")
    want = ranked_plainly([r[:2] for r in rows], items)
    assert any(r[2] is None for r in want)
    assert sorted((tuple(r) for r in fp_search.search(docs, table).collect()), key=repr) == want
    # Small trees, leaves and blocks of items give the same rows.
    monkeypatch.setattr(fp_search, "TREE", 40)
    monkeypatch.setattr(fp_search, "LEAF", 3)
    assert sorted((tuple(r) for r in fp_search.search(docs.coalesce(2), table, vocabulary=5).collect()), key=repr) == want
    assert fp_search.search(empty, table).count() == 0 and fp_search.search(docs, table.limit(0)).count() == 0
    assert [f.dataType.simpleString() for f in fp_search.search(empty, table).schema] == ["bigint", "int", "bigint", "bigint"]


def test_search_leaves_subtrees_out():
    import numpy as np

    r = np.random.default_rng(3)
    size, many = 40, 3000
    own = [np.sort(r.choice(size, r.integers(1, 6), replace=False)) for _ in range(many)]
    begin = np.concatenate([[0], np.cumsum([len(o) for o in own])])
    tf = r.integers(1, 4, begin[-1]).astype(np.int32)
    tf[:5] = 500
    tree = fp_search.Tree(np.arange(many), np.ones(many, bool), r.integers(10, 200, many), begin, np.concatenate(own), tf, size)
    seen = []

    class Watched(fp_search.Best):
        def offer(self, score, ids, known):
            seen.append(len(score))
            super().offer(score, ids, known)

    weight = r.integers(1, 5000, size)
    tree.search(np.array([1, 5, 9]), weight, best := Watched(10))
    assert sum(seen) < many / 2 and len(best.score) == 10
    full = fp_search.Best(10)
    sums = np.concatenate([[0], np.cumsum(np.where(np.isin(tree.term, [1, 5, 9]), weight[tree.term], 0) * tree.gain)])
    full.offer(sums[tree.begin[1:]] - sums[tree.begin[:-1]], tree.ids, tree.known)
    assert best.score.tolist() == full.score.tolist() and best.ids.tolist() == full.ids.tolist()


# The contract's own forms, for Python.
PLAIN = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
} | {r.kind: (r.pattern, lambda m, least=r.least: len(m[0]) >= least) for r in secrets.RULES if not r.base}


def secrets_plainly(text):
    spans = [(m.start(), k, kind, m.end()) for k, (kind, (pattern, passes)) in enumerate(PLAIN.items()) for m in re.finditer(pattern, text or "") if passes(m)]
    base = sorted(s for s in spans if s[1] < 3)
    more = [s for s in spans if s[1] >= 3 and not any(s[0] < b[3] and b[0] < s[3] for b in base)]
    word = lambda found: ",".join(f"{kind}:{first}:{last}" for first, _, kind, last in found)
    return (*(sum(b[2] == kind for b in base) for kind in ("assign", "access", "hex")), hashlib.sha256(word(base).encode()).hexdigest(), word(sorted(base + more)))


def test_secrets(spark, docs, rows, empty):
    got = sorted((tuple(r) for r in secrets.find_secrets(docs).collect()), key=repr)
    want = sorted(((r[0], *secrets_plainly(r[1])) for r in rows), key=repr)
    assert got == want
    assert any("github" in r[-1] for r in got) and any(r[1] for r in got)
    assert secrets.find_secrets(empty).count() == 0


def test_secrets_in_very_many_places(spark):
    """Texts with very many matches, a hot text on most rows, and added spans beside and inside base ones."""
    r = random.Random(4)
    pieces = [f"token={'x' * 12}", "secret:short", AWS, "f" * 16, f"xoxb-{'1' * 12}", f"token=xoxb-{'1' * 12}", f"sk_live_{'Aa' * 9}", "é"]
    texts = [" ".join(r.choice(pieces) for _ in range(n)) for n in (5, 300, 20_000)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *["password: " + "p" * 14] * 200])], "doc_id bigint, text string")
    got = {row[0]: tuple(row)[1:] for row in secrets.find_secrets(table).collect()}
    assert all(got[i] == secrets_plainly(t) for i, t in enumerate(texts))
    assert all(got[i] == secrets_plainly("password: " + "p" * 14) for i in range(3, 203))


def test_trigram_queries_lose_no_match():
    r = random.Random(8)
    for rule in secrets.RULES:
        query = secrets.trigram_query(rule.pattern)
        assert (query == secrets.ANY) == (rule.kind == "hex")
    tests = [r"ab?cde", r"(abc|def)+xyz", r"a[bc]{2}d+efg", r"(?i:HeL)lo", r"x*abc(de|f)?ghi", r"(ab|a.)cdef"]
    for pattern in tests:
        query = secrets.trigram_query(pattern)
        for _ in range(3000):
            text = "".join(r.choice("abcdefghilox") for _ in range(9))
            text = r.choice([text, "abcabcxyz", "abbdefg", "heLLo", "abcdeghi", "zaxcdef", "HELLO", "acde"]) + text
            if re.search(pattern, text):
                assert any(all(t in text.lower() for t in every) for every in query), (pattern, text)


def test_index_lists_candidates(docs, rows):
    queries = [secrets.trigram_query(rule.pattern) for rule in secrets.RULES]
    trigrams = sorted({t for q in queries for every in q for t in every})
    postings = secrets.index(docs, trigrams)
    held = {(trigrams[p["trigram"]], k) for p in postings.collect() for k in p["postings"]}
    keyed = docs.select("text", secrets.text_key(F.coalesce("text", F.lit(""))).alias("k")).distinct().collect()
    assert held == {(t, r["k"]) for r in keyed for t in trigrams if t in (r["text"] or "").lower()}
    chosen = {r["key"]: r["rules"] for r in secrets.candidates(postings, queries, trigrams).collect()}
    for r in keyed:
        low = (r["text"] or "").lower()
        want = sum(1 << n for n, q in enumerate(queries) if q != secrets.ANY and any(all(t in low for t in every) for every in q))
        assert chosen.get(r["k"], 0) == want


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest_plainly(rows):
    def leaf(row, text):
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[0], row[3], row[2], row[4], text)))

    def tree(nodes):
        """What is left, and for each place the (left, right) of each level."""
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                run = p - p % 16
                ways[i].append(("".join(nodes[run:p]), "".join(nodes[p + 1 : run + 16])))
            nodes, at = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)], [p // 16 for p in at]
        return nodes[0], ways

    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        own = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees[source] = (own, *tree([leaf(r, r[1]) for r in own]))
    root, above = tree([trees[s][1] for s in sources])
    for source, way in zip(sources, above):
        own, subroot, ways = trees[source]
        for row, steps in zip(own, ways):
            steps = steps + way
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]) if bad and row[1] is not None else row[1]
            fold = leaf(row, text)
            for left, right in steps:
                fold = h(left + fold + right)
            yield row[0], leaf(row, row[1]), subroot, root, h("".join(a + b for a, b in steps)), fold, fold == root


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest(docs, rows, empty, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "SPAN", 16**levels)
    monkeypatch.setattr(merkle, "PART", 64)
    got = merkle.manifest(docs)
    found = [tuple(r) for r in got.collect()]
    assert sorted((r[:-1] for r in found), key=repr) == sorted(manifest_plainly(rows), key=repr)
    # A version copies the leaf and its ancestors, no other node, and ends in its own root.
    heights = {r[0]: r[-1] for r in found if r[-1] is not None}
    assert heights and all(c[-1] == r[5] and len(c) >= 2 for r in found if (c := r[-1]) is not None)
    assert not all(r[-2] for r in found) and any(r[-2] and r[-1] for r in found)
    assert merkle.manifest(empty).count() == 0


def test_manifest_of_one_row(docs):
    only = docs.where("doc_id = 8").collect()
    one = merkle.manifest(docs.where("doc_id = 8"), F.lit(True), F.lit("changed")).first()
    assert len(only) == 1 and one["root"] == one["subroot"] == one["leaf"] and one["proof_sha256"] == h("")
    assert one["copied"] == [one["folded_root"]] and not one["verified"]
