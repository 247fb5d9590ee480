"""MinHash near-duplicates against all pairs of full sets."""

import random
import re
from collections import Counter

import pytest

from tests.llm.conftest import prose
from tidemark.llm import minhash, queries

DOCS = "doc_id long, text string"


def plain(rows):
    """(doc_id, n_shingles, component_id, kept) of every row."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(frozenset(tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))) if w else frozenset())
    up = {s: s for s in sets}

    def root(s):
        while up[s] is not s:
            s = up[s]
        return s

    distinct = [s for s in up if s]
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if 100 * min(len(a), len(b)) >= 80 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                up[root(b)] = root(a)
    least = {}
    for (doc, _), s in zip(rows, sets):
        if s and doc is not None:
            least[root(s)] = min(doc, least.get(root(s), doc))
    out = []
    for (doc, _), s in zip(rows, sets):
        component = least.get(root(s)) if s else doc
        out.append((doc, len(s), component, doc == component))
    return Counter(out)


def bent(text, changes, seed):
    r, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = f"w{r.random()}"
    return " ".join(words)


def edge_docs(edges):
    return [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]


@pytest.mark.parametrize("sizes", [{}, {"block": 2, "wide": 3, "size": 2000}, {"size": 3000, "rounds": 0}])
def test_edges_and_groups_of_near_copies(spark, edges, sizes):
    """Copies, near copies in chains and around a middle that few of them share, a passage in many documents, short texts."""
    middle, passage = prose(7, 300), prose(8, 60)
    rows = edge_docs(edges) + [(100 + i, bent(middle, 1 + i % 9, i)) for i in range(40)] + [(200 + i, passage + " " + prose(50 + i, 40)) for i in range(30)]
    rows += [(300 + i, " ".join(middle.split()[i * 8 : 200 + i * 8])) for i in range(12)]  # a chain
    rows += [(400 + i, t) for i, t in enumerate(("a b c d e f", "A B c d  e f", "a b c d e", "a b", "a\tb", "b a", "a"))] + [(None, "a b"), (None, "only here, without an id")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("component", minhash.F.lit("mine")).withColumn("node", minhash.F.lit("mine")).repartition(5)
    got = minhash.minhash_components(docs, **sizes)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = plain(rows)
    assert Counter(tuple(r) for r in got.collect()) == Counter({(d, n, c, True if d is None and c is None else k): x for (d, n, c, k), x in want.items()})


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in queries.op12_minhash(spark, small).collect()) == plain(rows)


def test_empty_table(spark):
    assert minhash.minhash_components(spark.createDataFrame([], DOCS)).count() == 0


def test_a_link_is_lost_by_chance_only():
    assert minhash.miss_probability(0.8) < 1e-8 and minhash.miss_probability(0.9) < 1e-15
    r = random.Random(3)
    for n in (5, 40, 400):  # at the bound itself, sets of any size
        for _ in range(40):
            both = [r.getrandbits(64) for _ in range(8 * n)]
            a = minhash.signature(minhash.np.array(both + [r.getrandbits(64) for _ in range(n)], minhash.np.uint64))
            b = minhash.signature(minhash.np.array(both + [r.getrandbits(64) for _ in range(n)], minhash.np.uint64))
            assert (a == b).sum() >= minhash.MATCHES


def test_similar_counts_exactly():
    r = random.Random(4)
    sets = [minhash.np.unique(minhash.np.array([r.randrange(60) for _ in range(r.randint(1, 60))], minhash.np.uint64)) for _ in range(60)]
    want = {i: {i} for i in range(60)}
    for i in range(60):
        for j in range(i):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            if 100 * len(a & b) >= 80 * len(a | b) and want[i] is not want[j]:
                want[i] |= want[j]
                for k in want[i]:
                    want[k] = want[i]
    got = {i: {i} for i in range(60)}
    for a, b in minhash.similar(sets, 80):
        got[b].add(a)
        got[a] = got[b]
    assert got == want
