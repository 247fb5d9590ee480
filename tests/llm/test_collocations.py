"""Collocations against counts of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import edge_rows
from tidemark.llm import collocations, queries

DOCS = "text string, lang string"


def plain(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for m in range(1, 6):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        inside = Counter()
        for p, c in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i : i + m]] = max(inside[p[i : i + m]], c)
        lines = []
        for p, a in found.items():
            if inside[p] >= a:
                continue
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            lines.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(lines)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def prose(seed, n, docs):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["é", "Über", "x\x00y"]
    for _ in range(docs):
        yield "".join(r.choice(words[: r.choice((3, 8, 33))]) + r.choice([" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    out = [(t, lang) for i, lang in enumerate(("en", "de", None, "und", "")) for t in prose(i, 400, 12)]
    out += [(r[1], r[2]) for r in edge_rows()] + [("a a a a a a a. b a b a b a", "en")] * 20 + [("of the of the kind of the", "en")] * 25 + [("the " * 3000, "en")]
    return out


@pytest.mark.parametrize(
    "options",
    [{}, {"bucket": 50}, {"split": 40, "bucket": 300}, {"split": 40, "salted": 90, "bucket": 300}, {"held": 60, "bucket": 1000}, {"broadcast_words": 0, "split": 40, "salted": 200}],
)
def test_phrases_of_all_kinds(spark, rows, options):
    """One, two and split pivots, salted ones, buckets beyond what a task holds, and ids by a join."""
    docs = spark.createDataFrame(rows, DOCS).withColumn("word", F.lit("mine")).withColumn("n", F.lit("mine")).repartition(4)
    got = sorted(tuple(r) for r in collocations.mine_collocations(docs, least=20, top=60, **options).collect())
    assert got == plain(rows, 20, 60)


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("text", "lang").collect()]
    df = queries.op13_collocations(spark, small)
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in df.collect()) == plain(rows, 100, 2000)


def test_counts_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 3 * 10**12, 1), ("en", "b", 2 * 10**12, 2)], "lang string, word string, f long, id long")
    phrases = spark.createDataFrame([([1, 2], 10**12)], "ids array<long>, f long")
    totals = spark.createDataFrame([("en", 7 * 10**13)], "lang string, n long")
    assert collocations.scored(phrases, words, totals).first().score == 1000 * 10**12 * 7 * 10**13 // (6 * 10**24)


def test_empty_table(spark):
    assert collocations.mine_collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.mine_collocations(spark.createDataFrame([(None, None), (" . ", "en")], DOCS), least=1).count() == 0
