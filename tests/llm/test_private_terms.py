"""Disclosing terms and generalised texts against plain versions."""

import math
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.test_brute_force import multiset, spans_of
from tidemark.llm import private_data

BASE = private_data.KINDS[:4]


def letters(text):
    """(start, end, lower-cased value) of the runs of four letters or more."""
    out, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end].isalpha():
            end += 1
        if end - at >= 4:
            out.append((at, end, text[at:end].lower()))
        at = max(end, at + 1)
    return out


def near_copies(texts):
    """text -> the least text that it is a near copy of, over links of like triples of terms; none may be in doubt."""
    triples = {}
    for t in texts:
        w = [x[2] for x in letters(t or "")] + [None, None]
        triples[t] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
    first = {t: t for t in texts}
    for i, a in enumerate(texts):
        for b in texts[:i]:
            like = len(triples[a] & triples[b]) / (len(triples[a] | triples[b]) or 1)
            assert not 0.35 < like < 0.75
            if like >= 0.75:
                old, new = max(first[a], first[b]), min(first[a], first[b])
                first = {t: new if f == old else f for t, f in first.items()}
    return first


def plain_spans(rows, disclosure=0.9, residual=0.75, prior=1.0, reach=80):
    """[(kind, start, end)] of every row, by comparing all pairs of entities and terms."""
    docs = {text for _, text in rows}
    witness = near_copies([d for d in docs if any(spans_of(d, BASE).values())])
    entities, terms, both = defaultdict(set), defaultdict(set), defaultdict(set)
    for text in docs:
        base = [(k, s, e) for k, found in spans_of(text, BASE).items() for s, e in found]
        words = letters(text or "")
        own = witness.get(text, text)
        for s, e, w in words:
            terms[w].add(own)
        for k, s, e in base:
            entities[k, text[s:e].lower()].add(own)
            for ws, we, w in words:
                if ws >= s - reach and we <= e + reach and not any(bs < we and ws < be for _, bs, be in base):
                    both[(k, text[s:e].lower()), w].add(own)
    told, n = set(), len(docs)
    for (entity, w), having in both.items():
        n_e, n_t, n_et = len(entities[entity]), len(terms[w]), len(having)
        ic, pmi = math.log2(n / n_e), math.log2(n * n_et / (n_e * (n_t + prior)))
        if ic > 0 and ic - pmi <= residual and pmi >= disclosure * ic:
            told.add(w)
    out = []
    for doc, text in rows:
        found = spans_of(text, BASE)
        base = [(i, s, e) for i, k in enumerate(BASE) for s, e in found[k]]
        more = [(4, s, e) for s, e, w in letters(text or "") if w in told and not any(bs < e and s < be for _, bs, be in base)]
        out.append((doc, base + more))
    return out, told


def corpus():
    r = random.Random(31)
    people = [(f"Surname{chr(97 + i)}ov", f"{chr(97 + i)}.x@corp{i}.example", f"+1 (555) 010-{1000 + i}") for i in range(12)]
    common = "weather trade office river market yellow letter people street window".split()
    rows = []
    for doc in range(400):
        words = [r.choice(common) for _ in range(r.randint(5, 60))]
        for _ in range(r.choice([0, 0, 1, 2])):
            name, mail, phone = r.choice(people)
            words.insert(r.randrange(len(words)), r.choice([f"{name} {mail}", f"{mail}, {name.upper()}", f"{name} <{mail}>", mail, name if doc % 9 == 0 else phone]))
        rows.append((doc, " ".join(words)))
    rows += [(None, rows[3][1]), (900, None), (901, ""), (902, "x" * 3000 + " " + rows[5][1])]
    # Two near copies of a page, and copies of one under other ids, are one witness.
    page = "Wenzelmann " + " ".join(r.choice(common) for _ in range(90)) + " Wenzelmann page@corp.example written by"
    return rows + [(910, page), (911, page + " Yellowing"), (912, page), (913, page)]


@pytest.mark.parametrize("times", [1, 3])
def test_disclosing_terms_against_all_pairs(spark, times):
    rows = corpus()
    want, told = plain_spans(rows)
    assert 3 <= len(told) and not {"office", "wenzelmann", "yellowing", "written"} & told
    docs = spark.createDataFrame(rows * times, "doc_id long, text string").repartition(3)
    got = private_data.find_private(docs).collect()
    assert multiset((x.doc_id, [tuple(s) for s in x.spans]) for x in got) == multiset(want * times)


def test_near_copies_have_one_witness(spark):
    r = random.Random(2)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    rows, groups = [], {}
    for k in range(30):
        base = prose(120).split()
        for c in range(k % 4 + 1):
            own = [*base]
            for _ in range(c):
                own[r.randrange(120)] = "changed"
            rows.append((len(rows), " ".join(own)))
            groups[len(rows) - 1] = k
    words = private_data._terms(private_data._rows(spark.createDataFrame(rows, "id long, text string"), "text"))
    key = {x.r: i for i, t in rows for x in private_data._rows(spark.createDataFrame([(i, t)], "id long, text string"), "text").select("r").collect()}
    got = {key[x.near]: x.witness for x in private_data.witnesses(words).collect()}
    assert set(got) == {i for i, k in groups.items() if k % 4}
    assert len({(groups[i], w) for i, w in got.items()}) == len({groups[i] for i in got}) == len(set(got.values()))


def test_terms_of_one_document_tell_nothing_and_those_of_two_do(spark):
    rows = [(1, "Zebulon writes from lone@corp.example"), (2, "ask Quillmark via pair@corp.example"), (3, "Quillmark or pair@corp.example, both")]
    rows += [(i, f"writes from both sides of the river, or asks {i} times") for i in range(10, 2000)]
    got = {r.doc_id: r.sanitised for r in private_data.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "Zebulon writes from [email]" and got[2] == "ask [term] via [email]" and got[3] == "[term] or [email], both"


def test_generalised_texts(spark):
    r = random.Random(8)
    rows = []
    for doc in range(60):
        text = "".join(r.choice("abcdé🙂 \n") for _ in range(r.choice([0, 3, 200, 3000])))
        spans = [(r.randrange(5), s, min(len(text), s + r.randint(1, 9))) for s in (r.randrange(len(text)) for _ in range(r.choice([0, 1, 40, 600])))] if text else []
        rows.append((doc, text, spans))
    df = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<kind:int,start:int,end:int>>")
    for x in df.withColumn("out", private_data.generalised(F.col("text"), F.col("spans"), block=4)).collect():
        out, at = "", 0
        merged = []
        for s, e, k in sorted((e[1], e[2], e[0]) for e in x.spans):
            if merged and s < merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e, k])
        for s, e, k in merged:
            out += x.text[at:s] + f"[{private_data.KINDS[k]}]"
            at = e
        assert x.out == out + x.text[at:]


def test_sanitising_edge_rows(edges, spark):
    got = private_data.sanitise(edges.withColumnsRenamed({"kept": "more_spans", "at": "hit_own_r"}))
    assert got.columns[:2] == ["doc_id", "text"] and got.columns[-2:] == ["private_spans", "sanitised"]
    rows = got.collect()
    assert len(rows) == edges.count() and all((x.sanitised is None) == (x.text is None) for x in rows)
    assert private_data.sanitise(edges.limit(0)).count() == 0


def test_a_text_dense_in_addresses_takes_seconds(spark):
    text = "".join(f"write user{i}@mail.example.com\n" for i in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    got = private_data.sanitise(docs).select(F.size("private_spans").alias("n"), F.length("sanitised").alias("size")).collect()
    assert [(x.n, x.size) for x in got] == [(100_000, 1_400_000)]
    assert time.time() - start < 90
