"""The whole pipeline against plain versions of its stages, over the smallest tables."""

from collections import defaultdict

import zstandard

import corpus_pipeline
from tests.llm.test_brute_force import PLAIN, plain_fingerprint, words
from tidemark.llm import line_dedup, pieces, quality, queries


def classes(n, linked):
    """Numbers 0 to n - 1 by the least one that links reach."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def good(text, bands):
    w = PLAIN.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = defaultdict(int)
    for g in grams:
        count[g] += 1
    repeated = {j for i, g in enumerate(grams) if count[g] > 1 for j in range(i, i + 3)}
    _, bad, verdict = quality.compression(text.encode(), zstandard.ZstdCompressor(level=3), bands)
    return len(w) >= 50 and 100 * len(repeated) <= 50 * len(w) and not verdict and bad <= 0.5


def without_repeated_lines(docs):
    """Lines of 40 characters go if they are near an earlier one, shorter ones with a letter or digit if they equal one."""
    places = defaultdict(list)
    for doc, text in docs.items():
        for i, line in enumerate(text.split("\n")):
            if len(line) >= 40 or any(c.isalnum() for c in line):
                places[line].append((doc, i))
    lines = sorted(places, key=lambda x: min(places[x]))
    long = lambda i: len(lines[i]) >= 40
    of = dict(zip(lines, classes(len(lines), lambda i, j: long(i) and long(j) and line_dedup.within(lines[i], lines[j], 2)), strict=True))
    stays = {min(places[lines[c]]) for c in of.values()}
    out = {}
    for doc, text in docs.items():
        new = "\n".join(x for i, x in enumerate(text.split("\n")) if x not in of or (doc, i) in stays)
        if new == text or len(PLAIN.findall(new)) >= 50:
            out[doc] = new
    return out


def test_pipeline(spark, small):
    table = spark.read.parquet(f"{small}/documents.parquet")
    docs = {r.doc_id: r.text or "" for r in table.select("doc_id", "text").collect()}
    bands = quality.fit_bands(table, spark.read.parquet(f"{small}/labels.parquet"))
    docs = without_repeated_lines({d: t for d, t in docs.items() if good(t, bands)})
    ids = sorted(docs)
    fps = [plain_fingerprint(docs[d]) for d in ids]
    groups = classes(len(ids), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    docs = {ids[c]: docs[ids[c]] for c in groups}
    patterns = set()
    for r in spark.read.parquet(f"{small}/benchmark.parquet").collect():
        w = words(r.text)
        m = min(13, len(w))
        patterns |= {tuple(w[s : s + m]) for s in range(len(w) - m + 1 if m else 0)}
    want = {}
    for d, text in docs.items():
        w = words(text)
        hit = {j for m in {len(p) for p in patterns} for s in range(len(w) - m + 1) if tuple(w[s : s + m]) in patterns for j in range(s, s + m)}
        if not hit or 20 * len(hit) < len(w):
            want[d] = text
    got = corpus_pipeline.run(spark, small).collect()
    model = pieces.Pieces(queries.vocabulary("piece_bpe_32k.model"))
    assert 0 < len(got) < table.count() and all(r.exact and r.n_pieces == len(r.pieces) for r in got)
    assert len(got) == len(want) and {r.doc_id: model.decode(r.pieces) for r in got} == want


def test_stages_on_edge_rows_and_an_empty_table(spark, small, edges):
    docs = edges.select(*corpus_pipeline.COLUMNS)
    long = docs.where("doc_id IN (4, 5, 6) OR doc_id IS NULL").withColumns({"doc_id": docs.doc_id + 100})
    for table in (docs.unionByName(long), docs.limit(0)):
        n = table.count()
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, table, small)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == list(corpus_pipeline.COLUMNS)
                table = spark.createDataFrame(out.collect(), docs.schema)
            assert out.count() <= n
        assert (out.count() > 0) == (n > 0)


def test_no_fragment_leaves_the_line_stage(spark, small):
    out = corpus_pipeline.line_dedup(spark, corpus_pipeline.quality(spark, spark.read.parquet(f"{small}/documents.parquet"), small), small)
    rows = out.collect()
    assert rows and all(len(PLAIN.findall(r.text)) >= 50 and r.n_chars == len(r.text) for r in rows)
