"""The pipeline, stage by stage, and the registered queries."""

from collections import Counter, defaultdict

import corpus_pipeline
from helpers import SF001
from test_search import brute_classes
from test_texts import brute_quality, lowered

import __spark_entry__
from mediatables.llm import mixing
from mediatables.llm.common import written


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(written(stage(spark, tables[-1], SF001), f"test-{name}"))
    assert all(t.columns == docs.columns for t in tables[:-1])
    raw, good, exact, near, mixed = ([tuple(r) for r in t.collect()] for t in tables[:-1])
    assert sorted(good) == sorted(r for r in raw if brute_quality(r[1])[-1])
    best = {}
    for r in good:
        best[lowered(r[1])] = max(best.get(lowered(r[1]), r), r)
    assert sorted(exact) == sorted(best.values())
    classes = {i: c for i, c, _ in brute_classes([(r[0], r[1]) for r in exact])}
    assert sorted(near) == sorted(r for r in exact if classes[r[0]] == r[0])
    copies = {r.doc_id: r.copies for r in mixing.mix_counts(tables[3]).collect()}
    assert Counter(r[0] for r in mixed) == Counter({i: n for i, n in copies.items() if n})
    pieces = tables[-1].collect()
    tokens = Counter()
    for r in pieces:
        tokens[r.doc_id, r.doc_tokens] += r.length
    assert {i: n // t for (i, t), n in tokens.items()} == {i: n for i, n in copies.items() if n}
    fill = defaultdict(int)
    for r in pieces:
        fill[r.sequence_id] += r.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in fill.values())


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)
