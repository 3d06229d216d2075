"""Spelling variants against brute force over all pairs of words."""

import random
import zlib

import pytest

from helpers import DOCS, frame, rows_of
from mediatables.llm import spelling


def brute_vocabulary(rows):
    import re
    count = {}
    low = str.maketrans(spelling.UPPER, spelling.UPPER.lower())
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 5:
                count[run] = count.get(run, 0) + 1
    return {w: n for w, n in count.items() if n >= 3}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute(vocab):
    out = {}
    for w, n in vocab.items():
        near = [(-vocab[v], v) for v in vocab if is_near(w, v)]
        best = min(near, default=None)
        form = best[1] if best and -best[0] >= 2 * n else None
        out[w] = [n, len(near), form, -best[0] if form else None]
    rows = []
    for w, (n, k, form, form_n) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.append((w, n, k, form, form_n, root))
    return sorted(rows, key=repr)


def corpus():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.randint(4, 7))) for _ in range(150)]
    words += ["aaaaa", "aaaaaa", "aaaaaaa", "baaaaa", "aaaaab", "Straße", "strasse", "x" * 400, "x" * 401,
              "colour", "color", "colours", "ÀÉÎÕÜ", "ÀÉÎÕÜÜ"]
    rows = []
    for k in range(60):
        text = " ".join(rnd.choices(words, k=30)) + ". " + rnd.choice(["COLOUR color1color", "x" * 401, "x" * 400, ""])
        rows.append((rnd.choice([k, 7, None]), text, "en", None, "k", "r", k, k))
    return rows + [(1, None, None, None, None, None, 0, 0), (2, "", None, None, None, None, 0, 0), rows[0]]


@pytest.mark.parametrize("limit", [1_000, 3])
def test_variants_match_brute_force(spark, limit):
    got = rows_of(spelling.spelling_variants(frame(spark, corpus()), limit=limit)
                  .select("word", "n", "n_near", "form", "form_n", "root"))
    want = brute(brute_vocabulary(corpus()))
    assert got == want
    assert sum(r[2] for r in want) > 40 and sum(r[3] is not None for r in want) > 5


def test_pairs_match_brute_force(spark):
    vocab = brute_vocabulary(corpus())
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    got = rows_of(spelling.near_pairs(df, limit=5).select("word", "near"))
    assert got == sorted(((a, b) for a in vocab for b in vocab if is_near(a, b)), key=repr)


def test_partitions_keep_their_limit(spark):
    vocab = brute_vocabulary(corpus())
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    parts = spelling.initial_partitions(df, 5).collect()
    sizes = {}
    for r in parts:
        sizes.setdefault((r.longest, r.head, r.tail, r.bound), []).append(r.word)
    for (longest, head, tail, _), words in sizes.items():
        assert len(words) <= 5 or longest - len(head) - len(tail) <= 1


def test_acceptor_is_minimal_and_complete():
    words = sorted({"".join(random.Random(k).choices("ab", k=6)) for k in range(40)})
    machine = spelling.Acceptor(words)
    assert sorted(machine.language(machine.start)) == words
    futures = {}
    for state in range(len(machine.states)):
        futures.setdefault(tuple(sorted(machine.language(state))), []).append(state)
    assert all(len(states) == 1 for states in futures.values())


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], DOCS)).collect() == []
