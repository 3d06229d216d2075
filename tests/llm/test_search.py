"""Near duplicates, passages, personal data, URLs and toxicity."""

import hashlib
import random
import re
from fractions import Fraction
from itertools import combinations, permutations

import numpy as np
import pytest
from helpers import corpus, frame, prose, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from mediatables.llm import near_join, pii, substring_dedup, toxicity, url_filter


def shingle_set(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_classes(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            parent[find(a)] = find(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((i, min(ids) if ids else None, links[k]))
    return sorted(out, key=repr)


def test_near_classes(spark):
    rows = [(r[0], r[1]) for r in corpus()]
    assert rows_of(near_join.near_classes(frame(spark))) == brute_classes(rows)
    assert near_join.near_classes(frame(spark, [])).count() == 0


def near_copies(n, words, edits, seed=0):
    rnd = random.Random(seed)
    base = prose(seed, words).split()
    out = []
    for k in range(n):
        copy = list(base)
        for _ in range(rnd.randint(0, edits)):
            copy[rnd.randrange(words)] = f"w{rnd.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_large_group_of_near_copies_in_cells(spark):
    texts = near_copies(90, 100, 3, 5) + [prose(900 + k, 60) + " " + prose(5, 40) for k in range(40)]
    rows = [(k, t) for k, t in enumerate(texts)]
    docs = frame(spark, [(*r, "en", "s", "", "", 0, 0) for r in rows])
    got = near_join.near_classes(docs, small=8, cell=16)
    assert rows_of(got) == brute_classes(rows)


def test_drop_near_copies_keeps_one_of_each(spark):
    kept = near_join.drop_near_copies(frame(spark))
    assert kept.columns == frame(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert [i for i in ids if i is not None and 30 <= i < 40] == [30]
    assert sorted(i for i in ids if i in (4, 5)) == [4] and ids.count(None) == 3


def test_runs_reach_the_recall():
    assert near_join.runs_for(0.999) == 8
    assert near_join.runs_for(0.9) < near_join.runs_for(0.99)


def test_components(spark):
    edges = [(k, k + 1) for k in range(1, 12)] + [(100, 50), (50, 70), (7, 7)]
    df = spark.createDataFrame(edges, "u long, v long")
    roots = {r.node: r.root for r in near_join.components(df).collect()}
    assert roots == {**{k: 1 for k in range(1, 13)}, 100: 50, 50: 50, 70: 50}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(1, 8))
def test_compact_windows_cover_each_subsequence_once(values, t):
    h = np.array(values)
    nodes = substring_dedup.compact_windows(h, t)
    for a in range(len(h)):
        for b in range(a + t - 1, len(h)):
            inside = [c for l, c, r in nodes if l <= a <= c <= b <= r]
            assert inside == [a + int(h[a:b + 1].argmin())]


def test_passages(spark):
    docs = frame(spark)
    found = substring_dedup.repeated_passages(docs).collect()
    ranges = {}
    for r in found:
        ranges.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    for k in range(4):  # a passage of 60 words from word 80 on
        assert any(a <= 80 and b >= 140 and b - a <= 66 for a, b in ranges[40 + k])
    for k in range(6):  # near copies of 120 words
        assert any(b - a >= 100 for a, b in ranges[30 + k])
    assert not {1, 2, 3, 4, 7, 8, 9, 60, 61, 62} & set(ranges)
    assert substring_dedup.repeated_passages(frame(spark, [])).count() == 0


def test_passages_of_long_copies_that_drift(spark):
    texts = []
    for seed in range(11, 15):  # whichever document of a pair is cut from the other
        words = prose(seed, 9000).split()
        texts += [words, [w for k, x in enumerate(words) for w in ([x, "x%d" % k] if k % 60 == 30 else [x])]]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    seen = [set() for _ in texts]
    for r in substring_dedup.repeated_passages(docs).collect():
        seen[r.doc_id] |= set(range(r.start_word, r.end_word))
    assert all(len(s) >= len(t) - 10 for s, t in zip(seen, texts))


def test_stretches_keep_the_least_and_the_largest_shift():
    links = [(f, 60 * k, 60 * k + 120, k) for k in range(100) for f in range(2)]
    assert substring_dedup.stretches(links, 2, 46) == [(0, 6060, 0, 99)]


def test_passages_of_lines_that_are_frequent_elsewhere(spark):
    lines = [prose(900 + k, 15) for k in range(4)]
    orders = list(permutations(lines))[::3]
    rows = [(2 * k + side, " ".join([prose(100 + 2 * k + side, 80), *order, prose(200 + 2 * k + side, 80)]))
            for k, order in enumerate(orders) for side in range(2)]
    rows += [(100 + k, " ".join([prose(1000 + k, 60 + k % 7), lines[k % 4], prose(2000 + k, 60)])) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for options in ({},):
        found = substring_dedup.repeated_passages(docs, **options).collect()
        pairs = {(r.doc_id, r.other_doc_id) for r in found if r.start_word <= 80 and r.end_word >= 140}
        assert {(2 * k, 2 * k + 1) for k in range(len(orders))} <= pairs


def test_windows_meet_in_groups_of_a_minimum_and_a_band():
    rnd = np.random.default_rng(2)
    one, other = rnd.integers(0, 2**60, (2, 90)).astype(np.uint64)
    docs = {1: one, 2: one, 3: np.concatenate([one, other]), 4: one, 5: other}
    windows = substring_dedup.windows_of(list(docs.values()), list(docs), 46, 5)
    alone = np.concatenate([substring_dedup.windows_of([s], [d], 46, 5) for d, s in docs.items()])
    assert sorted(x.tobytes() for x in windows) == sorted(x.tobytes() for x in alone)
    links, left = substring_dedup.meet_windows(windows)
    pairs = set(zip(links["a"].tolist(), links["b"].tolist()))
    assert {(1, 2), (1, 4)} <= pairs and (3, 5) in pairs and not {(1, 5), (2, 5), (4, 5)} & pairs
    # Linear: at most two links per window and group.
    assert len(links) <= 2 * 2 * substring_dedup.SECONDS * len(windows)
    groups = {(w["key"], k, w["sigs"][k]) for w in windows for k in range(4) if w["sigs"][k]}
    assert groups == {(w["key"], k, w["sigs"][k]) for w in left for k in range(4) if w["sigs"][k]}


def test_no_two_unlike_windows_of_a_group_are_left_out():
    rnd = np.random.default_rng(5)
    base = rnd.integers(0, 2**60, 140).astype(np.uint64)
    docs = {}
    for d in range(700):  # more than a cell holds
        docs[d] = base.copy() if d % 7 else base[:100].copy()
        if d % 5:
            at = rnd.integers(0, len(docs[d]), 6)
            docs[d][at] = rnd.integers(0, 2**60, 6)
    windows = substring_dedup.windows_of(list(docs.values()), list(docs), 46, 2)
    links, _ = substring_dedup.meet_windows(windows)
    pairs = set(zip(links["a"].tolist(), links["b"].tolist()))
    groups, first = {}, {}
    for w in sorted(windows, key=lambda w: (w["doc"], w["c"])):
        l, c, r = int(w["l"]), int(w["c"]), int(w["r"])
        l, r, d = max(l, c - substring_dedup.BAND), min(r, c + substring_dedup.BAND), int(w["doc"])
        head = first.setdefault((int(w["key"]), c - l, docs[d][l:r + 1].tobytes()), d)
        if head != d:  # copies
            assert (head, d) in pairs
            continue
        for k in range(2 * substring_dedup.SECONDS):
            if w["sigs"][k]:
                groups.setdefault((int(w["key"]), k, int(w["sigs"][k])), set()).add(d)
    assert max(map(len, groups.values())) > 2
    for members in groups.values():
        members = sorted(members)
        assert all((a, b) in pairs for k, b in enumerate(members) for a in members[:k])


def test_wide_groups_are_compared_in_cells():
    rnd = np.random.default_rng(6)
    windows = np.zeros(1500, substring_dedup.WINDOW)
    windows["doc"], windows["c"], windows["r"], windows["key"] = np.arange(1500), 30, 60, 9
    windows["same"], windows["sigs"] = np.arange(1500), rnd.integers(0, 2, (1500, 4))
    found = [substring_dedup.compare(*c) for c in substring_dedup.cells(windows)]
    assert max(map(len, found)) <= substring_dedup.CELL ** 2
    links = np.concatenate(found)
    alike = sum(((windows["sigs"][:k] > 0) & (windows["sigs"][:k] == w["sigs"])).any(axis=1).sum()
                for k, w in enumerate(windows))
    assert len(links) == len(np.unique(links)) == alike


def test_every_window_reaches_over_a_band():
    windows = substring_dedup.windows_of([np.random.default_rng(3).integers(0, 2**60, 3000).astype(np.uint64)], [1], 46, 5)
    assert (windows["sigs"] > 0).any(axis=1).all()


def edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"w{rnd.randrange(10**6)}"
    return words


def runs_of_five(words):
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def test_recall_of_near_passages(spark):
    """Passages with a similarity of 0.8 to 0.99, each shared by two documents,
    and many variants of one; brute force says which are near."""
    rnd = random.Random(6)
    texts, truth = [], []
    for k in range(150):
        base = prose(5000 + k, rnd.randint(60, 200)).split()
        copy = edited(rnd, base, rnd.randint(1, 4))
        a, b = runs_of_five(base), runs_of_five(copy)
        for side, words in enumerate((base, copy)):
            texts.append(" ".join([prose(7000 + 2 * k + side, 60), *words, prose(8000 + 2 * k + side, 60)]))
        if 0.8 <= len(a & b) / len(a | b) < 1:
            truth.append((2 * k, 2 * k + 1))
    base = prose(4999, 120).split()
    variants = []
    for k in range(120):
        variants.append(len(texts))
        texts.append(" ".join([prose(9000 + k, 40 + k % 9), *edited(rnd, base, 2), prose(9500 + k, 50)]))
    texts += [prose(6000 + k, 200) for k in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = substring_dedup.repeated_passages(docs.repartition(5)).collect()
    pairs = {(r.doc_id, r.other_doc_id) for r in found}
    print("near passages found", sum(p in pairs for p in truth), "of", len(truth))
    assert len(truth) > 60 and sum(p in pairs for p in truth) >= 0.9 * len(truth)
    covered = {r.doc_id for r in found if r.end_word - r.start_word >= 60}
    assert sum(v in covered for v in variants) >= 0.97 * len(variants)
    assert not {r.doc_id for r in found} & set(range(len(texts) - 50, len(texts)))


def test_verify_splits_and_trims():
    rnd = np.random.default_rng(1)
    one, two = rnd.integers(0, 2**60, 60).astype(np.uint64), rnd.integers(0, 2**60, 60).astype(np.uint64)
    noise = [rnd.integers(0, 2**60, 50).astype(np.uint64) for _ in range(4)]
    x = np.concatenate([noise[0], one, noise[1], two])
    y = np.concatenate([one, noise[2], two, noise[3]])
    got = sorted(substring_dedup.verify(x, y, 46, Fraction(4, 5)))
    assert got == [(50, 110, 0, 60), (160, 220, 110, 170)]


def test_verify_reads_on_where_a_copy_drifts():
    x = np.random.default_rng(4).integers(0, 2**60, 400).astype(np.uint64)
    y = np.concatenate([x[:175], x[:1] + np.uint64(1), x[175:]])
    assert substring_dedup.verify(x, y, 46, Fraction(4, 5), 0) == [(0, 400, 0, 401)]


def test_a_common_passage_gives_rows_in_proportion(spark):
    """Many documents share one passage, or a line, in unlike surroundings."""
    base, line = prose(4998, 60), prose(4997, 17)
    texts = [" ".join([prose(11000 + k, 55 + k % 9), line if k % 2 else base, prose(12000 + k, 70)]) for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = substring_dedup.repeated_passages(docs).collect()
    covered = {r.doc_id for r in found if r.start_word <= 55 + r.doc_id % 9 and r.end_word >= 115 + r.doc_id % 9}
    assert covered == set(range(0, 300, 2)) == {r.doc_id for r in found}
    assert len(found) <= 10 * len(covered)


def pair_levels(x, y, t):
    """Plainly: the level of each place of window x for window y, and their best."""
    places, tokens, high = x
    weights = [1 / tokens.count(k) for k in tokens]
    out = [0] * len(tokens)
    for p in places:
        start = min(p, high - t + 1)
        inside = [k for k, q in enumerate(places) if start <= q < start + t]
        held = sum(weights[k] for k in inside if tokens[k] in y[1])
        level = sum(held + 1e-6 >= at * sum(weights[k] for k in inside) for at in substring_dedup.LEVELS)
        for k in inside:
            if tokens[k] in y[1]:
                out[k] = max(out[k], level)
    return out, max(out)


def test_every_token_is_linked_at_the_best_level_any_window_has_for_it():
    rnd, t = random.Random(8), 10
    for trial in range(30):
        windows, outlines = [], []
        for key in range(3):
            base = [rnd.randrange(40 if trial % 2 else 10**6) for _ in range(2 * t - 1)]
            for k in range(rnd.choice([1, 2, 3, 12, 25])):
                low, high = -rnd.randrange(t), rnd.randrange(t)
                low, high = (low, high) if high - low >= t - 1 else (1 - t, t - 1)
                tokens = [rnd.choice([b, b, b, b, b + 10**7, rnd.randrange(10**8)]) if rnd.random() < 0.4 else b for b in base]
                places = [q for q in range(low, high + 1) if q % 3 == 0 or rnd.random() < 0.3]
                outlines.append((places, [tokens[q + t - 1] for q in places], high))
                windows.append((key, rnd.randrange(15), 100 + low, 100, 100 + high))
        order = rnd.sample(range(len(windows)), len(windows))
        windows, outlines = [windows[k] for k in order], [outlines[k] for k in order]
        sent = np.zeros(len(windows), substring_dedup.SENT)
        for name, column in zip(("key", "doc", "l", "c", "r"), zip(*windows)):
            sent[name] = column
        one, other = substring_dedup.linked(sent, np.array([len(p) for p, _, _ in outlines]),
                                            np.concatenate([q for _, q, _ in outlines]).astype(np.uint32),
                                            np.concatenate([p for p, _, _ in outlines]), t)
        links = set(zip(one.tolist(), other.tolist()))
        links |= {(b, a) for a, b in links}
        for a in range(len(windows)):
            best, found = [0] * len(outlines[a][0]), [0] * len(outlines[a][0])
            for b in range(len(windows)):
                if windows[a][0] == windows[b][0] and windows[a][1] != windows[b][1]:
                    (own, top), (_, back) = pair_levels(outlines[a], outlines[b], t), pair_levels(outlines[b], outlines[a], t)
                    own = [min(x, back) for x in own] if top else own
                    best = list(map(max, best, own))
                    if (a, b) in links:
                        found = list(map(max, found, own))
            assert found == best
        assert all(windows[a][0] == windows[b][0] and windows[a][1] != windows[b][1] for a, b in links)


def test_many_near_copies_give_rows_in_proportion(spark):
    """Copies of one text with edits at places of their own, where hardly any two are alike throughout."""
    rnd, base = random.Random(9), prose(4996, 400).split()
    rows = []
    for n in (100, 300):
        docs = spark.createDataFrame([(k, " ".join(edited(rnd, base, 10))) for k in range(n)], "doc_id long, text string")
        found = substring_dedup.repeated_passages(docs).collect()
        assert {r.doc_id for r in found} == set(range(n))
        rows.append(len(found))
    assert rows[1] <= 3 * 1.3 * rows[0]


PII_TEXTS = ["a@b.c.d x", "x@y.z_q@r.s a@b.c@d.e", "call +1 (743) 555-3824 now", "1.2.3.4 300.1.1.1 1.2.3.4.5.6.7.8",
             "4111 1111 1111 1111 and 4111-1111-1111-1112", "é\U0001F600 me@x.org +4912345678901",
             "1 " * 5000, "+1" + "(" * 3000, "a@b" + ".c" * 3000, "0000000000000001.2.3.4", "", None]


def brute_pii(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for rank, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            fine = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0,
                    "phone": 10 <= len(digits) <= 15}[kind]
            if fine:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_base_spans(spark):
    rnd = random.Random(4)
    texts = PII_TEXTS + ["".join(rnd.choice("a1.@-+ ()%_9Bé") for _ in range(rnd.randint(0, 60))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_pii(docs).collect():
        want = brute_pii(texts[r.doc_id])
        assert r.spans == want and r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(f"{k}:") for k in pii.KINDS]


def test_contexts_find_unseen_identifiers(spark):
    rows = [(k, f"{prose(k, 5)} phone number +1 212 555 {1000 + k} {prose(k, 3)}") for k in range(8)]
    rows += [(50, "the phone number 212-555-9999, please"), (51, "about 123456789 things"),
             (52, f"{prose(1, 3)} phone number 212-555-9999")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.spans, r.n_added) for r in pii.find_pii(docs, min_confidence=0.7).collect()}
    assert got[50] == ("phone:17:29", 1) and got[52][1] == 1
    assert got[51] == ("", 0) and all(got[k][1] == 0 for k in range(8))
    assert pii.find_pii(frame(spark, [])).count() == 0
    assert pii.find_pii(frame(spark)).count() == len(corpus())


@pytest.mark.parametrize("left,right", [("email=", ""), ("email:", ""), ('"', '"'), ("(", ")"), ("[", "]"), ("<", ">"),
                                        ('email="', '"')])
def test_contexts_with_a_prefix_find_unseen_identifiers(spark, left, right):
    rows = [(k, f"{prose(k, 5)} write to {left}user{k}@mail.example{right} {prose(k, 3)}") for k in range(8)]
    rows += [(50, f"please write to {left}x123456{right} today"), (51, f"about {left}x654321{right} things")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    begin = len(f"please write to {left}")
    assert got[50] == f"email:{begin}:{begin + 7}" and got[51] == ""


def test_contexts_are_followed_until_nothing_is_added(spark):
    texts = [f"{prose(k, 3)} alpha user{k}@mail.example" for k in range(25)]
    texts += [f"{prose(100 + k, 3)} alpha v10000{k}" for k in range(5)]
    texts += [f"{prose(200 + 10 * k + j, 3)} beta{'abcde'[k]} v10000{j}" for k in range(5) for j in range(5)]
    texts += [f"{prose(300 + k, 3)} beta{'abcde'[k]} w10000{k}" for k in range(5)]
    texts += [f"{prose(400 + k, 3)} gamma w10000{k}" for k in range(5)] + ["and then gamma x100001"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_added for r in pii.find_pii(docs).collect()}
    assert got[len(texts) - 1] == 1 and all(got[k] == 1 for k in range(25, len(texts)))


GLOBS = ["**casino**", "*.net/**", "a?c/*", "net/**", "**/x", "**", "*", "abc", "*b*c**d", "?" * 70 + "/**z"]


def glob_matches(glob, url):
    pattern = "".join(".*" if p == "**" else "[^/]*" if p == "*" else "[^/]" if p == "?" else re.escape(p)
                      for p in re.findall(r"\*\*|\*|\?|[^*?]+", glob))
    return re.fullmatch(pattern, url, re.S) is not None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcnet./casinox", max_size=90), max_size=15))
def test_automaton_matches_globs(urls):
    got = url_filter.match(url_filter.compile_globs(GLOBS), [u.encode() for u in urls])
    assert got.tolist() == [[glob_matches(g, u) for g in GLOBS] for u in urls]


@pytest.mark.parametrize(("url", "host", "path", "rule", "verdict"), [
    ("https://A.example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
    ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("http://x.org/fr/casino", "x.org", "/fr/casino", "org/fr/", "allow"),
    ("http://x.net", "x.net", "", None, "allow"), ("http://x.net?a://b/c", "x.net", "", None, "allow"),
    ("http://a.com/b.net/x", "a.com", "/b.net/x", None, "allow"),
    ("http://casino.com#z", "casino.com", "", None, "block"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("x\n://h\n/p\n?q", "h\n", "/p\n", None, "allow"),
])
def test_url_verdicts(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "h")], "page_id long, url string, host string")
    assert tuple(url_filter.url_verdicts(pages).first()) == (1, host, path, rule, verdict)


def test_url_verdicts_of_no_pages_and_long_urls(spark):
    schema = "page_id long, url string"
    assert url_filter.url_verdicts(spark.createDataFrame([], schema)).count() == 0
    long = "http://a.com/" + "x" * 20_000 + "casino"
    got = url_filter.url_verdicts(spark.createDataFrame([(None, long), (2, "http://a.com/")], schema)).collect()
    assert sorted(r.verdict for r in got) == ["allow", "block"]


def labelled(n):
    rnd = random.Random(3)
    rows = []
    for k in range(n):
        toxic, junk = k % 5 == 0, k % 3 == 0
        words = prose(k, 30).split() + ["idiot", "moron"] * toxic + ["buy", "cheap"] * junk
        rnd.shuffle(words)
        rows.append((k, " ".join(words), int(junk), int(toxic)))
    return rows


def test_chain_on_held_out_documents(spark):
    rows = labelled(300)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows[:200]] + [(None, 1, 1), (5, None, 1)],
                                   "doc_id long, junk int, toxic int")
    chain = toxicity.train(docs, labels, ["junk", "toxic"])
    assert len(chain[1].earlier) == 1
    got = {r.doc_id: r for r in toxicity.score(docs, chain, ["junk", "toxic"]).collect()}
    held = rows[200:]
    assert sum(got[r[0]].toxic == bool(r[3]) for r in held) >= 0.97 * len(held)
    assert sum((got[r[0]].p_junk > 0.5) == bool(r[2]) for r in held) >= 0.9 * len(held)


def test_chain_without_labels_and_odd_rows(spark):
    docs, none = frame(spark), spark.createDataFrame([], "doc_id long, junk int, toxic int")
    chain = toxicity.train(docs, none, ["junk", "toxic"])
    got = toxicity.score(docs, chain, ["junk", "toxic"]).collect()
    assert len(got) == len(corpus()) and not any(r.toxic for r in got)
    assert toxicity.score(frame(spark, []), chain, ["junk", "toxic"]).count() == 0


def test_unrelated_rows_of_one_id_stay(spark):
    a, b = prose(1, 60), prose(2, 60)
    docs = frame(spark, [(1, a, "en", None, "k", "r", 0, 0), (5, a + " zz", "en", None, "k", "r", 0, 0),
                         (5, b, "en", None, "k", "r", 0, 0)])
    assert {r.text for r in near_join.drop_near_copies(docs).collect()} == {a, b}


def test_near_copies_without_ids(spark):
    a, b = prose(3, 60), prose(4, 60)
    rows = [(None, a + f" w{k}", "en", None, "k", "r", 0, 0) for k in range(5)]
    rows += [(None, b, "en", None, "k", "r", 0, 0), (9, a, "en", None, "k", "r", 0, 0)]
    kept = near_join.drop_near_copies(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(None, b), (9, a)], key=repr)


def test_many_rows_without_ids_take_linear_time(spark):
    rows = [(None, prose(k, 40), "en", None, "k", "r", 0, 0) for k in range(3000)]
    got = near_join.near_classes(frame(spark, rows))
    assert got.where("n_links = 0").count() == 3000


def test_ids_of_any_type_and_clashing_columns(spark):
    a = prose(3, 60)
    docs = spark.createDataFrame(
        [("x", a, 1, 2, 3, 4, 5), ("y", a + " w", 1, 2, 3, 4, 5), ("z", prose(4, 60), 1, 2, 3, 4, 5)],
        "doc_id string, text string, key int, first int, rid int, row int, path int")
    kept = near_join.drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == 2


def test_sketches_keep_near_pairs():
    rnd = np.random.default_rng(8)
    for trial in range(300):
        n = int(rnd.integers(1, 800))
        shared = rnd.integers(0, 2 ** 32, n, dtype=np.uint64).astype(np.uint32)
        own = [rnd.integers(0, 2 ** 32, n // 9, dtype=np.uint64).astype(np.uint32) for _ in range(2)]
        held = [near_join.sketch(np.unique(np.concatenate([shared, x]))) for x in own]  # Jaccard 0.8 or more
        far = near_join.sketch(rnd.integers(0, 2 ** 32, 600, dtype=np.uint64).astype(np.uint32))
        stay = near_join.alike(np.frombuffer(b"".join([*held, far]), np.uint8).reshape(-1, near_join.BINS))
        assert stay[0, 1] and stay[1, 0] and not stay.diagonal().any()
        if n > 400:
            assert not stay[2].any()
