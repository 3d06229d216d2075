"""Token links against a version that compares all token ranges."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import DOCS, corpus, frame, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from mediatables.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain():
    """Texts to (A ids with bytes, B ids with bytes), the libraries as they are."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B)
    table = {letter: byte for byte, letter in alignment.byte_letters().items()}

    def tokens(text):
        if not text:
            return [], []
        left = [(i, bytes(table[c] for c in a.id_to_token(i)))
                for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i)
                  else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
        want = (" " + text).encode()
        if b"".join(x for _, x in left) != want or b"".join(x for _, x in right) != want:
            return [], []
        return left, right
    return tokens


def ranges(tokens):
    out, at = [], 0
    for i, held in tokens:
        out.append((i, at, at + len(held)))
        at += len(held)
    return out


def links_and_groups(left, right):
    left, right = ranges(left), ranges(right)
    links = [(i, j) for i, s, e in left for j, t, f in right if s < f and t < e]
    ends = sorted({e for _, _, e in left} & {e for _, _, e in right})
    groups, start = [], 0
    for end in ends:
        groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end)
                               for side in (left, right)))
        start = end
    return links, groups


def brute(rows):
    tokens = plain()
    found = [(r[0], *(lr := tokens(r[1])), *links_and_groups(*lr)) for r in rows]
    count = Counter(pair for _, _, _, links, _ in found for pair in set(links))
    highest = defaultdict(int)
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    return sorted(((doc, len(l), len(r), len(groups), len(links),
                    sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
                   for doc, l, r, links, groups in found), key=repr)


def small():
    extra = [(100, "a  b <|endoftext|> <s> </s>▁x"), (101, "tab\tand\nline \n end "), (102, " lead"),
             (103, "日本語 テキスト \U0001F600\U0001F601 naïve"), (104, "x\u0000y"), (105, "é ▁"),
             (106, "word nbsp 　wide"), (107, "same same same same"), (107, "same same"), (None, "same")]
    rows = [r for r in corpus() if len(r[1] or "") < 2000]
    return rows + [(i, t, "en", None, "k", "r", 0, 0) for i, t in extra]


def test_alignment_matches_brute_force(spark):
    got = rows_of(alignment.align(frame(spark, small()), A, B))
    assert got == brute(small())
    assert sum(r[1] > 0 for r in got) > 30


def test_long_texts(spark):
    rows = [r for r in corpus() if len(r[1] or "") >= 2000]
    got = rows_of(alignment.align(frame(spark, rows), A, B).select("doc_id", "n_a", "n_b"))
    tokens = plain()
    assert got == sorted(((r[0], *map(len, tokens(r[1]))) for r in rows), key=repr)


def test_small_blocks_agree(spark, monkeypatch):
    """Documents over several blocks and partitions count alike."""
    rows = small() * 3
    one = rows_of(alignment.align(frame(spark, rows).coalesce(1), A, B))
    many = rows_of(alignment.align(frame(spark, rows).repartition(7), A, B))
    assert one == many


def test_counts_of_pairs(spark):
    rows = small()
    got = {(r.a, r.b): (r.n_docs, r.n_links) for r in
           alignment.pair_counts(alignment.pair_index(frame(spark, rows), A, B)).collect()}
    tokens = plain()
    docs, total = Counter(), Counter()
    for r in rows:
        links = links_and_groups(*tokens(r[1]))[0]
        docs.update(set(links))
        total.update(links)
    assert got == {p: (docs[p], total[p]) for p in docs}


def test_bitmaps_round_trip():
    rnd = np.random.default_rng(5)
    sets = {p: np.sort(rnd.choice(alignment.BLOCK_DOCS, n, replace=False))
            for p, n in enumerate([1, 2, alignment.DENSE - 1, alignment.DENSE, alignment.DENSE + 1, alignment.BLOCK_DOCS])}
    pairs = np.repeat(list(sets), [len(x) for x in sets.values()])
    names, members, data, offsets = alignment.bitmaps(pairs, np.concatenate(list(sets.values())))
    for k, p in enumerate(names):
        held = data[offsets[k]:offsets[k + 1]].tobytes()
        assert members[k] == len(sets[p]) and alignment.members(held).tolist() == sets[p].tolist()
        assert len(held) <= alignment.BLOCK_DOCS // 8


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(" ab.é\n\t日▁' ​́")), min_size=1, max_size=4))
def test_words_or_whole_texts_are_alike(texts):
    known, found, words_only = alignment.aligner(A, B).units(texts)
    tokens = plain()
    for text, units in zip(texts, found):
        links, groups = links_and_groups(*tokens(text))
        assert ";".join(known.groups[u] for u in units) == ";".join(groups)
        assert Counter((p >> 16, p & 0xFFFF) for p in known.links(units)[0].tolist()) == Counter(links)
    known.cut(words_only)


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "")]])
def test_without_tokens(spark, rows):
    got = alignment.align(frame(spark, [(*r, "en", None, "k", "r", 0, 0) for r in rows]), A, B)
    assert rows_of(got) == sorted(((i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows), key=repr)
    assert [f.name for f in DOCS][0] == "doc_id"
