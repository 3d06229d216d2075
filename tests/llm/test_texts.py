"""Quality rules, exact dedup, packing, token files and mixing."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import corpus, frame, prose, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mediatables.llm import exact_dedup, mixing, packing, quality, token_files, tokens
from mediatables.session import scratch_path, session_conf

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    return t


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup, line_chars = set(), 0, 0
    for line in text.split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if own and line in seen:
            dup += 1
            line_chars += sum(map(len, own))
        seen.add(line)
    chars = sum(map(len, words))
    failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
    kept = not failed and 100 * line_chars <= quality.LINE_PERCENT * chars
    for n, most in quality.NGRAM_PERCENT.items():
        grams = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
        cover = {j for i in range(len(words) - n + 1) if grams[tuple(words[i:i + n])] > 1 for j in range(i, i + n)}
        kept &= 100 * sum(len(words[j]) for j in cover) <= most * chars
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), chars, symbols, dup, len(inside), failed, kept


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n#\t", max_size=200))
def test_quality_measures_match_brute_force(text):
    m = quality.measure(text)
    assert (*m[:5], *m[7:]) == brute_quality(text)


def test_quality_rows(spark):
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept)
           for r in quality.quality_rules(frame(spark)).collect()]
    assert sorted(got, key=repr) == sorted([(r[0], *brute_quality(r[1])) for r in corpus()], key=repr)
    kept = quality.keep_good(frame(spark))
    assert kept.columns == frame(spark).columns
    assert rows_of(kept) == sorted((r for r in corpus() if brute_quality(r[1])[-1]), key=repr)
    assert quality.quality_rules(frame(spark, [])).count() == quality.keep_good(frame(spark, [])).count() == 0


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_groups(spark):
    groups = defaultdict(list)
    for r in corpus():
        groups[lowered(r[1])].append(r[0])
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = ids.index(keep)
        want += [(i, keep, len(ids), k == first, digest) for k, i in enumerate(ids)]
    assert rows_of(exact_dedup.exact_groups(frame(spark))) == sorted(want, key=repr)
    kept = exact_dedup.drop_exact_copies(frame(spark))
    assert kept.columns == frame(spark).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((w[0] for w in want if w[3]), key=repr)
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0
    assert exact_dedup.drop_exact_copies(frame(spark, [])).count() == 0


def test_drop_exact_copies_with_any_names_and_ids(spark):
    rows = [("a", "T", 1, 2, 3, 4, 5, 6, 7), ("b", "t", 1, 2, 3, 4, 5, 6, 7), (None, None, 1, 2, 3, 4, 5, 6, 7),
            ("9", "", 1, 2, 3, 4, 5, 6, 7), ("10", "other", 1, 2, 3, 4, 5, 6, 7)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, h int, n int, pid int, max_id int, row int, "
                                       "rest int, `a.b` int")
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id, r.text) for r in kept.collect())
    assert got[0] == ("10", "other") and got[1] == ("9", "") and len(got) == 3


def test_exact_dedup_spills_until_buckets_fit(spark):
    rows = [(i, prose(i % 300, 30), "en", "s", "", "", 0, 0) for i in range(900)]
    small = exact_dedup.exact_groups(frame(spark, rows), table_bytes=4000)
    assert rows_of(small) == rows_of(exact_dedup.exact_groups(frame(spark, rows)))
    assert {r.group_size for r in small.collect()} == {3}


def test_content_table_compares_contents():
    table = exact_dedup.ContentTable()
    entries = [table.entry(5, b"%d" % (k % 3000)) for k in range(6000)]  # one hash for all
    assert entries[:3000] == list(range(3000)) == entries[3000:]


SPACES = st.text(alphabet=" \n\t\x1c\x85  　​ab1é,.!'ʰ", max_size=30)


def test_special_tokens_as_the_library_reads_them(tokenizer):
    text = "a <|endoftext|> b<|endoftext|>c  <|endoftext|>"
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert 50256 in want and [x.tolist() for x in tokens.encoder(PATH).encode([text])] == [want]


def test_encoder_forgets_and_keeps_no_state_between_texts(tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    own = tokens.Encoder(PATH)
    for k in range(6):
        texts = [prose(k + j, 40) + " word### word. Word... don't x" for j in range(3)] + ["", " lead", "new" * k]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in own.encode(texts)] == want


def test_encoder_cuts_few_texts_at_once(monkeypatch):
    texts = [prose(300 + k, 40) for k in range(30)] + ["", "one", " two  words"] + [prose(400, 900)]
    whole = [x.tolist() for x in tokens.Encoder(PATH).encode(texts)]
    own, seen, plain = tokens.Encoder(PATH), [], tokens.Encoder._encode
    monkeypatch.setattr(tokens, "CUT_CHARS", 1000)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 100)
    monkeypatch.setattr(tokens.Encoder, "_encode", lambda self, t: seen.append(t) or plain(self, t))
    assert [x.tolist() for x in own.encode(texts)] == whole and own.encode([]) == []
    assert all(len(t) < 2 or sum(map(len, t)) <= 1000 for t in seen) and sum(seen, []) == texts


@settings(max_examples=150, deadline=None)
@given(st.lists(SPACES, max_size=20))
def test_encoder_equals_tokenizer(texts):
    t = Tokenizer.from_file(PATH)
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in tokens.encoder(PATH).encode(texts)] == want


MIXED = st.text(alphabet=" \n\n  ab'st1.,-|<>~éßŁж中…\x0b\xa0", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(MIXED, max_size=20))
def test_pieces_equal_tokenizer(texts):
    t = tokens.encoder(PATH)._tokenizer
    texts.append("don't  'tis it's\n\nend.\n x\n <|endoftext|> y<|endoftext|>\n\n")
    want = [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in tokens.encoder(PATH).encode(texts)] == want


def test_letters_of_plain_words(tokenizer):
    """All are letters to the library as well."""
    letters = [chr(c) for c in range(0x530) if re.fullmatch(f"[{tokens.LETTERS}]", chr(c))]
    pieces = tokenizer.pre_tokenizer.pre_tokenize_str(" " + "".join(letters))
    assert len(letters) > 700 and len(pieces) == 1
    texts = [f"x a{c}b 1{c}2 .{c}. {c}" for c in letters]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in tokens.Encoder(PATH).encode(texts)] == want


def test_tokenizer_is_asked_for_new_pieces_only(tokenizer, monkeypatch):
    """Words that differ in punctuation and line ends share their pieces, and
    pieces met again outlast the others."""
    texts = ["x " + " ".join(f"{w}{end}{v}" for w in ("the", "house", "tree") for v in ("The", "House", "Tree"))
             for end in (".\n", ", ", "-", ";\n", "... ", ")\n")]
    own = tokens.Encoder(PATH)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in own.encode(texts)] == want
    assert len(own._pieces) < 20
    monkeypatch.setattr(tokens, "CACHE_WORDS", 60)
    own.encode(["x " + " ".join(f"once{k}a" for k in range(70))] + texts)
    learned = []
    plain = tokens.Encoder._learn
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, p: learned.extend(p) or plain(self, p))
    assert [ids.tolist() for ids in own.encode(texts)] == want and not learned and len(own._pieces) < 60


def test_pieces_of_half_a_million_words_are_learned_once(monkeypatch):
    texts = ["x " + " ".join(f"{chr(97 + a)}{chr(97 + b)}{chr(97 + c)}{chr(97 + d)}" for c in range(26) for d in range(26))
             for a in range(25) for b in range(26)]
    own, learned, plain = tokens.Encoder(PATH, token_files.ROOM), [], tokens.Encoder._learn
    monkeypatch.setattr(tokens.Encoder, "_learn", lambda self, p: learned.extend(p) or plain(self, p))
    first, again = own.encode(texts), own.encode(texts)
    assert len(learned) == len(set(learned)) == 25 * 26 ** 3
    assert all((x == y).all() for x, y in zip(first, again, strict=True))


def ids_of(tokenizer, text):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_packing(spark, tokenizer):
    rows = packing.pack(frame(spark), PATH, size=64).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 64 and at & (at - 1) == 0  # no sequence needs padding
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids, r.doc_tokens))
    for doc_id, text in {r[0]: r[1] for r in corpus() if r[0] not in (None, 10)}.items():
        want, at = ids_of(tokenizer, text), 0
        for start, length, ids, total in sorted(pieces[doc_id]):
            assert start == at and total == len(want) and ids == want[start:start + length].tobytes()
            at += length
        assert at == len(want)
    assert packing.pack(frame(spark, []), PATH).count() == 0


def test_equal_rows_are_spread(spark, tokenizer):
    """Rows equal in id and text, with null and repeated ids: each packs whole,
    and neither groups nor ranges get them all."""
    rows = [(None, None, "en", "s", "", "", 0, 0)] * 300 + [(10, prose(1, 30), "en", "s", "", "", 0, 0)] * 300
    docs = frame(spark, rows).repartition(4)
    apart = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with session_conf(spark, apart):
        got = packing.pack(docs, PATH, size=64).collect()
    n = len(ids_of(tokenizer, prose(1, 30)))
    for doc_id, total in ((None, 1), (10, n)):
        own = [r for r in got if r.doc_id == doc_id]
        assert {r.doc_tokens for r in own} == {total} and sum(r.length for r in own) == 300 * total
    assert len({r.sequence_id >> 32 for r in got if r.doc_id is None}) > 1
    path = scratch_path(spark, "test-equal")
    with session_conf(spark, apart):
        token_files.write_tokens(docs, path, PATH)
    blocks = spark.read.schema(token_files.BLOCKS).parquet(path)
    found = token_files.read_documents(blocks).orderBy("start", "n_tokens").collect()
    assert len(found) == 600 and blocks.select("shard").distinct().count() > 1
    at = 0
    for r in found:
        assert r.start == at and r.n_tokens == (1 if r.doc_id is None else n)
        at += r.n_tokens


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=60))
def test_first_fit_decreasing(lengths):
    pieces = [(k, 0, n) for k, n in enumerate(lengths)]
    bins = packing.first_fit_decreasing(pieces, 64)
    want: list[list] = []
    for piece in sorted(pieces, key=lambda p: (-p[2], p[0])):
        fit = next((b for b in want if sum(p[2] for p in b) + piece[2] <= 64), None)
        fit.append(piece) if fit is not None else want.append([piece])
    assert bins == want
    closed = packing.close_gaps(bins, 64)
    cells = sorted((d, s + k) for b in closed for d, s, n in b for k in range(n))
    assert cells == [(d, k) for d, n in enumerate(lengths) for k in range(n)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 6), min_size=1, max_size=60), max_size=12))
def test_repair_round_trip(docs):
    docs = [np.array(d, np.uint16) for d in docs]
    block = token_files.Block(token_files.compress(docs, 50))
    assert [d.tolist() for d in block.documents()] == [d.tolist() for d in docs]
    for k, d in enumerate(docs):
        assert block.slice(k, 3, 11).tolist() == d[3:11].tolist()


def test_repair_shortens_repetition():
    docs = [np.array([1, 2, 3, 4] * 500, np.uint16)]
    block = token_files.Block(token_files.compress(docs, 50))
    assert len(block.symbols) <= 500 and len(block.rules) and int(block.expansion.max()) >= 4


def test_pairs_of_two_byte_symbols_are_narrow_keys(monkeypatch):
    """Symbols of two bytes are compared as pairs of four bytes, with the same
    rules and the same ids as wide ones at and beyond that bound."""
    rng = np.random.default_rng(5)
    docs = [rng.integers(0, 40, 3000).astype(np.uint16) for _ in range(4)]
    docs.append(np.tile(np.array([40, 41, 42, 43], np.uint16), 500))
    seen, plain = set(), token_files._slot
    monkeypatch.setattr(token_files, "_slot", lambda keys: seen.add(keys.dtype.itemsize) or plain(keys))
    blocks = {}
    for vocabulary, widths in ((50, {4}), ((1 << 16) - 1, {4, 8}), (1 << 17, {8})):
        seen.clear()
        blocks[vocabulary] = token_files.Block(token_files.compress(docs, vocabulary))
        assert seen == widths
        assert [d.tolist() for d in blocks[vocabulary].documents()] == [d.tolist() for d in docs]
        assert blocks[vocabulary].slice(4, 3, 1999).tolist() == docs[4][3:1999].tolist()
        sizes = [len(blocks[vocabulary]._expand(np.array([vocabulary + k], np.uint32))) for k in range(len(blocks[vocabulary].rules))]
        assert sizes and sizes == blocks[vocabulary].expansion.tolist()


def test_blocks_are_read_by_spelling_each_rule_once(monkeypatch):
    docs = [np.array([1, 2, 3, 4, 5] * 400 + [k], np.uint16) for k in range(20)]
    block = token_files.Block(token_files.compress(docs, 50))
    spelled, plain = [], token_files.Block._expand
    monkeypatch.setattr(token_files.Block, "_expand", lambda self, s: spelled.extend(s.tolist()) or plain(self, s))
    assert [d.tolist() for d in block.documents()] == [d.tolist() for d in docs]
    assert len(block.rules) and spelled == [50 + k for k in range(len(block.rules))]
    assert token_files.Block(token_files.compress([], 50)).documents() == []


def test_token_files(spark, tokenizer):
    path = scratch_path(spark, "test-tokens")
    token_files.write_tokens(frame(spark), path, PATH, block_ids=500)
    got = sorted(token_files.read_documents(spark.read.parquet(path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in corpus()), key=lambda i: (i is not None, i))
    at = 0
    texts = defaultdict(list)
    for r in corpus():
        texts[r[0]].append(ids_of(tokenizer, r[1]))
    for r in got:
        assert r.start == at
        assert (r.n_tokens, r.ids_crc32) in [(len(x), zlib.crc32(x.tobytes())) for x in texts[r.doc_id]]
        at += r.n_tokens
    empty = scratch_path(spark, "test-tokens")
    token_files.write_tokens(frame(spark, []), empty, PATH)
    blocks = spark.read.schema(token_files.BLOCKS).parquet(empty)
    assert token_files.read_documents(blocks).count() == 0


def test_mixing(spark):
    mix = mixing.Mix(budget_percent=50)
    rows = mixing.mix_counts(frame(spark), mix).collect()
    assert len(rows) == len(corpus())
    leaves = defaultdict(list)
    for r in rows:
        leaves[r.domain, r.lang, r.source].append(r)
    for members in leaves.values():
        budget, total = members[0].leaf_budget, members[0].leaf_tokens
        assert total == sum(r.tokens for r in members)
        assert sum(r.tokens * r.copies for r in members) <= budget <= 2 * total
        assert max(r.copies for r in members) - min(r.copies for r in members) <= 1
    assert sum(m[0].leaf_budget for m in leaves.values()) <= sum(r.tokens for r in rows) // 2
    taken = mixing.mixed(frame(spark), mix)
    assert taken.columns == frame(spark).columns
    assert taken.count() == sum(r.copies for r in rows)
    assert mixing.mix_counts(frame(spark, []), mix).count() == mixing.mixed(frame(spark, []), mix).count() == 0


def test_weight_zero_takes_nothing_and_loses_nothing(spark):
    leaves = [("web", "en", "src0", 100), ("web", "es", "src0", 1000), ("forum", "en", "x", 1000)]
    mix = mixing.Mix(domain_weights={"web": 1, "forum": 1}, lang_weights={"en": 1, "es": 0}, budget_percent=50,
                     max_epochs=1)
    df = spark.createDataFrame([(*x, 1) for x in leaves], "domain string, lang string, source string, tokens long, n_docs long")
    got = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(df, mix).collect()}
    assert got == {("web", "en"): 100, ("web", "es"): 0, ("forum", "en"): 950}


def test_rows_without_ids_share_one_place_in_the_order(spark):
    rows = [(None, prose(k, 10), "en", "src0", "", "", 0, 0) for k in range(200)]
    rows += [(k, prose(k, 10), "en", "src0", "", "", 0, 0) for k in range(200)]
    got = mixing.mix_counts(frame(spark, rows), mixing.Mix(budget_percent=60, max_epochs=1)).collect()
    none = {r.copies for r in got if r.doc_id is None}
    assert len(none) == 1 and sum(r.tokens * r.copies for r in got) <= got[0].leaf_budget
    order = sorted({(hashlib.md5(f"7:0:{'(none)' if r.doc_id is None else r.doc_id}".encode()).hexdigest(), r.copies)
                    for r in got})
    assert [c for _, c in order] == sorted((c for _, c in order), reverse=True)


def test_shortages_go_to_siblings_first(spark):
    leaves = [("web", "en", "src0", 10), ("web", "de", "src0", 1000), ("forum", "en", "x", 1000)]
    mix = mixing.Mix(domain_weights={"web": 1, "forum": 1}, lang_weights={}, budget_percent=50, max_epochs=1)
    df = spark.createDataFrame([(*x, 1) for x in leaves], "domain string, lang string, source string, tokens long, n_docs long")
    got = {(r.domain, r.lang): r.budget for r in mixing.leaf_budgets(df, mix).collect()}
    assert got == {("web", "en"): 10, ("web", "de"): 492, ("forum", "en"): 502}
