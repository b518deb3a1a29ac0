"""Token counts and packing against the library itself."""

import math
import random
import zlib

import numpy as np
import pytest

from wafercast.llm import packing, token_counts
from wafercast.llm.queries import queries

from .conftest import ROWS, SMALL


@pytest.fixture(scope="module")
def tok():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(token_counts.vocabulary_path())


def ids(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def test_counts_equal_library(spark, tok, small):
    got = queries()["op1_token_counts"](spark, SMALL).toPandas().set_index("doc_id")
    assert len(got) == len(small)
    for i, t in small.items():
        n = len(ids(tok, t))
        assert (got.n_bytes[i], got.n_tokens[i], got.over_limit[i]) == (len(t.encode()), n, n > 2048)


def test_counts_edge_cases(edge, empty, tok):
    got = token_counts.count_tokens(edge, token_counts.vocabulary_path()).collect()
    want = sorted((r[0] or -1, len((r[1] or "").encode()), len(ids(tok, r[1]))) for r in ROWS)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert token_counts.count_tokens(empty, token_counts.vocabulary_path()).count() == 0


def test_counts_odd_texts(tok):
    reader = token_counts._reader(token_counts.vocabulary_path())
    ids_of = packing._reader(token_counts.vocabulary_path())
    rng = random.Random(5)
    parts = list("abcXYZ  \t\n'12.,!?éÀÿ×÷ªµßİıŉǅɏΣσς漢字🙂\u00ad\u0085\x1c\x00\x7f|<> ſK") + ["<|endoftext|>", "'s", "'LL", "</w>", "é"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        want = ids(tok, text)
        assert sum(reader.values(text.encode())) == len(want), repr(text)
        assert b"".join(ids_of.values(text.encode())) == np.array(want, "<u4").tobytes(), repr(text)
    long = "".join(rng.choice("abcdefgh") for _ in range(20000))
    assert sum(reader.values(long.encode())) == len(ids(tok, long))


def test_counts_latin_capitals(tok):
    """Capitals below U+0250 whose small letter lies above it are letters too."""
    reader = token_counts._reader(token_counts.vocabulary_path())
    ids_of = packing._reader(token_counts.vocabulary_path())
    for c in map(chr, range(0x80, 0x250)):
        for text in (f"ab{c}cd", c, f"1{c}{c}'s"):
            want = ids(tok, text)
            assert sum(reader.values(text.encode())) == len(want), repr(text)
            assert b"".join(ids_of.values(text.encode())) == np.array(want, "<u4").tobytes(), repr(text)


def check_packing(pdf, docs, tok):
    """Pieces are the documents' ids, sequences are gapless; number of sequences."""
    want = {}
    for i, t in docs:
        x = ids(tok, t) + [1]
        for p, at in enumerate(range(0, len(x), 4096)):
            part = np.array(x[at:at + 4096], "<u4")
            key = (i, p, at, len(part), zlib.crc32(part.tobytes()))
            want[key] = want.get(key, 0) + 1
    got = {}
    for r in pdf.itertuples():
        key = (None if r.doc_id != r.doc_id else r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
        got[key] = got.get(key, 0) + 1
    assert got == want
    for _, x in pdf.groupby("sequence_id"):
        x = x.sort_values("offset")
        assert (x.offset.to_numpy() == np.r_[0, x.length.cumsum().to_numpy()[:-1]]).all()
        assert x.length.sum() <= 4096
    return pdf.sequence_id.nunique()


def test_packing(spark, tok, small):
    pdf = queries()["op5_best_fit_packing"](spark, SMALL).toPandas()
    n = check_packing(pdf, list(small.items()), tok)
    assert n <= 1.02 * math.ceil(pdf.length.sum() / 4096) + 1


def test_packing_edge_cases(edge, empty, tok, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ITEMS", 6)     # several groups and rounds
    pdf = packing.pack(edge, token_counts.vocabulary_path()).toPandas()
    check_packing(pdf, [(r[0], r[1]) for r in ROWS], tok)
    assert packing.pack(empty, token_counts.vocabulary_path()).count() == 0


def test_genetic_algorithm_keeps_every_item():
    rng = random.Random(1)
    lengths = sorted((rng.randrange(1, 100) for _ in range(300)), reverse=True)
    first = packing.best_fit(range(300), lengths, [], 100)
    best = packing.evolve(lengths, [first, first], 100, seed=3, offspring=20)
    assert sorted(i for b in best for i in b) == list(range(300))
    assert all(sum(lengths[i] for i in b) <= 100 for b in best)
    assert len(best) <= len(first)
    child = packing.crossover(first, best, lengths, 100, rng)
    assert sorted(i for b in child for i in b) == list(range(300))
    assert packing._decode(packing._encode(best, 300)) and len(packing._decode(packing._encode(best, 300))) == len(best)


# ---- other vocabularies, and the genetic algorithm where best fit is not enough

def test_a_vocabulary_with_other_rules_is_read_by_the_library(spark, edge):
    from tokenizers import Tokenizer
    from wafercast.llm import packing, token_counts, vocab
    own, other = (token_counts.vocabulary_path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    assert vocab.cuts_at_space(vocab.load_tokenizer(own)) and not vocab.cuts_at_space(vocab.load_tokenizer(other))
    lib = Tokenizer.from_file(other)
    docs = edge.where("doc_id <> 11 and doc_id <> 12")
    want = {r.doc_id: lib.encode(r.text or "", add_special_tokens=False).ids for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, other).collect()} == {i: len(v) for i, v in want.items()}
    pieces = packing.token_pieces(docs, other, end_id=1).collect()
    import zlib
    import numpy as np
    assert all(r.ids_crc32 == zlib.crc32(np.array([*want[r.doc_id], 1], "<u4").tobytes()) for r in pieces)


def test_evolution_strictly_saves_bins():
    """Triplets that fill a bin exactly: best fit on sorted items needs more bins, evolution finds some of them."""
    import random
    from wafercast.llm import packing
    saved = 0
    for seed in range(6):
        rng, lengths = random.Random(seed), []
        for _ in range(8):
            a = rng.randint(260, 480)
            b = rng.randint(260, 1000 - a - 260)
            lengths += [a, b, 1000 - a - b]
        lengths.sort(reverse=True)
        first = packing.best_fit(range(24), lengths, [], 1000)
        best = packing.evolve(lengths, [], 1000, seed, population=12, offspring=400)
        again = packing.evolve(lengths, [best, first], 1000, seed + 1, population=12, offspring=400)
        assert sorted(i for b in best for i in b) == list(range(24)) and all(sum(lengths[i] for i in b) <= 1000 for b in again)
        assert len(again) <= len(best) <= len(first)
        saved += len(first) - len(again)
    assert saved > 0


def test_crossover_keeps_whole_bins_and_places_every_piece_once():
    import random
    from wafercast.llm import packing
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 600) for _ in range(60)), reverse=True)
    a = packing.best_fit(range(60), lengths, [], 1000)
    order = list(range(60))
    rng.shuffle(order)
    b = packing.best_fit(order, lengths, [], 1000)
    child = packing.crossover(a, b, lengths, 1000, random.Random(3))
    assert sorted(i for x in child for i in x) == list(range(60))
    whole = {frozenset(x) for x in b}
    assert sum(frozenset(x) in whole for x in child) >= 1
