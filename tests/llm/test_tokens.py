"""Token counts, packing and pieces against the libraries themselves."""
import random
import zlib
from collections import Counter as Tally

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from replyscope.llm.packing import CapacityTree, Encoder, best_fit_decreasing, pack
from replyscope.llm.piece_dropout import Encoder as Pieces
from replyscope.llm.piece_dropout import MASK, decode_pieces, encode_pieces, segmentations
from replyscope.llm.token_counts import Counter, count_tokens

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "abcdeé'stllm .,;!?0123456789<|>/\n\t ßİΣσς東京́̀가\x1c🙂ǅ²½_  ▁"


def odd_texts(n, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = "".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30)))
        if i % 5 == 0:
            s += rng.choice(["<|startoftext|>", "<|endoftext|>", " <|endoftext|>'s"]) + s[:4]
        out.append(s)
    return out


@pytest.fixture(scope="module")
def word_counter():
    return Counter(WORD)


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORD)


def test_counts_equal_the_library_for_any_chunks(word_counter, word_library):
    for i, s in enumerate(odd_texts(4000)):
        want = len(word_library.encode(s, add_special_tokens=False))
        assert word_counter.count(s, (3, 7, 1000)[i % 3]) == want, s


def test_random_words_have_one_segmentation(word_counter, word_library):
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 25)))
             for _ in range(4000)]
    assert [word_counter.count(w) for w in words] == \
        [len(e) for e in word_library.encode_batch(words, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n'", max_size=6), max_size=7))
def test_chunk_maps_compose_in_any_grouping(word_counter, parts):
    maps = [word_counter.chunk_map(p) for p in parts if p]
    if not maps:
        return
    left = maps[0]
    for m in maps[1:]:
        left = word_counter.compose(left, m)
    assert left == word_counter.scan(maps)


def test_count_query(docs, odd_rows, word_library):
    got = sorted(map(tuple, count_tokens(docs(odd_rows), WORD).collect()), key=str)
    want = []
    for k, t in odd_rows:
        n = len(word_library.encode(t or "", add_special_tokens=False))
        want.append((k, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=str)
    assert count_tokens(docs([]), WORD).collect() == []


def test_byte_ids_equal_the_library():
    library, ours = Tokenizer.from_file(BYTE), Encoder(BYTE)
    for s in odd_texts(4000, 9):
        ids = library.encode(s, add_special_tokens=False).ids
        assert ours.encode(s) == np.asarray(ids, dtype="<u4").tobytes(), s


def plain_best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [b for b in bins if b >= n]
        if fit:
            bins[bins.index(min(fit))] -= n
        else:
            bins.append(capacity - n)
    return bins


@settings(max_examples=60, deadline=None)
@given(st.sampled_from([7, 32, 100]).flatmap(
    lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_ranges_are_best_fit_decreasing(case):
    capacity, lengths = case
    plan = best_fit_decreasing(Tally(lengths), capacity)
    bins = {}
    for n, count in Tally(lengths).items():
        mine = [i for i in range(len(plan["length"])) if plan["length"][i] == n]
        for r in range(count):
            i = [j for j in mine if plan["first"][j] <= r][-1]
            step = r - plan["first"][i]
            bins.setdefault(plan["bin"][i] + step // plan["per_bin"][i], []).append(
                (plan["offset"][i] + step % plan["per_bin"][i] * n, n))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
    assert sorted(capacity - sum(n for _, n in h) for h in bins.values()) == \
        sorted(plain_best_fit(lengths, capacity))


def test_tightest_bin():
    tree = CapacityTree(10)
    assert tree.tightest(1) is None
    for r in (3, 7, 10):
        tree.add(r, 1)
    assert [tree.tightest(n) for n in (1, 3, 4, 7, 8, 10)] == [3, 3, 7, 7, 10, 10]
    tree.add(7, -1)
    assert tree.tightest(4) == 10


@pytest.mark.parametrize("per_bucket", [1, 1000])
def test_packing_places_every_piece_once(docs, odd_rows, per_bucket):
    library = Tokenizer.from_file(BYTE)
    rows = odd_rows + [(100 + i, "same text here") for i in range(40)]
    got = pack(docs(rows), BYTE, capacity=64, rows_per_bucket=per_bucket).collect()
    want = []
    for k, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((k, p, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, n in sorted(held):
            assert offset == at
            at += n
        assert at <= 64
    assert len(bins) == len(plain_best_fit([r.length for r in got], 64))


def test_packing_an_empty_table(docs):
    assert pack(docs([]), BYTE).collect() == []


def test_pieces_without_dropout_are_the_library_ones():
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    ours = Pieces(PIECE, 0, 1)
    for s in [*odd_texts(2000), "word " * 50, "x" * 300, "the  theme"]:
        if "▁" not in s and s:
            assert np.frombuffer(ours.encode(s, 3), "<u4").tolist() == library.encode(s), s


def test_dropout_varies_repeats_and_decodes():
    a, b, again = (Pieces(PIECE, .3, s) for s in (1, 2, 1))
    text = "the segmentation of international understanding " * 20
    one = a.encode(text, 5)
    assert one == again.encode(text, 5)
    assert one != b.encode(text, 5) and one != a.encode(text, 6)
    assert one != Pieces(PIECE, 0, 1).encode(text, 5)
    for s in [text, *odd_texts(2000, 3)]:
        assert a.model.decode(np.frombuffer(a.encode(s, 8), "<u4").tolist()) == s
    letters = Pieces(PIECE, 1, 1).encode("abc", 0)
    assert [a.model.library.id_to_piece(int(i)) for i in np.frombuffer(letters, "<u4")] == \
        ["▁", "a", "b", "c"]


def test_list_and_heap_agendas_agree():
    model = Pieces(PIECE, .2, 1).model
    rng = random.Random(4)
    for _ in range(500):
        s = "▁" + "".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 40)))
        key = rng.getrandbits(64) & MASK
        assert model._merge_short(s, .2, key) == model._merge_long(s, .2, key)


def test_piece_queries(docs, odd_rows):
    rows = docs(odd_rows)
    encoded = encode_pieces(rows, PIECE).cache()
    decoded = decode_pieces(encoded, PIECE).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in decoded))) == \
        sorted(map(str, ((k, t or "") for k, t in odd_rows)))
    report = segmentations(rows, PIECE).collect()
    assert len(report) == len(odd_rows) and all(r.lossless for r in report)
    assert sorted(r.n_pieces for r in report) == sorted(len(r.ids) for r in encoded.collect())
    assert encode_pieces(docs([]), PIECE).collect() == []


def test_dropout_acts_on_each_occurrence():
    coder, rng = Pieces(PIECE, .1, 7), random.Random(6)
    for word in ("the", "international", "segmentation"):
        alone = Tally(coder.encode(word, doc) for doc in range(6000))
        want = Tally(coder._bytes(coder.model.merge("▁" + word, .1, rng.getrandbits(64)))
                     for _ in range(6000))
        assert all(abs(alone[f] - want[f]) < 240 for f in alone | want)
        # Within a document as well, and no two documents are drawn alike.
        inside = [coder.encode(" ".join([word] * 50), doc) for doc in range(40)]
        assert len(set(inside)) == 40
    assert len(alone) > 20


def test_skips_by_number_are_the_keyed_skips():
    model = Pieces(PIECE, .2, 1).model
    for s in ("▁international", "▁the", "▁segmentation"):
        plain, count = model.merge_skipping(s, ())
        assert plain == model.merge(s, 0, 0)
        every, _ = model.merge_skipping(s, tuple(range(100)))
        assert every == list(s) and count > 0


def test_automaton_lasts_for_the_words_of_some_megabytes(monkeypatch):
    """Starting it afresh costs more than all other work on unseen words."""
    tokens = Counter(public_tokenizers.path("word_bpe_49k.json"))
    starts = []
    monkeypatch.setattr(tokens.transducer, "_reset", lambda: starts.append(1))
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(20_000)]
    tokens.count(" ".join(words))
    assert 50_000 < len(tokens.transducer.held) and not starts


@pytest.mark.parametrize("dropout", [0, .1, .5, 1])
def test_segments_side_by_side_equal_one_by_one(dropout, monkeypatch):
    """Segments of a batch run as arrays, whatever their length and block."""
    from replyscope.llm import piece_dropout
    one, many = Pieces(PIECE, dropout, 7), Pieces(PIECE, dropout, 7)
    rng = random.Random(8)
    texts = [*odd_texts(300, 4), "", " ", "the " * 400, "x" * 300, "  two  marks ▁ here ", "東京" * 40]
    texts += ["".join(rng.choices("etaoinshrdlu,. é", k=rng.randint(1, 400))) for _ in range(60)]
    keys = [rng.randrange(-2 ** 63, 2 ** 63) for _ in texts]
    want = [one.encode(t, k) for t, k in zip(texts, keys)]
    monkeypatch.setattr(piece_dropout, "BLOCK_CHARS", 100)
    assert [i.tobytes() for i in many.encode_all(texts, keys)] == want
    monkeypatch.undo()
    assert [i.tobytes() for i in many.encode_all(texts, keys)] == want
    assert many.encode_all([], []) == []
    plain = [t for t in texts if "▁" not in t and max(map(len, (" " + t).split(" "))) < 40]
    monkeypatch.setattr(many.model, "merge_skipping", None)     # none of these runs alone
    assert len(many.encode_all(plain, [1] * len(plain))) == len(plain)


def test_words_of_a_batch_equal_the_library_and_leave_no_states(word_library):
    """Unknown words take their transitions side by side; the automaton does
    not grow with them."""
    tokens, rng = Counter(WORD), random.Random(11)
    texts = odd_texts(1500, 12) + ["", "x" * 5000, "東" * 90, "ab " * 30_000]
    texts.append(" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
                          for _ in range(20_000)))
    want = [len(e) for e in word_library.encode_batch(texts, add_special_tokens=False)]
    assert tokens.count_all(texts) == want
    assert tokens.count_all(texts, 7) == want
    held = len(tokens.transducer.held)
    more = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 30))) for _ in range(9000)]
    assert tokens.count_all([" ".join(more)]) == \
        [len(word_library.encode(" ".join(more), add_special_tokens=False))]
    assert len(tokens.transducer.held) == held
    assert tokens.transducer.counts([]).tolist() == []
    assert tokens.transducer.counts(more).tolist() == [tokens.transducer.count(w) for w in more]


def test_a_worker_keeps_one_counter_over_its_tasks(spark):
    """The package is pickled by value; a task's copy finds the counter of the
    one before."""
    from pyspark import cloudpickle
    from replyscope.llm.token_counts import counter
    first, second = (cloudpickle.loads(cloudpickle.dumps(lambda: counter(WORD))) for _ in range(2))
    assert first() is second()
