"""Aligned tokens against a plain walk over both libraries' tokens."""
import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from replyscope.llm import queries
from replyscope.llm.token_counts import byte_symbols
from replyscope.llm.token_overlap import Alignment, gallop, overlaps, ranks, tokenizers

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


class Libraries:
    def __init__(self):
        self.a = Tokenizer.from_file(BYTE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
        self.byte = {c: b for b, c in enumerate(byte_symbols())}

    def tokens(self, text):
        """(id, bytes) of both sides, or nothing."""
        if not text:
            return [], []
        a = [(i, bytes(self.byte[c] for c in self.a.id_to_token(i)))
             for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            p = self.b.id_to_piece(i)
            b.append((i, bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                      else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        if b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            return [], []
        return a, b


def spans(tokens):
    out, at = [], 0
    for i, x in tokens:
        out.append((at, at + len(x), i))
        at += len(x)
    return out


def brute(rows):
    lib = Libraries()
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b = map(spans, lib.tokens(text))
        common = {e for _, e, _ in a} & {e for _, e, _ in b}
        parts = []
        for side in (a, b):
            parts.append([[]])
            for _, e, i in side:
                parts[-1][-1].append(str(i))
                if e in common:
                    parts[-1].append([])
        groups = ["|".join(map(",".join, pair)) for pair in zip(*parts)][:-1]
        links, j = [], 0
        for s, e, i in a:
            while j and b[j - 1][1] > s:
                j -= 1
            while j < len(b) and b[j][1] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][0] < e:
                links.append((i, b[k][2]))
                k += 1
        counts.update(links)
        docs.append((doc_id, len(a), len(b), len(groups), links,
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(most.get(j, 0), n)
    return sorted(((d, na, nb, g, len(links), sum(counts[p] == most[p[1]] for p in links),
                    sum(counts[p] for p in links), sha) for d, na, nb, g, links, sha in docs),
                  key=str)


def collected(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
                    r.groups_sha256) for r in df.collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(1, 9), min_size=1, max_size=60), min_size=1, max_size=5),
       st.integers(0, 2 ** 30))
def test_ranks_and_ranges(docs, seed):
    rng = random.Random(seed)
    left, right = [], []
    for doc in docs:
        total, other = sum(doc), []
        while sum(other) < total:
            other.append(min(rng.randint(1, 14), total - sum(other)))
        left += doc
        right += other
    drive, ends = np.cumsum(left), np.cumsum(right)
    want = np.searchsorted(ends, drive)
    assert ranks(drive, ends).tolist() == want.tolist()
    assert gallop(drive, ends, np.zeros(len(drive), dtype=np.int64)).tolist() == want.tolist()
    one = Alignment(np.asarray(left), np.asarray(right))
    assert one.meets.tolist() == [int(e) in set(ends.tolist()) for e in drive]
    pairs = {(i, j) for i in range(len(left)) for j in range(len(right))
             if drive[i] - left[i] < ends[j] and ends[j] - right[j] < drive[i]}
    assert set(zip(*(x.tolist() for x in one.links()))) == pairs


def test_bytes_of_ids_equal_the_libraries():
    tok, lib = tokenizers(BYTE, PIECE), Libraries()
    texts = ["<s> x </s> <unk>", "<|endoftext|> a", "東京 é\x00\x1c🙂\n\n \t", "ﬁ ½ ̀a", " ", "  b"]
    for text, (a, b) in zip(texts, tok.encode(texts)):
        want_a, want_b = lib.tokens(text)
        assert (a, b) == ([i for i, _ in want_a], [i for i, _ in want_b]), text
    assert tok.encode(["▁a"]) == [([], [])]
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        for entry, rank in map(bytes.split, f):
            assert tok.a_bytes[int(rank)] == base64.b64decode(entry)


def test_odd_rows_and_joined_counts(docs, odd_rows):
    rng = random.Random(4)
    rows = odd_rows + [(20 + i, " ".join(rng.choice(("under", "und", "naïve", "東京", "x1", "a,b"))
                                          for _ in range(30))) for i in range(20)] \
        + [(50, "▁ mark"), (51, "<s> <|endoftext|>"), (52, " "), (53, "\n" * 50)]
    want = brute(rows)
    # None, few, and all pairs in the broadcast table give the same.
    for limit in (0, 5, 1 << 20):
        assert collected(overlaps(docs(rows), BYTE, PIECE, table_pairs=limit)) == want
    assert collected(overlaps(docs([]), BYTE, PIECE)) == []
    assert collected(overlaps(docs([(1, None), (2, "")]), BYTE, PIECE)) == \
        [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_on_the_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert collected(queries.op12_token_overlap(spark, sf)) == brute(rows)
