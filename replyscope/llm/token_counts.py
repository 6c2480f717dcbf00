"""Token counts from a compiled tokenizer.

A byte-pair vocabulary is compiled into a deterministic transducer. Reading a
word symbol by symbol, each transition emits the change in the number of
tokens of the prefix read so far. A state is the set of vocabulary-trie nodes
that tokens still being read have reached, each with the token before it and
the count before it relative to now. Among the tokens that end at a symbol,
exactly one continues the segmentation before it: the one whose pair with the
token before it is not re-segmented by the merges. The unknown
words of a batch take their transitions side by side as arrays, and their
states last for a step; words met elsewhere (longer ones, those cut by a
chunk's border) go alone, and their states and transitions are kept.

Long texts are cut into chunks. White space resets the automaton, so the state
map of a chunk is (unfinished head, count, unfinished tail), or only a head if
the chunk has no white space. These maps compose associatively (the tail of
one meets the head of the next) and are combined by a pairwise scan."""
from __future__ import annotations

import gc
import json
import re
import sys
import types
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PairTable, map_batches, only

CHUNK_CHARS = 1 << 16
MAX_RUNS = 35_000        # runs without white space remembered per worker and generation
MAX_WORDS = 100_000      # words remembered per worker and generation
SIDE_BY_SIDE = 1 << 13   # words that take their transitions together
LONG_WORD = 64           # bytes from which a word goes alone
LONG_TEXT = 1 << 22      # characters of a batch from which runs are not gathered first
MAX_STATES = 90_000      # states kept before the automaton is started afresh
RESETS = re.compile(r"[\t\n\v\f\r \x85\xa0  -     　]+")
CONTROL = re.compile(r"[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use per byte."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


class Transducer:
    """Transitions ``(state, symbol) -> (state, emitted)`` over the symbols of
    one word. Symbols are the 256 bytes, and 256 more for a last byte, which
    carries the end-of-word suffix. A state is a flat tuple of (trie node,
    token before, count before relative to now) triples."""

    def __init__(self, merges: list[tuple[str, str]], suffix: str, vocab: dict[str, int]):
        printed = byte_symbols()
        names = printed + [c + suffix for c in printed]
        # Tokens are numbered: symbols first, then merges in rank order, so a
        # token's number orders the merges that made them.
        self.number = {t: i for i, t in enumerate(names)}
        self.parts: list[tuple[int, int]] = [(-1, -1)] * len(names)
        self.rank: dict[int, int] = {}
        for rank, (left, right) in enumerate(merges):
            made = self.number.setdefault(left + right, len(self.parts))
            if made == len(self.parts):
                self.parts.append((self.number[left], self.number[right]))
            self.rank[self._pair(self.number[left], self.number[right])] = rank + len(names)
        self.symbols = len(names)
        self.last = len(printed)
        byte = {c: i for i, c in enumerate(printed)}
        self.kids: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for token, number in self.number.items():
            if token not in vocab or not self._reached(number):
                continue
            node = 0
            for symbol in self._split(token, suffix, byte):
                below = self.kids[node].get(symbol)
                if below is None:
                    below = self.kids[node][symbol] = len(self.kids)
                    self.kids.append({})
                    self.ends.append(-1)
                node = below
            self.ends[node] = number
        # The same as arrays.
        self.child = PairTable({(node, symbol): below for node, kids in enumerate(self.kids)
                                for symbol, below in kids.items()})
        self.inner = np.asarray([bool(k) for k in self.kids])
        self.end = np.asarray(self.ends, dtype=np.int64)
        self.ranks = PairTable({(at >> 32, at & 0xFFFFFFFF): r for at, r in self.rank.items()})
        self.left, self.right = np.asarray(self.parts, dtype=np.int64).T.copy()
        self.made = np.asarray([-1 if a < 0 else self.rank[self._pair(a, b)]
                                for a, b in self.parts], dtype=np.int64)
        self._reset()

    @staticmethod
    def _pair(left: int, right: int) -> int:
        return left << 32 | right

    @staticmethod
    def _split(token: str, suffix: str, byte: dict[str, int]) -> list[int]:
        if suffix and token.endswith(suffix):
            body = [byte[c] for c in token[:-len(suffix)]]
            return [*body[:-1], body[-1] + len(byte)]
        return [byte[c] for c in token]

    def _reset(self) -> None:
        self.states: dict[tuple, int] = {}
        self.held: list[tuple] = []
        self.moves: dict[int, int] = {}
        self.known: dict[int, bool] = {}
        self._state((0, -1, 0))

    def _state(self, items: tuple) -> int:
        at = self.states.get(items)
        if at is None:
            at = self.states[items] = len(self.held)
            self.held.append(items)
        return at

    def _reached(self, token: int) -> bool:
        """Whether the merges make this token from its own symbols."""
        left, right = self.parts[token]
        return left < 0 or (self._reached(left) and self._reached(right)
                            and self._apart(left, right, self.rank[self._pair(left, right)]))

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """Whether the merges before ``limit`` leave the two tokens apart.

        The later of the merges that made the two symbols at their border is
        undone, again and again; if the border pair it uncovers would have
        merged before that, the two never came to stand side by side."""
        rank, parts, symbols = self.rank, self.parts, self.symbols
        while True:
            if rank.get(left << 32 | right, limit) < limit:
                return False
            if left < symbols and right < symbols:
                return True
            of_left = rank[self._pair(*parts[left])] if left >= symbols else -1
            of_right = rank[self._pair(*parts[right])] if right >= symbols else -1
            if of_left > of_right:      # equal merges run from the left
                limit, left = of_left, parts[left][1]
            else:
                limit, right = of_right + 1, parts[right][0]

    def _move(self, state: int, symbol: int) -> int:
        kept, emitted, token = [], 0, -1
        held, kids, ends, known = self.held[state], self.kids, self.ends, self.known
        for i in range(0, len(held), 3):
            below = kids[held[i]].get(symbol)
            if below is None:
                continue
            before, count = held[i + 1], held[i + 2]
            end = ends[below]
            if end >= 0:
                pair = before << 32 | end
                fit = known.get(pair)
                if fit is None:
                    fit = known[pair] = before < 0 or self._apart(before, end, 1 << 60)
                if fit:
                    if token >= 0:
                        raise ValueError("two segmentations")
                    emitted, token = count + 1, end
            if kids[below]:
                kept += (below, before, count)
        if token < 0:
            raise ValueError("no segmentation")
        for i in range(2, len(kept), 3):
            kept[i] -= emitted
        move = self._state((*kept, 0, token, 0)) << 16 | emitted + 32768
        self.moves[state << 9 | symbol] = move
        return move

    def count(self, word: str) -> int:
        """Tokens of one pre-token: the emitted counts along its path."""
        if len(self.held) > MAX_STATES:
            self._reset()
        read = word.encode()
        state, total, moves = 0, 0, self.moves
        for symbol in (*read[:-1], read[-1] + self.last):
            move = moves.get(state << 9 | symbol)
            if move is None:
                move = self._move(state, symbol)
            state = move >> 16
            total += (move & 65535) - 32768
        return total

    def _all_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_apart`` of many pairs, without a limit."""
        out = np.ones(len(left), dtype=bool)
        at, limit = np.arange(len(left)), np.full(len(left), 1 << 60)
        while len(at):
            rank = self.ranks(left, right)
            merged = (rank >= 0) & (rank < limit)
            out[at[merged]] = False
            go = ~merged & ((left >= self.symbols) | (right >= self.symbols))
            at, left, right = at[go], left[go], right[go]
            of_left, of_right = self.made[left], self.made[right]
            later = of_left > of_right
            limit = np.where(later, of_left, of_right + 1)
            left, right = np.where(later, self.right[left], left), \
                np.where(later, right, self.left[right])
        return out

    def counts(self, words: list[str]) -> np.ndarray:
        """``count`` of words side by side, a symbol of each a step. A state's
        items are rows: word, trie node, token before and count before."""
        read = [w.encode() for w in words]
        size = np.asarray([len(r) for r in read], dtype=np.int64)
        order = np.argsort(-size, kind="stable")
        stop = np.cumsum(size)
        start, size = (stop - size)[order], size[order]
        code = np.frombuffer(b"".join(read), dtype=np.uint8).astype(np.int64)
        code[stop - 1] += self.last
        n = len(read)
        total, token = np.zeros(n, dtype=np.int64), np.full(n, -1)
        word, node, before, count = np.arange(n), np.zeros(n, np.int64), token.copy(), total.copy()
        for step in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -step))       # the longer words come first
            below = np.where(word < live, self.child(node, code[np.minimum(
                start[word] + step, len(code) - 1)]), -1)
            on = np.flatnonzero(below >= 0)
            word, below, before, count = word[on], below[on], before[on], count[on]
            end = self.end[below]
            ends = np.flatnonzero(end >= 0)
            fit = before[ends] < 0
            check = np.flatnonzero(~fit)
            fit[check] = self._all_apart(before[ends[check]], end[ends[check]])
            ends = ends[fit]
            at = word[ends]
            if len(at) != live or not (np.bincount(at, minlength=live) == 1).all():
                raise ValueError("no segmentation, or two")
            total[at], token[at] = count[ends] + 1, end[ends]
            kept = np.flatnonzero(self.inner[below])
            word = np.concatenate([word[kept], np.arange(live)])
            node = np.concatenate([below[kept], np.zeros(live, np.int64)])
            before = np.concatenate([before[kept], token[:live]])
            count = np.concatenate([count[kept], total[:live]])
        out = np.empty(n, dtype=np.int64)
        out[order] = total
        return out


class Counter:
    """Counts tokens of chunks for a word-level BPE file: NFC, white-space and
    lower-case normalisation, split pattern, byte symbols, special strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["model"]["type"] != "BPE":
            raise ValueError("not a lower-casing word-level BPE file")
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"] for t in spec["added_tokens"]}
        self.special_at = re.compile("(" + "|".join(map(re.escape, sorted(self.special))) + ")")
        model = spec["model"]
        self.transducer = Transducer([tuple(m) for m in model["merges"]],
                                     model["end_of_word_suffix"] or "", model["vocab"])
        self.marked = self.special_at.search
        self.words: dict[str, int] = {}
        self.old_words: dict[str, int] = {}
        self.fresh: dict[str, int] = {}     # runs of the batch at hand
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def split(self, run: str) -> tuple[int, list[str]]:
        """Special strings in a run without white space, and its words."""
        marks, words = 0, []
        for i, part in enumerate(self.special_at.split(run) if self.marked(run) else (run,)):
            if i % 2:
                marks += 1
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            # Character by character: a sigma has no final form here.
            part = part.lower() if "\u03a3" not in part else "".join(c.lower() for c in part)
            words += self.pattern.findall(part)
        return marks, words

    def run(self, run: str) -> int:
        """Tokens of a run without white space."""
        total, found = self.split(run)
        words = self.words
        for word in found:
            n = words.get(word)
            if n is None:
                n = self.old_words.get(word)
                if n is None:
                    n = self.transducer.count(word)
                words[word] = n
            total += n
        if len(words) > MAX_WORDS:
            self.old_words, self.words = words, {}
        return total

    def runs(self, runs: list[str]) -> int:
        """Paths from the start state back to itself are remembered per run."""
        young, fresh, total = self.young, self.fresh, 0
        for r in runs:
            n = fresh.get(r)
            if n is None:
                n = young.get(r)
            if n is None:
                n = self.old.get(r)
                if n is None:
                    n = self.run(r)
                young[r] = n
                if len(young) > MAX_RUNS:
                    self.old, self.young = young, {}
                    young = self.young
            total += n
        return total

    def gather(self, texts: list[str]) -> None:
        """Count the runs of a batch's texts first, their unknown words side by
        side."""
        self.fresh = fresh = {}
        found, unknown = {}, {}
        for r in set().union(*(t.split() for t in texts)):
            n = self.young.get(r)
            if n is None:
                n = self.old.get(r)
            if n is not None:
                fresh[r] = n
                continue
            found[r] = marks, words = self.split(r)
            for w in words:
                if w not in unknown:
                    n = self.words.get(w)
                    unknown[w] = self.old_words.get(w) if n is None else n
        todo = [w for w, n in unknown.items() if n is None]
        long = [w for w in todo if len(w) * 4 > LONG_WORD and len(w.encode()) > LONG_WORD]
        for w in long:
            unknown[w] = self.transducer.count(w)
        todo = [w for w in todo if unknown[w] is None]
        for i in range(0, len(todo), SIDE_BY_SIDE):
            part = todo[i:i + SIDE_BY_SIDE]
            unknown.update(zip(part, self.transducer.counts(part).tolist()))
        for r, (marks, words) in found.items():
            fresh[r] = self.young[r] = marks + sum(map(unknown.__getitem__, words))
            if len(self.young) > MAX_RUNS:
                self.old, self.young = self.young, {}
        for w, n in unknown.items():
            self.words[w] = n
            if len(self.words) > MAX_WORDS:
                self.old_words, self.words = self.words, {}

    def count_all(self, texts: list[str], chunk_chars: int = CHUNK_CHARS) -> list[int]:
        if sum(map(len, texts)) < LONG_TEXT:
            self.gather(texts)
        out = [self.count(t, chunk_chars) for t in texts]
        self.fresh = {}
        return out

    def chunk_map(self, chunk: str) -> tuple:
        """State map of a chunk: ``(head,)`` if it never resets, else
        ``(head, count, tail)``."""
        parts = chunk.split() if not CONTROL.search(chunk) else RESETS.split(chunk)
        parts = [p for p in parts if p]
        if not RESETS.search(chunk):
            return (chunk,)
        head = "" if RESETS.match(chunk) else parts.pop(0)
        tail = parts.pop() if parts and not RESETS.match(chunk[-1]) else ""
        return head, self.runs(parts), tail

    def compose(self, a: tuple, b: tuple) -> tuple:
        if len(a) == 1 and len(b) == 1:
            return (a[0] + b[0],)
        if len(a) == 1:
            return a[0] + b[0], b[1], b[2]
        if len(b) == 1:
            return a[0], a[1], a[2] + b[0]
        middle = a[2] + b[0]
        return a[0], a[1] + b[1] + (self.runs([middle]) if middle else 0), b[2]

    def scan(self, maps: list[tuple]) -> tuple:
        """Neighbours are composed pairwise until one map is left."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i:i + 2]) if i + 1 < len(maps) else maps[i]
                    for i in range(0, len(maps), 2)]
        return maps[0]

    def count(self, text: str, chunk_chars: int = CHUNK_CHARS) -> int:
        maps = [self.chunk_map(text[i:i + chunk_chars]) for i in range(0, len(text), chunk_chars)]
        if not maps:
            return 0
        whole = self.scan(maps)
        ends = [whole[0]] if len(whole) == 1 else [whole[0], whole[2]]
        return (whole[1] if len(whole) == 3 else 0) + self.runs([e for e in ends if e])


def counter(path: str) -> Counter:
    """One per worker process and file. The package travels by value, so its
    globals are new in each task; the counters hang on a module of their own,
    else every task would load one, and leave it in the frozen set for good.
    The tables hold no reference cycles, so they are kept out of the collector."""
    held = vars(sys.modules.setdefault("replyscope_counters",
                                       types.ModuleType("replyscope_counters")))
    if path not in held:
        held[path] = Counter(path)
        gc.collect()
        gc.freeze()
    return held[path]


def count_tokens(df: DataFrame, tokenizer: str, limit: int = 2048, key: str = "doc_id",
                 text: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """One row per input row: key, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``tokenizer`` is the path of the vocabulary file on every machine. A null
    text counts as empty (0 bytes, 0 tokens); repeated rows are counted each;
    an empty table gives no rows. Nothing is shuffled: a text is in one task
    from the scan on, and its chunks' maps meet there."""
    docs = df.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"),
                     F.col(f"`{text}`").cast("string").alias("text"))

    def batch(part: pa.RecordBatch, tokens: Counter):
        texts = [t or "" for t in part.column(1).to_pylist()]
        n = tokens.count_all(texts, chunk_chars)
        return {"doc_id": part.column(0), "n_bytes": [len(t.encode()) for t in texts],
                "n_tokens": n, "over_limit": [x > limit for x in n]}

    return map_batches(only(docs, doc_id="bigint", text="string"), batch,
                       "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
                       text="text", setup=lambda: counter(tokenizer))
