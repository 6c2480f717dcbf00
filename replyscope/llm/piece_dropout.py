"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A text is prefixed with a space mark, its spaces become marks, and it falls
into segments: a run of marks and what follows up to the next mark (no piece
of the model spans more, so segments merge alone). In a segment an agenda
holds the candidate merges, best score first, leftmost first; each candidate
that comes up is skipped with the dropout rate, and is not offered again until
a neighbour changes. Symbols without a piece fall back to byte pieces.

Every occurrence is drawn by itself: a keyed hash of seed, document and the
segment's number in the text gives how many candidates are taken before one is
skipped, then again how many before the next (geometric gaps, the same as one
draw for each candidate). A segment falls apart further where no piece has the
two characters side by side; its parts run one after the other. A batch's
segments of one length run their agendas side by side as arrays, one candidate
of each a turn, so nothing is remembered from batch to batch; longer segments
and texts with literal marks run one by one, where the outcome of a part for
given skips is remembered. Both give the same ids, and segmentations repeat
exactly for a seed.
With dropout 0 the ids are the library's. Decoding joins the
pieces and bytes and restores the text exactly; a space mark that stands in
the text itself is written as its bytes so that it is not read as a space."""
from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PairTable, map_batches, mix, only

MARK = "▁"
MAX_SEGMENTS = 200_000       # segments, and parts, remembered per worker and generation
SHORT_SEGMENT = 48           # up to here the agenda is a plain list, and remembered
BLOCK_CHARS = 1 << 19        # characters whose segments run side by side
NONE = float("-inf")
MASK = 2 ** 64 - 1
_SEGMENTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_WORD = np.uint64(0x9E3779B97F4A7C15)
_MARK = np.uint32(ord(MARK))


class PieceModel:
    """Pieces, scores and byte ids of a merge-type SentencePiece model."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto
        with open(path, "rb") as f:
            raw = f.read()
        spec = proto.ModelProto.FromString(raw)
        if spec.trainer_spec.model_type != 2 or not spec.trainer_spec.byte_fallback \
                or spec.normalizer_spec.name != "identity" \
                or not spec.normalizer_spec.add_dummy_prefix \
                or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("not a merge-type model with byte fallback and plain text")
        self.library = SentencePieceProcessor(model_proto=raw)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes = [0] * 256
        self.back: list[bytes] = []
        for i, p in enumerate(spec.pieces):
            self.back.append(b"")
            if p.type == 6:
                self.bytes[int(p.piece[3:5], 16)] = i
                self.back[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == 1:
                self.score[p.piece] = p.score
                self.id[p.piece] = i
                self.back[i] = p.piece.replace(MARK, " ").encode()
            elif p.type == 2:
                self.back[i] = b""
        inner = [p for p in self.id if MARK in p.lstrip(MARK)]
        if inner:
            raise ValueError("pieces span spaces")
        # Characters that stand side by side in some piece; between any others
        # no merge can happen, so a segment falls apart there.
        self.joins = {a + b for p in self.id for a, b in zip(p, p[1:])}
        self.first_byte, self.last_byte = min(self.bytes), max(self.bytes)

    def ids_of(self, symbols: list[str], literal: bool) -> list[int]:
        out: list[int] = []
        for s in symbols:
            i = None if literal and s == MARK else self.id.get(s)
            if i is None:
                out.extend(self.bytes[b] for b in s.encode())
            else:
                out.append(i)
        return out

    def parts(self, segment: str) -> list[str]:
        """The segment cut where no piece can span."""
        joins = self.joins
        out, start = [], 0
        for i in range(1, len(segment)):
            if segment[i - 1:i + 1] not in joins:
                out.append(segment[start:i])
                start = i
        out.append(segment[start:])
        return out

    def merge(self, segment: str, dropout: float, key: int) -> list[str]:
        """Symbols of a segment after its agenda has run."""
        if len(segment) <= SHORT_SEGMENT:
            return self._merge_short(segment, dropout, key)
        return self._merge_long(segment, dropout, key)

    def _merge_short(self, segment: str, dropout: float, key: int) -> list[str]:
        """The agenda as a list: entry i is the candidate of symbols i, i + 1."""
        score = self.score.get
        symbols = list(segment)
        place = list(range(len(symbols)))
        agenda = [score(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        while agenda:
            best = max(agenda)
            if best == NONE:
                break
            i = agenda.index(best)
            both = symbols[i] + symbols[i + 1]
            if dropout:     # ``chance`` written out
                x = (key ^ place[i] * 0x9E3779B97F4A7C15 ^ len(both) * 0xC2B2AE3D27D4EB4F) & MASK
                x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & MASK
                if (x >> 24 & 0xFFFFFFFF) / 4294967296 < dropout:
                    agenda[i] = NONE
                    continue
            symbols[i] = both
            del symbols[i + 1], place[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = score(both + symbols[i + 1], NONE)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + both, NONE)
        return symbols

    def merge_skipping(self, segment: str, skips: tuple[int, ...]) -> tuple[list[str], int]:
        """Symbols of a short segment when the candidates of these numbers, in
        the order they come up, are skipped; and how many come up."""
        score = self.score.get
        symbols = list(segment)
        agenda = [score(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        turn = 0
        while agenda:
            best = max(agenda)
            if best == NONE:
                break
            i = agenda.index(best)
            turn += 1
            if turn - 1 in skips:
                agenda[i] = NONE
                continue
            both = symbols[i] + symbols[i + 1]
            symbols[i] = both
            del symbols[i + 1], agenda[i]
            if i < len(agenda):
                agenda[i] = score(both + symbols[i + 1], NONE)
            if i:
                agenda[i - 1] = score(symbols[i - 1] + both, NONE)
        return symbols, turn

    def _merge_long(self, segment: str, dropout: float, key: int) -> list[str]:
        """The agenda as a heap, for long runs without a space."""
        score = self.score.get
        symbols = list(segment)
        n = len(symbols)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        agenda = [(-score(a + b, NONE), i, a + b)
                  for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in self.score]
        heapq.heapify(agenda)
        while agenda:
            _, i, both = heapq.heappop(agenda)
            j = after[i]
            if j < 0 or not symbols[i] or symbols[i] + symbols[j] != both:
                continue
            if dropout and chance(key, i, len(both)) < dropout:
                continue
            symbols[i], symbols[j] = both, ""
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if both + symbols[k] in self.score:
                    heapq.heappush(agenda, (-score(both + symbols[k]), i, both + symbols[k]))
            h = before[i]
            if h >= 0 and symbols[h] + both in self.score:
                heapq.heappush(agenda, (-score(symbols[h] + both), h, symbols[h] + both))
        return [s for s in symbols if s]

    def decode(self, ids: list[int]) -> str:
        """The text: pieces and bytes joined, without the mark put before."""
        raw = b"".join(map(self.back.__getitem__, ids))
        return raw[1:].decode()


def chance(key: int, place: int, length: int) -> float:
    """A number in [0, 1) for a candidate, by its place and length."""
    x = (key ^ place * 0x9E3779B97F4A7C15 ^ length * 0xC2B2AE3D27D4EB4F) & MASK
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & MASK
    return (x >> 24 & 0xFFFFFFFF) / 4294967296


def spread(x: int) -> int:
    """``common.mix`` of one number."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


class Agendas:
    """Agendas of many segments side by side. Symbols are numbered, 0 for any
    character that is in no piece. A candidate is one number: parts from the
    left first, then the best score, then the leftmost place; and the symbol
    that it makes."""

    def __init__(self, model: PieceModel):
        chars = sorted(set("".join(model.id)))
        names = [*chars, *(p for p in model.id if len(p) > 1)]
        number = {p: i + 1 for i, p in enumerate(names)}
        self.id = np.asarray([-1, *(model.id.get(p, -1) for p in names)], dtype=np.int64)
        self.bytes = np.asarray(model.bytes, dtype=np.uint32)
        codes = np.asarray([ord(c) for c in chars], dtype=np.int64)
        self.of_code = np.zeros(int(codes.max(initial=0)) + 2, dtype=np.int64)
        self.of_code[codes] = np.arange(1, len(codes) + 1)
        level = {x: i for i, x in enumerate(sorted(set(model.score.values())))}
        self.bits = len(names).bit_length()     # of symbols, and of levels of scores
        self.score = PairTable({
            (number[p[:i]], number[p[i:]]): level[x] << self.bits + 6 | number[p]
            for p, x in model.score.items() for i in range(1, len(p))
            if p[:i] in number and p[i:] in number})
        self.joins = PairTable({(number[a], number[b]): 1 for a, b in model.joins})

    def run(self, code: np.ndarray, start: np.ndarray, size: np.ndarray, gap: np.ndarray,
            state: np.ndarray, log_kept: float) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the segments at ``start`` after their agendas have run,
        at their first characters and -1 at the others; and the characters'
        own symbols."""
        own = self.of_code[np.minimum(code, len(self.of_code) - 1)]
        score = np.append(self.score(own[:-1], own[1:]), -1)
        cut = np.ones(len(own), dtype=np.int64)
        cut[1:] = self.joins(own[:-1], own[1:]) < 0
        part = np.cumsum(cut)
        out = own.copy()
        order = np.argsort(size, kind="stable")
        lengths, first = np.unique(size[order], return_index=True)
        for n, rows in zip(lengths.tolist(), np.split(order, first[1:])):
            if 1 < n <= SHORT_SEGMENT:
                at = start[rows] + np.arange(n)[:, None]
                rank = ((63 - part[at] + part[start[rows]]) << 2 * self.bits + 6) \
                    + ((63 - np.arange(n)) << self.bits)[:, None]
                out[at] = self._run(own[at], score[at], rank, gap[rows], state[rows], log_kept)
        return out, own

    def _run(self, symbols: np.ndarray, score: np.ndarray, rank: np.ndarray, gap: np.ndarray,
             state: np.ndarray, log_kept: float) -> np.ndarray:
        """Columns are segments. A last row stands beyond both ends."""
        length, n = symbols.shape
        end = np.zeros((1, n), dtype=np.int64)
        score[-1] = -1
        agenda = np.concatenate([np.where(score < 0, -1, score + rank), end - 1])
        rank = np.concatenate([rank, end]).ravel()
        symbols = np.concatenate([symbols, end])
        place = np.broadcast_to(np.arange(length + 1)[:, None], symbols.shape)
        after, before = (place + 1).ravel(), (place - 1).ravel()
        before[:n] = length
        todo, symbol = agenda.ravel(), symbols.ravel()
        draws = np.zeros(n, dtype=np.uint64)
        made_bits, place_mask = (1 << self.bits) - 1, 63

        def offer(at: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
            score = self.score(left, right)
            todo[at] = np.where(score < 0, -1, score + rank[at])

        while True:
            best = agenda.max(axis=0)
            row = np.flatnonzero(best >= 0)
            if not len(row):
                break
            best = best[row]
            i = place_mask - (best >> self.bits & place_mask)
            take = gap[row] > 0
            if not take.all():
                skip = row[~take]
                todo[i[~take] * n + skip] = -1
                draws[skip] += np.uint64(1)
                u = ((mix(state[skip] + draws[skip] * _WORD) >> np.uint64(11)) + .5) / 2 ** 53
                gap[skip] = np.minimum(np.log(u) / log_kept, 2 ** 62).astype(np.int64)
                row, i, best = row[take], i[take], best[take]
            gap[row] -= 1
            both = best & made_bits
            left = i * n + row
            right = after[left] * n + row
            k = after[right]
            beyond = k * n + row
            symbol[left], symbol[right] = both, -1
            after[left], before[beyond] = k, i
            todo[right] = -1
            offer(left, both, symbol[beyond])
            h = before[left] * n + row
            offer(h, symbol[h], both)
        return symbols[:length]

    def ids(self, code: np.ndarray, symbols: np.ndarray, own: np.ndarray, start: np.ndarray,
            given: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments at ``start``, and how many each has; those of
        the ``given`` ones are inserted."""
        symbols = symbols.copy()
        ends = np.append(start[1:], len(code))
        for i in given:
            symbols[start[i]:ends[i]] = -1
            symbols[start[i]] = 0
        live = np.flatnonzero(symbols >= 0)
        ids = self.id[symbols[live]]
        plain = ids < 0
        count = np.ones(len(live), dtype=np.int64)
        c = code[live[plain]]
        count[plain] = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        first = np.searchsorted(live, start)
        for i, raw in given.items():
            count[first[i]] = len(raw) // 4
            plain[first[i]] = False
        out = np.repeat(ids, count).astype(np.uint32)
        raw = code[live[plain]].astype("<u4").tobytes().decode("utf-32-le").encode()
        out[np.repeat(plain, count)] = self.bytes[np.frombuffer(raw, dtype=np.uint8)]
        at = np.concatenate([[0], np.cumsum(count)])
        for i, raw in given.items():
            out[at[first[i]]:at[first[i] + 1]] = np.frombuffer(raw, dtype="<u4")
        return out, np.diff(at[np.append(first, len(live))])


class Encoder:
    def __init__(self, path: str, dropout: float, seed: int):
        if not 0 <= dropout <= 1:
            raise ValueError("dropout is a probability")
        self.model = PieceModel(path)
        self.agendas = Agendas(self.model)
        self.dropout, self.seed = dropout, seed
        self.log_kept = math.log1p(-dropout) if dropout < 1 else NONE
        self.mark = self._bytes([MARK], True)
        # Segment to candidates, plain ids and parts; part or (part, skips) to
        # candidates and ids.
        self.young: dict[str, tuple] = {}
        self.old: dict[str, tuple] = {}
        self.parts: dict = {}
        self.old_parts: dict = {}

    def _bytes(self, symbols: list[str], literal: bool = False) -> bytes:
        return array("I", self.model.ids_of(symbols, literal)).tobytes()

    def part(self, part: str, skips: tuple[int, ...]) -> tuple[int, bytes]:
        """How many candidates of a short part come up, and its ids."""
        at = (part, skips) if skips else part
        known = self.parts.get(at)
        if known is None:
            known = self.old_parts.get(at)
            if known is None:
                symbols, count = self.model.merge_skipping(part, skips)
                known = count, self._bytes(symbols)
            if len(self.parts) >= MAX_SEGMENTS:
                self.old_parts, self.parts = self.parts, {}
            self.parts[at] = known
        return known

    def segment(self, segment: str) -> tuple[float, bytes, list[str]]:
        """Candidates, ids without a skip, and parts. One with a long part has
        endless candidates, so that it is always drawn."""
        known = self.young.get(segment)
        if known is None:
            known = self.old.get(segment)
            if known is None:
                parts = self.model.parts(segment)
                short = [len(p) <= SHORT_SEGMENT for p in parts]
                if all(short):
                    plain = [self.part(p, ()) for p in parts]
                    known = sum(n for n, _ in plain), b"".join(ids for _, ids in plain), parts
                elif self.dropout:
                    return math.inf, b"", parts
                else:
                    return 0, b"".join(self.part(p, ())[1] if s else
                                       self._bytes(self.model.merge(p, 0, 0))
                                       for p, s in zip(parts, short)), parts
            if len(self.young) >= MAX_SEGMENTS:
                self.old, self.young = self.young, {}
            self.young[segment] = known
        return known

    def drawn(self, parts: list[str], gap: int, state: int) -> bytes:
        """Ids of a segment whose first ``gap`` candidates are taken."""
        out, draws = [], 0
        for j, part in enumerate(parts):
            if len(part) > SHORT_SEGMENT:
                key = spread(state ^ (j + 1) * 0xC2B2AE3D27D4EB4F & MASK)
                out.append(self._bytes(self.model.merge(part, self.dropout, key)))
                continue
            skips: tuple[int, ...] = ()
            at = 0
            count, ids = self.part(part, skips)
            while at + gap < count:
                skips += (at + gap,)
                at += gap + 1
                draws += 1
                u = ((spread(state + draws * 0x9E3779B97F4A7C15 & MASK) >> 11) + .5) / 2 ** 53
                gap = int(math.log(u) / self.log_kept)
                count, ids = self.part(part, skips)
            gap -= count - at
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str, key: int) -> bytes:
        """Ids as little-endian unsigned 32-bit bytes."""
        if not text:
            return b""
        if MARK in text:
            segments = [None if literal else s for s, literal in self._with_marks(text)]
        else:
            segments = _SEGMENTS.findall(MARK + text.replace(" ", MARK))
        if not self.dropout:
            return b"".join(self.mark if s is None else self.segment(s)[1] for s in segments)
        out: list[bytes] = []
        young = self.young.get
        gaps, states = self.gaps(key, len(segments))
        for i, s in enumerate(segments):
            if s is None:
                out.append(self.mark)
                continue
            count, plain, parts = young(s) or self.segment(s)
            if gaps[i] >= count:
                out.append(plain)
            else:
                out.append(self.drawn(parts, gaps[i], int(states[i])))
                young = self.young.get
        return b"".join(out)

    def encode_all(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        """Ids of texts, all in their own drawing; the same as ``encode``."""
        plain = [i for i, t in enumerate(texts) if t and MARK not in t]
        held = set(plain)
        out = [np.zeros(0, np.uint32) if i in held else
               np.frombuffer(self.encode(t, k), dtype="<u4")
               for i, (t, k) in enumerate(zip(texts, keys))]
        if not plain:
            return out
        whole = "".join(MARK + texts[i] for i in plain).replace(" ", MARK)
        code = np.frombuffer(whole.encode("utf-32-le"), dtype="<u4")
        lead = np.cumsum([0, *(len(texts[i]) + 1 for i in plain)])
        is_mark = code == _MARK
        opens = is_mark.copy()
        opens[1:] &= ~is_mark[:-1]
        opens[lead[:-1]] = True
        start = np.flatnonzero(opens)
        first = np.searchsorted(start, lead)
        gap, state = self._all_gaps([keys[i] for i in plain], np.diff(first))
        ids, counts = [], []
        a = 0
        while a < len(start):
            b = max(int(np.searchsorted(start, start[a] + BLOCK_CHARS)), a + 1)
            stop = start[b] if b < len(start) else len(code)
            got, n = self._block(code[start[a]:stop], start[a:b] - start[a], gap[a:b], state[a:b])
            ids.append(got)
            counts.append(n)
            a = b
        every = np.concatenate(ids)
        at = np.concatenate([[0], np.cumsum(np.concatenate(counts))])[first]
        for i, x, y in zip(plain, at[:-1].tolist(), at[1:].tolist()):
            out[i] = every[x:y]
        return out

    def _all_gaps(self, keys: list[int], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``gaps`` of documents with ``n`` segments each."""
        with np.errstate(over="ignore"):
            key = np.asarray([k & MASK for k in keys], dtype=np.uint64)
            of_doc = mix(mix(key) + np.uint64(self.seed & MASK))
            number = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            state = mix((number.astype(np.uint64) + np.uint64(1)) * _WORD + np.repeat(of_doc, n))
        if not self.dropout:
            return np.full(len(state), 2 ** 62), state
        u = ((mix(state) >> np.uint64(11)) + .5) / 2 ** 53
        return np.minimum(np.log(u) / self.log_kept, 2 ** 62).astype(np.int64), state

    def _block(self, code: np.ndarray, start: np.ndarray, gap: np.ndarray,
               state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(np.append(start, len(code)))
        with np.errstate(over="ignore"):
            symbols, own = self.agendas.run(code, start, size, gap.copy(), state, self.log_kept)
        given = {}
        for i in np.flatnonzero(size > SHORT_SEGMENT).tolist():
            segment = code[start[i]:start[i] + size[i]].astype("<u4").tobytes().decode("utf-32-le")
            count, plain, parts = self.segment(segment)
            given[i] = plain if gap[i] >= count else self.drawn(parts, int(gap[i]), int(state[i]))
        return self.agendas.ids(code, symbols, own, start, given)

    def gaps(self, key: int, n: int) -> tuple[list[int], np.ndarray]:
        """How many candidates each segment of a document takes before its
        first skip, and the state that its later draws come from."""
        with np.errstate(over="ignore"):
            start = spread(spread(key & MASK) + (self.seed & MASK) & MASK)
            states = mix((np.arange(n, dtype=np.uint64) + np.uint64(1)) * _WORD + np.uint64(start))
        u = ((mix(states) >> np.uint64(11)) + .5) / 2 ** 53
        return np.minimum(np.log(u) / self.log_kept, 2 ** 62).astype(np.int64).tolist(), states

    def _with_marks(self, text: str) -> list[tuple[str, bool]]:
        """Marks in the text part segments and stay literal."""
        out: list[tuple[str, bool]] = []
        for i, part in enumerate(text.split(MARK)):
            if i:
                out.append((MARK, True))
            part = part.replace(" ", MARK)
            out += [(s, False) for s in _SEGMENTS.findall(part if i else MARK + part)]
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, dropout: float, seed: int) -> Encoder:
    at = path, dropout, seed
    if at not in _ENCODERS:
        _ENCODERS.clear()       # one model and its memory at a time
        _ENCODERS[at] = Encoder(path, dropout, seed)
    return _ENCODERS[at]


def encode_pieces(df: DataFrame, model: str, dropout: float = 0.1, seed: int = 7) -> DataFrame:
    """One row per input row: ``doc_id, ids array<int>``. A null or empty text
    has no ids; rows with the same id and text get the same ids; an empty table
    gives no rows. Nothing is shuffled."""
    def batch(part: pa.RecordBatch, pieces: Encoder):
        keys, texts = ([x or empty for x in part.column(i).to_pylist()]
                       for i, empty in enumerate((0, "")))
        return {"doc_id": part.column(0),
                "ids": [ids.astype(np.int32) for ids in pieces.encode_all(texts, keys)]}

    return map_batches(only(df, doc_id="bigint", text="string"), batch,
                       "doc_id bigint, ids array<int>", text="text",
                       setup=lambda: encoder(model, dropout, seed))


def decode_pieces(df: DataFrame, model: str) -> DataFrame:
    """One row per input row: ``doc_id, text`` from ``ids``; null ids give an
    empty text."""
    def batch(part: pa.RecordBatch, pieces: Encoder):
        return {"doc_id": part.column(0),
                "text": [pieces.model.decode(i or []) for i in part.column(1).to_pylist()]}

    ids = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids")
    return map_batches(ids, batch, "doc_id bigint, text string",
                       setup=lambda: encoder(model, 0.0, 0))


def segmentations(df: DataFrame, model: str, dropout: float = 0.1, seed: int = 7) -> DataFrame:
    """One row per input row: ``doc_id, n_chars, n_pieces, n_byte_pieces,
    ids_crc32, lossless``; encodes and decodes each text in the same task."""
    def batch(part: pa.RecordBatch, pieces: Encoder):
        out: dict[str, list] = {k: [] for k in ("n_chars", "n_pieces", "n_byte_pieces",
                                                "ids_crc32", "lossless")}
        keys, texts = ([x or empty for x in part.column(i).to_pylist()]
                       for i, empty in enumerate((0, "")))
        model = pieces.model
        for text, ids in zip(texts, pieces.encode_all(texts, keys)):
            out["n_chars"].append(len(text))
            out["n_pieces"].append(len(ids))
            out["n_byte_pieces"].append(int(((ids >= model.first_byte)
                                             & (ids <= model.last_byte)).sum()))
            out["ids_crc32"].append(zlib.crc32(ids))
            out["lossless"].append(model.decode(ids.tolist()) == text)
        return {"doc_id": part.column(0), **out}

    return map_batches(only(df, doc_id="bigint", text="string"), batch,
                       "doc_id bigint, n_chars bigint, n_pieces bigint, n_byte_pieces bigint, "
                       "ids_crc32 bigint, lossless boolean", text="text",
                       setup=lambda: encoder(model, dropout, seed))
