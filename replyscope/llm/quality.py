"""Quality rules: per-text counts, then a linear-chain conditional random
field over lines whose Viterbi path marks each line content or boilerplate.
The share of a text's words in content lines decides whether it is kept.

The field is trained here on a bounded sample of labelled texts (at most
``MAX_TRAINING_TEXTS``, drawn per class by the hash of their id): lines of good texts are
taken as content, lines of bad ones as boilerplate. Every line of every text
is decoded."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, hash_spans, map_batches, mix, only, text_bytes

MAX_TRAINING_TEXTS = 1_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
SYMBOLS = b"#*$%&|<>"
# Upper bounds of the buckets that line features are cut into.
BUCKETS = (
    ("words", (1, 2, 4, 8, 16, 32, 64, 128)),
    ("symbols per word", (0, .05, .1, .2, .4, .8, 1.6)),
    ("capitals per letter", (0, .05, .1, .2, .4, .7)),
    ("exclamation marks per word", (0, .05, .1, .2, .4, .8)),
    ("bars per word", (0, .05, .1, .2, .4, .8)),
    ("digits per byte", (0, .05, .1, .2, .4)),
    ("bytes per word", (2, 3, 4, 6, 8, 12, 16)),
    ("repeated words", (0, .1, .25, .5, .75)),
    ("equal to an earlier line", (0,)),
    ("ends a sentence", (0,)),
)
N_FEATURES = len(BUCKETS)
WIDTH = 1 + max(len(b) for _, b in BUCKETS)
_MASK = {name: np.isin(np.arange(256), list(chars)) for name, chars in
         {"symbol": SYMBOLS, "upper": range(65, 91), "digit": range(48, 58), "bang": b"!",
          "bar": b"|",
          "letter": [*range(65, 91), *range(97, 123), *range(128, 256)]}.items()}


class Lines:
    """Counts of a slice of texts, and the features of its lines with words."""

    def __init__(self, column: pa.Array):
        raw, offsets = text_bytes(column)
        rows = len(offsets) - 1
        words = Words(raw, offsets)
        n = len(words.hash)
        self.n_words = np.diff(words.first)

        def upto(mask):
            return np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])

        chars = upto((raw & 0xC0) != 0x80)
        per_word = upto(chars[words.end] - chars[words.start])
        self.word_chars = per_word[words.first[1:]] - per_word[words.first[:-1]]
        counts = {name: upto(mask[raw]) for name, mask in _MASK.items()}
        self.n_symbols = counts["symbol"][offsets[1:]] - counts["symbol"][offsets[:-1]]

        at, h = words.windows(3)
        key = h ^ mix(words.row[at].astype(np.uint64))
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        again = at[times[inverse] > 1]
        covered = np.zeros(n, dtype=bool)
        for j in range(3):
            covered[again + j] = True
        covered = upto(covered)
        self.n_repeat = covered[words.first[1:]] - covered[words.first[:-1]]

        # Lines: from a row's start or after a line break up to the next one.
        breaks = np.flatnonzero(raw == 10)
        start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
        # A text that ends in a line break has an empty last line; the same
        # position starts the next text, so one entry stands for both.
        start = start[start < len(raw)]
        stop = np.append(start[1:], len(raw))
        stop = stop - (raw[stop - 1] == 10) if len(start) else stop
        first = np.searchsorted(words.start, start)
        last = np.searchsorted(words.start, stop)
        with_word = last > first
        start, stop, first, last = (x[with_word] for x in (start, stop, first, last))
        self.row = np.searchsorted(offsets, start, side="right") - 1
        self.words = last - first
        inside = np.zeros(len(raw) + 1, dtype=np.int8)
        np.add.at(inside, start, 1)
        np.add.at(inside, stop, -1)
        held = np.flatnonzero(np.cumsum(inside[:-1]) > 0) if len(start) else start
        line_hash, _ = hash_spans(raw, held, start)
        key = line_hash ^ mix(self.row.astype(np.uint64))
        _, once = np.unique(key, return_index=True)
        later = np.ones(len(start), dtype=bool)
        later[once] = False
        self.n_dup_lines = np.bincount(self.row[later], minlength=rows)

        def each(name):
            return counts[name][stop] - counts[name][start]

        size = np.maximum(stop - start, 1)
        tail = raw[words.end[last - 1] - 1] if len(start) else raw[:0]
        values = (self.words, each("symbol") / np.maximum(self.words, 1),
                  each("upper") / np.maximum(each("letter"), 1),
                  each("bang") / np.maximum(self.words, 1),
                  each("bar") / np.maximum(self.words, 1), each("digit") / size,
                  size / np.maximum(self.words, 1),
                  (covered[last] - covered[first]) / np.maximum(self.words, 1),
                  later, np.isin(tail, list(b".!?;:")))
        self.features = np.stack([np.searchsorted(b, v, side="left") for (_, b), v in
                                  zip(BUCKETS, values)], axis=1) if len(start) \
            else np.zeros((0, N_FEATURES), dtype=np.int64)
        self.rows = rows


class Field:
    """Linear-chain conditional random field with labels 0 (boilerplate) and 1
    (content): a weight per label and feature bucket, and per label pair."""

    def __init__(self, emit: np.ndarray | None = None, move: np.ndarray | None = None):
        self.emit = np.zeros((N_FEATURES, WIDTH, 2)) if emit is None else emit
        self.move = np.zeros((2, 2)) if move is None else move

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.emit[np.arange(N_FEATURES), features].sum(axis=1)

    def train(self, features: np.ndarray, row: np.ndarray, label: np.ndarray,
              steps: int = 150, rate: float = 1.0, penalty: float = 1e-3) -> "Field":
        """Penalised conditional log-likelihood by gradient steps, the
        expectations by forward and backward sums."""
        order, active, ends = _steps(row)
        features, label = features[order], label[order]
        after = np.concatenate([ends[t] + np.arange(n) for t, n in enumerate(active[1:])]) \
            if len(active) > 1 else np.zeros(0, dtype=np.int64)     # line before each later line
        seen_move = np.zeros((2, 2))
        np.add.at(seen_move, (label[after], label[active[0]:]), 1)
        whole_at = np.concatenate([np.arange(n) for n in active])
        speed_e, speed_m = np.zeros_like(self.emit), np.zeros_like(self.move)
        for _ in range(steps):
            s = self.scores(features)
            ahead, back = s.copy(), np.zeros_like(s)
            for t in range(1, len(active)):
                at = slice(ends[t], ends[t + 1])
                ways = ahead[ends[t - 1]:ends[t - 1] + active[t], :, None] + self.move
                ahead[at] += np.logaddexp(ways[:, 0], ways[:, 1])
            for t in range(len(active) - 1, 0, -1):
                at = slice(ends[t], ends[t + 1])
                ways = (s[at] + back[at])[:, None, :] + self.move
                back[ends[t - 1]:ends[t - 1] + active[t]] = np.logaddexp(ways[..., 0], ways[..., 1])
            first = ahead[:active[0]] + back[:active[0]]
            whole = np.logaddexp(first[:, 0], first[:, 1])
            p = np.exp(ahead + back - whole[whole_at][:, None])
            p[np.arange(len(label)), label] -= 1
            grad = np.zeros_like(self.emit)
            for f in range(N_FEATURES):
                for k in (0, 1):
                    grad[f, :, k] = np.bincount(features[:, f], p[:, k], minlength=WIDTH)
            later = (s + back)[active[0]:]
            both = np.exp(ahead[after][:, :, None] + self.move + later[:, None, :]
                          - whole[whole_at[active[0]:]][:, None, None])
            grad_m = both.sum(axis=0) - seen_move
            grad = grad / len(label) + penalty * self.emit
            grad_m = grad_m / len(label) + penalty * self.move
            speed_e, speed_m = .9 * speed_e - rate * grad, .9 * speed_m - rate * grad_m
            self.emit, self.move = self.emit + speed_e, self.move + speed_m
        return self

    def decode(self, features: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Viterbi labels of all lines; a tie goes to content."""
        if not len(row):
            return np.zeros(0, dtype=np.int64)
        by_place, active, ends = _steps(row)
        s = self.scores(features[by_place])
        best = s[:active[0]].copy()
        came = np.zeros(s.shape, dtype=np.int8)
        for t in range(1, len(active)):
            n = active[t]
            ways = best[:n, :, None] + self.move
            keep = ways[:, 1] >= ways[:, 0]
            came[ends[t]:ends[t + 1]] = keep
            best[:n] = np.where(keep, ways[:, 1], ways[:, 0]) + s[ends[t]:ends[t + 1]]
        label = (best[:, 1] >= best[:, 0]).astype(np.int64)
        out = np.empty(len(s), dtype=np.int64)
        for t in range(len(active) - 1, -1, -1):
            n = active[t]
            out[ends[t]:ends[t + 1]] = label[:n]
            label[:n] = came[ends[t] + np.arange(n), label[:n]]
        result = np.empty(len(s), dtype=np.int64)
        result[by_place] = out
        return result


def _steps(row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines in order of their place in their text, texts with more lines
    first: step ``t`` works on the first ``active[t]`` texts, whose lines start
    at ``ends[t]``."""
    _, first, index = np.unique(row, return_index=True, return_inverse=True)
    place = np.arange(len(row)) - first[index]
    lengths = np.bincount(index)
    by_length = np.argsort(-lengths, kind="stable")
    column = np.empty_like(by_length)
    column[by_length] = np.arange(len(by_length))
    active = np.searchsorted(-lengths[by_length], -np.arange(int(lengths.max())), side="left")
    return np.lexsort((column[index], place)), active, np.concatenate([[0], np.cumsum(active)])


def train_field(docs: DataFrame, labels: DataFrame,
                max_texts: int = MAX_TRAINING_TEXTS) -> Field:
    """Train on at most ``max_texts`` labelled texts, half of them good and half
    bad, drawn by the hash of their ids among those that have a text; a class
    with fewer gives all it has. Without texts of both kinds the field stays
    neutral, and then every line counts as content. Lines become features in
    the tasks, so the driver sees no text."""
    texts = only(docs, doc_id="bigint", text="string").where("text is not null")
    rank = F.row_number().over(Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = (only(labels, doc_id="bigint", quality="int")
              .where("quality in (0, 1) and doc_id is not null").distinct()
              .join(texts.select("doc_id").distinct(), "doc_id")
              .withColumn("rank", rank).where(F.col("rank") <= max_texts // 2))

    # At most max_texts ids go to the texts, not the texts to them.
    def lines(part: pa.RecordBatch, _):
        x = Lines(part.column(2))
        ends = np.searchsorted(x.row, np.arange(1, x.rows))
        return {"doc_id": part.column(0), "quality": part.column(1),
                "features": [f.tobytes() for f in np.split(x.features.astype(np.uint8), ends)]}

    chosen = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "quality", "text")
    # Rows that share an id are texts of their own, so the bound is set again.
    again = F.row_number().over(Window.partitionBy("quality")
                                .orderBy(F.xxhash64("doc_id"), "doc_id", "features"))
    sample = (map_batches(chosen, lines, "doc_id bigint, quality int, features binary", text="text")
              .withColumn("rank", again).where(F.col("rank") <= max_texts // 2)
              .orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "features")
              .select("quality", "features").toArrow())
    good = sample.column(0).to_numpy()
    features = [np.frombuffer(f, dtype=np.uint8).reshape(-1, N_FEATURES).astype(np.int64)
                for f in sample.column(1).to_pylist()]
    row = np.repeat(np.arange(len(features)), np.asarray([len(f) for f in features], dtype=int))
    if not 0 < good[row].sum() < len(row):
        return Field()
    return Field().train(np.concatenate(features), row, good[row].astype(np.int64))


def judge(df: DataFrame, field: Field, min_words: int = MIN_WORDS,
          max_repeat_percent: int = MAX_REPEAT_PERCENT,
          min_content_share: float = MIN_CONTENT_SHARE,
          carry: dict[str, str] | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, the counts, ``base_failed``,
    ``content_share``, ``kept``, and ``row``, the columns of ``carry`` (name to
    type), if any are asked for. A null or empty text has no words, fails
    the base rule and has a share of 0; repeated rows are judged each; an
    empty table gives no rows. Nothing is shuffled."""
    weights = (field.emit, field.move)

    def batch(part: pa.RecordBatch, model: Field):
        x = Lines(part.column(1))
        content = model.decode(x.features, x.row) == 1
        held = np.bincount(x.row[content], x.words[content], minlength=x.rows)
        share = held / np.maximum(x.n_words, 1)
        failed = (x.n_words < min_words) | (100 * x.n_repeat > max_repeat_percent * x.n_words)
        out = {"doc_id": part.column(0), "n_words": x.n_words, "word_chars": x.word_chars,
               "n_symbols": x.n_symbols, "n_dup_lines": x.n_dup_lines,
               "n_repeat_words": x.n_repeat, "base_failed": failed, "content_share": share,
               "kept": ~failed & (share >= min_content_share)}
        return out | {f"row_{c}": part.column(1 if c == "text" else f"row_{c}") for c in carried}

    schema = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
              "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, "
              "content_share double, kept boolean")
    docs = [F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("text").cast("string").alias("text")]
    # A carried text is the text itself: it goes to the task and back once.
    carried = dict(carry or {})
    docs += [F.col(f"`{c}`").cast(kind).alias(f"row_{c}") for c, kind in carried.items()
             if c != "text"]
    schema += "".join(f", row_{c} {kind}" for c, kind in carried.items())
    judged = map_batches(df.select(*docs), batch, schema, text="text",
                         setup=lambda: Field(*weights))
    if not carried:
        return judged
    row = F.struct(*[F.col(f"row_{c}").alias(c) for c in carried]).alias("row")
    return judged.select(*[c for c in judged.columns if not c.startswith("row_")], row)
