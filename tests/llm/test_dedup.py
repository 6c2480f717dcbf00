"""Near-duplicate groups, repeated windows and components by brute force."""
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from replyscope.llm.components import connected_components
from replyscope.llm.near_dedup import near_duplicates, overlaps
from replyscope.llm.substring_dedup import FMIndex, remove_repeats, repeated_windows
from replyscope.session import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def groups_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(size))))


def near_by_hand(rows, percent=85):
    sets = [(k, shingles(t)) for k, t in rows]
    links = []
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y \
                    and 100 * len(x & y) >= percent * len(x | y):
                links.append((a, b))
    root = groups_of({k for k, _ in sets if k is not None}, links)
    return sorted(((k, len(s), root.get(k) if k is not None else None,
                    k is None or root[k] == k) for k, s in sets), key=str)


def near_rows(seed, n_base=12, copies=14, filler=60):
    """Groups of edited copies around bases, a shared passage, loose texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = rng.sample(words, 30)
    rows, k = [], 0
    for b in range(n_base):
        base = [rng.choice(words) for _ in range(rng.choice([8, 40, 120]))]
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((k, " ".join(copy)))
            k += 1
    for _ in range(filler):
        rows.append((k, " ".join(passage + [rng.choice(words) for _ in range(rng.randint(0, 40))])))
        k += 1
    ids = list(range(k))
    rng.shuffle(ids)
    return [(ids[i], t) for i, t in rows]


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 5)])
def test_near_groups_are_those_of_all_pairs(docs, seed, block):
    rows = near_rows(seed)
    got = near_duplicates(docs(rows), block=block).collect()
    assert sorted(map(tuple, got), key=str) == near_by_hand(rows)


def test_near_groups_of_odd_rows(docs, odd_rows):
    got = near_duplicates(docs(odd_rows)).collect()
    assert sorted(map(tuple, got), key=str) == near_by_hand(odd_rows)
    assert near_duplicates(docs([])).collect() == []


def test_a_link_at_the_threshold(docs):
    words = [f"t{i}" for i in range(40)]
    # 38 shingles; changing the last word of 38 leaves 35 of 41 common ones.
    rows = [(5, " ".join(words)), (3, " ".join(words[:37])), (9, " ".join(words[:34]))]
    assert sorted(map(tuple, near_duplicates(docs(rows)).collect())) == near_by_hand(rows)


def test_overlaps():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, rng.integers(0, 30)).astype(np.uint64)) for _ in range(20)]
    got = overlaps(sets)
    assert all(got[i, j] == len(set(sets[i]) & set(sets[j])) for i in range(20) for j in range(20))


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (7, 7)]
    with Scratch(spark) as scratch:
        got = dict(map(tuple, connected_components(
            spark.createDataFrame(edges, "a bigint, b bigint"), scratch).collect()))
        want = groups_of({n for e in edges for n in e}, edges)
        assert got == {n: r for n, r in want.items()
                       if any(n in e and e[0] != e[1] for e in edges)}
        none = spark.createDataFrame([], "a bigint, b bigint")
        assert connected_components(none, scratch).collect() == []


def repeats_by_hand(rows, size=13):
    first = {}
    held = [(k, WORD.findall(t or "")) for k, t in rows]
    for k, w in held:
        for i in range(len(w) - size + 1) if k is not None else ():
            win = tuple(w[i:i + size])
            first[win] = min(first.get(win, k), k)
    out = []
    for k, w in held:
        gone = set()
        for i in range(len(w) - size + 1) if k is not None else ():
            if first[tuple(w[i:i + size])] < k:
                gone |= set(range(i, i + size))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def repeat_rows(seed, n=120):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(30)] + ["Ä", "東"]
    passages = [[rng.choice(words) for _ in range(rng.randint(10, 60))] for _ in range(6)]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            parts += rng.choice([p, p[a:], p[:a], [rng.choice(words) for _ in range(20)]])
        rows.append((k * 7 % n, rng.choice([" ", "\n", "  "]).join(parts)))
    return rows


@pytest.mark.parametrize("seed,many,shard", [(1, 2000, 200_000), (2, 0, 200), (3, 3, 500)])
def test_windows_go_as_by_hand(docs, seed, many, shard):
    rows = repeat_rows(seed)
    got = remove_repeats(docs(rows), many=many, shard_words=shard).collect()
    assert sorted(map(tuple, got), key=str) == repeats_by_hand(rows)


def test_windows_of_odd_rows(docs, odd_rows):
    rows = odd_rows + [(20, "wort " * 30), (21, None), (22, "a b c d e f g h i j k l m n")] \
        + [(23, "a b c d e f g h i j k l m n o")] * 2
    got = remove_repeats(docs(rows)).collect()
    assert sorted(map(tuple, got), key=str) == repeats_by_hand(rows)
    assert remove_repeats(docs([])).collect() == []


def test_kept_text(docs):
    rows = [(1, "a b c d\ne f g h i j k l m n"), (2, "x\ny  z"), (3, "q a b c d e f g h i j k l m z")]
    got = {r.doc_id: r for r in remove_repeats(docs(rows), carry="n_words string").collect()}
    assert got[2].kept_text == rows[1][1] and got[1].kept_text == rows[0][1]
    assert got[3].kept_text == "q z" and got[3].row.n_words == "x"


def test_index_counts_patterns():
    rng = np.random.default_rng(4)
    text = np.append(rng.integers(1, 6, 400), 0)
    index = FMIndex(text)
    for _ in range(200):
        n = int(rng.integers(1, 8))
        at = int(rng.integers(0, 390))
        pattern = text[at:at + n]
        low, high = (np.asarray([index.first[pattern[-1] + d]]) for d in (0, 1))
        for c in pattern[-2::-1]:
            low, high = index.extend(np.asarray([c]), low, high)
        want = sum(np.array_equal(text[i:i + n], pattern) for i in range(len(text) - n + 1))
        assert high[0] - low[0] == want
        assert at in index.places[low[0]:high[0]]


def test_repeated_windows_by_hand():
    rng = random.Random(8)
    segments = [np.asarray([rng.randrange(3) for _ in range(rng.randint(4, 9))], dtype=np.uint64)
                for _ in range(60)]
    first = np.asarray([rng.randrange(40) for _ in segments])
    last = first + np.asarray([rng.choice([0, 0, 3]) for _ in segments])
    low = defaultdict(lambda: 10**9)
    for s, f in zip(segments, first):
        for i in range(len(s) - 3):
            low[tuple(s[i:i + 4])] = min(low[tuple(s[i:i + 4])], f)
    want = {(n, i, low[tuple(s[i:i + 4])]) for n, s in enumerate(segments)
            for i in range(len(s) - 3) if low[tuple(s[i:i + 4])] < last[n]}
    dealt = np.concatenate(segments), np.asarray([len(s) for s in segments])
    got = set(zip(*(x.tolist() for x in repeated_windows(dealt, first, last, 4))))
    assert got == want
