"""Extraction, url rules, quality rules, fingerprints and scores."""
import collections
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replyscope.llm.html_extract import Page, best_text, extract_text, generalised
from replyscope.llm.pseudo_likelihood import (BUCKETS, EDGE, IDS, VOCABULARY, WINDOW, Network,
                                              Reader, frequent_words, pseudo_likelihood, score)
from replyscope.llm.quality import MIN_WORDS, Field, Lines, judge, train_field
from replyscope.llm.url_filter import RULES, Trie, filter_urls, split_url
from replyscope.llm.weighted_sampling import SAMPLES, fingerprints

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------ pages
PROSE = "A sentence of the article goes on for a while and ends here. " * 3


@pytest.mark.parametrize("source,want", [
    ("", ""), ("plain  text\n only", "plain text only"), ("<p>x<", "x<"),
    ("<p>a &amp; b&nbsp;c &#233; &#x6771;</p>", "a & b c é 東"),
    ("<div>a<br>b<p>c</div>", "a b\n\nc"),
    ("<article><h1>T</h1><p><b>one<br><p>two</article><footer>f</footer>", "T\n\none\n\ntwo"),
    ("<main><p>a<!-- <p>no</p> --><script>'</p>no'</script><style>p{}</style>b</main>", "ab"),
    ("<ul><li>one<li>two</ul>", "one\n\ntwo"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\n\nb\n\nc"),
    (f'<nav>n</nav><div class="side-bar sidebar2">s</div><div id="content"><h2>H</h2><p>{PROSE}</p>'
     f'<form>f</form><div class="ad-12">ad</div><div role="alert">n</div></div>'
     f'<section id="comments"><p>{PROSE * 9}</p></section>', f"H\n\n{PROSE.strip()}"),
    (f'<body><div class="x"><h1>Title</h1><div class="body-7"><p>{PROSE}</p></div></div>',
     f"Title\n\n{PROSE.strip()}"),
    ('<a title="a>b" href=\'x\'>link</a>', "link"), ("<p hidden>x</p>y", "y"),
    ("<title>t</title><body>b", "b"),
    ("<p>so <math><mi>a</mi><mo>=</mo><mn>1</mn><annotation>a=1</annotation></math> holds",
     "so a=1 holds"), ("<p>x <object data='y'>shown</object> z", "x shown z"),
])
def test_page_text(source, want):
    assert best_text(Page(source), None) == want


def test_generalised_classes():
    assert generalised("div", "post-1234 Entry entry2") == "div.entry.post"


def test_prose_beside_the_host_path_stays(spark):
    """One page of a host has a part of its article beside the usual container."""
    links = "<div class='more'><p><a href='x'>{}</a></p></div>".format(PROSE[:40])

    def page(intro):
        return f"<div class='w'>{intro}<div class='text'><p>{PROSE * 2}</p></div>{links}</div>"
    rows = [(i, "http://a.org/", page("")) for i in range(10)]
    rows += [(10, "http://a.org/", page(f"<div class='intro'><p>{PROSE}</p></div>"))]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract_text(df).collect()}
    text = (PROSE * 2).strip()
    assert got == {i: text for i in range(10)} | {10: f"{PROSE.strip()}\n\n{text}"}


def test_deep_pages_keep_their_paths_apart(spark):
    """Containers far below the root are told apart by the whole path, and a
    path shared by all pages of a host gets its votes however deep others lie."""
    def page(name, inner, text):
        return (f"<div class='{name}'>" + "".join(f"<div class='{c}'>" for c in inner)
                + f"<p>{text}</p>" + "</div>" * (len(inner) + 1))
    deep = Page(page("a", "x" * 40, PROSE) + page("b", "x" * 40, PROSE))
    assert len(set(deep.paths)) == len(deep.paths) and max(map(len, deep.paths)) < 250
    assert Page(page("a", "x" * 40, PROSE)).paths == deep.paths[:42]
    rows = [(i, "http://a.org/", page("story", chr(97 + i) * 10, PROSE) + page("below", "", "x"))
            for i in range(9)]
    rows += [(9, "http://a.org/", page("story", "z" * 10, PROSE * 2) + page("below", "", PROSE * 3)),
             (10, "http://a.org/", "<div>" * 500 + f"<p>{PROSE * 2000}")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract_text(df).collect()}
    assert got == {i: PROSE.strip() for i in range(9)} | {9: (PROSE * 2).strip(),
                                                          10: (PROSE * 2000).strip()}


def test_hosts_vote_on_paths(spark):
    """A page whose comments hold more prose than its article follows its host."""
    def page(article, below):
        return (f"<div class='menu'>m</div><div class='story-{len(article)}'><p>{article}</p></div>"
                f"<div class='below'><p>{below}</p></div>")
    rows = [(i, f"http://A.org/{i}", page(PROSE * 4, "short")) for i in range(9)]
    rows += [(9, "http://a.org/x", page(PROSE, PROSE * 2)), (10, "http://b.org/", None),
             (11, None, ""), (12, "x", "<p>lone"), (12, "x", "<p>lone")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string") \
        .withColumn("text", F.lit(1)).withColumn("host", F.lit("z"))
    got = collections.Counter((r.page_id, r.text, r.n_chars) for r in extract_text(df).collect())
    want = collections.Counter()
    for i, _, source in rows:
        text = "" if not source else "lone" if i == 12 else (PROSE * (1 if i == 9 else 4)).strip()
        want[i, text, len(text)] += 1
    assert got == want
    assert extract_text(df.limit(0)).collect() == []


# ------------------------------------------------------------------- urls
URLS = [None, "", "no scheme", "http://", "http://Example.ORG/es/x?y=/z", "http://example.org/en/12",
        "https://a.b.example.org/en/2", "http://example.org", "http://org/", "http://xorg/",
        "ftp://m.site.com/fr/1#a", "http://site.com/de/", "http://site.com/de", "http://com/fr/",
        "http://x.net/org/", "http://e.org:80/a", "a://b://c.org/", "http://org./", "http://.org/"]


def by_hand(url):
    host, path = "", ""
    if url and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
        host, slash, path = rest.partition("/")
        host, path = re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path
    fits = [(h.count("."), len(p), v, h + p) for v, h, p in RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


@pytest.mark.parametrize("max_trie_rules", [100, 1])
def test_longest_rule_wins(spark, max_trie_rules):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(0, None, "x")],
                               "page_id bigint, url string, host string")
    got = filter_urls(df, max_trie_rules=max_trie_rules).collect()
    assert sorted(map(tuple, got)) == sorted(
        [(i, *by_hand(u)) for i, u in enumerate(URLS)] + [(0, *by_hand(None))])
    assert filter_urls(df.limit(0), max_trie_rules=max_trie_rules).collect() == []


def test_block_holds_over_allow():
    trie = Trie([("block", "a.b", "/x"), ("allow", "a.b", "/x"), ("allow", "b", "/x/y/z")])
    assert trie.find("a.b", "/x/y/z") == ("block", "a.b/x")
    assert trie.find("c.b", "/x/y/z") == ("allow", "b/x/y/z") and trie.find("c.b", "/x") is None
    assert split_url("s://H/p?q") == ("h", "/p")


def test_bad_rules_are_refused(spark):
    with pytest.raises(ValueError):
        filter_urls(spark.createDataFrame([(1, "x")], "page_id bigint, url string"),
                    [("maybe", "a", "/")])


# ---------------------------------------------------------------- quality
def counts_by_hand(text):
    words = WORD.findall(text or "")
    triples = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {i + j for i in range(len(words) - 2) for j in range(3)
               if triples[words[i], words[i + 1], words[i + 2]] > 1}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again,
            len(covered))


def test_counts(docs, odd_rows):
    rng = np.random.default_rng(3)
    letters = list("ab\n\n |\t\x0b#東.") + ["é "]
    rows = odd_rows + [(100 + i, "".join(rng.choice(letters, rng.integers(0, 60))))
                       for i in range(300)]
    got = judge(docs(rows), Field()).collect()
    want = []
    for k, t in rows:
        c = counts_by_hand(t)
        failed = c[0] < MIN_WORDS or 100 * c[4] > 50 * c[0]
        want.append((k, *c, failed, not failed))
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                    r.n_repeat_words, r.base_failed, r.kept) for r in got), key=str) == \
        sorted(want, key=str)
    assert judge(docs([]), Field()).collect() == []


def random_lines(seed, rows=40, most=7):
    rng = np.random.default_rng(seed)
    words = ["aa", "BB!!", "c|", "d#", "e."]
    return Lines(pa.array(["\n".join(" ".join(rng.choice(words, rng.integers(1, 5)))
                                     for _ in range(rng.integers(1, most))) for _ in range(rows)]))


def test_viterbi_and_gradient_by_enumeration():
    x, rng = random_lines(1), np.random.default_rng(2)
    field = Field(rng.normal(size=Field().emit.shape), rng.normal(size=(2, 2)))
    label, s = field.decode(x.features, x.row), field.scores(x.features)

    def total(at, y):
        return s[at, y].sum() + sum(field.move[a, b] for a, b in zip(y, y[1:]))

    for r in range(x.rows):
        at = np.flatnonzero(x.row == r)
        paths = [np.asarray(y) for y in itertools.product((0, 1), repeat=len(at))]
        assert total(at, label[at]) == pytest.approx(max(total(at, y) for y in paths))
    # One small training step moves by the gradient of the log-likelihood.
    truth = rng.integers(0, 2, len(x.row))

    def likelihood(f):
        nonlocal s
        s, out = f.scores(x.features), 0
        move, field.move = field.move, f.move
        for r in range(x.rows):
            at = np.flatnonzero(x.row == r)
            out += total(at, truth[at]) - np.logaddexp.reduce(
                [total(at, np.asarray(y)) for y in itertools.product((0, 1), repeat=len(at))])
        field.move = move
        return out / len(x.row)

    start = Field(np.zeros_like(field.emit), np.zeros((2, 2)))
    after = Field(start.emit.copy(), start.move.copy()).train(x.features, x.row, truth, steps=1,
                                                             rate=1e-4, penalty=0)
    grad = [(after.emit - start.emit) / 1e-4, (after.move - start.move) / 1e-4]
    for name, g in zip(("emit", "move"), grad):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        up = Field(start.emit.copy(), start.move.copy())
        getattr(up, name)[at] += 1e-4
        assert (likelihood(up) - likelihood(start)) / 1e-4 == pytest.approx(g[at], abs=1e-3)


def test_labelled_texts_are_told_apart(spark, sf):
    """Held-out accuracy: the field sees even ids only."""
    docs = spark.read.parquet(f"{sf}/../sf0.01/documents.parquet")
    labels = spark.read.parquet(f"{sf}/../sf0.01/labels.parquet")
    field = train_field(docs, labels.where("doc_id % 2 = 0"))
    held = (judge(docs, field).join(labels.where("doc_id % 2 = 1"), "doc_id")
            .where("not base_failed").select("kept", "quality").collect())
    good = [r.kept for r in held if r.quality == 1]
    bad = [r.kept for r in held if r.quality == 0]
    assert len(bad) > 5 and np.mean(good) > .97 and np.mean(bad) < .1
    neutral = train_field(docs, labels.where("quality = 1"))
    assert not neutral.emit.any() and not neutral.move.any()


def test_a_rare_class_is_learnt(spark):
    """Three bad texts among thousands of labels, most of them without a text."""
    good = "A calm sentence of plain words goes on and ends here.\nAnd one more follows it."
    bad = "$$$ CLICK !!! NOW | 50% | %%%\n### BUY !!! || 99 | $$$"
    rows = [(i, good, "x") for i in range(30)] + [(i, bad, "x") for i in (3_000, 3_001, 3_002)]
    rows += [(5, good, "x"), (40, None, "x"), (41, "", "x"), (None, good, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rank string")
    labels = spark.createDataFrame([(i, int(not 3_000 <= i < 3_003), "y") for i in range(6_000)]
                                   + [(5, 1, "y"), (8, None, "y"), (None, 0, "y"), (9, 7, "y")],
                                   "doc_id bigint, quality int, features string")
    for most in (1_000, 8):
        field = train_field(docs, labels, max_texts=most)
        for text, content in ((good, [1, 1]), (bad, [0, 0])):
            x = Lines(pa.array([text]))
            assert field.decode(x.features, x.row).tolist() == content
    for none in (labels.limit(0), labels.where("doc_id in (40, 41, 3000)")):
        assert not train_field(docs, none).emit.any()


# ------------------------------------------------------------ fingerprints
def generalised_jaccard(a, b):
    a, b = (collections.Counter(WORD.findall(t)) for t in (a, b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


@pytest.mark.parametrize("per_bucket", [1, 7, 500])
def test_fingerprints(docs, odd_rows, per_bucket):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    rows = odd_rows + [(int(k) * 5, " ".join(rng.choice(words, rng.integers(1, 80))))
                       for k in rng.permutation(90) + 10]
    got = fingerprints(docs(rows), ids_per_bucket=per_bucket).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [t or "" for _, t in order]
    want = []
    for i, (k, _) in enumerate(order):
        cut, after = len(texts[i]) // 3, texts[(i + 1) % len(texts)]
        edited = texts[i][:len(texts[i]) - cut] + after[:cut]
        want.append((k, len(texts[i]), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == \
        sorted(want, key=str)
    by_id = {(r.doc_id, r.edited_sha256): r for r in got}
    prints, errors = collections.defaultdict(set), []
    for i, (k, _) in enumerate(order):
        r = by_id[k, want[i][2]]
        prints[texts[i]].add(r.fingerprint)
        cut, after = len(texts[i]) // 3, texts[(i + 1) % len(texts)]
        if WORD.search(texts[i]) and WORD.search(after):
            errors.append(r.near_next - generalised_jaccard(texts[i], after))
            errors.append(r.near_edited - generalised_jaccard(
                texts[i], texts[i][:len(texts[i]) - cut] + after[:cut]))
    assert all(len(p) == 1 for p in prints.values())
    assert abs(np.mean(errors)) < .03 and np.std(errors) < .1
    assert all(len(r.fingerprint) in (0, 4 * SAMPLES) for r in got)


def test_fingerprints_of_few_rows(docs):
    assert fingerprints(docs([])).collect() == []
    lone = fingerprints(docs([(4, "abc def")])).first()
    assert lone.near_next == 1 and lone.near_edited < 1
    empty = fingerprints(docs([(None, None), (None, "")])).collect()
    assert all(r.fingerprint == "" and r.near_next == 1 and r.n_chars == 0 for r in empty)


# ---------------------------------------------------------------- scores
def test_gradient_of_the_network():
    rng = np.random.default_rng(1)
    around, centre = rng.integers(0, IDS + 1, (50, 2 * WINDOW)), rng.integers(0, IDS, 50)
    net = Network()
    after = Network(net.flat())
    after.step(around, centre, 1e-2)
    moved = (after.flat() - net.flat()) / 1e-2
    flat = net.flat().astype(np.float64)
    for at in np.argsort(-np.abs(moved))[:12]:
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        rise = (Network(up).log_probability(around, centre).mean()
                - Network(down).log_probability(around, centre).mean()) / 2e-2
        assert rise == pytest.approx(moved[at], rel=.05, abs=1e-3)


def test_probabilities_sum_to_one():
    around = np.tile(np.asarray([[1, 2, 3, EDGE]]), (IDS, 1))
    assert np.exp(Network().log_probability(around, np.arange(IDS))).sum() == pytest.approx(1, abs=1e-4)


def test_neighbours_stop_at_the_text():
    around, ids, first = Reader(np.zeros(0, np.uint64)).read(pa.array(["a b", None, "C c"]))
    assert first.tolist() == [0, 2, 2, 4] and ids[2] == ids[3]
    assert (ids >= VOCABULARY).all() and (ids < VOCABULARY + BUCKETS).all()
    assert around[0].tolist() == [EDGE, EDGE, ids[1], EDGE]
    assert around[3].tolist() == [EDGE, ids[2], EDGE, EDGE]


def test_training_beats_the_unigram_start(docs):
    rng = np.random.default_rng(2)
    pairs = [("ka", "lo"), ("mi", "nu"), ("po", "ra")]
    rows = [(i, " ".join(w for j in rng.integers(0, 3, 60) for w in pairs[j])) for i in range(300)]
    df = docs(rows)
    vocabulary, counts = frequent_words(df.select("doc_id", "text"))
    start = score(df.select("doc_id", "text"), Network().start_from(counts), vocabulary)
    trained = pseudo_likelihood(df, rounds=3)
    before, after = (x.agg(F.avg("mean_log_likelihood")).first()[0] for x in (start, trained))
    assert after > before + .3


def test_scores_of_odd_rows(docs, odd_rows):
    got = pseudo_likelihood(docs(odd_rows)).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in got) == \
        sorted((str(k), len(WORD.findall(t or ""))) for k, t in odd_rows)
    assert all((r.mean_log_likelihood is None) == (r.n_words == 0) for r in got)
    assert all(r.log_likelihood == 0 for r in got if not r.n_words)
    assert pseudo_likelihood(docs([])).collect() == []


def further_network(further, seed=3):
    rng = np.random.default_rng(seed)
    counts = np.zeros(IDS + 1 + further)
    counts[:VOCABULARY] = rng.integers(50, 500, VOCABULARY)
    counts[IDS + 1:] = rng.integers(1, 50, further)
    rest = rng.integers(0, 9, BUCKETS)
    counts[VOCABULARY:IDS] = rest + np.bincount(np.arange(further) % BUCKETS, counts[IDS + 1:],
                                                BUCKETS)
    return Network().start_from(counts), counts, rest


def test_further_words_have_probabilities_of_their_own():
    net, counts, rest = further_network(1000)
    ids = np.concatenate([np.arange(IDS), IDS + 1 + np.arange(1000)])
    p = np.exp(net.log_probability(np.full((len(ids), 2 * WINDOW), EDGE), ids))
    assert p.sum() == pytest.approx(1, abs=1e-4)
    inside = p[IDS:] / np.bincount(np.arange(1000) % BUCKETS, p[IDS:], BUCKETS)[
        np.arange(1000) % BUCKETS]
    whole = np.bincount(np.arange(1000) % BUCKETS, counts[IDS + 1:], BUCKETS)
    assert inside == pytest.approx(counts[IDS + 1:] / whole[np.arange(1000) % BUCKETS], rel=1e-3)


def test_gradient_of_further_words():
    rng = np.random.default_rng(1)
    net = further_network(600)[0]
    around = rng.integers(0, IDS + 601, (50, 2 * WINDOW))
    centre = np.concatenate([rng.integers(0, IDS, 20), rng.integers(IDS + 1, IDS + 601, 30)])
    after = Network(net.flat(), 600)
    after.step(around, centre, 1e-2)
    moved, flat = (after.flat() - net.flat()) / 1e-2, net.flat().astype(np.float64)
    first = len(flat) - net.tree.size
    for at in [*np.argsort(-np.abs(moved))[:6], *first + np.argsort(-np.abs(moved[first:]))[:6]]:
        up, down = flat.copy(), flat.copy()
        up[at] += 1e-2
        down[at] -= 1e-2
        rise = (Network(up, 600).log_probability(around, centre).mean()
                - Network(down, 600).log_probability(around, centre).mean()) / 2e-2
        assert rise == pytest.approx(moved[at], rel=.05, abs=1e-3)


def same_bucket(n):
    held = collections.defaultdict(list)
    for i in itertools.count():
        b = Reader(np.zeros(0, np.uint64)).read(pa.array([f"rare{i}"]))[1][0]
        held[b].append(f"rare{i}")
        if len(held[b]) == n:
            return held[b]


def test_words_outside_are_scored_by_their_own_counts(docs):
    a, b, c = same_bucket(3)
    rows = [(9, " ".join(f"w{i}" for i in range(VOCABULARY)))] * 60
    rows += [(0, a)] * 55 + [(1, b)] * 8 + [(2, c)]
    got = {r.doc_id: r.log_likelihood for r in pseudo_likelihood(docs(rows)).collect()}
    assert got[0] - got[1] == pytest.approx(np.log(55 / 8), abs=1e-5)
    assert got[1] - got[2] == pytest.approx(np.log(8), abs=1e-5)


def test_vocabulary_grows_with_the_corpus(docs):
    rows = [(i, " ".join(f"w{j}" for j in range(1500))) for i in range(4)] + [(5, "lone")]
    words, counts = frequent_words(docs(rows).select("doc_id", "text"), own=4)
    assert len(words) == 1500 and len(counts) == IDS + 1 + 1500 - VOCABULARY
    assert counts[:IDS].sum() == 4 * 1500 + 1
    ids = Reader(words).read(pa.array([rows[0][1]]))[1]
    assert len(set(ids)) == 1500 and not ((ids >= VOCABULARY) & (ids <= IDS)).any()


def test_network_helpers_against_loops():
    """Rows are added by column, neighbours read through edges, and words whose
    hashes share a slot are told apart."""
    from replyscope.llm import pseudo_likelihood as pl
    rng = np.random.default_rng(3)
    table, at = rng.normal(size=(9, 4)).astype(np.float32), rng.integers(0, 9, 50)
    rows = rng.normal(size=(50, 4)).astype(np.float32)
    want = table.copy()
    np.add.at(want, at, rows)
    pl._add_rows(table, at, iter(rows.T))
    assert np.allclose(table, want, atol=1e-5)
    logits = np.asarray([[0, 1, 2], [-300, 500, 499], [-70, -80, -90]], dtype=np.float32)
    share = pl._log_share(logits.copy(), np.asarray([2, 1, 0]))
    assert np.allclose(share, [2 - np.log(1 + np.e + np.e ** 2), -np.log1p(np.exp(-1)), 0], atol=1e-4)
    hashes = np.asarray([5, 6, 7, 1 << 63, (1 << 63) + 1, 2 ** 64 - 1], dtype=np.uint64)
    words = type("W", (), {"hash": np.asarray([7, 5, 8, 2 ** 64 - 1, (1 << 63) + 1], np.uint64),
                           "row": np.asarray([0, 0, 0, 2, 2]), "first": np.asarray([0, 3, 3, 5])})
    around, ids, _ = Reader(hashes).read_words(words)
    assert ids.tolist() == [2, 0, VOCABULARY + 8, 5, 4]
    e = EDGE
    assert around.tolist() == [[e, e, 0, VOCABULARY + 8], [e, 2, VOCABULARY + 8, e], [2, 0, e, e],
                               [e, e, 4, e], [e, 5, e, e]]
