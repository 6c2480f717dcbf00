"""License labels: base phrases against a regular-expression search, notices
against whole, edited and look-alike texts."""
import random
import re

import pytest

from replyscope.llm import queries
from replyscope.llm.license_scan import (NOTICES, PHRASES, Index, Scanner, file_words, scan_licenses,
                                         words_of)

FILLER = "the of and this work in to for is a with free use copy notice version general".split()


def base(text):
    words = words_of(text or "")
    hits = [(i, label) for phrase, label in PHRASES for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(hits), min((i for i, _ in hits), default=None),
            max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits})))


def filler(rng, n):
    return " ".join(rng.choice(FILLER) for _ in range(n))


@pytest.fixture(scope="module")
def scanner():
    index = Index()
    df = Index().idf
    return Scanner(index, df(index.numbers(index.hash) * 0 + 5, 100))


def labels(scanner, text):
    words = file_words([text])
    out = scanner.scan(scanner.index.numbers(words.hash), words.first)
    return out["labels"][0].split(",") if out["labels"][0] else [], out["score"][0]


def test_words():
    assert words_of("Under the MIT-License, v2.0 naïve_x東京ÉA") == \
        ["under", "the", "mit", "license", "v2", "0", "naïve", "x東京Éa"]


def test_every_notice_is_found_anywhere(scanner):
    rng = random.Random(8)
    for label, text, _ in NOTICES:
        for lead in (0, 1, 500):
            found, score = labels(scanner, filler(rng, lead) + "\n" + text + "\n" + filler(rng, 300))
            assert label in found and score == 1.0
        commented = "\n".join(" * " + line for line in re.findall(r".{1,60}(?:\s|$)", text))
        assert label in labels(scanner, commented.upper())[0]


def test_edited_notices_are_found(scanner):
    rng = random.Random(9)
    for label, text, keys in NOTICES:
        words = text.split()
        if len(words) < 30:
            continue
        at = {len(words) // 3, len(words) - 3}
        edited = " ".join(w if i not in at or any(words_of(w)[0] in k.split() for k in keys)
                          else w + " inserted" for i, w in enumerate(words))
        found, score = labels(scanner, filler(rng, 40) + " " + edited)
        assert label in found and score >= 0.7


def test_missing_key_phrases_and_shuffled_words_are_not(scanner):
    rng = random.Random(10)
    for label, text, keys in NOTICES:
        words = words_of(text)
        for _ in range(3):
            mixed = words[:]
            rng.shuffle(mixed)
            if not any(" ".join(k.split()) in " ".join(mixed) for k in keys):
                assert label not in labels(scanner, " ".join(mixed))[0]
        assert labels(scanner, filler(rng, 2000)) == ([], 0.0)
    # Key phrases alone, far from each other, are no notice.
    gpl = next(k for label, _, k in NOTICES if label == "gpl-3")
    assert labels(scanner, (" " + filler(rng, 100) + " ").join(gpl)) == ([], 0.0)


def test_several_notices_in_one_file(scanner):
    rng = random.Random(11)
    text = f" {filler(rng, 50)} ".join(t for _, t, _ in NOTICES)
    assert labels(scanner, text)[0] == sorted({label for label, _, _ in NOTICES})


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                   for r in df.collect()), key=str)


def test_odd_rows(docs, odd_rows):
    rows = odd_rows + [(20, "Under the MIT License. under THE mit license"), (21, "cc-by/nc CC BY"),
                       (22, "xunder the mit license"), (23, "under the mit licenses"),
                       (24, "apache license,\nVersion 2.0 cc by nc cc by nc"), (25, NOTICES[0][1]),
                       (None, "under the mit license"), (20, "under the mit license")]
    out = scan_licenses(docs(rows))
    assert rows_of(out) == sorted(((d, *base(t)) for d, t in rows), key=str)
    found = {(r.doc_id, r.labels, r.score) for r in out.where("doc_id in (1, 2, 25)").collect()}
    assert found == {(1, "", 0.0), (2, "", 0.0), (25, "mit", 1.0)}
    assert scan_licenses(docs([])).collect() == []
    assert [r.labels for r in scan_licenses(docs([(1, None)])).collect()] == [""]


def test_no_notices_leave_the_base(docs):
    out = scan_licenses(docs([(1, "cc by nc"), (2, "x")]), notices=()).collect()
    assert sorted((r.doc_id, r.labels, r.score) for r in out) == [(1, "cc-by-nc", 0.0), (2, "", 0.0)]
    assert [r.n_words for r in scan_licenses(docs([(1, "a b")]), (), ()).collect()] == [2]


def test_query_on_the_table(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op13_license_scan(spark, sf)
    assert rows_of(out) == sorted(((d, *base(t)) for d, t in texts.items()), key=str)
    for r in out.collect():
        held = set(r.labels.split(",")) - {""}
        assert set(r.base_labels.split(",")) - {""} <= held
        assert ("gpl-3" in held) == ("GNU General Public License, version 3." in texts[r.doc_id])
        assert (r.score > 0) == any(t in texts[r.doc_id] for _, t, _ in NOTICES)
