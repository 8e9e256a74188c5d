import re

from shelfmark.llm import license_scan as l
from tests.llm.samples import ODD, frame, sentences, with_clashes

NOTICE = l.NOTICES[0]
TEXTS = [
    "Under the MIT License. under, the mit-license!",
    "CC BY NC BY NC cc by nc cc by nc",
    "Apache License, Version 2.0 and apache license version 3",
    "under the mit",
    "cc by",
    "ünder the mit license under the mit licenseß",
    "x " * 3000 + "cc by nc",
]


def found_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def phrases(text):
    words, starts, labels = found_words(text), [], set()
    for p in l.PHRASES:
        for i in range(len(words) - len(p.words) + 1):
            if words[i : i + len(p.words)] == p.words:
                starts.append(i)
                labels.add(p.label)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted(labels))


def test_phrases_equal_brute_force(spark):
    rows = ODD + list(enumerate(TEXTS, 50))
    got = l.scan(with_clashes(frame(spark, rows))).collect()
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(got, key=repr) == sorted([(i, *phrases(t)) for i, t in rows], key=repr)


def labels(spark, text):
    return l.scan(frame(spark, [(1, text)])).first()


def test_whole_notice(spark):
    row = labels(spark, sentences(30) + " " + NOTICE.text + " " + sentences(30))
    assert (row.labels, row.base_labels, row.score) == ("mit", "", 1.0)


def test_neighbouring_diagonals_merge(spark):
    words = NOTICE.text.split()
    edited = " ".join([*words[:15], "indeed", *words[15:30], *words[31:]])
    row = labels(spark, edited)
    assert row.labels == "mit" and 0.8 <= row.score < 1 and row.n_spans == 1


def test_scattered_grams_are_no_licence(spark):
    words = NOTICE.text.split()
    scattered = " ".join(" ".join(words[i : i + 3]) + " " + sentences(40, i) for i in range(0, 40, 3))
    assert labels(spark, scattered).labels == ""


def test_half_a_notice_is_no_licence(spark):
    assert labels(spark, " ".join(NOTICE.text.split()[:25])).labels == ""


def test_labels_add_to_base_ones(spark):
    row = labels(spark, "Under the MIT License. All rights reserved.")
    assert (row.base_labels, row.labels) == ("mit", "all-rights-reserved,mit")


def test_empty_table(spark):
    assert l.scan(frame(spark, [])).count() == 0
