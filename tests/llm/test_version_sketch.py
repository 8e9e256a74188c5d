import base64
import hashlib
import random

import numpy as np
import pytest

from shelfmark.llm import version_sketch as m
from shelfmark.llm.common import Workspace
from tests.llm.samples import ODD, frame, sentences, with_clashes

PATTERN = m.paragraph_pattern()


def plain_paragraphs(text, max_words=m.MAX_WORDS):
    out = []
    for line in text.split("\n"):
        run = []
        for word in line.split():
            run.append(word)
            if word[-1] in ".!?" or len(run) == max_words:
                out.append(run)
                run = []
        if run:
            out.append(run)
    return out


def multiset(text):
    seen, out = {}, set()
    for p in PATTERN.findall(text):
        seen[p] = seen.get(p, -1) + 1
        out.add((p, seen[p]))
    return out


def plain_likeness(a, b):
    a, b = multiset(a), multiset(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_rows(rows):
    import xxhash

    def tie(text):
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        return h - (1 << 64) if h >> 63 else h

    docs = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), -tie(r[1])))
    out = []
    for (i, text), (_, following) in zip(docs, docs[1:] + docs[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        digest = hashlib.sha256(changed.encode()).hexdigest()
        out.append((i, len(text), digest, plain_likeness(text, changed), plain_likeness(text, following)))
    return sorted(out, key=repr)


def fingerprint(text):
    made = m.Sketches.of(*m.elements([text], PATTERN), 1, m.CELLS)
    return base64.b64encode(made.encoded()[0]).decode()


def test_paragraphs_are_runs_of_words():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "bc", "é", ".", "!", " ", "  ", "\n", "\t"]) for _ in range(60))
        assert [p.split() for p in PATTERN.findall(text)] == plain_paragraphs(text)


def test_long_words_end():
    for text in ("." * 200_000, "a" * 200_000, "a." * 100_000, "x " * 100_000):
        assert sum(map(len, PATTERN.findall(text))) >= 100_000


@pytest.mark.parametrize("n", [0, 3, 200])
def test_peeling_recovers_all_differences(n):
    rng = np.random.default_rng(n)
    common = rng.integers(0, 2**64, 500, np.uint64)
    left, right = (np.concatenate((common, rng.integers(0, 2**64, k, np.uint64))) for k in (n, n // 2))
    sides = [(np.zeros(len(x), np.int64), np.sort(x)) for x in (left, right)]
    found = m.differences(*sides, 1)
    assert set(found.digest[found.sign == 1]) == set(left) - set(common)
    assert set(found.digest[found.sign == -1]) == set(right) - set(common)
    assert (found.cells[0] > m.CELLS) == (n > m.CELLS)


def test_pairs_do_not_mix():
    rng = random.Random(5)
    left = [sentences(rng.randint(0, 300), i) for i in range(60)]
    right = [m.edited(a, b) for a, b in zip(left, left[1:] + left[:1])]
    sides = [m.elements(side, PATTERN) for side in (left, right)]
    sizes = [np.bincount(o, minlength=60) for o, _ in sides]
    got = m.likeness(*sizes, m.differences(*sides, 60))
    assert got.tolist() == [plain_likeness(a, b) for a, b in zip(left, right)]


def test_fingerprints_alone_tell_small_differences():
    a, b = "one two. three four. five", "one two. three. five six"
    marks = [fingerprint(t) for t in (a, b)]
    digest = {p: int(m.elements([p], PATTERN)[1][0]) for p in ("three four.", "five", "three.", "five six")}
    assert m.fingerprint_difference(*marks) == (
        {digest["three four."], digest["five"]},
        {digest["three."], digest["five six"]},
    )
    assert m.fingerprint_difference(marks[0], fingerprint(sentences(2000))) is None


def test_documents_and_their_neighbours(spark):
    base = sentences(400)
    rows = ODD + [(20 + i, base) for i in range(30)] + [(100 + i, sentences(i * 9, i)) for i in range(60)]
    rows += [(300, "\n".join(["a repeated line"] * 50)), (301, sentences(20_000)), (302, "ß" * 7)]
    found = m.fingerprints(with_clashes(frame(spark, rows)).repartition(5), Workspace(spark)).collect()
    got = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found]
    assert sorted(got, key=repr) == plain_rows(rows)
    assert len({r.fingerprint for r in found if 20 <= (r.doc_id or 0) < 50}) == 1
    by_id = {r.doc_id: r for r in found}
    assert by_id[301].fingerprint == fingerprint(dict(rows)[301])
    assert by_id[302].fingerprint != by_id[301].fingerprint


def test_one_row_and_none(spark):
    assert m.fingerprints(frame(spark, []), Workspace(spark)).count() == 0
    row = m.fingerprints(frame(spark, [(1, "a b. c")]), Workspace(spark)).first()
    assert (row.n_chars, row.near_next) == (6, 1.0)
    empty = m.fingerprints(frame(spark, [(None, None)]), Workspace(spark)).first()
    assert (empty.n_chars, empty.near_edited, empty.near_next) == (0, 1.0, 1.0)


def test_text_ids(spark):
    rows = [("b", "of b."), ("a", "of a, longer."), (None, "none")]
    found = m.fingerprints(frame(spark, rows, "doc_id string, text string"), Workspace(spark)).collect()
    want = {"b": ("of b.", "of a, longer."), "a": ("of a, longer.", "none"), None: ("none", "of b.")}
    for r in found:
        assert r.edited_sha256 == hashlib.sha256(m.edited(*want[r.doc_id]).encode()).hexdigest()


def test_two_columns_of_versions(spark):
    rows = [("a b. c d.", "a b. e f."), (None, ""), ("same", "same"), (sentences(900), None)]
    df = frame(spark, rows, "versions string, new string")
    found = m.compare_versions(df, "versions", "new").collect()
    assert [r.versions_.likeness for r in found] == [plain_likeness(a or "", b or "") for a, b in rows]
    assert [(len(r.versions_.only_left), len(r.versions_.only_right)) for r in found[:3]] == [(1, 1), (0, 0), (0, 0)]
    assert len(found[3].versions_.only_left) == len(multiset(rows[3][0]))
    assert found[2].versions_.left_fingerprint == found[2].versions_.right_fingerprint
