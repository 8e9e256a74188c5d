import re
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import quality_rules as q
from shelfmark.llm.common import Workspace
from tests.llm.samples import ODD, SCHEMA, frame, sentences, with_clashes

TEXTS = [
    "a b c a b c",
    "a b c a b c a b c d",
    "a a a a a",
    "one\ntwo\none\n\n \none",
    "### $$ | <b>",
    "w " * 60,
    sentences(80),
    " ".join(f"w{i % 30}" for i in range(200)),
]


def measured(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for v in windows.values() if len(v) > 1 for i in v for k in range(3)}
    lines = [line for line in text.split("\n") if line.strip("\t\n\x0b\x0c\r ")]
    symbols = sum(text.count(s) for s in q.SYMBOLS)
    dup = len(lines) - len(set(lines))
    return len(words), sum(map(len, words)), symbols, len(lines), dup, len(covered)


def test_measures_equal_brute_force(spark):
    rows = ODD + list(enumerate(TEXTS, 100))
    found = q.measure(with_clashes(frame(spark, rows))).collect()
    got = Counter((r.doc_id, *[r[m] for m in q.MEASURES]) for r in found)
    assert got == Counter((i, *measured(t)) for i, t in rows)


def test_long_text(spark):
    text = sentences(30_000)
    row = q.measure(frame(spark, [(1, text)])).first()
    assert tuple(row[m] for m in q.MEASURES) == measured(text)


def test_policies_read_the_stored_bits(spark):
    workspace = Workspace(spark)
    rows = [(1, sentences(80)), (2, "short"), (3, "w " * 60), (4, "## " * 60 + sentences(80))]
    entries = q.store_ledger(q.ledger(frame(spark, rows)), workspace)
    kept = {p.version: {r.doc_id for r in q.apply_policy(entries, p).filter("kept").collect()} for p in (q.BASE, q.FULL)}
    assert kept == {"base-1": {1, 4}, "full-1": {1}}
    workspace.clear()


def test_ablations_equal_counting(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    entries = q.ledger(frame(spark, rows))
    failures = [r.failures for r in entries.collect()]
    for r in q.ablations(entries, [q.BASE, q.FULL]).collect():
        policy = q.BASE if r.policy == "base-1" else q.FULL
        mask = policy.mask()
        bit = 1 << next(x.bit for x in q.RULES if x.name == r.rule)
        assert r.n_failing == sum(f & bit != 0 for f in failures)
        assert r.n_only_this_rule == sum(f & mask == bit for f in failures)
        assert r.n_kept == sum(f & mask == 0 for f in failures)
        assert r.n_kept_without_it == sum(f & mask & ~bit == 0 for f in failures)


def test_bits_and_names_are_unique():
    assert len({r.bit for r in q.RULES}) == len({r.name for r in q.RULES}) == len(q.RULES)


def test_empty_table(spark):
    assert q.apply_policy(q.ledger(frame(spark, [], SCHEMA)), q.FULL).count() == 0


def test_no_python_in_the_plan(spark):
    plan = q.ledger(frame(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_unknown_rule():
    with pytest.raises(KeyError):
        q.Policy("v", ("no such rule",)).mask()
