import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import simhash as s
from shelfmark.llm.common import Workspace
from tests.llm.samples import ODD, frame, sentences, with_clashes


def plain_fingerprint(text, length=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius=3):
    values = np.unique(np.array(values, np.uint64))
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, v in enumerate(values):
        for j in np.flatnonzero(np.bitwise_count(values ^ v) <= radius):
            a, b = sorted((root(i), root(int(j))))
            label[b] = a
    return {int(v): root(i) for i, v in enumerate(values)}


def near(center, n, radius, rng):
    out = []
    for _ in range(n):
        value = center
        for bit in rng.sample(range(64), rng.randint(0, radius)):
            value ^= 1 << bit
        out.append(value)
    return out


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints_equal_brute_force():
    texts = [t for _, t in ODD] + [sentences(n, n) for n in (1, 2, 3, 4, 50, 2000)]
    for text in texts:
        assert s.fingerprint(text or "") == plain_fingerprint(text)


def test_one_shingle_hashes_like_the_engine(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert s.fingerprint("A b\tC") == value % (1 << 64)


@pytest.mark.parametrize("radius", [1, 3])
def test_close_lanes_equal_popcounts(radius):
    rng = random.Random(radius)
    values = [rng.getrandbits(64) for _ in range(40)]
    values = np.array(values + [w for v in values[:20] for w in near(v, 6, radius + 1, rng)], np.uint64)
    planes = s.bit_planes(values)
    words = planes.shape[1]
    query, word = np.repeat(np.arange(len(values)), words), np.tile(np.arange(words), len(values))
    hits, lanes = s.close_lanes(planes, values[query], word, radius)
    got = set()
    for h, bits in zip(hits, lanes):
        got |= {(query[h], word[h] * 64 + k) for k in range(64) if int(bits) >> k & 1}
    got = {(a, b) for a, b in got if b < len(values)}
    distance = np.bitwise_count(values[:, None] ^ values[None, :])
    assert got == set(zip(*np.nonzero(distance <= radius)))


def test_every_close_pair_shares_a_block():
    masks = s.block_masks(3)
    rng = random.Random(0)
    for _ in range(2000):
        a = rng.getrandbits(64)
        b = near(a, 1, 3, rng)[0]
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("max_bucket", [16_384, 7])
def test_components_equal_brute_force(spark, max_bucket):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(100)]
    for v in values[:6]:
        chain = v
        for _ in range(30):
            chain = near(chain, 1, 3, rng)[0]
            values.append(chain)
    distinct = spark.createDataFrame([(signed(v),) for v in set(values)], "bits long")
    workspace = Workspace(spark)
    roots = s.components(s.bucket_links(distinct, 3, max_bucket), workspace).collect()
    got = {r.node % (1 << 64): r.root for r in roots}
    got |= {r.root % (1 << 64): r.root for r in roots}
    want = plain_components(values)
    groups = {}
    for v, label in want.items():
        groups.setdefault(label, set()).add(v)
    for group in groups.values():
        assert len({got.get(v, signed(v)) for v in group}) == 1
    assert len(set(got.values())) == sum(len(g) > 1 for g in groups.values())
    workspace.clear()


def test_documents(spark):
    base = sentences(400)
    words = base.split()
    rows = ODD + [(20, base), (21, base), (22, base.upper()), (30, " ".join(words[:-1] + ["end"]))]
    found = s.near_duplicates(with_clashes(frame(spark, rows))).collect()
    assert len(found) == len(rows)
    fingerprints = [plain_fingerprint(t) for _, t in rows]
    label = plain_components(fingerprints)
    smallest = {}
    for (i, _), f in zip(rows, fingerprints):
        if i is not None:
            smallest[label[f]] = min(smallest.get(label[f], i), i)
    want = sorted(((i, signed(f), smallest.get(label[f])) for (i, _), f in zip(rows, fingerprints)), key=repr)
    assert sorted(((r.doc_id, r.bits, r.component_id) for r in found), key=repr) == want


def test_hexadecimal_digits(spark):
    rows = spark.createDataFrame([(0,), (-1,), (255,)], "bits long")
    assert [r[0] for r in rows.select(s.as_hex("bits")).collect()] == ["0" * 16, "f" * 16, "0" * 14 + "ff"]


def test_empty_table(spark):
    assert s.near_duplicates(frame(spark, [])).count() == 0


def test_radius_that_counters_cannot_hold():
    with pytest.raises(ValueError, match="power of two"):
        s.close_lanes(s.bit_planes(np.zeros(1, np.uint64)), np.zeros(1, np.uint64), np.zeros(1, int), 2)


def test_row_keys_tell_ids_from_texts(spark):
    from shelfmark.llm.common import row_key

    rows = [("http://a", "b:c x"), ("http://a:b", "c x"), ("null", ""), (None, ""), ("", "-:"), (None, "0::")]
    df = frame(spark, rows, "doc_id string, text string")
    assert df.select(row_key().alias("k")).distinct().count() == len(rows)
