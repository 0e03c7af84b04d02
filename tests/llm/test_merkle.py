import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quarterdeck.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """All levels from the leaves to the root."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k : k + 16])) for k in range(0, len(out[-1]), 16)])
    return out


def path(levels, k):
    for nodes in levels[:-1]:
        at = k - k % 16
        yield "".join(nodes[at:k]), "".join(nodes[k + 1 : at + 16])
        k //= 16


def plain(rows):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    by = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
        by.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, leaf(r)), r[0], leaf(r), leaf((*r[:4], lower(r[4]) if hit else r[4]))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(by[s])]) for s in order]
    top = tree([t[-1][0] for t in trees])
    out = []
    for i, s in enumerate(order):
        for k, (_, doc_id, h, shown) in enumerate(sorted(by[s])):
            sides = [*path(trees[i], k), *path(top, i)]
            for a, b in sides:
                shown = sha(a + shown + b)
            out.append((doc_id, h, trees[i][-1][0], top[-1][0], sha("".join(a + b for a, b in sides)), shown, shown == top[-1][0]))
    return sorted(out, key=str)


def rows(rng, sizes):
    ids = rng.sample(range(10**6), sum(sizes.values()))
    return [(ids.pop(), s, rng.choice(["en", None]), rng.choice([1, None]), rng.choice(["Abc é", "", None, "low", "ÀB c"])) for s, n in sizes.items() for _ in range(n)]


def found(df, **options):
    return sorted(map(tuple, merkle.manifest(df, given=merkle.lowered(), **options).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_is_that_of_plain_trees(spark, levels):
    given = rows(random.Random(levels), {"a": 1, None: 16, "b": 17, "ä": 256, "Z": 257, "c": 300, "": 15})
    df = spark.createDataFrame(given, SCHEMA).repartition(7)
    assert found(df, levels=levels) == plain(given)


def test_many_sources(spark):
    given = rows(random.Random(8), {f"s{k}": 1 + k % 3 for k in range(290)})
    assert found(spark.createDataFrame(given, SCHEMA), levels=1) == plain(given)


def test_tampering_is_found_and_nothing_else(spark):
    given = rows(random.Random(5), {"a": 400})
    hit = {r[0] for r in given if zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] in ("Abc é", "ÀB c")}
    out = merkle.manifest(spark.createDataFrame(given, SCHEMA), given=merkle.lowered(), levels=2).collect()
    assert hit and {r.doc_id for r in out if not r.verified} == hit
    assert all(r.verified for r in merkle.manifest(spark.createDataFrame(given, SCHEMA)).collect())


def test_defined_cases(spark):
    big = 2**60 + 1
    given = [(None, None, None, None, None), (None, None, "en", 3, "B"), (big, "x", None, None, "A" * 200_000), (3, "x", "en", 1, "same"), (3, "x", "en", 1, "same"), (3, "x", "en", 1, "Other")]
    df = spark.createDataFrame(given, SCHEMA).withColumns({c: F.lit("own") for c in ("id", "h", "shown", "key", "pos", "n", "block", "root", "a.b", "_part")})
    assert found(df) == plain(given)
    assert found(df.limit(0)) == []
    one = spark.createDataFrame([(7, "s", "en", 1, "t")], SCHEMA)
    (r,) = merkle.manifest(one).collect()
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == sha("") and r.verified
