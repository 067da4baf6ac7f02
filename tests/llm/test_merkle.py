"""The manifest against a plain tree, leaf by leaf."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedloom.llm import merkle, queries

FOLDER = "/root/testdata/sf0.001"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def spell(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i : i + 2])) for i in range(0, len(last), 2)])
    return levels


def climb(levels, place, node=None):
    """Siblings of a leaf, and the top that another node in its place gives."""
    siblings, node = [], levels[0][place] if node is None else node
    for level in levels[:-1]:
        run = level[place // 2 * 2 : place // 2 * 2 + 2]
        siblings += run[:place % 2] + run[place % 2 + 1 :]
        run[place % 2] = node
        node, place = h("".join(run)), place // 2
    return siblings, node


def plain_rows(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    langs = {}
    for d in docs:
        langs.setdefault(d[2], []).append(d)
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted(langs[x], key=lambda d: (d[0] is not None, d[0] or 0, spell(d))) for x in names]
    trees = [plain_levels([spell(d) for d in g]) for g in groups]
    over = plain_levels([t[-1][0] for t in trees])
    root, out = over[-1][0], []
    for k, (group, tree) in enumerate(zip(groups, trees)):
        for place, d in enumerate(group):
            bad = None
            if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0:
                bad = spell((*d[:3], None if d[3] is None else d[3] + 1, d[4]))
            below, top = climb(tree, place, bad)
            above, folded = climb(over, k, top)
            out.append((d[0], tree[0][place], tree[-1][0], root, h("".join(below + above)), folded, folded == root))
    return sorted(out, key=repr)


def found_rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_missing_nodes_are_the_fewest():
    for size in (1, 2, 5, 8, 13):
        for bits in range(1, 1 << min(size, 8)):
            held = [k for k in range(min(size, 8)) if bits >> k & 1]
            found = set(merkle.missing(np.array(held), size))
            plain = set()
            for level in range(merkle.height(size)):
                known = {k >> level for k in held}
                plain |= {(level, k ^ 1) for k in known if k ^ 1 not in known and k ^ 1 < merkle.width(size, level)}
            assert found == plain


ODD = [
    (None, "s", "en", 1, "x"), (None, "s", "en", 1, "x"), (7, "s", "en", None, None), (7, "s", "en", 2, ""), (7, None, "en", 2, ""),
    *[(k, "é漢", "zz", k, "t" * k) for k in range(2, 39)], *[(-k, "a", None, k, None) for k in range(1, 18)],
    (50, "s", "", 5, "alone"), (51, "s", "é", 5, "w " * 400_000), *[(60 + k, None, "Z", 3, "same") for k in range(2)],
]


@pytest.fixture
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, source string, lang string, n_chars long, text string")
    names = ("id", "grp", "leaf", "other", "tree", "pos", "size", "block", "level", "digest", "of", "_slice")
    return rows.withColumns({c: F.lit("clash") for c in names})


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_rows_equal_a_plain_tree(odd, monkeypatch, bits):
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits)
    assert found_rows(merkle.verified_documents(odd)) == plain_rows(ODD)


def test_one_group_one_leaf_and_none(odd):
    one = odd.where("doc_id = 50")
    rows = found_rows(merkle.verified_documents(one))
    assert rows == plain_rows([r for r in ODD if r[0] == 50]) and rows[0][4] == h("")
    group = odd.where("lang = 'zz'")
    assert found_rows(merkle.verified_documents(group)) == plain_rows([r for r in ODD if r[2] == "zz"])
    assert merkle.verified_documents(odd.where("false")).count() == 0


def test_many_groups_have_a_tall_top(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_BITS", 2)
    rows = [(k, "s", f"l{k % 37}", k, "t") for k in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found_rows(merkle.verified_documents(frame)) == plain_rows(rows)


def test_a_partition_asks_for_its_path_only(odd, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_BITS", 2)
    hashed = odd.select(F.col("doc_id").alias("id"), F.col("lang").alias("grp"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("leaf"))
    manifest = merkle.build(merkle.stage(hashed, "test"))
    asked = merkle._wanted(manifest.leaves, manifest.trees).collect()
    assert len(asked) == len({(r["tree"], r["block"], r["of"], r["level"], r["pos"]) for r in asked})
    assert all(r["level"] >= 2 or r["of"] == merkle.TOP or r["pos"] == 0 for r in asked)
    stored = [(r["tree"], r["level"], r["pos"]) for r in manifest.nodes.collect()]
    assert len(stored) == len(set(stored)) and {(r["of"], r["level"], r["pos"]) for r in asked} <= set(stored)


def test_the_query_equals_a_plain_tree_and_its_sql(spark, duck):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(*merkle.FIELDS).collect()]
    found = found_rows(queries.op13_merkle(spark, FOLDER))
    assert found == plain_rows(docs)
    assert 0 < sum(not r[-1] for r in found) < len(found) / 3
    relation = duck.sql(queries.ORACLE_SQL["op13_merkle"])
    assert relation.columns == queries.op13_merkle(spark, FOLDER).columns
    assert sorted(relation.fetchall(), key=repr) == found
