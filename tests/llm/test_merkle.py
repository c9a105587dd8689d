"""The manifest against trees built by plain loops."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path string, tree string, _row string, at string"
ODD = [None, "", "a", "é ß 中 😀", "-", "1:a", "|;", "x" * 50_000, "\n\t ", "ABC"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def plain_tree(leaves, fanout):
    """Root of the tree, and per leaf its siblings before and after it on every level."""
    steps = [[] for _ in leaves]
    nodes = [(digest, [i]) for i, digest in enumerate(leaves)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            digests = [d for d, _ in run]
            for nth, (_, below) in enumerate(run):
                for i in below:
                    steps[i].append(("".join(digests[:nth]), "".join(digests[nth + 1 :])))
            above.append((sha(*digests), [i for _, below in run for i in below]))
        nodes = above
    return nodes[0][0], steps


def plain_manifest(rows, fanout):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row[0]))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([leaf for _, _, leaf, _ in sorted(by_source[n], key=lambda x: x[:3])], fanout) for n in names]
    root, upper = plain_tree([t[0] for t in trees], fanout)
    out = []
    for name, (subroot, lower), above in zip(names, trees, upper, strict=True):
        for (_, _, leaf, doc), steps in zip(sorted(by_source[name], key=lambda x: x[:3]), lower, strict=True):
            path = "".join(f"{before}|{after};" for before, after in steps + above)
            out.append((str(doc), str(name), leaf, subroot, root, path))
    return sorted(out)


def found(spark, rows, **more):
    df = spark.createDataFrame([(*row, "x", "y", "z", "u", "v") for row in rows], SCHEMA).repartition(5)
    return sorted(tuple(map(str, r[:2])) + tuple(r[2:]) for r in merkle.manifest(df, **more).collect())


def some_rows(n, sources, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        text = rng.choice(ODD) if rng.random() < 0.3 else f"text {rng.random()}"
        doc = None if rng.random() < 0.05 else rng.randrange(-n, 3 * n)
        rows.append((doc, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 0, 7]), text))
    return rows + rows[: n // 10]  # repeated rows


@pytest.mark.parametrize(
    ("n", "sources", "fanout"),
    [
        (1, ["only"], 16),
        (90, ["only"], 3),  # a deep tree of one source: its root is the root
        (120, ["big"] * 30 + [None, "", "é", "z", "Z"], 2),
        (150, [f"s{i}" for i in range(60)], 3),  # more sources than children, some of one row
        (300, ["hot"] * 3 + [f"s{i}" for i in range(20)], 16),
    ],
)
def test_manifest_equals_plain_trees(spark, n, sources, fanout):
    rows = some_rows(n, sources, n)
    assert found(spark, rows, fanout=fanout) == plain_manifest(rows, fanout)


def test_no_rows_no_root(spark):
    assert found(spark, []) == []
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).columns == ["doc_id", "source", "leaf", "subroot", "root", "path"]


def test_a_changed_leaf_does_not_lead_to_the_root(spark):
    rows = some_rows(60, ["a", "b", None], 5)
    df = spark.createDataFrame([(*row, "x", "y", "z", "u", "v") for row in rows], SCHEMA)
    changed = F.when(F.col("lang").isNull(), merkle.leaf_digest({"text": F.lit("other")}))
    for row in (
        merkle.manifest(df, {"changed": changed})
        .select(
            "changed", "root",
            merkle.folded(F.col("leaf"), F.col("path")).alias("same"),
            merkle.folded(F.col("changed"), F.col("path")).alias("other"),
            merkle.proof_digest(F.col("path")).alias("proof"), "path",
        )
        .collect()
    ):
        assert row.same == row.root
        assert (row.other == row.root) is False if row.changed else row.other is None
        assert row.proof == sha(row.path.replace("|", "").replace(";", ""))
