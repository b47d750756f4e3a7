"""The Merkle manifest against trees folded in plain Python."""

import hashlib

from pyspark.sql import functions as F

from tarifold.llm import merkle
from tarifold.llm.common import lower_ascii

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree_of(leaves):
    """Root and each leaf's (left, right) siblings, level by level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    sides = []
    for at in range(len(leaves)):
        steps = []
        for level in levels[:-1]:
            first = at // 16 * 16
            steps.append(("".join(level[first:at]), "".join(level[at + 1:first + 16])))
            at //= 16
        sides.append(steps)
    return levels[-1][0], sides


def expected(rows, changed=lambda row: None):
    """Sorted (id, leaf, subroot, root, proof, folded)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    subroots, inner = [], {}
    for source in order:
        members = sorted(trees[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        root, sides = tree_of([leaf_of(r) for r in members])
        subroots.append(root)
        inner[source] = (members, sides)
    root, tops = tree_of(subroots)
    out = []
    for source, subroot, top in zip(order, subroots, tops):
        for row, steps in zip(*inner[source]):
            node = leaf_of(changed(row) or row)
            for left, right in steps + top:
                node = h(left, node, right)
            out.append((row[0], leaf_of(row), subroot, root, h(*[a + b for a, b in steps + top]), node))
    return sorted(out, key=str)


def proved(df, claimed=None):
    rows = merkle.prove(merkle.build_manifest(df, claimed)).collect()
    assert all(r["verified"] == (r["folded_root"] == r["root"]) for r in rows)
    return sorted([(r["id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in rows], key=str)


def test_trees_of_many_sizes(spark):
    sizes = {None: 1, "": 2, "a": 16, "b": 17, "Ä": 255, "c": 256, "d": 257, "z": 600, "𝄞": 33, "": 3}
    rows = [(n * 7 - 300, source, "en", n, f"Text {n} of {source}") for source, k in sizes.items() for n in range(k)]
    got = proved(spark.createDataFrame(rows, SCHEMA))
    assert got == expected(rows)
    assert {r[3] for r in got} == {r[5] for r in got}


def test_many_sources(spark):
    rows = [(n, f"s{n % 700}", None, None, "x" * n) for n in range(1500)]
    assert proved(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_awkward_rows(spark):
    rows = [(1, "a", "en", 2, "Same"), (1, "a", "en", 2, "Same"), (1, "a", "en", 2, "other"), (None, None, None, None, None),
            (None, "a", "en", 0, ""), (None, "a", "en", 0, ""), (3, "a", None, None, "Ö" * 2_000_000), (-7, "", "-", 1, "-")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("tree", "pos", "node", "n", "row", "at", "block")})
    assert proved(df) == expected(rows)
    for size in (0, 1):
        assert proved(spark.createDataFrame(rows[:size], SCHEMA)) == (expected(rows[:size]) if size else [])


def test_changed_texts_are_found(spark):
    rows = [(n, "s" if n % 3 else None, "en", n, "Abc" if n % 2 else "abc") for n in range(300)]
    claimed = F.when(F.col("doc_id") % 5 == 0, merkle.leaf_hash(*[lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in merkle.COLUMNS]))
    got = proved(spark.createDataFrame(rows, SCHEMA), claimed)
    assert got == expected(rows, lambda r: (*r[:4], r[4].lower()) if r[0] % 5 == 0 else None)
    assert {r[0] for r in got if r[3] != r[5]} == {n for n in range(300) if n % 5 == 0 and n % 2}


def test_frontier_gives_witnesses_as_siblings_end():
    tree = merkle.Frontier(4)
    leaves = [h(str(n)) for n in range(23)]
    for leaf in leaves:
        tree.append(leaf)
    assert [len(run) for run in tree.open] == [3, 1, 1]
    assert len(tree.witnesses[0]) == 2 and len(tree.witnesses[17]) == 1 and not tree.witnesses[22]
    root = tree.finish()
    assert all(merkle.fold(leaf, w) == root for leaf, w in zip(leaves, tree.witnesses))
