import hashlib
import random
import zlib

import pytest

from tests.llm.corpus import CLASHES
from tidegate.llm import manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    values = (None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text))
    return sha(*("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(leaves):
    """Root, and for each leaf its [(left, right)] up to it."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place // 3 * 3
            paths[i].append(("".join(level[run:place]), "".join(level[place + 1:run + 3])))
            at[i] = place // 3
        level = [sha(*level[i:i + 3]) for i in range(0, len(level), 3)]
    return level[0], paths


def brute(data):
    groups = {}
    for row in data:
        groups.setdefault(row[3], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for rows in groups.values():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r)))
    trees = {s: tree([leaf_of(*r) for r in groups[s]]) for s in names}
    root, tops = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for row, path in zip(groups[s], trees[s][1]):
            doc_id, text = row[:2]
            altered = text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
            node = leaf_of(doc_id, text.replace("\n", "") if altered else text, *row[2:])
            for left, right in path + top:
                node = sha(left, node, right)
            out.append((doc_id, leaf_of(*row), trees[s][0], root, sha(*(a + b for a, b in path + top)), node, node == root))
    return out


def documents(sizes, seed=4):
    pick, data = random.Random(seed), []
    for source, count in sizes.items():
        for _ in range(count):
            text = pick.choice([None, "", "plain", "two\nlines", "ä\n\n漢 " * pick.randint(1, 9)])
            data.append((pick.choice([None, 5, pick.randint(0, 10**6)]), text, pick.choice([None, "de", "en"]), source, pick.choice([None, 3])))
    pick.shuffle(data)
    return data


@pytest.mark.parametrize("sizes", [
    {None: 5, "": 1, "a": 2, "b": 3, "B": 4, "é": 9, "z": 10, "src": 27, "src0": 28, "hot": 300},
    {"one": 1}, {"full": 81, "over": 82, "low": 243, "high": 244},
    {f"s{i}": 1 + i % 3 for i in range(100)}])
def test_equals_brute_force(spark, sizes):
    data = documents(sizes)
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", *(f"'x' AS {c}" for c in (*CLASHES, "group", "key", "digest", "own", "steps", "members")))
    got = manifest.proofs(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute(data), key=str)


def test_repeated_rows_are_leaves_of_their_own(spark):
    data = [(1, "same\nrow", "en", "s", 8)] * 500 + [(None, None, None, None, None)] * 100
    got = sorted(map(tuple, manifest.proofs(spark.createDataFrame(data, SCHEMA).repartition(8)).collect()), key=str)
    assert got == sorted(brute(data), key=str)


def test_ranks_are_dense_however_rows_are_dealt(spark):
    data = documents({"hot": 700, "b": 50, None: 30})
    rows = spark.createDataFrame(data, SCHEMA).selectExpr("source AS `group`", "doc_id AS key", "coalesce(text, '-') AS digest", "n_chars AS own")
    found = {}
    for r in manifest.ranked(rows, "leaves").collect():
        found.setdefault((r["group"], r["size"]), []).append(r["low"])
    assert {g: sorted(v) for g, v in found.items()} == {("hot", 700): list(range(700)), ("b", 50): list(range(50)), (None, 30): list(range(30))}


def test_one_changed_row_breaks_only_its_own_proof(spark):
    data = [(i, "a\nb", "en", f"s{i % 4}", 3) for i in range(200)]
    got = manifest.proofs(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r.doc_id for r in got if not r.verified} == {i for i in range(200) if zlib.crc32(str(i).encode()) % 2 == 0}


def test_empty_table(spark):
    assert manifest.proofs(spark.createDataFrame([], SCHEMA)).count() == 0
