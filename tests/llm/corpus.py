"""Small documents with all the cases that operators must survive, and plain helpers."""

import random
import re

LOWER = {i: i + 32 for i in range(65, 91)}
BLANKS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Names that operators use themselves.
CLASHES = ("row", "score", "found", "kept", "block", "n_words", "label", "unit", "node", "component", "predicted", "place")


def rows(count=60, seed=7):
    """(doc_id, text): nulls, blanks, copies, near copies, shared passages, repeated rows and one long text."""
    pick = random.Random(seed)
    vocabulary = [("".join(pick.choice("abcdeö") for _ in range(pick.randint(1, 7)))) for _ in range(300)]

    def words(n):
        return [pick.choice(vocabulary) for _ in range(n)]

    passage, base = words(70), words(120)
    out = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (6, "two words"), (7, "a b c d"), (None, "no id here"), (None, None),
           (8, " ".join(base)), (9, " ".join(base)), (9, " ".join(base)), (10, "\n".join(base)), (11, " ".join(base).upper())]
    for i in range(12, 12 + count):
        kind = i % 6
        if kind == 0:
            text = words(30) + passage + words(20)
        elif kind == 1:
            text = list(base)
            for _ in range(pick.randint(0, 6)):
                text[pick.randrange(len(text))] = "edit"
        elif kind == 2:
            text = passage[:pick.randint(45, 70)]
        elif kind == 3:
            text = passage + passage
        else:
            text = words(pick.randint(1, 200))
        out.append((i, pick.choice([" ", "  ", "\n"]).join(text)))
    out.append((1000, " ".join(words(20_000))))
    out.append((1001, "x" * 100_000))
    out.append((1002, "<s>\x00 <|endoftext|> ▁▁ 　 é\t中😀 a\x1cb \x85"))
    return out


def frame(spark, data, clashes=True):
    """Documents as a frame, with extra columns under the operators' own names."""
    df = spark.createDataFrame(data, "doc_id long, text string")
    return df.selectExpr("*", *(f"'x' AS {c}" for c in CLASHES)) if clashes else df


def least_components(nodes, pairs):
    """{node: smallest node reachable over the pairs}"""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}
