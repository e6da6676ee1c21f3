import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.corpus import frame, rows
from tests.llm.test_tokenizers import BYTES, ODD
from tidegate.llm import packing

WORDS = public_tokenizers.path("word_bpe_49k.json")
TRAPS = ["l'été d'Orléans.Ça va?", "it's I'LL 'Re", "a<|endoftext|>b <|STARTOFTEXT|>", "éa ño ́x á.b", "ΣΑΣ İstanbul ẞ", "a b\x85c\x1cd e",
         "x1y22 ½ ²", "...!?a|b;c:d,e", "한국어 한", "A.B,C!D E\n\nF\tG", "Éa.éB ÀÖØ×÷ö", "Ǆ. ŉ", "á̧b̧́"]


def check_plan(lengths, capacity):
    plan = packing.pack(np.array(lengths, np.int64), capacity)
    for doc, size in enumerate(lengths):
        own = sorted(plan[plan[:, 0] == doc].tolist(), key=lambda p: p[1])
        assert [p[1] for p in own] == [0, *np.cumsum([p[2] for p in own]).tolist()][:-1] and sum(p[2] for p in own) == size
    by_sequence = {}
    for _, _, length, sequence, offset in plan.tolist():
        assert offset == by_sequence.get(sequence, 0) and length > 0
        by_sequence[sequence] = offset + length
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    assert all(n == capacity or n < capacity and n & (n - 1) == 0 for n in by_sequence.values())
    return plan


def test_plans():
    random = np.random.default_rng(5)
    for _ in range(200):
        capacity = int(random.choice([8, 16, 100, 4096]))
        top = random.choice([2, capacity // 2 + 2, capacity + 1, 3 * capacity])
        check_plan(random.integers(1, top, random.integers(0, 60)).tolist(), capacity)
    check_plan([4096] * 3, 4096)
    check_plan([1365] * 30, 4096)
    check_plan([2049] * 9, 4096)


def test_classes_have_a_fixed_count_and_most_documents_stay_whole():
    rest = np.array([2100, 2000, 3000, 1400, 1500, 1900, 100, 2048, 1300, 1300])
    members, classes, filler = packing.fill_classes(rest, 4096)
    assert classes.tolist() == [1, 1, 2, 2] and members.tolist() == [0, 2, 1, 3, 4, 5] and sorted(filler.tolist()) == [6, 7, 8, 9]
    lengths = np.random.default_rng(2).lognormal(6.5, 1, 3000).astype(int) + 1
    assert len(check_plan(lengths.tolist(), 4096)) < 1.5 * len(lengths)


def test_ids_equal_the_library():
    own, other = packing.Coder(WORDS, 2), packing.Coder(BYTES, 2)
    assert own.by_run and not other.by_run
    plain = [t for t in [t for _, t in rows()] + ODD + TRAPS if "<|" not in (t or "")]
    for texts in (plain, [" ".join(plain[-20:])], ["\n".join(filter(None, plain))], ODD + TRAPS, [None], [], ["", None, " "], ["H\u0331 A\u030a", "A", "\u030a"]):
        for code in (own, other):
            flat, lengths = code.ids(pa.array(texts, pa.string()))
            want = [code.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
            assert lengths.tolist() == [len(ids) for ids in want] and flat.tolist() == [i for ids in want for i in ids]


@pytest.mark.parametrize("block,batch", [(packing.BLOCK_IDS, packing.BATCH_IDS), (9000, 5000)])
def test_pieces_hold_every_id_once(spark, block, batch):
    data = rows() + list(enumerate(ODD + TRAPS, 2000))
    library = Tokenizer.from_file(WORDS)
    coded = [(d, library.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in data]
    found = packing.packed(frame(spark, data), WORDS, 2, 4096, block, batch).withColumn("sum", F.crc32("ids"))
    pieces = found.collect()
    one_row = {d for d, _ in coded if [e for e, _ in coded].count(d) == 1}
    for d, ids in coded:
        if d in one_row:
            own = sorted((p for p in pieces if p.doc_id == d), key=lambda p: p.start)
            assert [i for p in own for i in np.frombuffer(p.ids, "<u4")] == ids and {p.doc_tokens for p in own} == {len(ids)}
            assert all(p.sum == zlib.crc32(np.array(ids[p.start:p.start + p.length], "<u4").tobytes()) for p in own)
    assert sum(p.length for p in pieces) == sum(len(ids) for _, ids in coded)
    together = packing.sequences(found).collect()
    by_sequence = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == len(by_sequence.get(p.sequence_id, b"")) // 4
        by_sequence[p.sequence_id] = by_sequence.get(p.sequence_id, b"") + bytes(p.ids)
    assert {r.sequence_id: bytes(r.ids) for r in together} == by_sequence
    sizes = [len(b) // 4 for b in by_sequence.values()]
    assert all(n == 4096 or n < 4096 and n & (n - 1) == 0 for n in sizes) and sizes.count(4096) > 10


def test_empty_table(spark):
    assert packing.packed(frame(spark, []), WORDS, 2).count() == 0
