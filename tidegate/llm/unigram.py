"""Token counts of a unigram vocabulary without the tokens: count-only Viterbi.

An Aho-Corasick automaton lists the pieces that end at each character; the best score of each prefix and the number of
pieces it takes are carried along, nothing else. The rules are those of the tokenizers library's Unigram model: among
equal scores the piece that starts first stays; a character that is no piece itself may stand alone at the lowest score
less 10, and counts as its UTF-8 bytes. Scores are 64-bit; those of the vocabulary used here are whole numbers, so
sums are exact in any order.

Before that, a blank is put in front of the text and blanks become U+2581. No piece has a blank behind another
character, so texts are cut there, and what a run of characters counts is remembered (a bounded memo).

Defined cases: null is an empty text; an empty text has no tokens and the score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegate.llm.frames import arrow_batch, map_arrow, texts
from tidegate.llm.words import Memo, chunks

BLANK = "▁"
RUN = re.compile(f"{BLANK}*[^{BLANK}\n]+|\n|{BLANK}+")
# Fixed value of the library: how far an unknown character lies below the lowest score.
UNKNOWN_PENALTY = 10.0


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a model file, in the order of their ids."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return [(p.piece, float(p.score)) for p in model.pieces]


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        known = {p for p, _ in pieces}
        if not all(f"<0x{b:02X}>" in known for b in range(256)):
            raise ValueError("the vocabulary lacks byte pieces")
        # Unknown neighbours are looked up together by the library; that never finds a piece if this holds.
        self.single = {p for p in known if len(p) == 1}
        if any(len(p) > 1 and not self.single.intersection(p) for p in known if not re.fullmatch("<0x..>", p)):
            raise ValueError("a piece consists of unknown characters")
        if any(re.search(f"[^{BLANK}]{BLANK}|\n.|.\n", p, re.S) for p in known):
            raise ValueError("pieces cross word borders")
        self.unknown = min(score for _, score in pieces) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        for piece, score in dict(pieces).items():
            self.automaton.add_word(piece, (score, len(piece)))
        self.automaton.make_automaton()
        self.memo = Memo(lambda runs: list(map(self.count_run, runs)), entries=150_000, chars=6_000_000)

    def count_run(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best way through a text."""
        size, single, unknown = len(text), self.single, self.unknown
        best: list[float | None] = [0.0] + [None] * size
        count = [0] * (size + 1)

        def close(at: int) -> None:
            """Let the character before this place stand alone if it is no piece; all its other ways are known."""
            char = text[at - 1]
            if char not in single:
                score = best[at - 1] + unknown
                if best[at] is None or score > best[at]:
                    best[at], count[at] = score, count[at - 1] + len(char.encode("utf-8"))

        at = 0
        # The pieces that end at a place come longest first, so the one that starts first is kept among equals.
        for end, (score, length) in self.automaton.iter(text):
            while at < end:
                at += 1
                close(at)
            before = end + 1 - length
            score += best[before]
            if best[end + 1] is None or score > best[end + 1]:
                best[end + 1], count[end + 1] = score, count[before] + 1
        while at < size:
            at += 1
            close(at)
        return count[size], best[size]

    def count_each(self, texts: list[str | None]) -> Iterator[tuple[int, float]]:
        """(pieces, score) of each text."""
        for chunk in chunks(texts):
            runs = [RUN.findall(BLANK + t.replace(" ", BLANK)) if t else [] for t in chunk]
            for found in self.memo.values_of(runs):
                yield sum([n for n, _ in found]), float(sum([s for _, s in found]))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """One counter per Python worker."""
    return Counter(vocabulary(path))


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and score of every whole text."""
    def run(batches):
        found = counter(path)
        for batch in batches:
            rows = list(found.count_each(batch.column("text").to_pylist()))
            yield arrow_batch(doc_id=batch.column("doc_id"), n_tokens=pa.array([n for n, _ in rows], pa.int64()),
                              score=pa.array([s for _, s in rows], pa.float64()))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(texts(docs), run, f"doc_id {id_type}, n_tokens long, score double")
