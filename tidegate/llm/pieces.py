"""SentencePiece encoding and decoding of merge-type (BPE) models by a table over prefixes.

Merging is described without merging: a sequence of pieces is the encoding of a text exactly when every piece encodes
to itself and every neighbouring pair encodes to that pair. So each prefix of a text has one last piece. For each
end position an automaton (Aho-Corasick over all pieces) names the pieces that end there; the one that is compatible
with the last piece of the prefix before it is the entry of the table. The ids are then read off backwards. The work
is linear in the text, also for words of any length.

No piece has a blank after another character, and no piece of several characters contains a line break. Texts are
therefore cut there, and what a run of characters gave is remembered (a bounded memo).

Defined cases: null is an empty text; an empty text has no ids and decodes to an empty text; characters that no piece
holds become byte pieces, or the unknown id where the model has no byte pieces; U+2581 counts as a blank, as in the
library.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tidegate.llm.frames import arrow_batch, map_arrow, texts
from tidegate.llm.words import Memo, chunks

BLANK = "▁"
RUN = re.compile(r" *[^ \n]+|\n| +")
UNKNOWN_TEXT = " ⁇ "
# Kinds of pieces in the model file (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
MERGE_MODEL = 2
# Pairs of pieces whose fit is remembered.
MOST_PAIRS = 800_000


class PieceModel:
    """Pieces of a merge-type model file, with encoding and decoding."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (model.trainer_spec.model_type != MERGE_MODEL or rules.precompiled_charsmap or rules.remove_extra_whitespaces
                or not rules.add_dummy_prefix or not rules.escape_whitespaces or kinds & {USER, UNUSED}):
            raise ValueError("only merge-type models that keep the text as it is are supported")
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.unknown = self.kinds.index(UNKNOWN)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte_values = {i: bytes([b]) for b, i in self.bytes.items()}
        normal = {p.piece.replace(BLANK, " "): (i, p.score) for i, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(re.search(r"[^ ] |\n.|.\n", text) for text in normal):
            raise ValueError("pieces cross word borders")
        self.ids = {text: i for text, (i, _) in normal.items()}
        self.scores = {text: score for text, (_, score) in normal.items()}
        self.texts = {i: text for text, i in self.ids.items()}
        self.decimal = list(map(str, range(len(self.pieces))))
        self.sizes = [len(self.texts.get(i, " ")) for i in range(len(self.pieces))]
        self.shown = [self.texts.get(i) for i in range(len(self.pieces))]
        # Pieces that do not encode to themselves never stand in an encoding.
        self.automaton = ahocorasick.Automaton()
        for text, i in self.ids.items():
            if len(text) == 1 or self.merged(text) == [text]:
                self.automaton.add_word(text, (i, len(text)))
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.memo = Memo(self._entries, entries=200_000, chars=7_000_000)

    def merged(self, text: str) -> list[str]:
        """What merging makes of a short text: best score first, leftmost among equals. Used for pairs of pieces only."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        if len(self.fits) > MOST_PAIRS:
            self.fits.clear()
        pair = [self.texts[left], self.texts[right]]
        known = self.fits[left << 16 | right] = self.merged(pair[0] + pair[1]) == pair
        return known

    def encode_run(self, text: str) -> list[int]:
        """Ids of a text, blanks as they are, by the prefix table. last[i] is the last piece of text[:i + 1]; -1 stands for
        a character without a piece, which merges with nothing. The entry behind the text is that of the empty prefix."""
        last = [-1] * (len(text) + 1)
        known = self.fits.get
        filled = -1
        for end, (piece, count) in self.automaton.iter(text):
            if filled == end:
                continue
            left = last[end - count]
            if left >= 0:
                fit = known(left << 16 | piece)
                if fit is False or fit is None and not self.compatible(left, piece):
                    continue
            last[end] = piece
            filled = end
        ids: list[int] = []
        sizes = self.sizes
        at = len(text) - 1
        while at >= 0:
            piece = last[at]
            if piece >= 0:
                ids.append(piece)
                at -= sizes[piece]
                continue
            if self.bytes:
                ids.extend([self.bytes[b] for b in reversed(text[at].encode("utf-8"))])
            else:
                ids.append(self.unknown)
            at -= 1
        ids.reverse()
        return ids

    @staticmethod
    def runs(text: str) -> list[str]:
        """The text with its blank in front, cut where no piece crosses."""
        return RUN.findall(" " + text.replace(BLANK, " ")) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for run in self.runs(text) for i in self.encode_run(run)]

    def decode(self, ids: list[int]) -> str:
        """Text of ids: the blank put in front goes, control pieces are nothing, runs of byte pieces are read as UTF-8."""
        shown = self.decode_run(ids)
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        return shown[1:] if first is not None and self.kinds[first] == NORMAL and shown.startswith(" ") else shown

    def decode_run(self, ids: list[int]) -> str:
        out, pending = [], b""
        for i in ids:
            value = self.byte_values.get(i)
            if value is not None:
                pending += value
                continue
            if pending:
                out.append(_utf8(pending))
                pending = b""
            out.append(UNKNOWN_TEXT if i == self.unknown else "" if self.kinds[i] == CONTROL else self.texts[i])
        if pending:
            out.append(_utf8(pending))
        return "".join(out)

    def _entries(self, runs: list[str]) -> list[tuple[str, str]]:
        """Of each run: its ids as text, and what they decode to."""
        out, decimal, shown = [], self.decimal, self.shown
        for run in runs:
            ids = self.encode_run(run)
            parts = [shown[i] for i in ids]
            back = self.decode_run(ids) if None in parts else "".join(parts)
            # One text in memory, not two equal ones.
            out.append((",".join([decimal[i] for i in ids]), run if back == run else back))
        return out

    def round_trips(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """Of each whole text its ids as decimal numbers joined by commas, and the text they decode to."""
        for chunk in chunks(texts):
            for entries in self.memo.values_of([self.runs(text) for text in chunk]):
                # The first run begins with the blank put in front, which decoding takes off again.
                yield ",".join([e[0] for e in entries]), "".join([e[1] for e in entries])[1:]


def _utf8(data: bytes) -> str:
    """Bytes as text; each byte that belongs to no character becomes U+FFFD."""
    out = []
    while data:
        try:
            out.append(data.decode("utf-8"))
            break
        except UnicodeDecodeError as error:
            out.append(data[:error.start].decode("utf-8") + "�")
            data = data[error.start + 1:]
    return "".join(out)


@lru_cache(maxsize=2)
def model(path: str) -> PieceModel:
    """One model per Python worker."""
    return PieceModel(path)


def encode_decode(docs: DataFrame, path: str, with_text: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text; with_text adds ids (text) and decoded."""
    def run(batches):
        pieces = model(path)
        for batch in batches:
            count, ids_hash, text_hash, ids_text, decoded_text = [], [], [], [], []
            for ids, decoded in pieces.round_trips(batch.column("text").to_pylist()):
                count.append(ids.count(",") + 1 if ids else 0)
                ids_hash.append(hashlib.sha256(ids.encode("ascii")).hexdigest())
                text_hash.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                if with_text:
                    ids_text.append(ids)
                    decoded_text.append(decoded)
            more = {"ids": pa.array(ids_text, pa.string()), "decoded": pa.array(decoded_text, pa.string())} if with_text else {}
            yield arrow_batch(doc_id=batch.column("doc_id"), n_tokens=pa.array(count, pa.int64()),
                              ids_sha256=pa.array(ids_hash, pa.string()), decoded_sha256=pa.array(text_hash, pa.string()), **more)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_arrow(texts(docs), run, schema + (", ids string, decoded string" if with_text else ""))
