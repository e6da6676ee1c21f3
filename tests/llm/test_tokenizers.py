import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, normalizers
from tokenizers.models import Unigram

from tests.llm.corpus import frame, rows
from tidegate.llm import pieces, tokenfiles, unigram

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a  b", "  a", "a\n\nb ", "▁x", " ", "x" * 500, "aaaa  " * 30, " \n ", " " * 40, "ab" * 3000, "don't 12's", "\t\t  x", "a   b"]


def test_pieces_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    data = rows() + list(enumerate(ODD, 2000))
    got = pieces.encode_decode(frame(spark, data), PIECES, with_text=True).collect()
    want = []
    for d, text in data:
        ids = library.encode(text or "")
        joined, decoded = ",".join(map(str, ids)), library.decode(ids)
        want.append((d, len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), joined, decoded))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_decoding_of_any_ids():
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.model(PIECES)
    random = np.random.default_rng(1)
    for _ in range(3000):
        ids = random.choice(np.concatenate([np.arange(300), random.integers(0, 32000, 100)]), random.integers(0, 8)).tolist()
        assert own.decode(ids) == library.decode(ids)


def test_other_kinds_of_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PIECES, "rb").read())
    model.trainer_spec.model_type = 1
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.PieceModel(str(tmp_path / "m"))


def test_counts_equal_the_library(spark):
    library = Tokenizer(Unigram(unigram.vocabulary(PIECES), 0, True))
    library.normalizer = normalizers.Sequence([normalizers.Prepend("▁"), normalizers.Replace(" ", "▁")])
    data = rows() + list(enumerate(ODD, 2000))
    got = unigram.token_counts(frame(spark, data), PIECES).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((d, len(library.encode(t or "").ids)) for d, t in data), key=str)


def test_first_start_wins_among_equal_scores():
    base = [(f"<0x{b:02X}>", -9.0) for b in range(256)]
    counter = unigram.Counter(base + [("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0)])
    assert counter.count_run("aaa") == (1, -3.0) and counter.count_run("aab") == (2, -3.0)
    assert counter.count_run("é") == (2, -19.0)


def test_token_files(spark, tmp_path):
    library = Tokenizer.from_file(BYTES)
    data = rows() + list(enumerate(ODD, 2000))
    folder = f"file://{tmp_path}/tokens"
    manifest = tokenfiles.write(frame(spark, data), BYTES, 2, folder)
    got = list(map(tuple, tokenfiles.read(spark, folder).collect()))
    coded = [(d, library.encode(t or "", add_special_tokens=False).ids + [2])
             for d, t in sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))]
    start, want = 0, []
    for d, ids in coded:
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want and manifest["total"] == start
    assert [tokenfiles.tokens(spark, folder, i).tolist() for i in (0, 5, len(data) - 1)] == [coded[i][1] for i in (0, 5, len(data) - 1)]
    with pytest.raises(IndexError):
        tokenfiles.tokens(spark, folder, len(data))


def test_empty_tables(spark):
    assert tokenfiles.round_trip(frame(spark, []), BYTES).count() == 0
    assert pieces.encode_decode(frame(spark, []), PIECES).count() == 0
    assert unigram.token_counts(frame(spark, []), PIECES).count() == 0


def test_pairs_of_many_texts_stay_known_and_are_bounded(monkeypatch):
    import sentencepiece

    own, library = pieces.PieceModel(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    text = "".join(t or "" for _, t in rows())[:20_000]
    # Pairs that no text has; a corpus of several languages has some hundred thousand.
    own.fits.update({-1 - i: True for i in range(400_000)})
    assert own.encode(text) == library.encode(text) and len(own.fits) > 400_000
    monkeypatch.setattr(pieces, "MOST_PAIRS", 10)
    assert own.encode(text + " Xyz") == library.encode(text + " Xyz") and own.encode(text[::-1]) == library.encode(text[::-1])
    assert len(own.fits) <= 11


def test_decoded_run_is_no_second_copy():
    run = " governed"
    assert pieces.PieceModel(PIECES)._entries([run])[0][1] is run
