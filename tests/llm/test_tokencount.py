import math
import random

import pytest
import sentencepiece

from loanfold.llm import tokencount
from tests.llm.helpers import documents

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def plain(word, scores):
    """Best (score, tokens) of a word by trying every last piece, longest first."""
    unknown = min(scores.values()) - tokencount.PENALTY
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + scores[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in scores]
        options.append((best[end - 1][0] + unknown, best[end - 1][1] + len(word[end - 1].encode())))
        best.append(max(options, key=lambda o: o[0]))
    return best[-1][1]


@pytest.mark.parametrize("kept,sliced", [(tokencount.KEPT_CHARACTERS, tokencount.SLICE_BYTES), (20, 60), (10_000, 60)])
def test_as_by_brute_force(spark, monkeypatch, kept, sliced):
    monkeypatch.setattr(tokencount, "KEPT_CHARACTERS", kept)
    monkeypatch.setattr(tokencount, "SLICE_BYTES", sliced)
    scores = tokencount.piece_scores(MODEL)
    rng = random.Random(2)
    words = ["the", "there", "thereafter", "Übung", "naïve", "日本語", "x" * 40, "\n", "a\tb", "😀", "1234", "word,"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 30)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " "), (63, "a  b "), (None, "the there"), (3, rows[3][1]), (64, "thereafter " * 40_000)]
    found = tokencount.count_tokens(documents(spark, rows, extra=True), MODEL).collect()
    known = {w: plain(w, scores) for w in {"▁" + w for _, t in rows if t for w in t.split(" ")}}
    expected = []
    for i, t in rows:
        split = ["▁" + w for w in t.split(" ")] if t else []
        expected.append((i, len(split), sum(known[w] for w in split)))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert tokencount.count_tokens(documents(spark, []).filter("false"), MODEL).collect() == []


@pytest.mark.parametrize("scores", [{"a": -1.0, "aa": -2.0, "aaa": -3.0}, {"ab": -1.0, "abc": -1.5, "c": -0.5}])
def test_ties_take_the_longest_last_piece(scores):
    words = ["a" * n for n in range(1, 7)] + ["abc", "abcabc", "ab", "zab"]
    found = tokencount.terminal_counts(words, tokencount.endings(scores), min(scores.values()) - tokencount.PENALTY)
    assert found == {w: plain(w, scores) for w in words}


def test_model_type_is_read_from_the_file():
    proto = sentencepiece.SentencePieceProcessor(model_file=MODEL).serialized_model_proto()
    assert tokencount.model_type(proto) == tokencount.MERGE_RANKS
    piece = b"\x0a\x05\x0a\x03abc"
    assert tokencount.model_type(piece) == 1
    assert tokencount.model_type(piece + b"\x12\x06\x12\x02xy\x18\x03") == 3
    assert tokencount.model_type(piece + b"\x12\x07\x15\x00\x00\x80\x3f\x18\x02") == 2


def test_no_piece_of_low_score_is_dropped():
    file = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    low = [file.id_to_piece(i) for i in range(file.vocab_size()) if file.get_score(i) <= -1e6 and not file.is_byte(i)]
    scores = tokencount.piece_scores(MODEL)
    assert low and set(low) <= set(scores) and max(scores[p] for p in low) < -9


def test_scores_of_a_unigram_model_are_taken_as_they_are(monkeypatch):
    class File:
        pieces = [("<unk>", 0.0), ("a", -1.5), ("rare", -2e6), ("b", -250.0), ("none", -math.inf)]

        def __init__(self, model_file):
            pass

        def vocab_size(self):
            return len(self.pieces)

        def id_to_piece(self, i):
            return self.pieces[i][0]

        def get_score(self, i):
            return self.pieces[i][1]

        def is_unknown(self, i):
            return i == 0

        def serialized_model_proto(self):
            return b"\x12\x02\x18\x01"

        is_control = is_byte = is_unused = lambda self, i: False

    monkeypatch.setattr(tokencount.sentencepiece, "SentencePieceProcessor", File)
    assert tokencount.piece_scores("any") == {"a": -1.5, "rare": -2e6, "b": -250.0}
