"""Token counts under a unigram model, computed once per shared prefix of distinct pre-tokens, each distinct one once a task."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from .common import byte_slices

SPACE = "\N{LOWER ONE EIGHTH BLOCK}"
SLICE_BYTES = 8 << 20
#: Characters of the pre-tokens whose counts a task keeps from slice to slice; beyond it, it starts again.
KEPT_CHARACTERS = 4 << 20
#: Fixed value: the model type of merge-rank files, TrainerSpec.model_type in the published format of model files.
MERGE_RANKS = 2
#: What a character that is no piece costs below the least likely piece.
PENALTY = 10.0


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol buffer message: whole numbers, or bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        field, kind = divmod(number(), 8)
        if kind == 0:
            yield field, number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            yield field, message[at:at + size]
            at += size


def model_type(proto: bytes) -> int:
    """The model type in the trainer's settings of a serialized model; 1, a unigram model, where none is stated."""
    trainer = b"".join(value for field, value in _fields(proto) if field == 2)
    return next((value for field, value in _fields(trainer) if field == 3), 1)


def piece_scores(model: str) -> dict[str, float]:
    """Log probabilities of the pieces of a model file.

    In a file of merge ranks, by the model type it states, scores are no probabilities: its pieces get Zipf's law over the
    ranks, -log(rank), equal ones ranked by id. Scores of other files are taken as they are. Control, byte and unused pieces
    have none, nor has one of a score that is not finite.
    """
    file = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces = [(file.id_to_piece(i), file.get_score(i)) for i in range(file.vocab_size())
              if not (file.is_control(i) or file.is_unknown(i) or file.is_byte(i) or file.is_unused(i))]
    if model_type(file.serialized_model_proto()) == MERGE_RANKS:
        ranked = sorted(pieces, key=lambda x: -x[1])
        return {p: -math.log(rank) for rank, (p, _) in enumerate(ranked, 1)}
    return {p: s for p, s in pieces if math.isfinite(s)}


def endings(scores: dict[str, float]) -> dict[str, float | None]:
    """All ends of pieces: the score of those that are pieces themselves, None for the others."""
    return dict.fromkeys((p[i:] for p in scores for i in range(1, len(p))), None) | scores


def terminal_counts(words: list[str], ends: dict[str, float | None], unknown: float) -> dict[str, int]:
    """Tokens of the likeliest segmentation of each word.

    The sorted distinct words are the leaves of a trie in depth-first order. Every node, a prefix, has the best score of
    any segmentation that ends there and its number of tokens, from the nodes above it; only the path to the current
    word is kept. The last piece is looked for from short to long, up to where nothing longer can end a piece; of equal
    scores the longest wins. A character that is no piece is as many tokens as it has bytes in UTF-8.
    """
    found: dict[str, int] = {}
    best, tokens = [0.0], [0]
    before = ""
    for word in sorted(words):
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        del best[shared + 1:], tokens[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            top, count = best[end - 1] + unknown, 0
            for start in range(end - 1, -1, -1):
                score = ends.get(word[start:end], False)
                if score is False:
                    break
                if score is not None and (score := score + best[start]) >= top:
                    top, count = score, tokens[start] + 1
            best.append(top)
            tokens.append(count or tokens[end - 1] + len(word[end - 1].encode()))
        found[word] = tokens[-1]
        before = word
    return found


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """Per document: doc_id, n_pretokens, n_tokens.

    A text gets a space in front; each space starts a pre-token, which has the space sign and what follows up to the next
    space, so that the pre-tokens give the text back. NULL and empty texts have none. The piece table (its
    size is that of the model file) goes to all tasks; documents are neither shuffled nor joined. A task walks the trie of the
    distinct pre-tokens of a slice that it has not counted before, and keeps terminal counts up to KEPT_CHARACTERS. Every row
    is counted by itself; other columns are ignored. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(piece_scores(model))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = shared.value
        ends = endings(scores)
        unknown = min(scores.values(), default=0.0) - PENALTY
        known, size = {}, 0
        for batch in batches:
            for lo, hi in byte_slices(batch["text"].cast(pa.binary()), SLICE_BYTES):
                texts = pc.fill_null(batch["text"].slice(lo, hi - lo), "")
                split = pc.split_pattern(texts, " ")  # an empty text has one empty part
                parts = split.flatten().dictionary_encode()
                words = parts.dictionary.to_pylist()
                if size > KEPT_CHARACTERS:
                    known, size = {}, 0
                new = [SPACE + w for w in words if w not in known]
                size += sum(map(len, new))
                known |= {w[1:]: n for w, n in terminal_counts(new, ends, unknown).items()}
                counts = np.array([known[w] for w in words], np.int64)[parts.indices.to_numpy()]
                sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
                tokens = np.add.reduceat(counts, np.cumsum(sizes) - sizes)
                filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(np.where(filled, sizes, 0)), pa.array(np.where(filled, tokens, 0))],
                    names=["doc_id", "n_pretokens", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_pretokens long, n_tokens long")
