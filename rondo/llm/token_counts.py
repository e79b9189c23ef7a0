"""Token counts under a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton of the vocabulary finds every piece that ends at each character. Dynamic programming carries
the best score of each prefix and the number of its pieces, and nothing else. Words, split at white space and marked with
the vocabulary's word sign in front, are tokenised one by one, as the tokenizer's own splitter does it, so a word's count
is computed once and remembered.

The tie rules are the unigram model's: pieces that start further left are tried first, and only a strictly better score
replaces a found one. A character that no piece covers is unknown and costs ten less than the worst piece. Adjacent unknown
characters are one unknown token, or, with byte pieces in the vocabulary, a token for each of its bytes.

Public vocabularies at hand have ranks, not probabilities; a piece of rank r gets the score -log(r + 2), Zipf's law. Defined
cases: null, empty and blank texts have no tokens. Null and repeated ids are counted like others. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = "▁"
#: Words a task remembers before it starts afresh, and characters of a text it splits at once.
WORDS, SEGMENT = 500_000, 1 << 20


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model's normal pieces, and its byte pieces with the score 0."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out, rank = [], 0
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            out.append((model.id_to_piece(i), 0.0))
        elif not (model.is_unknown(i) or model.is_control(i)):
            out.append((model.id_to_piece(i), -math.log(rank + 2)))
            rank += 1
    return out


def _is_byte(piece: str) -> bool:
    return len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")


class Counter:
    """Counts the pieces of words."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if not _is_byte(piece):
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.bytes = sum(_is_byte(p) for p, _ in pieces) == 256
        self.unknown = min((s for p, s in pieces if not _is_byte(p)), default=0.0) - 10.0

    def count(self, word: str) -> int:
        """Pieces of the best segmentation; ``word`` carries its word sign."""
        ends: list[list[tuple[int, float]]] = [[] for _ in word]
        for end, found in self.automaton.iter(word):
            ends[end].append(found)
        best, pieces, unknown = [0.0], [0], [False]
        for end, found in enumerate(ends):
            score = tokens = None
            lost = False
            # Longest first: those start furthest left.
            for length, value in sorted(found, reverse=True):
                start = end + 1 - length
                if score is None or best[start] + value > score:
                    score, tokens = best[start] + value, pieces[start] + 1
            if not any(length == 1 for length, _ in found):
                # No piece is this character alone: it may be unknown.
                if score is None or best[end] + self.unknown > score:
                    lost, score = True, best[end] + self.unknown
                    cost = len(word[end].encode()) if self.bytes else int(not unknown[end])
                    tokens = pieces[end] + cost
            best.append(score)
            pieces.append(tokens)
            unknown.append(lost)
        return pieces[-1]


def _words(text: str) -> Iterator[list[str]]:
    at = 0
    while len(text) - at > SEGMENT:
        cut = text.rfind(" ", at + 1, at + SEGMENT)
        cut = cut if cut > 0 else text.find(" ", at + SEGMENT)
        if cut < 0:
            break
        yield text[at:cut].split()
        at = cut
    yield text[at:].split()


def _count(pieces: list[tuple[str, float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, known = Counter(pieces), {}
        for batch in batches:
            tokens, words = [], []
            for text in batch.column("_text"):
                total = number = 0
                for part in _words(text.as_py() or ""):
                    if len(known) > WORDS:
                        known.clear()
                    for word in set(part):
                        if word not in known:
                            known[word] = counter.count(WORD + word)
                    total += sum(map(known.__getitem__, part))
                    number += len(part)
                tokens.append(total)
                words.append(number)
            columns = [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_tokens of every document; one pass, no shuffle."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_count(pieces), f"doc_id {kind}, n_words long, n_tokens long")
