"""Token counts of a unigram model by dynamic programming over a trie.

A unigram model splits a pre-token (a word with its leading mark) into the pieces of highest total
log probability. The forward score of a prefix does not depend on what follows, so pre-tokens that
share a prefix share its scores: the distinct pre-tokens of a batch of documents are put into a
trie, each node's forward score and number of pieces is computed once from its ancestors, and the
counts at the terminal nodes are what documents add up.

Documents are processed where they are read; nothing is shuffled, and a batch's trie is bounded.
The vocabulary comes from a public tokenizer file whose path is a parameter. No public unigram
model is at hand, so scores follow Zipf's law over the file's ranks (a piece of rank r has
probability proportional to 1 / (r + 1)); a model with scores of its own can be passed instead.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Pieces longer than this are left out of the model, so a node looks at that many ancestors.
LONGEST = 16
#: Documents of one trie hold about this many characters.
BATCH_CHARS = 4_000_000
#: A pre-token is any run of characters other than ASCII white space.
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Score of one byte of a character that no piece covers; below any piece.
BYTE_SCORE = -25.0


@dataclass(frozen=True)
class Unigram:
    """Piece -> log probability. A character outside the pieces costs one token per byte."""

    scores: dict[str, float]

    @staticmethod
    def from_file(path: str = VOCABULARY) -> Unigram:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
        return Unigram({p: -math.log(r + 1) - total for r, p in enumerate(pieces)
                        if len(p) <= LONGEST})


def trie_counts(words: list[str], scores: dict[str, float]) -> dict[str, int]:
    """Pieces of the best split of each distinct word.

    Words are inserted in sorted order. A node of the trie is a prefix; its best score and number
    of pieces stand in ``best`` and ``pieces`` at its depth while the walk is below it, so a shared
    prefix is scored once. Equal scores take the longer last piece.
    """
    known, longest = scores.get, LONGEST
    best, pieces, path, counts = [0.0], [0], "", {}
    for word in sorted(words):
        shared, limit = 0, min(len(path), len(word))
        while shared < limit and path[shared] == word[shared]:
            shared += 1
        del best[shared + 1:], pieces[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            top, count = -math.inf, 0
            for start in range(max(0, end - longest), end):
                score = known(word[start:end])
                if score is not None and best[start] + score > top:
                    top, count = best[start] + score, pieces[start] + 1
            if word[end - 1] not in scores:
                size = len(word[end - 1].encode("utf-8", "surrogatepass"))
                fallback = best[end - 1] + size * BYTE_SCORE
                if fallback > top:
                    top, count = fallback, pieces[end - 1] + size
            best.append(top)
            pieces.append(count)
        path = word
        counts[word] = pieces[len(word)]
    return counts


def token_counts(docs: DataFrame, model: Unigram | None = None, path: str = VOCABULARY,
                 batch_chars: int = BATCH_CHARS) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row of ``docs``.

    Null, empty and blank texts have no tokens. Repeated rows are counted each; null ids are kept.
    """
    given = model.scores if model else None
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches):
        scores = given if given is not None else Unigram.from_file(path).scores
        cached: dict[str, int] = {}
        for batch in batches:
            ids, texts, at = batch.column(0), batch.column(1), 0
            while at < len(ids):
                held, chars, first = [], 0, at
                while at < len(ids) and (at == first or chars < batch_chars):
                    words = Counter(_WORD.findall(texts[at].as_py() or ""))
                    chars += sum(map(len, words))
                    held.append(words)
                    at += 1
                fresh = set().union(*held).difference(cached)
                if len(cached) > 200_000:
                    cached, fresh = {}, set().union(*held)
                marked = trie_counts([MARK + w for w in fresh], scores)
                cached.update((w, marked[MARK + w]) for w in fresh)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, at - first),
                    pa.array([sum(w.values()) for w in held], pa.int64()),
                    pa.array([sum(n * cached[k] for k, n in w.items()) for w in held],
                             pa.int64()),
                ], schema=schema)

    narrow = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text")
    return narrow.mapInArrow(run, "doc_id bigint, n_words bigint, n_tokens bigint")
