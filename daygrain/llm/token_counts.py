"""Unigram token counts by trie-shared dynamic programming over distinct pre-tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from daygrain.llm.spans import chunks, span_hashes, word_spans
from daygrain.session import ship

#: Pre-tokens a Python worker remembers before it starts afresh.
REMEMBER = 1 << 21
SPACE_MARK = "▁"


class Unigram:
    """Pieces with log probabilities. A character no piece covers is spelt by as many byte tokens as it has bytes."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.byte = min(pieces.values(), default=0.0) - 10.0

    @classmethod
    def from_ranks(cls, path: str) -> Unigram:
        """The ordinary pieces of a public sentencepiece vocabulary under Zipf's law.

        Its file orders pieces by how early they were merged, which follows their frequency; the
        probability of rank r is taken as proportional to 1 / (r + 2.7).
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
        # Stored scores fall with the merge order; single characters come last of all.
        order = sorted(usual, key=lambda k: (-model.get_score(k), k))
        total = math.log(sum(1 / (r + 2.7) for r in range(1, len(order) + 1)))
        return cls({model.id_to_piece(k): -math.log(r + 2.7) - total for r, k in enumerate(order, 1)})

    def counts(self, words: list[str]) -> list[int]:
        """Tokens in the likeliest segmentation of each word; ties go to fewer tokens.

        The words go through a trie in sorted order: the scores of a prefix are computed once, when
        the walk first reaches its node, and stand on the path while words below it are visited.
        """
        found = [0] * len(words)
        best, number = [0.0], [0]
        path = ""
        pieces, longest, byte = self.pieces, self.longest, self.byte
        for k in sorted(range(len(words)), key=words.__getitem__):
            word = words[k]
            shared = 0
            for a, b in zip(path, word):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], number[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                size = len(word[end - 1].encode())
                top, few = best[end - 1] + size * byte, number[end - 1] + size
                for start in range(max(0, end - longest), end):
                    score = pieces.get(word[start:end])
                    if score is not None:
                        score += best[start]
                        if score > top or (score == top and number[start] + 1 < few):
                            top, few = score, number[start] + 1
                best.append(top)
                number.append(few)
            path = word
            found[k] = number[-1]
        return found


class Counter:
    """Counts by the hash of a pre-token, in a table that starts afresh when full."""

    def __init__(self, model: Unigram):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Token counts of the words at these spans."""
        keys, one, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        values = np.zeros(len(keys), np.int64)
        values[known] = self.values[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            raw = data.tobytes()
            words = [SPACE_MARK + raw[a:b].decode() for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist())]
            values[new] = self.model.counts(words)
            if len(self.keys) > REMEMBER:
                self.clear()
            where = np.searchsorted(self.keys, keys[new])
            self.keys, self.values = np.insert(self.keys, where, keys[new]), np.insert(self.values, where, values[new])
        return values[back]


_counters: dict[str, Counter] = {}


def _counted(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(Unigram.from_ranks(path))
        counter = _counters[path]
        for batch in batches:
            words, tokens = [], []
            for chunk in chunks(batch.column("text"), 4 << 20):
                starts, ends, first = word_spans(chunk)
                sums = np.concatenate(([0], np.cumsum(counter.look_up(chunk.bytes, starts, ends)))) if len(starts) else np.zeros(1, np.int64)
                words += np.diff(first).tolist()
                tokens += np.diff(sums[first]).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], ["doc_id", "n_pretokens", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_pretokens, n_tokens) of each row of ``docs`` (doc_id, text; more columns are ignored).

    Pre-tokens are the words between ASCII white space, each with a mark for the space before it.
    Null, empty and white-space texts have none of either. ``vocabulary`` is a sentencepiece file.
    """
    ship(docs.sparkSession)
    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(_counted(vocabulary), "doc_id bigint, n_pretokens bigint, n_tokens bigint")
