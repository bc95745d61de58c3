"""Token counts by trie-shared dynamic programming.

A pre-token is a word with the vocabulary's word mark in front. Its tokens are those of the best
path of a unigram model: the segmentation into pieces with the largest sum of log probabilities,
and of the fewest pieces among equals. The distinct pre-tokens of a slab go into a trie character
by character; the best score of a prefix is worked out when its node is made and shared by all
pre-tokens that begin with it, and the end of a pre-token stores its count. Nothing is shuffled: a
task keeps its trie from slab to slab and begins a new one beyond ``MAX_NODES``.

The given vocabularies hold ranks, not probabilities; a piece of rank r counts as ``-log(r + 2)``, a
character outside the vocabulary as its UTF-8 bytes at ``BYTE_SCORE`` each.

Defined cases: null and empty texts have no tokens; an empty table gives an empty result; repeated
rows are counted each; other columns are ignored; a word of any length is scored whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyloom.llm.text import LARGE_SLAB_BYTES, slabs, word_hashes, words_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
WORD_MARK = "▁"
BYTE_SCORE = -20.0
MAX_NODES = 1_000_000
#: Pre-tokens of more characters share no prefixes with others.
LONG = 1000


def load_pieces(path: str = VOCABULARY) -> dict[str, float]:
    """Pieces and scores of a sentencepiece vocabulary, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return {model.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(usable)}


class Trie:
    """Prefixes of pre-tokens. A node is a number; per node its last character, the node before it,
    its best score and the pieces on the best path."""

    def __init__(self, pieces: Mapping[str, float]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.before, self.last = [-1], [""]
        self.score, self.count = [0.0], [0]

    def _grow(self, node: int, char: str) -> int:
        before, last, score, count = self.before, self.last, self.score, self.count
        size = len(char.encode())
        best, fewest = score[node] + BYTE_SCORE * size, count[node] + size
        piece, at = char, node
        for _ in range(self.longest):
            own = self.pieces.get(piece)
            if own is not None:
                total, pieces = score[at] + own, count[at] + 1
                if total > best or (total == best and pieces < fewest):
                    best, fewest = total, pieces
            if at == 0:
                break
            piece = last[at] + piece
            at = before[at]
        made = len(before)
        self.child[node, char] = made
        before.append(node)
        last.append(char)
        score.append(best)
        count.append(fewest)
        return made

    def tokens(self, pretoken: str) -> int:
        """Tokens of a pre-token; prefixes seen before are not scored again. Long ones get a trie
        of their own, cut behind them while they are read: a path needs no node before the longest
        piece's start."""
        if len(pretoken) > LONG:
            return self._tokens_of_long(pretoken)
        node, child = 0, self.child
        for char in pretoken:
            made = child.get((node, char))
            node = self._grow(node, char) if made is None else made
        return self.count[node]

    def _tokens_of_long(self, pretoken: str) -> int:
        own, node = Trie(self.pieces), 0
        for char in pretoken:
            if len(own.before) > LONG:
                keep = range(len(own.before) - own.longest - 1, len(own.before))
                own.last, own.score, own.count = ([x[k] for k in keep] for x in (own.last, own.score, own.count))
                own.before, own.child = list(range(-1, len(keep) - 1)), {}
                node = len(keep) - 1
            node = own._grow(node, char)
        return own.count[node]


def count_tokens(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens of every row; ``path`` names the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(shared.value)
        for batch in slabs(batches, LARGE_SLAB_BYTES):
            words = words_of(batch.column("text"))
            _, first, which = np.unique(word_hashes(words), return_index=True, return_inverse=True)
            data = words.data.tobytes()
            spans = zip(words.starts[first].tolist(), words.ends[first].tolist(), strict=True)
            tokens = []
            for word in sorted((data[a:b].decode(errors="replace"), k) for k, (a, b) in enumerate(spans)):
                if len(trie.before) > MAX_NODES:
                    trie.clear()
                tokens.append((word[1], trie.tokens(WORD_MARK + word[0])))
            per_word = np.zeros(len(first), dtype=np.int64)
            if tokens:
                at, n = np.array(tokens).T
                per_word[at] = n
            sums = np.concatenate([[0], np.cumsum(per_word[which])])
            columns = [batch.column("doc_id"), pa.array(np.diff(words.first)), pa.array(np.diff(sums[words.first]))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_tokens long")
