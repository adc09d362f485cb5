"""Token counts of a unigram segmentation, with scores shared in a trie.

A pre-token is a run without white space behind the mark of a word start. Its
tokens are the segmentation into vocabulary pieces with the smallest total
cost; the cost of a piece is the rounded -log of a Zipf probability of its rank
in the vocabulary file, a whole number, so sums are exact. Of equal costs the
segmentation with fewer tokens counts. A character outside the vocabulary costs
and counts one byte token per UTF-8 byte.

A task inserts the distinct pre-tokens it meets in a trie. Each node keeps the
forward score of its prefix, the best cost and token count of all segmentations
ending there. A shared prefix is scored once, and a node where a pre-token ends
stores its count. The trie is dropped when it reaches MAX_NODES, so memory is
bounded.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.common import extended, sliced, texts, travels, with_fields

travels(__name__)

MAX_NODES = 500_000
LONGEST = 64  # longer pre-tokens are scored without the trie
SCALE = 1000
_COST = 1 << 32  # a score is its cost times this plus its tokens, so that one sum and one comparison serve both
MARK = "▁"


class Vocabulary:
    def __init__(self, pieces: list[str], byte_cost: int):
        self.cost = {}
        for rank, piece in enumerate(pieces):
            self.cost.setdefault(piece, round(SCALE * math.log(rank + 2)))
        # The pieces read backwards, as a trie: all pieces that end at a place are met on one walk.
        self.ends: dict = {}
        for piece, cost in self.cost.items():
            node = self.ends
            for ch in reversed(piece):
                node = node.setdefault(ch, {})
            node[""] = cost * _COST + 1
        self.byte_cost = byte_cost

    @staticmethod
    def from_file(path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        return Vocabulary(usable, round(SCALE * math.log(len(usable) + 2)))

    def step(self, text: str, end: int, scores: list[int]) -> int:
        """Forward score of text[:end] from those of its shorter prefixes."""
        best, node = -1, self.ends
        for start in range(end - 1, -1, -1):
            node = node.get(text[start])
            if node is None:
                break
            piece = node.get("")
            if piece is not None:
                score = scores[start] + piece
                if score < best or best < 0:
                    best = score
        last = text[end - 1]
        if last not in self.cost:
            n = len(last.encode("utf-8", "surrogatepass"))
            score = scores[end - 1] + n * (self.byte_cost * _COST + 1)
            if score < best or best < 0:
                best = score
        return best

    def count(self, text: str) -> int:
        scores = [0]
        for end in range(1, len(text) + 1):
            scores.append(self.step(text, end, scores))
        return scores[-1] % _COST


class Trie:
    """Prefixes of pre-tokens with their forward scores; ``counts`` holds those of whole pre-tokens."""

    def __init__(self, vocabulary: Vocabulary, max_nodes: int = MAX_NODES):
        self.vocabulary, self.max_nodes = vocabulary, max_nodes
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int] | None] = [None]
        self.scores: list[int] = [0]
        self.counts: dict[str, int] = {}

    def count(self, pretoken: str) -> int:
        known = self.counts.get(pretoken)
        if known is None:
            text = MARK + pretoken
            if len(text) > LONGEST:
                return self.vocabulary.count(text)
            if len(self.scores) + len(text) > self.max_nodes:
                self.clear()
            known = self.counts[pretoken] = self._insert(text)
        return known

    def _insert(self, text: str) -> int:
        children, scores, step = self.children, self.scores, self.vocabulary.step
        node, path = 0, [0]
        for end, ch in enumerate(text, 1):
            below = children[node]
            if below is None:
                below = children[node] = {}
            child = below.get(ch)
            if child is None:
                child = below[ch] = len(scores)
                scores.append(step(text, end, path))
                children.append(None)
            path.append(scores[child])
            node = child
        return path[-1] % _COST


def count_tokens(docs: DataFrame, path: str | None = None, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``n_pretokens`` and ``n_tokens``; columns so named are replaced.

    A null or empty text, or one of white space, has none. Rows are counted one
    by one, whole: repeated rows alike, no rows give no rows. Nothing is
    shuffled. ``path`` is a sentencepiece vocabulary, by default the public one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        trie = Trie(Vocabulary.from_file(path or public_tokenizers.path("piece_bpe_32k.model")))
        for batch in sliced(batches):
            words, tokens = [], []
            for text in texts(batch, text_col):
                found = Counter(text.split()) if text else {}
                words.append(sum(found.values()))
                tokens.append(sum(n * trie.count(w) for w, n in found.items()))
            new = {"n_pretokens": pa.array(words, pa.int64()), "n_tokens": pa.array(tokens, pa.int64())}
            yield extended(batch, new)

    return docs.mapInArrow(run, with_fields(docs.schema, n_pretokens="long", n_tokens="long"))
