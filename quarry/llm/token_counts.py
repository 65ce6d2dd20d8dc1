"""Token counts under a unigram model, by dynamic programming shared along a trie.

Every distinct pre-token is inserted once into a trie. A trie node stands for a prefix and
holds the best score with which pieces of the vocabulary make up that prefix, and how many
pieces that takes; a new node looks only at the nodes above it, so words that share a prefix
share its scores. The count at a word's last node is remembered for the word.

The vocabulary is that of a public SentencePiece file. A piece's log-probability follows its
rank by Zipf's law: -log(rank + 1), up to a constant. Characters outside the vocabulary fall
back to one token per UTF-8 byte, each scored below every piece.

Tries live in the workers and hold at most ``NODES`` nodes; a full one starts anew, which
changes no count. Ties in score go to fewer pieces.

Defined cases: NULL and blank texts have 0 tokens; NULL and repeated ids keep one row each;
an empty table gives an empty result; columns named as those added are replaced.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import BLANK, read, use_package

#: Nodes of a worker's trie, and words whose counts it remembers.
NODES = 800_000
WORDS = 400_000
#: Longest word that stays in the trie.
LONG = 64
#: Lengths of pieces that are tried at every place.
SHORT = (1, 2)
#: Fixed value: SentencePiece's mark for the start of a word.
MARK = "▁"


def vocabulary(path: str) -> dict[str, float]:
    """Pieces and their log-probabilities; control and byte pieces are left out."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return {sp.id_to_piece(i): -math.log(i + 1) for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}


class Trie:
    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        # the lengths to try where a prefix ends, by its last three characters
        lengths: dict[str, set[int]] = {}
        for piece in pieces:
            if len(piece) > 2:
                lengths.setdefault(piece[-3:], set()).add(len(piece))
        self.lengths = {end: (*SHORT, *sorted(n)) for end, n in lengths.items()}
        self.fallback = min(pieces.values(), default=0.0) - 1.0
        self.clear()

    def clear(self) -> None:
        # a node is found by its prefix; its value is (score, -tokens)
        self.nodes: dict[str, tuple[float, int]] = {"": (0.0, 0)}

    def insert(self, word: str) -> int:
        """The number of tokens of a word's best segmentation."""
        nodes, pieces = self.nodes, self.pieces
        if len(nodes) > NODES:
            self.clear()
            nodes = self.nodes
        keep = len(word) <= LONG
        known = len(word) if keep else 0
        while word[:known] not in nodes:
            known -= 1
        path = [nodes[word[:end]] for end in range(known + 1)]
        for end in range(known + 1, len(word) + 1):
            last = word[end - 1]
            size = 1 if last < "\x80" else len(last.encode("utf-8", "replace"))
            score, tokens = path[end - 1]
            score, tokens = score + size * self.fallback, tokens - size
            for n in self.lengths.get(word[end - 3 : end], SHORT) if end > 2 else SHORT[:end]:
                if n <= end:
                    piece = pieces.get(word[end - n : end])
                    if piece is not None:
                        above = path[end - n]
                        total = above[0] + piece
                        if total > score or (total == score and above[1] - 1 > tokens):
                            score, tokens = total, above[1] - 1
            best = (score, tokens)
            path.append(best)
            if keep:
                nodes[word[:end]] = best
        return -path[-1][1]


class Counts(dict):
    """Token counts of words, filled in from the trie."""

    def __init__(self, trie: Trie):
        super().__init__()
        self.trie = trie

    def __missing__(self, word: str) -> int:
        n = self.trie.insert(MARK + word)
        if len(self) >= WORDS:
            self.clear()
        if len(word) <= LONG:
            self[word] = n
        return n


@functools.cache
def counts(path: str) -> Counts:
    return Counts(Trie(vocabulary(path)))


_blanks = str.maketrans(dict.fromkeys(BLANK, " "))


def pre_tokens(text: str | None) -> list[str]:
    return [w for w in (text or "").translate(_blanks).split(" ") if w]


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with ``n_words`` and ``n_tokens`` of the whole text."""

    use_package(docs.sparkSession)

    @F.arrow_udf("struct<words: long, tokens: long>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = counts(path)
        for batch in batches:
            words, tokens = [], []
            for at in range(0, len(batch), 64):
                for t in batch.slice(at, 64).to_pylist():
                    found = pre_tokens(t)
                    words.append(len(found))
                    tokens.append(sum(map(known.__getitem__, found)))
            yield pa.StructArray.from_arrays([pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["words", "tokens"])

    out = docs.withColumn("__n", run(F.col(text)))
    return out.withColumns({"n_words": F.col("__n.words"), "n_tokens": F.col("__n.tokens")}).drop("__n")


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, vocabulary_path()).select("doc_id", "n_words", "n_tokens")
