"""Token counts by a unigram segmentation, with forward scores shared along a trie of words.

The best segmentation of a word depends on its prefixes only, so words that begin alike share work.
The distinct words of a batch are put in order, which walks their trie depth first: from one
word to the next, the forward scores of the common prefix stay and only the rest is computed. Each
word end keeps its count, and documents add up the counts of their words.
"""

from __future__ import annotations

import itertools
import math
import os.path
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = "doc_id long, n_words long, n_tokens long"

#: What stands for the space before a word.
SPACE = "▁"
#: Rows whose distinct words are walked together, and words whose counts a worker keeps.
ROWS_AT_ONCE = 1000
MOST_WORDS = 200_000
LONGEST_WORD = 64
#: Depth to which forward scores are kept for the next word; beyond it they are computed again.
DEEPEST = 256
#: Log-probability of a byte of a character that no piece covers, below that of the rarest piece.
BYTE_PENALTY = 10.0

_counters: dict[str, Counter] = {}


def vocabulary(path: str | None = None) -> dict[str, float]:
    """Pieces and their log-probabilities.

    The file ranks its pieces; a unigram model needs probabilities. They follow from the ranks by Zipf's
    law, so that nothing is trained.
    """
    from sentencepiece import SentencePieceProcessor

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    known = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    known.sort(key=lambda i: (-model.get_score(i), i))
    norm = math.log(sum(1 / rank for rank in range(1, len(known) + 1)))
    return {model.id_to_piece(i): -math.log(rank) - norm for rank, i in enumerate(known, 1)}


class Counter:
    """Counts of words by the most probable segmentation, the one of fewest pieces among equals."""

    def __init__(self, pieces: dict[str, float]):
        self.root: dict = {}
        for piece, score in pieces.items():
            node = self.root
            for c in piece:
                node = node.setdefault(c, {})
            node[""] = score
        self.byte = min(pieces.values(), default=0.0) - BYTE_PENALTY
        self.known: dict[bytes, int] = {}

    def counts(self, words: list[str]) -> list[int]:
        """Of every word, which come in code point order."""
        # At every depth of the current word, as far as `DEEPEST`: the best (score, -pieces), and pieces begun and not ended.
        best: list[tuple[float, int]] = [(0.0, 0)]
        begun: list[list[tuple[tuple[float, int], dict]]] = [[]]
        found, before = [], ""
        for word in words:
            shared = min(len(os.path.commonprefix((before, word))), len(best) - 1)
            del best[shared + 1 :], begun[shared + 1 :]
            start, going = best[-1], begun[-1]
            for c in itertools.islice(word, shared, None):
                start, going = self._step(c, start, going)
                if len(best) <= DEEPEST:
                    best.append(start)
                    begun.append(going)
            found.append(-start[1])
            before = word
        return found

    def _step(self, c: str, start: tuple[float, int], begun: list[tuple[tuple[float, int], dict]]):
        """The best score behind one more character, and the pieces begun and not ended there."""
        here, going = None, []
        for origin, node in [*begun, (start, self.root)]:
            child = node.get(c)
            if child is not None:
                going.append((origin, child))
                if "" in child:
                    ended = (origin[0] + child[""], origin[1] - 1)
                    if here is None or ended > here:
                        here = ended
        if c not in self.root or "" not in self.root[c]:
            n = len(c.encode("utf-8", "surrogatepass"))
            spelled = (start[0] + n * self.byte, start[1] - n)
            if here is None or spelled > here:
                here = spelled
        return here, going

    def totals(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """(words, tokens) of every text."""
        if len(self.known) > MOST_WORDS:
            self.known.clear()
        split = [t.split() for t in texts]
        missing = {w for words in split for w in words if w not in self.known}
        named = sorted((SPACE + w.decode("utf-8", "replace"), w) for w in missing)
        fresh = dict(zip((w for _, w in named), self.counts([n for n, _ in named])))
        kept = {w: n for w, n in fresh.items() if len(w) <= LONGEST_WORD}
        self.known.update(kept)
        count = self.known if len(kept) == len(fresh) else {**self.known, **fresh}
        return [(len(words), sum(map(count.__getitem__, words))) for words in split]


def counter(path: str | None) -> Counter:
    """One for each file in a worker."""
    if path not in _counters:
        _counters[path] = Counter(vocabulary(path))
    return _counters[path]


def token_counts(docs: DataFrame, tokenizer: str | None = None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens for every document.

    Words are runs of characters other than ASCII white space. A word, with a space mark before it, is cut
    into the pieces of the `tokenizer` file whose summed log-probability is highest; a character that
    is no piece may be spelled in bytes. A null or blank text has none. Every row is counted, rows
    without an id and rows that share one too. Other columns are ignored. A word of any length, such as a
    text without spaces, takes time in proportion to its length and no memory besides its own.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(tokenizer)
        for part in parts:
            found = []
            for at in range(0, len(part), ROWS_AT_ONCE):
                found += words.totals([t or b"" for t in part.column("text").slice(at, ROWS_AT_ONCE).to_pylist()])
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", "n_words", "n_tokens"])

    return source.mapInArrow(count, ROWS)
